"""Queries over projections, filters, cleaning, functions, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.functions import expressions as X
from tablework.operators import aggregates as A
from tablework.operators import clean as C
from tablework.operators import joins as J
from tablework.plans import property as P
from tablework.schemas import table
from tablework.workload.fixtures import Fixtures
from tablework.workload.registry import query

TODAY = "2024-06-30"


def today():
    return F.lit(TODAY).cast("date")


@query(
    "p01_prefix_project",
    "SELECT user_id AS train_user_id, event_type AS train_event_type, value AS train_value, event_id AS train_event_id FROM events",
)
def p01(fx: Fixtures) -> DataFrame:
    return C.prefix_columns(fx.table("events").select("user_id", "event_type", "value", "event_id"), "train")


@query("p02_select_list", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def p02(fx: Fixtures) -> DataFrame:
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    return fx.table("orders").select(*columns)


@query(
    "p03_cast",
    """SELECT Year, TailNum, TRY_CAST(ArrDelay AS INT) AS ArrDelay, CAST(AirTime AS INT) AS AirTime,
      TRY_CAST(CarrierDelay AS DOUBLE) AS CarrierDelay FROM flights""",
    ("flights",),
)
def p03(fx: Fixtures) -> DataFrame:
    data = fx.flights().select("Year", "TailNum", "ArrDelay", "AirTime", "CarrierDelay")
    return C.cast_columns(data, {"ArrDelay": "int", "AirTime": "int", "CarrierDelay": "double"})


@query("p04_drop", "SELECT * EXCLUDE (datetime, row_id) FROM readings", ("readings",))
def p04(fx: Fixtures) -> DataFrame:
    return fx.readings().drop("datetime", "row_id")


@query(
    "p05_filter_range",
    "SELECT * FROM readings WHERE data_block_id > 3 AND data_block_id <= 20 AND target <> 0",
    ("readings",),
)
def p05(fx: Fixtures) -> DataFrame:
    block = F.col("data_block_id")
    return fx.readings().where((block > 3) & (block <= 20) & (F.col("target") != 0))


@query("p06_isin", "SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def p06(fx: Fixtures) -> DataFrame:
    return fx.table("orders").where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))


@query(
    "p07_not_null_count",
    """SELECT count(parcelid) AS complete FROM properties WHERE roomcnt IS NOT NULL AND yearbuilt IS NOT NULL
      AND yardbuildingsqft17 IS NOT NULL AND unitcnt IS NOT NULL AND lotsizesquarefeet IS NOT NULL AND fips IS NOT NULL""",
    ("properties",),
)
def p07(fx: Fixtures) -> DataFrame:
    cols = ["roomcnt", "yearbuilt", "yardbuildingsqft17", "unitcnt", "lotsizesquarefeet", "fips"]
    return C.complete_rows(fx.properties(), cols).agg(F.count("parcelid").alias("complete"))


@query(
    "p08_col_neq",
    """SELECT parcelid, roomcnt, unitcnt, fips FROM properties
      WHERE roomcnt IS NOT NULL AND roomcnt <> unitcnt OR roomcnt <> fips OR unitcnt <> poolcnt""",
    ("properties",),
)
def p08(fx: Fixtures) -> DataFrame:
    rooms, units = F.col("roomcnt"), F.col("unitcnt")
    keep = (rooms.isNotNull() & (rooms != units)) | (rooms != F.col("fips")) | (units != F.col("poolcnt"))
    return fx.properties().where(keep).select("parcelid", "roomcnt", "unitcnt", "fips")


@query("p09_dropna_any", "SELECT * FROM readings WHERE target IS NOT NULL", ("readings",))
def p09(fx: Fixtures) -> DataFrame:
    return C.complete_rows(fx.readings())


@query(
    "p10_dropna_subset",
    "SELECT * FROM properties WHERE fips IS NOT NULL AND roomcnt IS NOT NULL",
    ("properties",),
)
def p10(fx: Fixtures) -> DataFrame:
    return C.complete_rows(fx.properties(), ["fips", "roomcnt"])


@query(
    "p11_fillna",
    """SELECT parcelid, coalesce(lotsizesquarefeet, 0) AS lotsizesquarefeet, coalesce(unitcnt, 0) AS unitcnt,
      coalesce(yearbuilt, 0) AS yearbuilt, coalesce(decktypeid, 0) AS decktypeid FROM properties""",
    ("properties",),
)
def p11(fx: Fixtures) -> DataFrame:
    data = fx.properties().select("parcelid", "lotsizesquarefeet", "unitcnt", "yearbuilt", "decktypeid")
    return C.fill_nulls(data, {c: 0 for c in data.columns[1:]})


@query(
    "p12_fill_mode",
    """WITH m AS (SELECT
        (SELECT roomcnt FROM properties WHERE roomcnt IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS r,
        (SELECT unitcnt FROM properties WHERE unitcnt IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS u,
        (SELECT p_type FROM properties WHERE p_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS t)
      SELECT parcelid, coalesce(roomcnt, r) AS roomcnt, coalesce(unitcnt, u) AS unitcnt, coalesce(p_type, t) AS p_type
      FROM properties, m""",
    ("properties",),
)
def p12(fx: Fixtures) -> DataFrame:
    return C.fill_mode(fx.properties().select("parcelid", "roomcnt", "unitcnt", "p_type"), ["roomcnt", "unitcnt", "p_type"])


@query(
    "p13_flags",
    """SELECT parcelid, CASE WHEN decktypeid IS NULL THEN 0 ELSE 1 END AS hasdeck,
      CASE WHEN poolcnt IS NULL AND decktypeid IS NULL THEN 0 ELSE 1 END AS hashottub,
      CASE WHEN lotsizesquarefeet IS NULL THEN 0 ELSE 1 END AS lotexists,
      CASE WHEN poolcnt IS NULL THEN 'No' ELSE 'Yes' END AS pool FROM properties""",
    ("properties",),
)
def p13(fx: Fixtures) -> DataFrame:
    return fx.properties().select(
        "parcelid",
        X.presence_flag("decktypeid").alias("hasdeck"),
        X.presence_flag("poolcnt", "decktypeid").alias("hashottub"),
        X.presence_flag("lotsizesquarefeet").alias("lotexists"),
        X.yes_no("poolcnt").alias("pool"),
    )


@query(
    "p14_buckets",
    f"""SELECT parcelid,
      CASE WHEN yearbuilt IS NULL THEN NULL WHEN year(DATE '{TODAY}') - yearbuilt <= 10 THEN '0 - 10 years old'
        WHEN year(DATE '{TODAY}') - yearbuilt <= 60 THEN '10 - 60 years old' ELSE '60 or more years old' END AS Age_Group,
      CASE WHEN yardbuildingsqft17 IS NULL OR yardbuildingsqft17 = 0 THEN 'none' WHEN yardbuildingsqft17 < 0 THEN NULL
        WHEN yardbuildingsqft17 < 200 THEN 'small' WHEN yardbuildingsqft17 < 300 THEN 'medium'
        WHEN yardbuildingsqft17 < 400 THEN 'large' ELSE 'extra_large' END AS patiosize,
      CASE WHEN roomcnt IS NULL OR roomcnt = 0 THEN 'none' WHEN roomcnt <= 4 THEN 'small' WHEN roomcnt <= 8 THEN 'medium'
        ELSE 'large' END AS roomcntcat,
      CAST(CASE WHEN unitcnt IS NULL THEN 0 WHEN unitcnt >= 5 THEN 5 ELSE unitcnt END AS INT) AS unitcntcat
      FROM properties""",
    ("properties",),
)
def p14(fx: Fixtures) -> DataFrame:
    return fx.properties().select(
        "parcelid",
        P.age_group("yearbuilt", today()).alias("Age_Group"),
        P.patio_size().alias("patiosize"),
        P.room_category().alias("roomcntcat"),
        P.unit_category().alias("unitcntcat"),
    )


# The range labels of the counted buckets.
PATIO_RANGES = ["<200", "200-300", "300-400", ">400"]
TAX_RANGES = ["<1000", "1000-10000", "10000-100000", "100000-1000000", "Over_1000000"]


def patio_bucket():
    return X.bucketize("yardbuildingsqft17", [200, 300, 400], PATIO_RANGES)


def tax_bucket():
    return X.bucketize("taxvaluedollarcnt", [1000, 10000, 100000, 1000000], TAX_RANGES, null_label="Null")


@query(
    "p15_bucket_counts",
    """SELECT 'patio' AS what, CASE WHEN yardbuildingsqft17 < 200 THEN '<200' WHEN yardbuildingsqft17 < 300 THEN '200-300'
        WHEN yardbuildingsqft17 < 400 THEN '300-400' WHEN yardbuildingsqft17 >= 400 THEN '>400' END AS bucket,
        count(*) AS total_within_range FROM properties GROUP BY 2
      UNION ALL
      SELECT 'tax', CASE WHEN taxvaluedollarcnt IS NULL THEN 'Null' WHEN taxvaluedollarcnt < 1000 THEN '<1000'
        WHEN taxvaluedollarcnt < 10000 THEN '1000-10000' WHEN taxvaluedollarcnt < 100000 THEN '10000-100000'
        WHEN taxvaluedollarcnt < 1000000 THEN '100000-1000000' ELSE 'Over_1000000' END, count(*)
      FROM properties GROUP BY 2""",
    ("properties",),
)
def p15(fx: Fixtures) -> DataFrame:
    a = A.bucket_counts(fx.properties(), patio_bucket()).select(F.lit("patio").alias("what"), "*")
    b = A.bucket_counts(fx.properties(), tax_bucket()).select(F.lit("tax").alias("what"), "*")
    return a.unionByName(b)


@query(
    "p16_years_bucket",
    """SELECT parcelid, CASE WHEN coalesce(yearbuilt, 0) = 0 THEN 'No Structure' WHEN yearbuilt < 1960 THEN 'Over 60 Years'
      WHEN yearbuilt < 2010 THEN '10 to 50 years old' ELSE 'Newer than 10 years' END AS agegroup FROM properties""",
    ("properties",),
)
def p16(fx: Fixtures) -> DataFrame:
    return fx.properties().select("parcelid", P.built_category().alias("agegroup"))


@query(
    "p17_late_flag",
    "SELECT Year, TailNum, ArrDelay, TRY_CAST(ArrDelay AS INT) > 0 AS LateArrival FROM flights",
    ("flights",),
)
def p17(fx: Fixtures) -> DataFrame:
    late = X.late_flag(X.parse_number("ArrDelay", "int"))
    return fx.flights().select("Year", "TailNum", "ArrDelay", late.alias("LateArrival"))


@query(
    "p18_ratios",
    """SELECT parcelid, landtaxvaluedollarcnt / nullif(lotsizesquarefeet, 0) AS landpricepersqft,
      taxvaluedollarcnt / nullif(lotsizesquarefeet, 0) AS totalpricepersqft,
      (taxvaluedollarcnt - landtaxvaluedollarcnt) / nullif(lotsizesquarefeet, 0) AS structurepricepersqft,
      parcelid / 1000000 AS lat, round(landtaxvaluedollarcnt / nullif(lotsizesquarefeet * 100, 0), 0) AS landestimate_tens,
      round(yearbuilt / 10, 0) AS yearbuilt_group FROM properties""",
    ("properties",),
)
def p18(fx: Fixtures) -> DataFrame:
    land, tax, lot = (F.col(c) for c in ("landtaxvaluedollarcnt", "taxvaluedollarcnt", "lotsizesquarefeet"))
    return fx.properties().select(
        "parcelid",
        X.ratio(land, lot).alias("landpricepersqft"),
        X.ratio(tax, lot).alias("totalpricepersqft"),
        X.ratio(tax - land, lot).alias("structurepricepersqft"),
        (F.col("parcelid") / 1e6).alias("lat"),
        F.round(X.ratio(land, lot * 100), 0).alias("landestimate_tens"),
        F.round(F.col("yearbuilt") / 10, 0).alias("yearbuilt_group"),
    )


@query(
    "p19_parity_rule",
    """SELECT parcelid, CASE WHEN taxvaluedollarcnt % 2 = 0 THEN taxvaluedollarcnt * 1.03::DOUBLE
      ELSE taxvaluedollarcnt * 0.98::DOUBLE END AS zestimate FROM properties WHERE file_year = 2016""",
    ("properties",),
)
def p19(fx: Fixtures) -> DataFrame:
    data = fx.properties().where(F.col("file_year") == 2016)
    return data.select("parcelid", X.parity_estimate("taxvaluedollarcnt").alias("zestimate"))


@query(
    "p20_sentinel",
    "SELECT Year, TailNum, coalesce(TRY_CAST(CarrierDelay AS DOUBLE), 0) AS CarrierDelay FROM flights",
    ("flights",),
)
def p20(fx: Fixtures) -> DataFrame:
    return fx.flights().select("Year", "TailNum", X.sentinel_to_zero("CarrierDelay").alias("CarrierDelay"))


@query("p21_distinct", "SELECT DISTINCT Origin, Dest FROM flights", ("flights",))
def p21(fx: Fixtures) -> DataFrame:
    return fx.flights().select("Origin", "Dest").distinct()


@query(
    "p22_first_per_key",
    """SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate FROM (SELECT *, row_number() OVER
      (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def p22(fx: Fixtures) -> DataFrame:
    data = fx.table("orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return C.first_per_key(data, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "p23_hash_sample",
    """SELECT o_orderkey, o_totalprice FROM orders
      WHERE CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE < 0.1::DOUBLE""",
)
def p23(fx: Fixtures) -> DataFrame:
    return C.hash_sample(fx.table("orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 0.1)


@query(
    "p23_random_sample",
)
def p23_random(fx: Fixtures) -> DataFrame:
    return C.random_sample(fx.table("orders").select("o_orderkey", "o_totalprice"), 0.1, 12345)


@query("p24_parse_money", "SELECT id, line, price_num AS price FROM houses", ("houses",))
def p24(fx: Fixtures) -> DataFrame:
    return fx.houses().select("id", "line", X.parse_money("price").alias("price"))


@query(
    "p25_age_features",
    """SELECT id, line, CAST(sold - yr_built AS INT) AS years_since_built,
      CAST(CASE WHEN yr_renovated <> 0 THEN sold - yr_renovated ELSE sold - yr_built END AS INT) AS years_since_renovated
      FROM houses""",
    ("houses",),
)
def p25(fx: Fixtures) -> DataFrame:
    return fx.houses().select(
        "id",
        "line",
        (F.col("sold") - F.col("yr_built")).alias("years_since_built"),
        X.years_since_renewal("sold", "yr_built", "yr_renovated").alias("years_since_renovated"),
    )


@query(
    "p26_binary_flag",
    "SELECT id, line, CASE WHEN sqft_basement = 0 THEN 0 ELSE 1 END AS has_basement FROM houses",
    ("houses",),
)
def p26(fx: Fixtures) -> DataFrame:
    return fx.houses().select("id", "line", X.binary_flag("sqft_basement").alias("has_basement"))


@query(
    "p27_cardinality",
    """SELECT column_name, n_distinct, n_distinct <= 15 AS is_categorical FROM (
      SELECT 'roomcnt' AS column_name, count(DISTINCT roomcnt) AS n_distinct FROM properties
      UNION ALL SELECT 'unitcnt', count(DISTINCT unitcnt) FROM properties
      UNION ALL SELECT 'yearbuilt', count(DISTINCT yearbuilt) FROM properties
      UNION ALL SELECT 'p_type', count(DISTINCT p_type) FROM properties
      UNION ALL SELECT 'parcelid', count(DISTINCT parcelid) FROM properties)""",
    ("properties",),
)
def p27(fx: Fixtures) -> DataFrame:
    return C.detect_categoricals(fx.properties().select("roomcnt", "unitcnt", "yearbuilt", "p_type", "parcelid"))


@query(
    "p28_one_hot",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS status_F,
      CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS status_O,
      CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS status_P FROM orders""",
)
def p28(fx: Fixtures) -> DataFrame:
    return C.one_hot(fx.table("orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", "status")


K07_SCHEMA = table("row_id bigint not null", "target double not null", "datetime timestamp_ntz not null")


@query(
    "k07_enforce_schema",
    """SELECT 'ok' AS outcome, count(*) AS n_rows, sum(row_id)::BIGINT AS id_sum FROM readings WHERE target IS NOT NULL
      UNION ALL SELECT 'rejected', count(*), sum(row_id)::BIGINT FROM readings WHERE target IS NULL""",
    ("readings",),
)
def k07(fx: Fixtures) -> DataFrame:
    text = fx.readings().select(
        F.col("row_id").cast("string").alias("row_id"),
        F.coalesce(F.col("target").cast("string"), F.lit("NA")).alias("target"),
        F.col("datetime").cast("string").alias("datetime"),
    )
    ok, rejected = C.enforce_schema(text, K07_SCHEMA)

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("row_id").cast("long")).alias("id_sum")).select(
            F.lit(name).alias("outcome"), "*"
        )

    return counted(ok, "ok").unionByName(counted(rejected, "rejected"))


@query("o01_sort", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey")
def o01(fx: Fixtures) -> DataFrame:
    data = fx.table("orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return A.sort_rows(data, ["o_orderdate"], ["o_orderkey"])


@query(
    "o02_topk",
    """SELECT CAST(datetime AS DATE) AS date, round(sum(target), 4) AS total FROM readings GROUP BY 1 ORDER BY 1 DESC LIMIT 10""",
    ("readings",),
)
def o02(fx: Fixtures) -> DataFrame:
    daily = fx.readings().groupBy(F.to_date("datetime").alias("date")).agg(F.round(F.sum("target"), 4).alias("total"))
    return A.latest(daily, "date", 10)


@query(
    "o03_best_worst",
    """WITH t AS (SELECT l_partkey AS item, count(*) AS n, avg(CAST(1 + (l_orderkey + l_linenumber) % 5 AS INT)) AS m FROM lineitem GROUP BY 1 HAVING count(*) > 15)
      SELECT * FROM (SELECT 'best' AS kind, item, round(m, 6) AS m FROM t ORDER BY t.m DESC, item LIMIT 20)
      UNION ALL SELECT * FROM (SELECT 'worst', item, round(m, 6) FROM t ORDER BY t.m, item LIMIT 20)""",
)
def o03(fx: Fixtures) -> DataFrame:
    score = (1 + (F.col("l_orderkey") + F.col("l_linenumber")) % 5).cast("int")
    scores = A.item_means(fx.table("lineitem").select(F.col("l_partkey").alias("item"), score.alias("s")), "item", "s")

    def edge(kind: str, order) -> DataFrame:
        return scores.orderBy(order, "item").limit(20).select(
            F.lit(kind).alias("kind"), "item", F.round("average_rating", 6).alias("m")
        )

    return edge("best", F.desc("average_rating")).unionByName(edge("worst", F.asc("average_rating")))


@query("o04_limit", "SELECT least(count(*), 10000) AS n_rows FROM orders")
def o04(fx: Fixtures) -> DataFrame:
    return fx.table("orders").limit(10000).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "u01_union_files",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE year(o_orderdate) < 1995
      UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE year(o_orderdate) >= 1995
      UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'""",
)
def u01(fx: Fixtures) -> DataFrame:
    o = fx.table("orders")
    cols = ["o_orderkey", "o_custkey", "o_totalprice"]
    year = F.year("o_orderdate")
    return (
        o.where(year < 1995).select(cols)
        .unionByName(o.where(year >= 1995).select(cols))
        .unionByName(o.where(F.col("o_orderstatus") == "P").select(cols))
    )


@query(
    "u02_difference",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def u02(fx: Fixtures) -> DataFrame:
    existing = fx.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return J.new_rows(fx.table("orders").select("o_orderkey", "o_totalprice"), existing, ["o_orderkey"])


@query(
    "f_date",
    f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(CAST(o_orderdate AS DATE) + 1 AS DATE) AS next_day,
      CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '{TODAY}') AS INT) AS age_days, CAST(year(o_orderdate) AS INT) AS y,
      CAST(year(DATE '{TODAY}' - INTERVAL 10 YEAR) AS INT) AS y10, CAST(date_trunc('hour', o_orderdate) AS TIMESTAMP) AS h
      FROM orders""",
)
def f_date(fx: Fixtures) -> DataFrame:
    day = F.to_date("o_orderdate")
    return fx.table("orders").select(
        "o_orderkey",
        day.alias("d"),
        F.date_add(day, 1).alias("next_day"),
        F.datediff(today(), day).alias("age_days"),
        F.year("o_orderdate").alias("y"),
        F.year(F.add_months(today(), -120)).alias("y10"),
        F.date_trunc("hour", "o_orderdate").cast("timestamp_ntz").alias("h"),
    )


@query(
    "f_string",
    """SELECT p_partkey, lpad(CAST(p_size AS VARCHAR), 5, '0') AS padded, substr(lpad(CAST(p_size AS VARCHAR), 5, '0'), 1, 2) AS prefix,
      list_extract(string_split(p_brand, '#'), -1) AS last_part, concat(p_brand, p_type, p_size) AS joined,
      trim('  ' || p_name || ' ') AS trimmed, regexp_replace(p_name, '[aeiou]', '', 'g') AS no_vowels,
      substr(p_name, 2, length(p_name)) AS tail FROM part""",
)
def f_string(fx: Fixtures) -> DataFrame:
    padded = F.lpad(F.col("p_size").cast("string"), 5, "0")
    return fx.table("part").select(
        "p_partkey",
        padded.alias("padded"),
        F.substring(padded, 1, 2).alias("prefix"),
        F.element_at(F.split("p_brand", "#"), -1).alias("last_part"),
        F.concat("p_brand", "p_type", F.col("p_size").cast("string")).alias("joined"),
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
        F.regexp_replace("p_name", "[aeiou]", "").alias("no_vowels"),
        F.substr("p_name", F.lit(2), F.length("p_name")).alias("tail"),
    )


@query(
    "f_math",
    """SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 6) AS net, CAST(l_orderkey % 7 AS INT) AS m,
      l_quantity / nullif(l_tax, 0) AS q, round(ln(l_extendedprice), 9) AS logp, round(exp(l_discount), 9) AS expd,
      format('{:,.0f}', l_extendedprice) AS text FROM lineitem""",
)
def f_math(fx: Fixtures) -> DataFrame:
    price = F.col("l_extendedprice")
    return fx.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(price * (1 - F.col("l_discount")), 6).alias("net"),
        F.expr("CAST(mod(l_orderkey, 7) AS INT)").alias("m"),
        X.ratio("l_quantity", "l_tax").alias("q"),
        F.round(F.ln(price), 9).alias("logp"),
        F.round(F.exp("l_discount"), 9).alias("expd"),
        X.format_pattern(price, ",###").alias("text"),
    )


@query(
    "f_conditional",
    """SELECT row_id, coalesce(target, 0) AS filled, CASE WHEN target IS NULL THEN 'none' WHEN target > 10 THEN 'high' ELSE 'low' END AS level,
      (target > 10) IS TRUE AS is_high, target IS NULL AS missing, TRY_CAST(CASE WHEN county = 3 THEN 'NA' ELSE CAST(county AS VARCHAR) END AS INT) AS code
      FROM readings""",
    ("readings",),
)
def f_conditional(fx: Fixtures) -> DataFrame:
    t = F.col("target")
    code = F.when(F.col("county") == 3, "NA").otherwise(F.col("county").cast("string"))
    return fx.readings().select(
        "row_id",
        F.coalesce(t, F.lit(0.0)).alias("filled"),
        F.when(t.isNull(), "none").when(t > 10, "high").otherwise("low").alias("level"),
        F.coalesce(t > 10, F.lit(False)).alias("is_high"),
        t.isNull().alias("missing"),
        X.parse_number(code, "int").alias("code"),
    )


@query(
    "f_array",
    """SELECT o_custkey, count(DISTINCT o_orderpriority) AS n,
      array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS priorities FROM orders GROUP BY 1""",
)
def f_array(fx: Fixtures) -> DataFrame:
    # The set is bounded by the number of different priorities.
    items = F.sort_array(F.collect_set("o_orderpriority"))
    return (
        fx.table("orders").groupBy("o_custkey").agg(items.alias("_i"))
        .select("o_custkey", F.size("_i").cast("long").alias("n"), F.array_join("_i", ",").alias("priorities"))
    )

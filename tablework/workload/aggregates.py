"""Queries over aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.operators import aggregates as A
from tablework.operators.clean import complete_rows
from tablework.workload.fixtures import Fixtures
from tablework.workload.joins import rounded
from tablework.workload.registry import query
from tablework.workload.relational import patio_bucket


@query(
    "a01_value_counts",
    "SELECT Origin, Dest, Cancelled, count(*) AS count FROM flights GROUP BY 1, 2, 3",
    ("flights",),
)
def a01(fx: Fixtures) -> DataFrame:
    return A.value_counts(fx.flights(), "Origin", "Dest", "Cancelled")


@query(
    "a02_daily_sums",
    """SELECT CAST(datetime AS DATE) AS date, round(sum(CASE WHEN is_consumption = 1 THEN target END), 4) AS total_consumption_amt,
      round(sum(CASE WHEN is_consumption = 0 THEN target END), 4) AS total_production_amt FROM readings GROUP BY 1""",
    ("readings",),
)
def a02(fx: Fixtures) -> DataFrame:
    return rounded(A.consumption_production(fx.readings(), how="full").drop("net_amt"), 4)


@query(
    "a03_median_avg",
    """SELECT CAST(datetime AS DATE) AS forecast_date, round(median(target), 9) AS price_median, round(avg(target), 9) AS price_average
      FROM readings GROUP BY 1""",
    ("readings",),
)
def a03(fx: Fixtures) -> DataFrame:
    return rounded(A.price_stats(fx.readings(), F.to_date("datetime"), {"target": "price"}), 9)


@query(
    "a04_energy_prices",
    """WITH e AS (SELECT CAST(forecast_date AS DATE) AS d, median(euros_per_mwh) AS m, avg(euros_per_mwh) AS a FROM electricity_prices GROUP BY 1),
      g AS (SELECT forecast_date AS d, median(lowest_price_per_mwh) AS lm, avg(lowest_price_per_mwh) AS la,
        median(highest_price_per_mwh) AS hm, avg(highest_price_per_mwh) AS ha FROM gas_prices GROUP BY 1)
      SELECT coalesce(e.d, g.d) AS forecast_date, round(m, 11) AS electricity_price_per_mwh_median, round(a, 11) AS electricity_price_per_mwh_average,
        round(lm, 11) AS gas_lowest_price_per_mwh_median, round(la, 11) AS gas_lowest_price_per_mwh_average,
        round(hm, 11) AS gas_highest_price_per_mwh_median, round(ha, 11) AS gas_highest_price_per_mwh_average
      FROM e FULL OUTER JOIN g ON e.d = g.d""",
    ("electricity_prices", "gas_prices"),
)
def a04(fx: Fixtures) -> DataFrame:
    return rounded(A.energy_prices_daily(fx.electricity_prices(), fx.gas_prices()), 11)


@query(
    "a05_count_distinct",
    """SELECT Year, count(DISTINCT TailNum) AS planes, count(DISTINCT UniqueCarrier) AS carriers, count(DISTINCT Origin) AS origins
      FROM flights GROUP BY 1""",
    ("flights",),
)
def a05(fx: Fixtures) -> DataFrame:
    exprs = {"planes": "TailNum", "carriers": "UniqueCarrier", "origins": "Origin"}
    return A.distinct_counts(fx.flights(), ["Year"], exprs)


@query(
    "a06_concat_distinct",
    """SELECT count(DISTINCT concat(product_type, data_block_id, county)) AS n_concat,
      count(DISTINCT (product_type, data_block_id, county)) AS n_tuple FROM client""",
    ("client",),
)
def a06(fx: Fixtures) -> DataFrame:
    cols = ["product_type", "data_block_id", "county"]
    text = F.concat(*[F.col(c).cast("string") for c in cols])
    return A.distinct_counts(fx.client(), [], {"n_concat": text, "n_tuple": cols})


RATE_SQL = """SELECT {by}, round(sum(Cancelled) / count(*), 8) AS cancel_rate,
  round(count(*) FILTER (TRY_CAST(ArrDelay AS INT) > 0) / nullif(count(TRY_CAST(ArrDelay AS INT)), 0), 8) AS late_rate,
  round(1 - count(*) FILTER (TRY_CAST(ArrDelay AS INT) > 0) / nullif(count(TRY_CAST(ArrDelay AS INT)), 0), 8) AS on_time_rate,
  count(*) AS sample FROM flights GROUP BY {by} {having}"""


@query("a07_rates_year", RATE_SQL.format(by="Year", having=""), ("flights",))
def a07(fx: Fixtures) -> DataFrame:
    return rounded(A.delay_rates(fx.flights(), "Year"), 8)


KNOWN = "HAVING count(*) > 30 AND count(TRY_CAST(ArrDelay AS INT)) > 0"


@query("a08_rates_route", RATE_SQL.format(by="Origin, Dest", having=KNOWN), ("flights",))
def a08(fx: Fixtures) -> DataFrame:
    return rounded(A.delay_rates(fx.flights(), "Origin", "Dest", min_sample=30), 8)


@query("a09_rates_plane", RATE_SQL.format(by="TailNum", having=KNOWN), ("flights",))
def a09(fx: Fixtures) -> DataFrame:
    return rounded(A.delay_rates(fx.flights(), "TailNum", min_sample=30), 8)


@query(
    "a10_carriers_year",
    "SELECT Year, count(DISTINCT UniqueCarrier) AS unique_carriers FROM flights GROUP BY 1",
    ("flights",),
)
def a10(fx: Fixtures) -> DataFrame:
    return A.distinct_counts(fx.flights(), ["Year"], {"unique_carriers": "UniqueCarrier"})


CONSTANT_SQL = """SELECT User_ID, Movie_ID, count(Movie_ID) AS num_movies, count(DISTINCT Rating) AS unique_ratings
  FROM ratings GROUP BY 1, 2 HAVING count(Movie_ID) > 2 AND count(DISTINCT Rating) = 1"""


@query("a11_constant_raters", CONSTANT_SQL, ("ratings",))
def a11(fx: Fixtures) -> DataFrame:
    return A.constant_raters(fx.ratings(), ["User_ID", "Movie_ID"], 2)


@query(
    "a11_constant_totals",
    f"SELECT count(*) AS n_raters, coalesce(sum(num_movies), 0)::BIGINT AS n_ratings FROM ({CONSTANT_SQL})",
    ("ratings",),
)
def a11_totals(fx: Fixtures) -> DataFrame:
    found = A.constant_raters(fx.ratings(), ["User_ID", "Movie_ID"], 2)
    return found.agg(F.count(F.lit(1)).alias("n_raters"), F.coalesce(F.sum("num_movies"), F.lit(0)).alias("n_ratings"))


@query(
    "a12_item_means",
    """SELECT Movie_ID, round(avg(Rating), 8) AS average_rating, count(Rating) AS num_ratings FROM ratings GROUP BY 1 HAVING count(Rating) > 15""",
    ("ratings",),
)
def a12(fx: Fixtures) -> DataFrame:
    return rounded(A.item_means(fx.ratings()), 8)


@query(
    "a13_dup_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def a13(fx: Fixtures) -> DataFrame:
    return A.key_duplicates(fx.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "a13_unique_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) = 1",
)
def a13_unique(fx: Fixtures) -> DataFrame:
    return A.key_uniques(fx.table("lineitem"), ["l_orderkey", "l_linenumber"])


PROPERTY_COLUMNS = [
    "parcelid",
    "file_year",
    "roomcnt",
    "yearbuilt",
    "yardbuildingsqft17",
    "unitcnt",
    "poolcnt",
    "decktypeid",
    "lotsizesquarefeet",
    "landtaxvaluedollarcnt",
    "taxvaluedollarcnt",
    "fips",
    "p_brand",
    "p_type",
]


def per_column(select: str, cols=PROPERTY_COLUMNS) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, {select.format(c=c)} FROM properties" for c in cols)


@query("a14_null_counts", per_column("count(*) - count({c}) AS null_count"), ("properties",))
def a14(fx: Fixtures) -> DataFrame:
    return A.null_counts(fx.properties())


@query(
    "a14_null_total",
    f"SELECT sum(null_count)::BIGINT AS null_cells FROM ({per_column('count(*) - count({c}) AS null_count')})",
    ("properties",),
)
def a14_total(fx: Fixtures) -> DataFrame:
    return A.null_counts(fx.properties()).agg(F.sum("null_count").alias("null_cells"))


@query("a15_fill_rates", per_column("round(count({c}) / count(*), 9) AS fill_rate"), ("properties",))
def a15(fx: Fixtures) -> DataFrame:
    return rounded(A.fill_rates(fx.properties()), 9)


NUMERIC = ["roomcnt", "yearbuilt", "lotsizesquarefeet", "taxvaluedollarcnt"]


@query(
    "a16_profile",
    per_column(
        """count({c}) AS count, count(*) - count({c}) AS nulls, round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS stddev,
        round(min({c})::DOUBLE, 5) AS min, round(max({c})::DOUBLE, 5) AS max, round(quantile_cont({c}::DOUBLE, 0.25), 5) AS p25,
        round(median({c}::DOUBLE), 5) AS p50, round(quantile_cont({c}::DOUBLE, 0.75), 5) AS p75""",
        NUMERIC,
    ),
    ("properties",),
)
def a16(fx: Fixtures) -> DataFrame:
    return rounded(A.profile(fx.properties(), NUMERIC), 5)


MIXED = {"flag": "nullif(l_returnflag, 'R')", "status": "l_linestatus", "shipped": "CAST(l_shipdate AS DATE)", "taxed": "l_tax > 0.04"}


@query(
    "a16_profile_all",
    "WITH t AS (SELECT "
    + ", ".join(f"{v} AS {c}" for c, v in MIXED.items())
    + " FROM lineitem) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS count, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS n_distinct,
        (SELECT CAST({c} AS VARCHAR) FROM t WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
        (SELECT count(*) FROM t WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY 1 DESC LIMIT 1) AS freq,
        CAST(min({c}) AS VARCHAR) AS first, CAST(max({c}) AS VARCHAR) AS last FROM t"""
        for c in MIXED
    ),
)
def a16_all(fx: Fixtures) -> DataFrame:
    """Text, date and boolean columns."""
    return A.profile_values(fx.table("lineitem").selectExpr(*(f"{v} AS {c}" for c, v in MIXED.items())))


@query(
    "a17_class_balance",
    """SELECT is_consumption, count(*) AS count, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM readings WHERE target <> 0), 8) AS percent
      FROM readings WHERE target <> 0 GROUP BY 1""",
    ("readings",),
)
def a17(fx: Fixtures) -> DataFrame:
    data = complete_rows(fx.readings()).where(F.col("target") != 0)
    return rounded(A.class_balance(data, "is_consumption"), 8)


@query(
    "a18_share_total",
    """WITH k AS (SELECT * FROM orders), t AS (SELECT count(*) AS total FROM k)
      SELECT o_orderpriority, count(*) AS count, total, round(count(*) / total, 2) AS share,
        format('{:,.0f} K', count(*) / 1000) AS count_text FROM k, t GROUP BY 1, total""",
)
def a18(fx: Fixtures) -> DataFrame:
    return A.share_of_total(fx.table("orders"), "o_orderpriority")


@query(
    "a19_group_means",
    """SELECT c_mktsegment, c_nationkey, round(avg(c_acctbal), 5) AS avg_c_acctbal FROM customer WHERE c_acctbal <> 0 GROUP BY 1, 2""",
)
def a19(fx: Fixtures) -> DataFrame:
    data = fx.table("customer").where(F.col("c_acctbal") != 0)
    return A.group_means(data, ["c_mktsegment", "c_nationkey"], ["c_acctbal"], 5)


@query(
    "a21_minmax",
    "SELECT min(l_extendedprice) AS prediction_min, max(l_extendedprice) AS prediction_max FROM lineitem",
)
def a21(fx: Fixtures) -> DataFrame:
    return fx.table("lineitem").agg(
        F.min("l_extendedprice").alias("prediction_min"), F.max("l_extendedprice").alias("prediction_max")
    )


@query(
    "a22_histogram",
    f"""WITH r AS ({RATE_SQL.format(by="Origin, Dest", having=KNOWN).replace("round(", "(").replace(", 8)", ")")}),
      l AS (SELECT min(late_rate) AS a, max(late_rate) AS z FROM r),
      lim AS (SELECT CASE WHEN a = z THEN a - 0.5 ELSE a END AS lo, CASE WHEN a = z THEN z + 0.5 ELSE z END AS hi FROM l WHERE a IS NOT NULL),
      b AS (SELECT CAST(least(floor((late_rate - lo) * 10 / (hi - lo)), 9) AS INT) AS bin, count(*) AS n FROM r, lim GROUP BY 1),
      f AS (SELECT CAST(unnest(range(10)) AS INT) AS bin, lo, hi FROM lim)
      SELECT f.bin, round(lo + f.bin * ((hi - lo) / 10), 9) AS bin_start, round(lo + (f.bin + 1) * ((hi - lo) / 10), 9) AS bin_end,
        coalesce(n, 0) AS count FROM f LEFT JOIN b ON f.bin = b.bin""",
    ("flights",),
)
def a22(fx: Fixtures) -> DataFrame:
    routes = A.delay_rates(fx.flights(), "Origin", "Dest", min_sample=30)
    return rounded(A.histogram(routes, "late_rate"), 9)


POINTS = [float(p) for p in range(0, 100, 5)]


@query(
    "a23_kde",
    """WITH x AS (SELECT User_ID, count(*) AS n FROM ratings GROUP BY 1), p AS (SELECT CAST(unnest(range(0, 100, 5)) AS DOUBLE) AS x)
      SELECT p.x, round(sum(exp(-0.5::DOUBLE * ((n - p.x) / 4) * ((n - p.x) / 4))) / (count(*) * 4 * sqrt(2 * pi())), 9) AS density
      FROM x, p WHERE n < 2500 GROUP BY p.x""",
    ("ratings",),
)
def a23(fx: Fixtures) -> DataFrame:
    per_user = A.value_counts(fx.ratings(), "User_ID")
    return rounded(A.density(per_user, "count", POINTS, 4.0, below=2500), 9)


@query("a24_shape", "SELECT count(*) AS n_rows, CAST(11 AS INT) AS n_cols FROM lineitem")
def a24(fx: Fixtures) -> DataFrame:
    return A.shape(fx.table("lineitem"))


CORR = ["price_num", "sqft_living", "sqft_lot", "sqft_basement", "grade"]


@query(
    "a25_corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 7) AS corr FROM houses"
        for i, a in enumerate(CORR)
        for b in CORR[i:]
    ),
    ("houses",),
)
def a25(fx: Fixtures) -> DataFrame:
    return rounded(A.corr_matrix(fx.houses(), CORR), 7)


@query(
    "a27_distinct_then_bucket",
    """SELECT CASE WHEN yardbuildingsqft17 < 200 THEN '<200' WHEN yardbuildingsqft17 < 300 THEN '200-300'
      WHEN yardbuildingsqft17 < 400 THEN '300-400' WHEN yardbuildingsqft17 >= 400 THEN '>400' END AS patiorange, count(*) AS total_within_range
      FROM (SELECT DISTINCT p_brand, yardbuildingsqft17 FROM properties WHERE fips IS NOT NULL) GROUP BY 1""",
    ("properties",),
)
def a27(fx: Fixtures) -> DataFrame:
    data = fx.properties().where(F.col("fips").isNotNull()).select("p_brand", "yardbuildingsqft17").distinct()
    return A.bucket_counts(data, patio_bucket(), "patiorange")

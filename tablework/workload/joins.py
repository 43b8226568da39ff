"""Queries over joins, windows and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.operators import aggregates as A
from tablework.operators import joins as J
from tablework.operators import merge as M
from tablework.operators.clean import prefix_columns
from tablework.plans.medallion import build_gold_features
from tablework.session import fresh_database, staged
from tablework.sinks.tables import write_table
from tablework.workload.fixtures import Fixtures
from tablework.workload.registry import query


@query(
    "j01_lookup_chain",
    """SELECT c_custkey, c_nationkey, n_name, n_regionkey, r_name, c_acctbal FROM customer
      LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def j01(fx: Fixtures) -> DataFrame:
    return J.enrich(
        fx.table("customer").select("c_custkey", "c_nationkey", "c_acctbal"),
        [
            ("c_nationkey", fx.table("nation"), "n_nationkey", ["n_name", "n_regionkey"]),
            ("n_regionkey", fx.table("region"), "r_regionkey", ["r_name"]),
        ],
    )


@query(
    "j02_fips_state",
    """SELECT parcelid, lpad(CAST(fips * 1000 + 1 AS VARCHAR), 5, '0') AS fips_str, state_fips, n_name AS state_name
      FROM properties LEFT JOIN (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state_fips, n_name FROM nation)
      ON substr(lpad(CAST(fips * 1000 + 1 AS VARCHAR), 5, '0'), 1, 2) = state_fips""",
    ("properties",),
)
def j02(fx: Fixtures) -> DataFrame:
    code = F.lpad((F.col("fips") * 1000 + 1).cast("string"), 5, "0")
    states = fx.table("nation").select(F.col("n_nationkey").alias("state_fips"), F.col("n_name").alias("state_name"))
    facts = fx.properties().select("parcelid", code.alias("fips_str"))
    return J.enrich_state(facts, states, "fips_str", "state_fips")


@query(
    "j03_shifted_daily",
    """SELECT row_id, r.datetime, forecast_date, lowest_price_per_mwh FROM readings r
      LEFT JOIN gas_prices g ON CAST(r.datetime AS DATE) = g.forecast_date + 1""",
    ("readings", "gas_prices"),
)
def j03(fx: Fixtures) -> DataFrame:
    gas = fx.gas_prices().select("forecast_date", "lowest_price_per_mwh")
    return J.join_shifted(fx.readings().select("row_id", "datetime"), gas, "datetime", "forecast_date")


@query(
    "j03_shifted_hourly_fanout",
    """SELECT row_id, forecast_date, euros_per_mwh FROM readings r
      LEFT JOIN electricity_prices e ON CAST(r.datetime AS DATE) = CAST(e.forecast_date AS DATE) + 1""",
    ("readings", "electricity_prices"),
)
def j03_fanout(fx: Fixtures) -> DataFrame:
    prices = fx.electricity_prices().select("forecast_date", "euros_per_mwh")
    out = J.join_shifted(fx.readings().select("row_id", "datetime"), prices, "datetime", "forecast_date", 1, "day")
    return out.drop("datetime")


@query(
    "j04_composite_left",
    """SELECT row_id, r.product_type, r.county, r.is_business, eic_count, installed_capacity FROM readings r LEFT JOIN client c
      ON c.product_type = r.product_type AND c.county = r.county AND c.is_business = r.is_business AND c.date = CAST(r.datetime AS DATE)""",
    ("readings", "client"),
)
def j04(fx: Fixtures) -> DataFrame:
    facts = fx.readings().select("row_id", "product_type", "county", "is_business", F.to_date("datetime").alias("date"))
    keys = ["product_type", "county", "is_business", "date"]
    return facts.join(fx.client().drop("data_block_id"), keys, "left").drop("date")


GOLD_SQL = """SELECT a.county AS train_county, a.is_business AS train_is_business, a.product_type AS train_product_type,
  a.target AS train_target, a.is_consumption AS train_is_consumption, a.datetime AS train_datetime,
  a.data_block_id AS train_data_block_id, a.row_id AS train_row_id, a.prediction_unit_id AS train_prediction_unit_id,
  b.forecast_date AS gas_prices_forecast_date, b.lowest_price_per_mwh AS gas_prices_lowest_price_per_mwh,
  b.highest_price_per_mwh AS gas_prices_highest_price_per_mwh, b.origin_date AS gas_prices_origin_date,
  b.data_block_id AS gas_prices_data_block_id, c.forecast_date AS electric_prices_forecast_date,
  c.euros_per_mwh AS electric_prices_euros_per_mwh, c.origin_date AS electric_prices_origin_date,
  c.data_block_id AS electric_prices_data_block_id, d.product_type AS client_product_type, d.county AS client_county,
  d.eic_count AS client_eic_count, d.installed_capacity AS client_installed_capacity, d.is_business AS client_is_business,
  d.date AS client_date, d.data_block_id AS client_data_block_id
  FROM readings a LEFT JOIN gas_prices b ON CAST(a.datetime AS DATE) = b.forecast_date + 1
  LEFT JOIN electricity_prices c ON {electricity}
  LEFT JOIN client d ON d.product_type = a.product_type AND d.county = a.county AND d.is_business = a.is_business
    AND d.date = CAST(a.datetime AS DATE)"""
GOLD_VIEWS = ("readings", "gas_prices", "electricity_prices", "client")


def gold_of(fx: Fixtures, grain: str) -> DataFrame:
    """Prices and client states are stored, so that their size is measured and the readings need no shuffle to meet them."""
    dims = (staged(df, "j05") for df in (fx.gas_prices(), fx.electricity_prices(), fx.client()))
    return build_gold_features(fx.readings(), *dims, grain)


@query(
    "j05_gold_features",
    GOLD_SQL.format(electricity="CAST(a.datetime AS DATE) = CAST(c.forecast_date AS DATE) + 1"),
    GOLD_VIEWS,
)
def j05(fx: Fixtures) -> DataFrame:
    return gold_of(fx, "day")


@query(
    "j05_gold_features_hourly",
    GOLD_SQL.format(electricity="date_trunc('hour', a.datetime) = c.forecast_date + INTERVAL 1 DAY"),
    GOLD_VIEWS,
)
def j05_hourly(fx: Fixtures) -> DataFrame:
    return gold_of(fx, "hour")


@query(
    "j06_exact_ts",
    """SELECT row_id, g.lowest_price_per_mwh, e.euros_per_mwh FROM readings r
      LEFT JOIN gas_prices g ON CAST(r.datetime AS DATE) = g.forecast_date
      LEFT JOIN electricity_prices e ON date_trunc('hour', r.datetime) = e.forecast_date""",
    ("readings", "gas_prices", "electricity_prices"),
)
def j06(fx: Fixtures) -> DataFrame:
    gas = prefix_columns(fx.gas_prices().select("forecast_date", "lowest_price_per_mwh"), "g")
    prices = prefix_columns(fx.electricity_prices().select("forecast_date", "euros_per_mwh"), "e")
    out = J.join_shifted(fx.readings().select("row_id", "datetime"), gas, "datetime", "g_forecast_date", 0, "day")
    out = J.join_shifted(out, prices, "datetime", "e_forecast_date", 0, "hour")
    return out.select(
        "row_id", F.col("g_lowest_price_per_mwh").alias("lowest_price_per_mwh"), F.col("e_euros_per_mwh").alias("euros_per_mwh")
    )


@query(
    "j06_exact_instant",
    """SELECT row_id, n_same, top FROM readings r LEFT JOIN
      (SELECT datetime AS at, count(*) AS n_same, max(target) AS top FROM readings GROUP BY 1) m ON r.datetime = m.at""",
    ("readings",),
)
def j06_instant(fx: Fixtures) -> DataFrame:
    """Facts joined on the exact instant, fractions of seconds included."""
    moments = fx.readings().groupBy(F.col("datetime").alias("at")).agg(F.count(F.lit(1)).alias("n_same"), F.max("target").alias("top"))
    return J.join_exact(fx.readings().select("row_id", "datetime"), moments, "datetime", "at").select("row_id", "n_same", "top")


@query(
    "j07_multiplicity",
    """WITH a AS (SELECT count(*) AS n FROM readings),
      b AS (SELECT count(*) AS n FROM readings r LEFT JOIN electricity_prices e ON CAST(r.datetime AS DATE) = CAST(e.forecast_date AS DATE) + 1)
      SELECT a.n AS rows_before, b.n AS rows_after, b.n / a.n AS multiplicity FROM a, b""",
    ("readings", "electricity_prices"),
)
def j07(fx: Fixtures) -> DataFrame:
    facts = fx.readings().select("row_id", "datetime")
    joined = J.join_shifted(facts, fx.electricity_prices().select("forecast_date"), "datetime", "forecast_date")
    return J.check_multiplicity(facts, joined)


@query(
    "j08_full_outer",
    """SELECT coalesce(a.d, b.d) AS d, n_orders, n_ships FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n_orders FROM orders GROUP BY 1) a
      FULL OUTER JOIN (SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS n_ships FROM lineitem GROUP BY 1) b ON a.d = b.d""",
)
def j08(fx: Fixtures) -> DataFrame:
    a = fx.table("orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count(F.lit(1)).alias("n_orders"))
    b = fx.table("lineitem").groupBy(F.to_date("l_shipdate").alias("d")).agg(F.count(F.lit(1)).alias("n_ships"))
    return J.full_outer_by_key(a, b, ["d"])


@query(
    "j09_inner_aggregates",
    """WITH c AS (SELECT CAST(datetime AS DATE) AS date, sum(target) AS a FROM readings WHERE is_consumption = 1 GROUP BY 1),
      p AS (SELECT CAST(datetime AS DATE) AS date, sum(target) AS a FROM readings WHERE is_consumption = 0 GROUP BY 1)
      SELECT c.date AS date, round(c.a, 4) AS total_consumption_amt, round(p.a, 4) AS total_production_amt, round(p.a - c.a, 4) AS net_amt
      FROM c JOIN p ON c.date = p.date""",
    ("readings",),
)
def j09(fx: Fixtures) -> DataFrame:
    return rounded(A.consumption_production(fx.readings()), 4)


def rounded(df: DataFrame, digits: int) -> DataFrame:
    return df.select([F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query(
    "j10_left_anti",
    """SELECT row_id, county, target FROM readings r WHERE NOT EXISTS
      (SELECT 1 FROM client c WHERE c.product_type = r.product_type AND c.county = r.county AND c.date = CAST(r.datetime AS DATE) AND c.installed_capacity > 200)""",
    ("readings", "client"),
)
def j10(fx: Fixtures) -> DataFrame:
    facts = fx.readings().withColumn("date", F.to_date("datetime"))
    existing = fx.client().where(F.col("installed_capacity") > 200)
    return J.new_rows(facts, existing, ["product_type", "county", "date"]).select("row_id", "county", "target")


@query(
    "j11_in_subquery",
    """SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def j11(fx: Fixtures) -> DataFrame:
    keys = fx.table("customer").where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    return J.in_set(fx.table("orders"), keys, "o_custkey")


@query(
    "j12_latest_version",
    """SELECT * FROM bronze_readings b1 WHERE process_timestamp =
      (SELECT max(process_timestamp) FROM bronze_readings b2 WHERE b1.row_id = b2.row_id)""",
    ("readings", "bronze_readings"),
)
def j12(fx: Fixtures) -> DataFrame:
    return J.latest_version(fx.bronze_readings(), ["row_id"], "process_timestamp")


@query(
    "j13_attach_total",
    """SELECT o_orderpriority, count(*) AS n, (SELECT count(*) FROM orders) AS total FROM orders GROUP BY 1""",
)
def j13(fx: Fixtures) -> DataFrame:
    o = fx.table("orders")
    counts = o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return J.with_total(counts, o.agg(F.count(F.lit(1)).alias("total")))


@query(
    "j14_pred_actual",
    """WITH a AS (SELECT User_ID, Movie_ID, avg(Rating) AS actual FROM ratings GROUP BY 1, 2),
      p AS (SELECT Movie_ID, avg(Rating) AS prediction FROM ratings GROUP BY 1)
      SELECT User_ID, a.Movie_ID, round(actual, 6) AS actual, round(prediction, 6) AS prediction,
        round((actual - prediction) * (actual - prediction), 6) AS sq FROM a JOIN p ON a.Movie_ID = p.Movie_ID""",
    ("ratings",),
)
def j14(fx: Fixtures) -> DataFrame:
    actual = fx.ratings().groupBy("User_ID", "Movie_ID").agg(F.avg("Rating").alias("actual"))
    predicted = fx.ratings().groupBy("Movie_ID").agg(F.avg("Rating").alias("prediction"))
    gap = F.col("actual") - F.col("prediction")
    return rounded(J.score_pairs(predicted, actual, ["Movie_ID"]).withColumn("sq", gap * gap), 6)


@query(
    "j15_topn_titles",
    """WITH t AS (SELECT l_partkey AS p_partkey, count(*) AS n FROM lineitem GROUP BY 1)
      SELECT p_partkey, n, p_name FROM (SELECT * FROM t ORDER BY n DESC, p_partkey LIMIT 20) LEFT JOIN part USING (p_partkey)""",
)
def j15(fx: Fixtures) -> DataFrame:
    scores = fx.table("lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("n"))
    return J.top_titles(scores, fx.table("part").select("p_partkey", "p_name"), "p_partkey", "n", 20)


def merge_sides(fx: Fixtures) -> tuple[DataFrame, DataFrame]:
    """Orders before 1997 as the target; the source knows later ones, misses some and has changed others."""
    o = fx.table("orders").select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("y"))
    target = o.where("y < 1997")
    price = F.when(F.col("o_orderkey") % 4 == 1, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return target, o.where("o_orderkey % 5 <> 0").withColumn("o_totalprice", price)


MERGE_SQL = """WITH o AS (SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS INT) AS y FROM orders),
  t AS (SELECT * FROM o WHERE y < 1997),
  s AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 4 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, y
        FROM o WHERE o_orderkey % 5 <> 0)"""


@query("j16_merge_sync", MERGE_SQL + " SELECT * FROM s")
def j16(fx: Fixtures) -> DataFrame:
    target, source = merge_sides(fx)
    db = fresh_database(fx.spark, "merge")
    write_table(target, f"{db}.t")
    M.merge_sync(fx.spark, f"{db}.t", source, ["o_orderkey"])
    return fx.spark.table(f"{db}.t")


@query(
    "j16_merge_actions",
    MERGE_SQL
    + """ SELECT CASE WHEN s.o_orderkey IS NULL THEN 'delete' WHEN t.o_orderkey IS NULL THEN 'insert'
      WHEN t.o_totalprice = s.o_totalprice THEN 'keep' ELSE 'update' END AS _action, count(*) AS n_rows
      FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey GROUP BY 1""",
)
def j16_actions(fx: Fixtures) -> DataFrame:
    target, source = merge_sides(fx)
    return M.merge_actions(target, source, ["o_orderkey"]).groupBy("_action").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "j16_merge_upsert",
    MERGE_SQL + " SELECT * FROM s UNION ALL SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)",
)
def j16_upsert(fx: Fixtures) -> DataFrame:
    target, source = merge_sides(fx)
    return M.merge_actions(target, source, ["o_orderkey"], delete_missing=False).drop("_action")


@query(
    "j17_lookup_default",
    """SELECT coalesce(fips, 0) AS fips, n_name, count(*) AS n FROM properties LEFT JOIN nation ON fips = n_nationkey GROUP BY fips, n_name""",
    ("properties",),
)
def j17(fx: Fixtures) -> DataFrame:
    grouped = fx.properties().groupBy("fips").agg(F.count(F.lit(1)).alias("n"))
    return J.enrich_default(grouped, "fips", fx.table("nation"), "n_nationkey", "n_name")


@query(
    "w01_latest_rows_blocks",
    """SELECT * FROM readings WHERE data_block_id IN (SELECT data_block_id FROM
      (SELECT data_block_id, row_number() OVER (ORDER BY data_block_id DESC) AS rn FROM readings) WHERE rn <= 5)""",
    ("readings",),
)
def w01_rows(fx: Fixtures) -> DataFrame:
    return J.latest_blocks(fx.readings(), "data_block_id", 5, distinct=False)


@query(
    "w01_latest_distinct_blocks",
    """SELECT * FROM readings WHERE data_block_id IN (SELECT DISTINCT data_block_id FROM readings ORDER BY 1 DESC LIMIT 5)""",
    ("readings",),
)
def w01_distinct(fx: Fixtures) -> DataFrame:
    return J.latest_blocks(fx.readings(), "data_block_id", 5)

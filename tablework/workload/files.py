"""Queries that write files or tables first and then read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.operators import aggregates as A
from tablework.schemas import table
from tablework.session import fresh_database, scratch_dir, staged
from tablework.sinks import tables as K
from tablework.sources import files as S
from tablework.sources import text as TX
from tablework.workload.fixtures import Fixtures
from tablework.workload.registry import query

CUSTOMER = table(
    "c_custkey bigint", "c_name string", "c_nationkey int", "c_acctbal double", "c_mktsegment string"
)
EVENTS = table(
    "event_id bigint", "ts timestamp_ntz", "user_id bigint", "event_type string", "value double", "props string"
)


def orders_slim(fx: Fixtures) -> DataFrame:
    return fx.table("orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.year("o_orderdate").alias("y")
    )


SLIM_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(year(o_orderdate) AS INT) AS y FROM orders"


@query("s01_csv_scan", "SELECT * FROM customer")
def s01(fx: Fixtures) -> DataFrame:
    path = K.export_csv(fx.table("customer"), scratch_dir(fx.spark, "s01"))
    return S.read_csv(fx.spark, path, CUSTOMER)


@query("s01_csv_inferred", "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer")
def s01_inferred(fx: Fixtures) -> DataFrame:
    """Types found by a pass over the file; whole numbers come out as the narrowest fitting type."""
    path = K.export_csv(fx.table("customer"), scratch_dir(fx.spark, "s01i"))
    read = S.read_csv(fx.spark, path, infer=True)
    return read.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_acctbal", "c_mktsegment")


@query(
    "s01_malformed",
    """SELECT 'good' AS kind, c_custkey, c_acctbal, CAST(NULL AS VARCHAR) AS raw_text FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 7 <> 0
      UNION ALL SELECT 'bad', NULL, NULL, CASE WHEN c_custkey % 5 = 0 THEN concat('x', c_custkey, ',', c_name, ',', c_nationkey, ',0.5,', c_mktsegment)
        ELSE concat(c_custkey, ',', c_name) END FROM customer WHERE c_custkey % 5 = 0 OR c_custkey % 7 = 0""",
)
def s01_malformed(fx: Fixtures) -> DataFrame:
    """A fifth of the rows have text for a number, others too few fields; both end up apart, none is lost."""
    key = F.col("c_custkey")
    broken = F.concat_ws(",", F.concat(F.lit("x"), key), "c_name", "c_nationkey", F.lit("0.5"), "c_mktsegment")
    line = F.when(key % 5 == 0, broken).when(key % 7 == 0, F.concat_ws(",", "c_custkey", "c_name"))
    whole = F.concat_ws(",", "c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").cast("string"), "c_mktsegment")
    path, db = scratch_dir(fx.spark, "s01m"), fresh_database(fx.spark, "s01m")
    fx.table("customer").select(F.coalesce(line, whole).alias("value")).write.text(path)
    S.load_csv_checked(fx.spark, path, CUSTOMER, f"{db}.customer", f"{db}.customer_malformed", header=False)
    good = fx.spark.table(f"{db}.customer").select(F.lit("good").alias("kind"), "c_custkey", "c_acctbal", F.lit(None).cast("string").alias("raw_text"))
    bad = fx.spark.table(f"{db}.customer_malformed")
    return good.unionByName(bad.select(F.lit("bad").alias("kind"), F.lit(None).cast("long").alias("c_custkey"), F.lit(None).cast("double").alias("c_acctbal"), "raw_text"))


@query(
    "a24_file_shape",
    """SELECT count(*) AS n_rows, CAST(1 AS INT) AS n_cols,
      CAST(sum(strlen(concat(o_orderkey, ',', o_custkey, ',', o_orderstatus, ',', o_orderpriority)) + 1) AS BIGINT) AS n_octets FROM orders""",
)
def a24_file_shape(fx: Fixtures) -> DataFrame:
    """Size in rows, columns and octets of a file of order lines."""
    path = scratch_dir(fx.spark, "a24")
    fx.table("orders").select(F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")).write.text(path)
    return A.file_shape(fx.spark, path, fx.spark.read.text(path))


@query("s02_multi_file_scan", "SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_nationkey < 5")
def s02(fx: Fixtures) -> DataFrame:
    a = K.export_csv(fx.table("customer"), scratch_dir(fx.spark, "s02a"))
    b = K.export_csv(fx.table("customer").where("c_nationkey < 5"), scratch_dir(fx.spark, "s02b"))
    return S.read_csv(fx.spark, [a, b], CUSTOMER)


@query(
    "s03_discover",
    """SELECT 'bronze_customer' AS table_name, count(*) AS n_rows FROM customer
      UNION ALL SELECT 'bronze_orders', count(*) FROM orders UNION ALL SELECT 'bronze_part', count(*) FROM part""",
)
def s03(fx: Fixtures) -> DataFrame:
    folder = scratch_dir(fx.spark, "s03")
    for name in ("customer", "orders", "part"):
        K.export_csv(fx.table(name), f"{folder}/{name}.csv")
    fx.table("region").write.json(f"{folder}/region.json")
    return S.discovered(fx.spark, folder)


@query("s04_json_scan", "SELECT * FROM events")
def s04(fx: Fixtures) -> DataFrame:
    path = K.export_json(fx.table("events"), scratch_dir(fx.spark, "s04"))
    return S.read_json(fx.spark, path, EVENTS)


BLOCKS = 64  # of each item, so that a popular one is not written by one task


def block_files(fx: Fixtures, label: str) -> list[str]:
    """Four block-text files: a header line per block of an item, then its ratings; each file holds several parts."""
    data = fx.ratings().select(
        F.regexp_extract("Movie_ID", r"(\d+)", 1).cast("int").alias("item"), "User_ID", "Rating", "Date", F.pmod(F.xxhash64("User_ID", "Date"), F.lit(BLOCKS)).alias("block")
    )
    lines = data.select("item", "block", F.lit(1).alias("kind"), F.concat_ws(",", "User_ID", "Rating", "Date").alias("value"))
    heads = data.select("item", "block").distinct().select("item", "block", F.lit(0).alias("kind"), F.concat("item", F.lit(":")).alias("value"))
    both = staged(lines.unionByName(heads), label, spread=True)
    paths = []
    for i in range(4):
        path = scratch_dir(fx.spark, f"{label}-{i}")
        part = both.where(F.col("item") % 4 == i)
        # A header must stand before its lines, so a block stays in one part of the written file.
        part.repartition("item", "block").sortWithinPartitions("item", "block", "kind").select("value").write.text(path)
        paths.append(path)
    return paths


BLOCK_SQL = """SELECT regexp_extract(Movie_ID, '([0-9]+)', 1) AS Movie_ID, CAST(User_ID AS VARCHAR) AS User_ID, Rating, Date FROM ratings"""


@query("s05_block_text", BLOCK_SQL, ("ratings",))
def s05(fx: Fixtures) -> DataFrame:
    return TX.parse_block_ratings(fx.spark, block_files(fx, "s05"))


@query(
    "s11_ingest_ratings",
    f"SELECT Movie_ID, count(*) AS n, sum(Rating)::BIGINT AS total FROM ({BLOCK_SQL}) GROUP BY 1",
    ("ratings",),
)
def s11(fx: Fixtures) -> DataFrame:
    db = fresh_database(fx.spark, "s11")
    stored = TX.ingest_ratings(fx.spark, block_files(fx, "s11"), f"{db}.ratings")
    return stored.groupBy("Movie_ID").agg(F.count(F.lit(1)).alias("n"), F.sum("Rating").alias("total"))


@query(
    "s06_ragged_csv",
    """SELECT CAST(p_partkey AS VARCHAR) AS Movie_ID, CASE WHEN p_size % 9 = 0 THEN NULL ELSE 1950 + p_size END AS Release_Year,
      concat('Café ', p_name, ' ', p_type, ' "', p_brand, '"') AS Title FROM part""",
)
def s06(fx: Fixtures) -> DataFrame:
    year = F.when(F.col("p_size") % 9 == 0, "NULL").otherwise((F.col("p_size") + 1950).cast("string"))
    title = F.concat(F.lit("Café "), "p_name", F.lit(", "), "p_type", F.lit(', "'), "p_brand", F.lit('"'))
    # Blank plus comma in the written title: dropping the comma leaves the blank.
    line = F.concat_ws(",", F.col("p_partkey").cast("string"), year, title)
    path = scratch_dir(fx.spark, "s06")
    fx.table("part").select(line.alias("value")).write.option("encoding", "ISO-8859-1").option("quote", "").option(
        "escapeQuotes", False
    ).option("sep", "\u0001").csv(path)
    return TX.parse_titles(fx.spark, path)


@query(
    "s07_ingest_meta",
    """SELECT c_custkey, TRUE AS has_path, TRUE AS is_csv, TRUE AS has_size, TRUE AS has_time, 'run-7' AS run_id, 'bronze' AS job_group FROM customer""",
)
def s07(fx: Fixtures) -> DataFrame:
    path = K.export_csv(fx.table("customer"), scratch_dir(fx.spark, "s07"))
    df = S.with_ingest_metadata(S.read_csv(fx.spark, path, CUSTOMER), "run-7", "bronze")
    return df.select(
        "c_custkey",
        F.col("file_path").contains("s07").alias("has_path"),
        F.col("file_name").endswith(".csv").alias("is_csv"),
        (F.col("file_size") > 0).alias("has_size"),
        (F.col("file_modification_time") <= F.col("process_timestamp")).alias("has_time"),
        "run_id",
        "job_group",
    )


@query(
    "s08_file_year",
    "SELECT parcelid, CAST(file_year AS VARCHAR) AS file_year, taxvaluedollarcnt FROM properties",
    ("properties",),
)
def s08(fx: Fixtures) -> DataFrame:
    folder = scratch_dir(fx.spark, "s08")
    data = fx.properties()
    paths = []
    for year in (2016, 2017):
        part = data.where(F.col("file_year") == year).select("parcelid", "taxvaluedollarcnt")
        paths.append(K.export_csv(part, f"{folder}/properties_{year}.csv"))
    return S.with_file_year(S.read_csv(fx.spark, paths, table("parcelid bigint", "taxvaluedollarcnt double")))


@query("s09_table_scan", SLIM_SQL)
def s09(fx: Fixtures) -> DataFrame:
    db = fresh_database(fx.spark, "s09")
    K.write_table(orders_slim(fx), f"{db}.bronze_orders")
    return fx.spark.sql(f"SELECT * FROM {db}.bronze_orders")


@query(
    "s10_sanitize",
    """SELECT c_custkey AS City_Code, c_acctbal AS nov_2010, c_acctbal + 1 AS dec_2010, c_nationkey AS Population_Rank,
      c_acctbal * 2 AS jan_2017 FROM customer""",
)
def s10(fx: Fixtures) -> DataFrame:
    wide = fx.table("customer").select(
        F.col("c_custkey").alias("City Code"),
        F.col("c_acctbal").alias("November 2010"),
        (F.col("c_acctbal") + 1).alias("December 2010"),
        F.col("c_nationkey").alias("Population Rank"),
        (F.col("c_acctbal") * 2).alias("January 2017"),
    )
    return S.sanitize_columns(wide)


@query("k01_overwrite", SLIM_SQL)
def k01(fx: Fixtures) -> DataFrame:
    db = fresh_database(fx.spark, "k01")
    K.write_table(orders_slim(fx).where("y < 1996"), f"{db}.t")
    return K.write_table(orders_slim(fx), f"{db}.t")


@query("k02_append", f"{SLIM_SQL} UNION ALL {SLIM_SQL} WHERE o_orderstatus = 'F'")
def k02(fx: Fixtures) -> DataFrame:
    db = fresh_database(fx.spark, "k02")
    K.write_table(orders_slim(fx), f"{db}.t", "append")
    return K.write_table(orders_slim(fx).where("o_orderstatus = 'F'"), f"{db}.t", "append")


@query("k03_partitioned", SLIM_SQL)
def k03(fx: Fixtures) -> DataFrame:
    db = fresh_database(fx.spark, "k03")
    return K.write_table(orders_slim(fx), f"{db}.t", partition_by=["y"])


@query("k04_replace_schema", f"SELECT o_orderkey, o_totalprice * 2 AS doubled, y FROM ({SLIM_SQL})")
def k04(fx: Fixtures) -> DataFrame:
    """The second version of the table is computed from the first one and has other columns."""
    db = fresh_database(fx.spark, "k04")
    first = K.write_table(orders_slim(fx), f"{db}.t")
    return K.swap_table(first.select("o_orderkey", (F.col("o_totalprice") * 2).alias("doubled"), "y"), f"{db}.t")


@query("k05_ctas", SLIM_SQL)
def k05(fx: Fixtures) -> DataFrame:
    db = fresh_database(fx.spark, "k05")
    K.ctas(orders_slim(fx), f"{db}.t", if_not_exists=True)
    return K.ctas(orders_slim(fx).where("y < 1996"), f"{db}.t", if_not_exists=True)


@query(
    "k08_insert_overwrite",
    """SELECT 'bronze_orders' AS table_name, CAST(max(year(o_orderdate)) AS INT) AS data_block_id FROM orders
      UNION ALL SELECT 'bronze_lineitem', CAST(max(year(l_shipdate)) AS INT) FROM lineitem""",
)
def k08(fx: Fixtures) -> DataFrame:
    db = fresh_database(fx.spark, "k08")
    marks = f"{db}.bronze_loading_checkpoint"
    top_o = fx.table("orders").agg(F.max(F.year("o_orderdate"))).first()[0]
    top_l = fx.table("lineitem").agg(F.max(F.year("l_shipdate"))).first()[0]
    K.set_watermark(fx.spark, marks, "bronze_orders", 0)
    K.set_watermark(fx.spark, marks, "bronze_lineitem", top_l)
    K.set_watermark(fx.spark, marks, "bronze_orders", top_o)
    return fx.spark.table(marks).select("table_name", "data_block_id")


@query("k12_partitions", f"SELECT y, count(*) AS n_rows FROM ({SLIM_SQL}) GROUP BY 1")
def k12(fx: Fixtures) -> DataFrame:
    db = fresh_database(fx.spark, "k12")
    K.write_table(orders_slim(fx), f"{db}.t", partition_by=["y"])
    return K.partition_inventory(fx.spark, f"{db}.t", "y")


@query("k13_csv_export", f"SELECT o_orderkey AS order_id, o_totalprice AS price FROM ({SLIM_SQL})")
def k13(fx: Fixtures) -> DataFrame:
    path = K.export_csv(orders_slim(fx).select("o_orderkey", "o_totalprice"), scratch_dir(fx.spark, "k13"))
    schema = table("o_orderkey bigint", "o_totalprice double")
    return S.read_csv(fx.spark, path, schema).toDF("order_id", "price")

"""Queries over streams: every one drains its source and reads what arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.session import fresh_database, scratch_dir
from tablework.sinks.tables import write_table
from tablework.streaming.copy import stream_copy, stream_counts, stream_to_memory
from tablework.workload.fixtures import Fixtures
from tablework.workload.registry import query


@query("t01_stream_copy", "SELECT * FROM readings", ("readings",))
def t01(fx: Fixtures) -> DataFrame:
    db = fresh_database(fx.spark, "t01")
    write_table(fx.readings(), f"{db}.silver_train")
    stream_copy(fx.spark, f"{db}.silver_train", scratch_dir(fx.spark, "t01c"), f"{db}.gold_train")
    return fx.spark.table(f"{db}.gold_train")


@query("t02_incremental", "SELECT * FROM readings", ("readings",))
def t02(fx: Fixtures) -> DataFrame:
    """Two runs over a growing table; the second copies only what the first has not seen."""
    db, checkpoint = fresh_database(fx.spark, "t02"), scratch_dir(fx.spark, "t02c")
    early = F.col("data_block_id") < 15
    write_table(fx.readings().where(early), f"{db}.silver_train", "append")
    stream_copy(fx.spark, f"{db}.silver_train", checkpoint, f"{db}.gold_train")
    write_table(fx.readings().where(~early), f"{db}.silver_train", "append")
    stream_copy(fx.spark, f"{db}.silver_train", checkpoint, f"{db}.gold_train")
    return fx.spark.table(f"{db}.gold_train")


@query("t03_complete_counts", "SELECT county, product_type, count(*) AS count FROM readings GROUP BY 1, 2", ("readings",))
def t03(fx: Fixtures) -> DataFrame:
    db, checkpoint = fresh_database(fx.spark, "t03"), scratch_dir(fx.spark, "t03c")
    early = F.col("data_block_id") < 15
    for part in (early, ~early):
        write_table(fx.readings().where(part), f"{db}.silver_train", "append")
        stream_counts(fx.spark, f"{db}.silver_train", ["county", "product_type"], f"{db}.counts", checkpoint)
    return fx.spark.table(f"{db}.counts")


@query("t04_memory", "SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1")
def t04(fx: Fixtures) -> DataFrame:
    """Counts per nation of the whole table are few rows, whatever its size."""
    db = fresh_database(fx.spark, "t04")
    write_table(fx.table("customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n")), f"{db}.t")
    return fx.spark.table(stream_to_memory(fx.spark.readStream.table(f"{db}.t")))


@query("t05_interval_trigger", "SELECT * FROM readings", ("readings",))
def t05(fx: Fixtures) -> DataFrame:
    db = fresh_database(fx.spark, "t05")
    write_table(fx.readings(), f"{db}.silver_train")
    q = stream_copy(
        fx.spark, f"{db}.silver_train", scratch_dir(fx.spark, "t05c"), f"{db}.gold_train", interval="2 seconds"
    )
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return fx.spark.table(f"{db}.gold_train")


@query("t06_path_sink", "SELECT * FROM readings", ("readings",))
def t06(fx: Fixtures) -> DataFrame:
    db, path = fresh_database(fx.spark, "t06"), scratch_dir(fx.spark, "t06")
    write_table(fx.readings(), f"{db}.silver_train")
    stream_copy(fx.spark, f"{db}.silver_train", scratch_dir(fx.spark, "t06c"), path=path)
    return fx.spark.read.parquet(path)

"""Text formats that no reader option covers: block headers and ragged last fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablework.functions.expressions import parse_number

SEGMENT = 1 << 16  # lines that meet in one window


def parse_block_ratings(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Ratings from files in which a line ``<item>:`` sets the item of the following lines
    ``<user>,<score>,<date>``.

    A file may be cut into many splits and a block may run over several of them. Splits are cut into
    segments of at most ``SEGMENT`` lines. Inside a segment
    the last header is carried forward in line order; lines before the first header of a segment
    take the last header of the segments before it. The only per-file window runs over one row per
    segment, so neither a huge file nor a huge block nor a huge split meets in one task.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = (
        spark.read.text(paths)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
        )
        .withColumn("pos", F.monotonically_increasing_id())
        .withColumn("segment", F.floor(F.col("pos") / SEGMENT))
        .withColumn("header", F.regexp_extract(F.trim("value"), r"^(\d+):$", 1))
        .withColumn("header", F.when(F.col("header") != "", F.col("header")))
    )
    part = Window.partitionBy("file", "start", "segment")
    carried = lines.withColumn(
        "here", F.last("header", ignorenulls=True).over(part.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    )
    # One row per segment: its last header, or none, and from these the header it starts with.
    ends = lines.groupBy("file", "start", "segment").agg(F.max_by("header", F.when(F.col("header").isNotNull(), F.col("pos"))).alias("last"))
    before = Window.partitionBy("file").orderBy("start", "segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select("file", "start", "segment", F.last("last", ignorenulls=True).over(before).alias("carry"))
    fields = F.split("value", ",")
    return (
        carried.where(F.col("header").isNull() & F.col("value").contains(","))
        .join(starts, ["file", "start", "segment"], "left")
        .select(
            F.coalesce("here", "carry").alias("Movie_ID"),
            F.trim(F.get(fields, F.lit(0))).alias("User_ID"),
            F.get(fields, F.lit(1)).try_cast("int").alias("Rating"),
            F.trim(F.get(fields, F.lit(2))).try_cast("date").alias("Date"),
        )
    )


def ingest_ratings(spark: SparkSession, paths: Sequence[str], table: str) -> DataFrame:
    """Parse several block files and store them as one table."""
    parse_block_ratings(spark, paths).write.mode("overwrite").saveAsTable(table)
    return spark.table(table)


def parse_titles(spark: SparkSession, paths: str | Sequence[str], encoding: str = "ISO-8859-1") -> DataFrame:
    """``id,year,title`` lines whose title may hold commas (they are dropped) and whose year may be NULL."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    # Every byte is a character in this encoding, so the raw lines are decoded, not re-read.
    fields = F.split("value", ",", 3)
    raw = spark.read.option("encoding", encoding).schema("value STRING").csv(paths, sep="\u0001", quote="")
    return raw.select(
        F.trim(F.get(fields, F.lit(0))).alias("Movie_ID"),
        parse_number(F.get(fields, F.lit(1)), "int").alias("Release_Year"),
        F.regexp_replace(F.coalesce(F.get(fields, F.lit(2)), F.lit("")), ",", "").alias("Title"),
    )

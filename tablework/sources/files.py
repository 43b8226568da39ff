"""File scans: CSV, JSON, directory discovery, audit columns, file-name columns, header clean-up."""

from __future__ import annotations

import re
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablework.session import staged
from tablework.sinks.tables import write_table


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str | None = None,
    header: bool = True,
    infer: bool = False,
) -> DataFrame:
    """One table from a file, a folder or a list of them.

    With a schema the data are read once. ``infer=True`` costs a second full pass; with neither
    every column is text.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.format("csv").option("header", header)
    if schema is not None:
        reader = reader.schema(schema).option("mode", "PERMISSIVE")
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.load(paths)


def load_csv_checked(spark: SparkSession, path: str | Sequence[str], schema: StructType, table: str, quarantine: str, header: bool = True) -> dict[str, int]:
    """Append the well-formed rows of CSV files to one table and the raw text of all others to a second one; returns their numbers.

    A row is malformed if it has too many or too few fields or a value that is not of its column's type. The files
    are parsed once, with all columns (Spark looks for faults only in columns that are asked for). ``quarantine``
    has the columns file_path, raw_text and load_timestamp.
    """
    bad = "_corrupt_record"
    reader = spark.read.schema(StructType([*(StructField(f.name, f.dataType) for f in schema.fields), StructField(bad, StringType())]))
    reader = reader.option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad)
    seen = Observation()
    parsed = reader.csv([path] if isinstance(path, str) else list(path)).withColumn("_file", F.col("_metadata.file_path"))
    counted = parsed.observe(seen, F.count_if(F.col(bad).isNull()).alias("good"), F.count_if(F.col(bad).isNotNull()).alias("bad"))
    rows = staged(counted, "parsed")
    write_table(rows.where(F.col(bad).isNull()).select(schema.names), table, "append")
    left = rows.where(F.col(bad).isNotNull()).select(F.col("_file").alias("file_path"), F.col(bad).alias("raw_text"), F.current_timestamp().alias("load_timestamp"))
    write_table(left, quarantine, "append")
    try:
        return dict(seen.get)
    except Py4JJavaError:  # files without any row report nothing
        return {"good": 0, "bad": 0}


def read_json(spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path if isinstance(path, str) else list(path))


def discover_csv(spark: SparkSession, directory: str, prefix: str = "bronze_") -> dict[str, str]:
    """Map table name -> path for every ``*.csv`` entry (file, or folder of part files) of a directory.

    Only names are listed, through the file system Spark itself uses.
    """
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(directory.rstrip("/") + "/*.csv")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = {}
    for status in fs.globStatus(pattern) or []:
        path = status.getPath()
        found[prefix + path.getName()[: -len(".csv")]] = path.toString()
    return dict(sorted(found.items()))


def discovered(spark: SparkSession, directory: str, prefix: str = "bronze_") -> DataFrame:
    """The discovery as a table with row counts."""
    parts = []
    for name, path in discover_csv(spark, directory, prefix).items():
        counts = read_csv(spark, path).agg(F.count(F.lit(1)).alias("n_rows"))
        parts.append(counts.select(F.lit(name).alias("table_name"), "n_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def with_ingest_metadata(df: DataFrame, run_id: str, job_group: str) -> DataFrame:
    """Add the audit columns to a file scan; must be called directly on the scan."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("file_modification_time"),
        F.lit(run_id).cast("string").alias("run_id"),
        F.lit(job_group).alias("job_group"),
        F.current_timestamp().alias("process_timestamp"),
    )


def with_file_year(df: DataFrame, out: str = "file_year") -> DataFrame:
    """Add the four digits after the last ``_`` of the file name (``properties_2016.csv`` -> 2016).

    A CSV table written by Spark is a folder of part files; its folder name is used then.
    """
    path = F.regexp_replace(F.col("_metadata.file_path"), "/part-[^/]*$", "")
    name = F.element_at(F.split(path, "/"), -1)
    return df.select("*", F.substring(F.element_at(F.split(name, "_"), -1), 1, 4).alias(out))


# The month names used in wide price files.
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)


def clean_name(name: str, month_style: bool = True) -> str:
    """``November 2010`` -> ``nov_2010``; other blanks and odd characters become ``_``."""
    month = re.fullmatch(r"(\w+) (\d{4})", name.strip())
    if month_style and month and month.group(1) in MONTHS:
        return f"{month.group(1)[:3].lower()}_{month.group(2)}"
    return re.sub(r"[^0-9A-Za-z]+", "_", name.strip()).strip("_")


def sanitize_columns(df: DataFrame, month_style: bool = True) -> DataFrame:
    return df.toDF(*[clean_name(c, month_style) for c in df.columns])

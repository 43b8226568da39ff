"""Managed tables, typed writes, control rows and CSV export."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Text writers cut times to milliseconds unless told otherwise.
TIME_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def balanced(df: DataFrame, partition_by: Sequence[str] | None) -> DataFrame:
    """Bring the rows of one output partition together, in files of the advisory size.

    The rebalance hint lets adaptive execution split a partition value that holds much of the data
    over several tasks and merge small ones, where ``repartition(col)`` would use one task each.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_table(
    df: DataFrame, name: str, mode: str = "overwrite", partition_by: Sequence[str] | None = None
) -> DataFrame:
    """Save as a parquet table and return it; appending to a missing table creates it."""
    spark = df.sparkSession
    if mode == "overwrite" or not spark.catalog.tableExists(name):
        return swap_table(df, name, partition_by)
    writer = balanced(df, partition_by).write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return spark.table(name)


def replace_partitions(df: DataFrame, name: str, partition_by: Sequence[str]) -> DataFrame:
    """Write the frame's partition values into a table in place of what they held; other partitions stay.

    Writing the same rows again leaves the same table.
    """
    spark = df.sparkSession
    ordered = [c.name for c in spark.catalog.listColumns(name)]
    key = "spark.sql.sources.partitionOverwriteMode"  # an insert into a table takes it from the session only
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        balanced(df.select(*ordered), partition_by).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(key, before)
    return spark.table(name)


def location_of(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {name}").where(F.col("col_name") == "Location").collect()
    return rows[0]["data_type"]


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def table_property(spark: SparkSession, name: str, key: str) -> str | None:
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == key).collect()
    return found[0]["value"] if found else None


def partition_states(spark: SparkSession, name: str, column: str) -> dict[str, str]:
    """For each value of a table's only partition column a text that changes when its files do. Reads the listing alone."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(location_of(spark, name))
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(root, True)
    found: dict[str, list[int]] = {}
    while files.hasNext():
        status = files.next()
        folder, file = status.getPath().getParent().getName(), status.getPath().getName()
        if folder.startswith(f"{column}=") and not file.startswith(("_", ".")):
            state = found.setdefault(folder.removeprefix(f"{column}="), [0, 0, 0])
            state[0] += 1
            state[1] += status.getLen()
            state[2] = max(state[2], status.getModificationTime())
    return {value: ":".join(map(str, state)) for value, state in found.items()}


def drop_partitions(spark: SparkSession, name: str, parts: Sequence[str], values: Sequence[tuple]) -> None:
    """Remove whole partitions from a table, with their files."""
    for row in values:
        spec = []
        for p, v in zip(parts, row, strict=True):
            text = "null" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
            spec.append(f"`{p}` = {text}")
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({', '.join(spec)}) PURGE")


def _versions_prefix(spark: SparkSession, name: str) -> str:
    """Folders of the versions of a table start with this path."""
    db, _, table = name.rpartition(".")
    return f"{spark.catalog.getDatabase(db or spark.catalog.currentDatabase()).locationUri}/{table}__"


def swap_table(df: DataFrame, name: str, partition_by: Sequence[str] | None = None) -> DataFrame:
    """Replace content and schema of a table by a frame that may read that same table.

    Each version is written to a folder of its own; only then the table name points there. A job
    that fails before leaves the old version in place. With equal columns the name is repointed in
    one catalog call. Otherwise the new version is created under a second name, the old table steps
    aside under a third, and the second takes the name; if that fails the old table gets its name
    back, and only afterwards is it dropped. Old versions stay on disk, so that running readers can
    finish, until :func:`drop_old_versions` is called.
    """
    spark = df.sparkSession
    path = _versions_prefix(spark, name) + uuid.uuid4().hex[:12]
    writer = balanced(df, partition_by).write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    if spark.catalog.tableExists(name):
        before = [(f.name, f.dataType) for f in spark.table(name).schema]
        if not partition_by and not partition_columns(spark, name) and before == [(f.name, f.dataType) for f in df.schema]:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            spark.catalog.refreshTable(name)
            return spark.table(name)
    fresh = f"{name}_new_{uuid.uuid4().hex[:8]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    parts = f"PARTITIONED BY ({', '.join(partition_by)}) " if partition_by else ""
    spark.sql(f"CREATE TABLE {fresh} ({columns}) USING parquet {parts}LOCATION '{path}'")
    if partition_by:
        spark.catalog.recoverPartitions(fresh)
    aside = f"{name}_old_{uuid.uuid4().hex[:8]}" if spark.catalog.tableExists(name) else None
    if aside:
        spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
    try:
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    except Exception:
        if aside:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
        raise
    if aside:
        spark.sql(f"DROP TABLE {aside}")
    return spark.table(name)


def drop_old_versions(spark: SparkSession, name: str) -> int:
    """Delete the version folders of a table that its name no longer points to; returns their number."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(_versions_prefix(spark, name) + "*")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    current = location_of(spark, name).rstrip("/").rsplit("/", 1)[-1]
    table = name.split(".")[-1]
    folders = [s.getPath() for s in fs.globStatus(pattern) or []]
    ours = [f for f in folders if re.fullmatch(rf"{table}__[0-9a-f]{{12}}", f.getName())]  # not those of t__x
    old = [f for f in ours if f.getName() != current]
    for folder in old:
        fs.delete(folder, True)
    return len(old)


def ctas(df: DataFrame, name: str, if_not_exists: bool = False) -> DataFrame:
    """``CREATE TABLE ... AS``; with ``if_not_exists`` an existing table stays as it is."""
    spark = df.sparkSession
    view = f"v_{uuid.uuid4().hex[:8]}"
    df.createOrReplaceTempView(view)
    try:
        clause = "IF NOT EXISTS " if if_not_exists else ""
        spark.sql(f"CREATE TABLE {clause}{name} USING parquet AS SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
    return spark.table(name)


def partition_inventory(spark: SparkSession, name: str, column: str) -> DataFrame:
    """Rows per partition value; a count over the partition column reads no data column."""
    return spark.table(name).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def create_control(spark: SparkSession, name: str) -> None:
    """High-water marks, one row per loaded table, each in its own partition.

    Separate partitions let one table's mark be replaced without touching the others.
    """
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (data_block_id INT, load_timestamp TIMESTAMP, table_name STRING) "
        "USING parquet PARTITIONED BY (table_name)"
    )


def set_watermark(spark: SparkSession, name: str, table: str, value: int) -> None:
    create_control(spark, name)
    spark.sql(
        f"INSERT OVERWRITE {name} PARTITION (table_name = '{table}') VALUES ({int(value)}, current_timestamp())"
    )


def get_watermark(spark: SparkSession, name: str, table: str, default: int = -1) -> int:
    if not spark.catalog.tableExists(name):
        return default
    top = spark.table(name).where(F.col("table_name") == table).agg(F.max("data_block_id")).first()[0]
    return default if top is None else top


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write a result as CSV with a header; every task writes its own part."""
    df.write.mode(mode).option("header", True).options(**TIME_FORMATS).csv(path)
    return path


def export_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).options(**TIME_FORMATS).json(path)
    return path

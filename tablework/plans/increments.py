"""What has changed since the last load: blocks of a table by their files, and what silver may hold of new keys.

A loaded table remembers, for each block of its source, the state of that block's files (a number of
files, their octets, their latest change). The next load reads the blocks whose state differs, whichever
numbers they have, so late files in old blocks are seen as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tablework.sinks.tables import partition_columns, partition_states, replace_partitions, write_table

BLOCK = "data_block_id"
STATE = "loaded_block_states"
RANGES = "silver_key_ranges"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class Changes:
    """The blocks of ``source`` that differ from what ``reader`` has loaded. Without a block partition: all of it, always."""

    def __init__(self, spark: SparkSession, db: str, source: str, reader: str):
        self.spark, self.name, self.reader, self.state_table = spark, f"{db}.{source}", reader, f"{db}.{STATE}"
        self.states = partition_states(spark, self.name, BLOCK) if partition_columns(spark, self.name) == [BLOCK] else None
        known: dict[str, str] = {}
        if spark.catalog.tableExists(self.state_table):
            known = {r[BLOCK]: r.state for r in spark.table(self.state_table).where(F.col("reader") == reader).collect()}
        self.first = not known
        self.blocks = None if self.states is None else sorted(b for b, s in self.states.items() if known.get(b) != s)
        self.all = self.blocks is None or len(self.blocks) == len(self.states)

    def any(self) -> bool:
        return self.blocks is None or bool(self.blocks)

    def inside(self) -> Column:
        """A condition on the block column that prunes to the changed blocks."""
        values = [int(b) for b in self.blocks or [] if b != NO_VALUE]
        found = F.col(BLOCK).isin(values)
        return found | F.col(BLOCK).isNull() if self.blocks and len(values) < len(self.blocks) else found

    def rows(self) -> DataFrame:
        """The rows of the changed blocks; no other file is read."""
        table = self.spark.table(self.name)
        return table if self.all else table.where(self.inside())

    def remember(self) -> None:
        """The changed blocks are loaded now. Call it last: a load that fails before is repeated."""
        if self.states is None:
            return
        data = [(b, s, self.reader) for b, s in self.states.items()]
        states = self.spark.createDataFrame(data, f"{BLOCK} string, state string, reader string")
        if self.spark.catalog.tableExists(self.state_table):
            replace_partitions(states, self.state_table, ["reader"])
        else:
            write_table(states, self.state_table, "overwrite", ["reader"])


def add_key_ranges(batch: DataFrame, db: str, table: str, key: str) -> None:
    """Note between which values the key lies in each block of a batch that is about to be appended to silver."""
    if not isinstance(batch.schema[key].dataType, IntegralType):
        return
    ranges = batch.groupBy(BLOCK).agg(F.min(key).cast("long").alias("low"), F.max(key).cast("long").alias("high"))
    rows = ranges.select(F.col(BLOCK).cast("int").alias(BLOCK), "low", "high", F.lit(table).alias("table_name"))
    write_table(rows, f"{db}.{RANGES}", "append", ["table_name"])


def possible_matches(spark: SparkSession, db: str, table: str, fresh: DataFrame, keys: Sequence[str], changes: Changes) -> DataFrame | None:
    """The part of silver that may hold keys of the fresh rows; None if there is no silver table yet.

    Keys with the block in them can only be in the same blocks. A whole-number key is looked for in the blocks whose
    range of keys meets the fresh ones, and only between these. Otherwise all of silver is compared.
    """
    name = f"{db}.silver_{table}"
    if not spark.catalog.tableExists(name):
        return None
    silver, key = spark.table(name), keys[0]
    if changes.blocks is None:
        return silver
    if BLOCK in keys:
        return silver.where(changes.inside())
    if not isinstance(fresh.schema[key].dataType, IntegralType) or not spark.catalog.tableExists(f"{db}.{RANGES}"):
        return silver
    low, high = fresh.agg(F.min(key), F.max(key)).first()
    if low is None:
        return silver.limit(0)
    ranges = spark.table(f"{db}.{RANGES}").where(F.col("table_name") == table)
    met = ranges.groupBy(BLOCK).agg(((F.max("high") >= low) & (F.min("low") <= high)).alias("met")).collect()  # one row per block
    if not {r[BLOCK] for r in met} >= {None if b == NO_VALUE else int(b) for b in partition_states(spark, name, BLOCK)}:
        return silver  # rows that were written by other means
    blocks = [r[BLOCK] for r in met if r.met]
    condition = F.col(BLOCK).isin([b for b in blocks if b is not None])
    condition = condition | F.col(BLOCK).isNull() if None in blocks else condition
    return silver.where(condition & F.col(key).between(low, high))

"""Key-wise synchronisation of a table with a source: update, insert, delete.

A merge writes only the partitions that hold a changed row. Tables without partitions of their own can be
cut into ranges of a key by :func:`write_ranged`; merges then rewrite the touched ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablework.session import staged
from tablework.sinks.tables import drop_partitions, partition_columns, replace_partitions, swap_table, table_property, write_table

RANGE = "key_range"
RANGES_PROPERTY = "tablework.ranges"


class DuplicateSourceKey(ValueError):
    """A key occurs twice in the source, so the outcome would be arbitrary."""


def assert_unique(source: DataFrame, keys: Sequence[str]) -> None:
    complete = source.na.drop("any", subset=list(keys))
    if complete.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        raise DuplicateSourceKey(f"source holds several rows for one value of {list(keys)}")


def merge_actions(
    target: DataFrame, source: DataFrame, keys: Sequence[str], delete_missing: bool = True, null_safe: bool = False, old: Sequence[str] = ()
) -> DataFrame:
    """All rows of the merge with ``_action``: insert, update, keep or delete.

    ``old`` names columns whose values in the target are wanted as ``_old_<name>`` too.

    Target rows found in the source take every non-key column from it; ``keep`` marks those that
    were equal already, and, without ``delete_missing``, those the source does not know. A null key
    matches nothing unless ``null_safe`` is set, so such source rows are inserted.
    """
    keys = list(keys)
    values = [c for c in target.columns if c not in keys]
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns], F.lit(True).alias("_t"))
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in target.columns], F.lit(True).alias("_s"))
    on = F.lit(True)
    for k in keys:
        pair = F.col(f"t_{k}").eqNullSafe(F.col(f"s_{k}")) if null_safe else F.col(f"t_{k}") == F.col(f"s_{k}")
        on = on & pair
    in_target, in_source = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    same = F.lit(True)
    for c in values:
        same = same & F.col(f"t_{c}").eqNullSafe(F.col(f"s_{c}"))
    action = (
        F.when(in_target & in_source, F.when(same, "keep").otherwise("update"))
        .when(in_source, "insert")
        .otherwise("delete" if delete_missing else "keep")
    )
    merged = [F.when(in_source, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c) for c in target.columns]
    before = [F.col(f"t_{c}").alias(f"_old_{c}") for c in old]
    if null_safe:
        return t.join(s, on, "full").select(*merged, action.alias("_action"), *before)
    # Null keys match nothing, so these rows need no join, in which they would meet in one task.
    t_known, s_known = (_complete(x, [f"{side}_{k}" for k in keys]) for x, side in ((t, "t"), (s, "s")))
    joined = t.where(t_known).join(s.where(s_known), on, "full").select(*merged, action.alias("_action"), *before)
    alone_t = t.where(~t_known).select(*[F.col(f"t_{c}").alias(c) for c in target.columns], F.lit("delete" if delete_missing else "keep").alias("_action"), *before)
    none = [F.lit(None).cast(target.schema[c].dataType).alias(f"_old_{c}") for c in old]
    alone_s = s.where(~s_known).select(*[F.col(f"s_{c}").alias(c) for c in target.columns], F.lit("insert").alias("_action"), *none)
    return joined.unionByName(alone_t).unionByName(alone_s)


def _complete(df: DataFrame, cols: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNotNull()
    return out


def merge_sync(
    spark: SparkSession,
    target: str,
    source: DataFrame,
    keys: Sequence[str],
    delete_missing: bool = True,
    null_safe: bool = False,
    unique_checked: bool = False,
    scope: Column | None = None,
) -> dict[str, int]:
    """Synchronise ``db.table`` with the source and return the number of rows per action.

    A missing table is created from the source. ``unique_checked`` skips the duplicate-key test for
    sources that are grouped by the keys. ``scope`` is a condition on target rows: only these are compared, and the
    source must hold all that is to be in that part of the table afterwards.

    A partitioned target, or one made by :func:`write_ranged`, gets only those partitions written that
    hold a changed row; the files of all others stay as they are. Another target is replaced as a whole.
    """
    if not unique_checked:
        assert_unique(source, keys)
    if not spark.catalog.tableExists(target):
        write_table(source, target)
        return {"insert": spark.table(target).count(), "update": 0, "keep": 0, "delete": 0}
    parts = partition_columns(spark, target)
    source = ranged(source, target)
    seen = Observation()  # the counts ride along with the write, so the join runs once
    table = spark.table(target)
    actions = merge_actions(table if scope is None else table.where(scope), source, keys, delete_missing, null_safe, parts)
    names = ("insert", "update", "keep", "delete")
    counted = actions.observe(seen, *[F.count_if(F.col("_action") == a).alias(a) for a in names])
    if parts:
        write_changes(staged(counted.where(F.col("_action") != "keep"), "merge-changes"), target, keys, parts, null_safe)
    else:
        merged = counted.where(F.col("_action") != "delete").drop("_action")
        swap_table(merged if scope is None else merged.unionByName(table.where(~F.coalesce(scope, F.lit(False)))), target)
    try:
        counts = seen.get
    except Py4JJavaError:  # a plan found to be empty at run time reports no metrics at all
        counts = {}
    return {a: counts.get(a, 0) for a in names}


def write_changes(changes: DataFrame, target: str, keys: Sequence[str], parts: Sequence[str], null_safe: bool = False) -> int:
    """Write the partitions that the changes (a stored table of :func:`merge_actions`) touch; returns their number.

    The new content of these partitions is written aside first. A crash leaves some of them
    old and some new, and repeating the merge brings the rest.
    """
    spark = changes.sparkSession
    here = changes.where(F.col("_action") != "delete").select(*parts)
    before = changes.where(F.col("_action") != "insert").select(*[F.col(f"_old_{p}").alias(p) for p in parts])
    touched = [tuple(r) for r in here.unionByName(before).distinct().collect()]  # no more than the table has partitions
    if not touched:
        return 0
    table = spark.table(target)
    inside = table.where(in_partitions(touched, parts))
    gone = changes.where(F.col("_action") != "insert").select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k).eqNullSafe(F.col(f"_k_{k}")))  # rows with null keys change only by being deleted, all of them
    content = inside.join(gone, on, "left_anti").unionByName(changes.where(F.col("_action") != "delete").select(*table.columns))
    content = staged(content, "merge-partitions")
    left = {tuple(r) for r in content.select(*parts).distinct().collect()}
    if left:
        replace_partitions(content, target, parts)
    drop_partitions(spark, target, parts, [t for t in touched if t not in left])
    return len(touched)


def in_partitions(values: Sequence[tuple], parts: Sequence[str]) -> Column:
    """A condition on partition columns that Spark can prune by."""
    if len(parts) == 1:
        known = [v for (v,) in values if v is not None]
        found = F.col(parts[0]).isin(known)
        return found | F.col(parts[0]).isNull() if len(known) < len(values) else found
    any_of = F.lit(False)
    for row in values:
        one = F.lit(True)
        for p, v in zip(parts, row, strict=True):
            one = one & (F.col(p).isNull() if v is None else F.col(p) == F.lit(v))
        any_of = any_of | one
    return any_of


def write_ranged(df: DataFrame, name: str, key: str, ranges: int = 64) -> DataFrame:
    """Save a table that is cut into about equal ranges of a key (a number, date or time), as partitions ``key_range``.

    The bounds come from a quantile sketch and are kept with the table, so a later merge puts every row into its
    range; what lies beyond the last bound goes to the last range, null keys to the first.
    """
    kind = df.schema[key].dataType.simpleString()
    number = F.col(key).cast("double") if kind != "date" else F.unix_date(key).cast("double")
    number = F.col(key).cast("timestamp").cast("double") if kind.startswith("timestamp") else number
    steps = [k / ranges for k in range(1, ranges)]
    found = df.agg(F.percentile_approx(number, F.array(*map(F.lit, steps)), 10_000)).first()[0] if steps else []
    bounds = sorted(set(found or []))
    write_table(df.withColumn(RANGE, range_of(df, key, bounds)), name, "overwrite", [RANGE])
    text = ",".join([key, *map(repr, bounds)])
    df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{RANGES_PROPERTY}' = '{text}')")
    return df.sparkSession.table(name)


def range_of(df: DataFrame, key: str, bounds: Sequence[float]) -> Column:
    kind = df.schema[key].dataType.simpleString()
    number = F.unix_date(key) if kind == "date" else F.col(key).cast("timestamp") if kind.startswith("timestamp") else F.col(key)
    over = F.filter(F.array(*map(F.lit, bounds)), lambda b: b < number.cast("double")) if bounds else F.array()
    return F.when(F.col(key).isNull(), 0).otherwise(F.size(over))


def ranged(source: DataFrame, target: str) -> DataFrame:
    """The source with the range column of a target that :func:`write_ranged` made; as it is for other targets."""
    text = table_property(source.sparkSession, target, RANGES_PROPERTY)
    if text is None:
        return source
    key, *bounds = text.split(",")
    return source.withColumn(RANGE, range_of(source, key, [float(b) for b in bounds]))

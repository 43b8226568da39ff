"""Projections, casts, null handling, de-duplication and sampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

from tablework.functions.expressions import hash_fraction, parse_number


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    """Put ``prefix_`` in front of every column name."""
    return df.toDF(*[f"{prefix}_{c}" for c in df.columns])


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; values that do not fit become null."""
    text = {c for c, t in df.dtypes if t == "string"}
    return df.withColumns({c: parse_number(c, t) if c in text else F.col(c).try_cast(t) for c, t in types.items()})


def complete_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Keep rows in which all given columns (default: every column) hold a value."""
    return df.na.drop("any", subset=list(cols) if cols else None)


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls column by column, all in one projection so that no fill undoes another."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def column_modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the most frequent non-null value per column, the smallest one on ties.

    Counting by (column, value) in one pass keeps the shuffle spread over the values; only one
    best value per column and task reaches the last step.
    """
    slots = {c: f"_m{i}" for i, c in enumerate(cols)}
    renamed = df.select([F.col(c).alias(s) for c, s in slots.items()])
    counted = renamed.groupingSets([[F.col(s)] for s in slots.values()], *slots.values()).agg(
        F.count(F.lit(1)).alias("_n"), *[F.grouping(s).alias(f"_g{s}") for s in slots.values()]
    )
    best = []
    for c, s in slots.items():
        mine = (F.col(f"_g{s}") == 0) & F.col(s).isNotNull()
        rank = F.when(mine, F.struct((-F.col("_n")).alias("n"), F.col(s).alias("v")))
        best.append(F.min(rank)["v"].alias(c))
    return counted.agg(*best)


def fill_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace nulls by the mode of their column; the one-row modes come in as scalar subqueries."""
    modes = column_modes(df, cols)
    return df.select(
        [
            F.coalesce(F.col(c), modes.select(c).scalar()).alias(c) if c in cols else F.col(c)
            for c in df.columns
        ]
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row per key in an explicit order.

    A ``min`` over (order, row) combines before the shuffle, so a hot key sends one row per task
    where a ``row_number`` window would sort the whole key in one task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordered = F.struct(
        *[(F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order)],
        *[F.col(c) for c in rest],
    )
    best = df.groupBy(*keys).agg(F.min(ordered).alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(df.columns)


def random_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Bernoulli sample; depends on the partitioning, see :func:`hash_sample`."""
    return df.sample(fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, keys: Sequence[str], fraction: float) -> DataFrame:
    """Sample whole keys by their hash: the same rows on every run and cluster."""
    return df.where(hash_fraction(*keys) < fraction)


def detect_categoricals(df: DataFrame, max_levels: int = 15) -> DataFrame:
    """One row per column: its number of distinct values and whether it counts as categorical.

    (column, value) pairs are made distinct first, so no task sees all values of a column.
    """
    pairs = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                    for c in df.columns
                ]
            )
        ).alias("p")
    ).select("p.*")
    counts = pairs.groupBy("column_name").agg(F.count_distinct("value").alias("n_distinct"))
    return counts.withColumn("is_categorical", F.col("n_distinct") <= max_levels)


def one_hot(df: DataFrame, col: str, prefix: str | None = None, levels: Sequence[object] | None = None) -> DataFrame:
    """Replace a column by one 0/1 column per value, named ``prefix_value``.

    ``levels`` names the values that get a column; by default all that occur do, which are as many
    names as the result has columns. Values whose names would be equal get a number behind theirs. For
    very many values :func:`tablework.ml.features.one_hot_vector` is the better form.
    """
    prefix = prefix or col
    if levels is None:
        levels = sorted(r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().collect())
    taken = {c.lower() for c in df.columns if c != col}
    flags = []
    for v in levels:
        name = plain = f"{prefix}_{str(v).replace(' ', '_')}"
        n = 1
        while name.lower() in taken:
            n += 1
            name = f"{plain}_{n}"
        taken.add(name.lower())
        flags.append(F.when(F.col(col) == F.lit(v), 1).otherwise(0).alias(name))
    return df.select(*[c for c in df.columns if c != col], *flags)


def enforce_schema(df: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Split text rows into those that satisfy a typed schema with NOT NULL columns and the rest.

    A row is rejected when a value does not parse or a required one is missing.
    """
    typed = {f"_t_{f.name}": F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    for f in schema.fields:
        if isinstance(f.dataType, NumericType) and dict(df.dtypes)[f.name] == "string":
            typed[f"_t_{f.name}"] = parse_number(f.name, f.dataType.simpleString())
    bad = F.lit(False)
    for f in schema.fields:
        broken = F.col(f.name).isNotNull() & F.col(f"_t_{f.name}").isNull()
        bad = bad | broken
        if not f.nullable:
            bad = bad | F.col(f"_t_{f.name}").isNull()
    tested = df.withColumns(typed).withColumn("_bad", bad)
    ok = tested.where(~F.col("_bad")).select([F.col(f"_t_{f.name}").alias(f.name) for f in schema.fields])
    return ok, tested.where("_bad").select(df.columns)

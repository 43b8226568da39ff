"""Lookup, date-shifted, anti, semi and one-row joins.

No join carries a broadcast hint: Spark broadcasts a side only while its measured size is below
``spark.sql.autoBroadcastJoinThreshold``, and beyond it sorts and merges, where adaptive execution
splits hot partitions of the fact side (inner, left, semi and anti joins all keep facts on the left).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.functions.expressions import as_col, padded_prefix


def enrich(df: DataFrame, lookups: Sequence[tuple[str, DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Chain of left joins code -> description.

    Each item is (code column, lookup, key of the lookup, columns to add). A lookup must have one
    row per key, otherwise the join would multiply facts (see :func:`check_multiplicity`).
    """
    for code, lookup, key, out in lookups:
        side = lookup.select(F.col(key).alias(f"_k_{code}"), *out)
        df = df.join(side, F.col(code) == F.col(f"_k_{code}"), "left").drop(f"_k_{code}")
    return df


def enrich_default(df: DataFrame, code: str, lookup: DataFrame, key: str, out: str, default=0) -> DataFrame:
    """Left lookup; a missing code is shown as ``default``."""
    return enrich(df, [(code, lookup, key, [out])]).withColumn(code, F.coalesce(F.col(code), F.lit(default)))


def enrich_state(df: DataFrame, states: DataFrame, county_code: str, state_key: str) -> DataFrame:
    """Left join on the state part (first two digits) of a zero-padded five digit county code."""
    states = states.withColumn(state_key, F.lpad(F.col(state_key).cast("string"), 2, "0"))
    return df.join(states, padded_prefix(county_code, 5, 2) == states[state_key], "left")


def join_shifted(
    fact: DataFrame,
    dim: DataFrame,
    ts: str,
    dim_ts: str,
    days: int = 1,
    grain: str = "day",
    how: str = "left",
) -> DataFrame:
    """Join facts with the dimension row of ``days`` before.

    ``grain="day"`` compares dates (an hourly dimension then matches up to 24 rows per fact),
    ``grain="hour"`` compares hours. The key is computed on the dimension side, which keeps it an
    equi-join and leaves the fact column untouched. Dimension columns must not clash with facts.
    """
    if grain == "day":
        left_key = F.to_date(F.col(ts))
        key = F.date_add(F.to_date(dim_ts), days) if days else F.to_date(dim_ts)
    elif grain == "hour":
        left_key = F.date_trunc("hour", ts).cast("timestamp_ntz")
        key = (F.col(dim_ts) + F.expr(f"INTERVAL {int(days)} DAY")).cast("timestamp_ntz")
    else:
        raise ValueError("grain is 'day' or 'hour'")
    return fact.join(dim.withColumn("_join_key", key), left_key == F.col("_join_key"), how).drop("_join_key")


def join_exact(fact: DataFrame, dim: DataFrame, fact_key: str | Column, dim_key: str, how: str = "left") -> DataFrame:
    """Join on equal keys, times to the last digit; dimension columns must not clash with facts, and a null key meets nothing."""
    return fact.join(dim, as_col(fact_key) == dim[dim_key], how)


def check_multiplicity(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before and after a join and their ratio (1.0 = the join added no rows)."""
    n_before = before.agg(F.count(F.lit(1)).alias("n"))
    return (
        after.agg(F.count(F.lit(1)).alias("rows_after"))
        .withColumn("rows_before", n_before.scalar())
        .select(
            "rows_before", "rows_after", F.try_divide(F.col("rows_after"), F.col("rows_before")).alias("multiplicity")
        )
    )


def full_outer_by_key(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join with one coalesced key. Both sides are aggregates, one row per key."""
    return a.join(b, list(keys), "full")


def new_rows(source: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not there yet; only the keys of the existing side are read."""
    return source.join(existing.select(*keys), list(keys), "left_anti")


def in_set(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_semi")


def latest_version(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Rows that carry the highest ``ts`` of their key; ties stay, rows with a null key go.

    The maxima combine before the shuffle and the semi join can split a hot key, whereas a window
    over the key would put all its rows into one task.
    """
    keys = list(keys)
    newest = df.groupBy(*keys).agg(F.max(ts).alias(ts))
    return df.join(newest, [*keys, ts], "left_semi")


def latest_blocks(df: DataFrame, block: str, n: int, distinct: bool = True) -> DataFrame:
    """All rows in the latest blocks.

    ``distinct=True``: the ``n`` highest block values. ``distinct=False``: the blocks of the last
    ``n`` rows, usually a single one.
    """
    top = df.select(block).distinct() if distinct else df.select(block)
    top = top.orderBy(F.col(block).desc_nulls_last()).limit(n)
    return in_set(df, top.distinct(), block)


def with_total(df: DataFrame, total: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame, as scalar subqueries."""
    return df.select("*", *[total.select(c).scalar().alias(c) for c in total.columns])


def score_pairs(predictions: DataFrame, actuals: DataFrame, keys: Sequence[str]) -> DataFrame:
    return actuals.join(predictions, list(keys))


def top_titles(scores: DataFrame, titles: DataFrame, key: str, score: str, n: int, ascending: bool = False) -> DataFrame:
    """The best (or worst) ``n`` items, ties by key, with their titles."""
    order = F.col(score).asc() if ascending else F.col(score).desc()
    return scores.orderBy(order, F.col(key)).limit(n).join(titles, key, "left")

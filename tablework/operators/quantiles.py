"""Exact quantiles without gathering a group's values in one place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablework.session import staged

ACCURACY = 10_000  # of the sketches that choose brackets
GRID = 128  # steps of a sketch that are looked at
BUFFER = 5_000  # values of one bracket that may be held in a row


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], probs: Sequence[float], accuracy: int = ACCURACY, buffer: int = BUFFER
) -> DataFrame:
    """Interpolated quantiles and moments, one row per key and column.

    Columns: ``keys, _col, n_rows, n, mean, stddev, min, max, q0, q1, ...`` with the quantiles in
    rising order of ``probs``; ``n`` counts values, and a group without any has null results.

    Spark's own exact percentile keeps every distinct value of a group in one buffer. Here each wanted
    rank has a bracket of two values, at first the smallest and the largest. Every pass is one aggregate
    over the facts, all columns side by side. It counts the values below, at and between the ends of the
    brackets, so a bracket is known to hold its rank (one that a sketch placed wrongly is widened), and
    takes a sketch of the values in between to place narrower ends. Once the count shows that at most
    ``buffer`` values lie between, the next pass holds these, and the rank is read off. All aggregates
    combine before their shuffle, so a hot group costs no more than others.
    """
    keys, probs, accuracy = list(keys), sorted(probs), max(accuracy, 10 * GRID)  # a sketch must be finer than its steps
    targets = [(i, j) for i in range(len(cols)) for j in range(len(probs))]
    facts = df.select(*keys, *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(cols)])
    steps = [k / GRID for k in range(GRID + 1)]

    first = [F.count(F.lit(1)).alias("n_rows")]
    for i in range(len(cols)):
        v = F.col(f"_v{i}")
        named = {"n": F.count(v), "mean": F.avg(v), "stddev": F.stddev_samp(v), "min": F.min(v), "max": F.max(v)}
        first += [x.alias(f"{name}{i}") for name, x in named.items()] + [F.percentile_approx(v, steps, accuracy).alias(f"grid{i}")]
    totals = staged(facts.groupBy(*keys).agg(*first), "totals")

    # Brackets are rows (key, target); the facts meet them side by side, one struct per target.
    starts = F.array(*[F.struct(F.lit(x).alias("target"), *[F.col(f"{name}{i}").alias(name) for name in ("n", "min", "max", "grid")], F.lit(float(probs[j])).alias("p")) for x, (i, j) in enumerate(targets)])
    long = totals.select(*keys, F.inline(starts))
    at = F.floor(F.col("p") * GRID).cast("int")
    few = F.col("n") <= buffer
    low = F.when(few, F.col("min")).otherwise(F.get("grid", F.greatest(at - 1, F.lit(0))))
    high = F.when(few, F.col("max")).otherwise(F.get("grid", F.least(at + 2, F.lit(GRID))))
    none = F.lit(None).cast("double")
    state = long.select(
        *keys, "target", F.floor(F.col("p") * (F.col("n") - 1)).alias("rank"), "n", "min", "max", low.alias("lo"), high.alias("hi"), few.alias("few"),
        none.alias("a"), none.alias("b"), (F.col("n") == 0).alias("done"),
    )
    state = staged(state, "brackets")
    while state.where("NOT done").limit(1).count():
        work = _wide(state.where("NOT done"), keys, len(targets))
        found = [_measure(F.col(f"_v{i}"), F.col(f"t{x}"), steps, accuracy).alias(f"m{x}") for x, (i, _) in enumerate(targets)]
        seen = staged(_beside(facts, work, keys).groupBy(*keys).agg(*found), "measures")
        rows = seen.select(*[F.col(k).alias(f"_k{x}") for x, k in enumerate(keys)], F.posexplode(F.array(*[f"m{x}" for x in range(len(targets))])).alias("_t", "m"))
        same = _all([F.col(k).eqNullSafe(F.col(f"_k{x}")) for x, k in enumerate(keys)]) & (F.col("target") == F.col("_t"))
        state = staged(_narrow(state.join(rows, same, "left"), keys, buffer), "brackets")

    # One row per column from the wide rows, of which there is one per key.
    done = _wide(state, keys, len(targets))
    done = done.select(*[F.col(k).alias(f"_k{x}") for x, k in enumerate(keys)], *[f"t{x}" for x in range(len(targets))])
    same = _all([F.col(k).eqNullSafe(F.col(f"_k{x}")) for x, k in enumerate(keys)])
    wide = totals.join(done, same) if keys else _with_row(totals, done)
    out = []
    for i, c in enumerate(cols):
        fields = [F.lit(c).alias("_col"), F.col("n_rows"), *[F.col(f"{name}{i}").alias(name) for name in ("n", "mean", "stddev", "min", "max")]]
        for j, p in enumerate(probs):
            t = F.col(f"t{targets.index((i, j))}")
            part = F.lit(float(p)) * (t["n"] - 1) - t["rank"]
            fields.append((t["a"] + (t["b"] - t["a"]) * part).alias(f"q{j}"))
        out.append(F.struct(*fields))
    return wide.select(*keys, F.inline(F.array(*out)))


def _wide(state: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """One row per key with a struct t0, t1, ... for each target; null where that is not among the rows."""
    whole = F.struct("rank", "n", "lo", "hi", "few", "a", "b")
    return state.groupBy(*keys).agg(*[F.first(F.when(F.col("target") == x, whole), ignorenulls=True).alias(f"t{x}") for x in range(n)])


def _measure(v: Column, t: Column, steps: list[float], accuracy: int) -> Column:
    """Counts below, at and between the ends of a bracket, a sketch of the values between, and these if they are few."""
    lo, hi = t["lo"], t["hi"]
    between = (v > lo) & (v < hi)
    return F.struct(
        F.count_if(v < lo).alias("below"), F.count_if(v == lo).alias("at_lo"), F.count_if(between).alias("between"),
        F.count_if((v == hi) & (lo != hi)).alias("at_hi"),
        F.percentile_approx(F.when(between & ~t["few"], v), steps, accuracy).alias("grid"),
        F.sort_array(F.collect_list(F.when(between & t["few"], v))).alias("values"),
    )


def _then(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later ones use several times; as generated rows they are evaluated once."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _narrow(df: DataFrame, keys: Sequence[str], buffer: int) -> DataFrame:
    """The brackets after a pass: done, wider where they missed their rank, else narrower."""
    rank, lo, hi, m, inside, end, after = (F.col(c) for c in ("rank", "lo", "hi", "m", "inside", "end", "after"))
    short, over, known, near = F.col("short"), F.col("over"), F.col("known"), F.col("near")
    s = _then(
        df,
        inside=m["below"] + m["at_lo"],  # rank of the first value between
        end=m["below"] + m["at_lo"] + m["between"],
        after=F.least(rank + 1, F.col("n") - 1),  # both neighbours of the quantile are wanted
    )
    s = _then(s, short=rank < m["below"], over=after >= end + m["at_hi"])
    # Values strictly between the new ends are no more than were counted between the old ones.
    s = _then(s, known=~short & ~over & (F.col("few") | (m["between"] == 0)), near=~short & ~over & (m["between"] <= buffer))
    spot = lambda r: (F.lit(GRID) * (r - inside) / F.greatest(m["between"], F.lit(1))).cast("int")
    value = lambda r: F.when(r < inside, lo).when(r < end, F.get(m["values"], (r - inside).cast("int"))).otherwise(hi)
    low = F.when(short, F.col("min")).when(over | near | (rank < inside), lo).otherwise(F.coalesce(F.get(m["grid"], F.greatest(spot(rank) - 1, F.lit(0))), lo))
    high = F.when(over, F.col("max")).when(short | near | (after >= end), hi).otherwise(F.coalesce(F.get(m["grid"], F.least(spot(after) + 2, F.lit(GRID))), hi))
    fixed = F.col("done") | m.isNull()
    keep = lambda old, new: F.when(fixed, F.col(old)).otherwise(new).alias(old)
    return s.select(
        *keys, "target", "rank", "n", "min", "max", keep("lo", low), keep("hi", high), keep("few", near),
        keep("a", F.when(known, value(rank))), keep("b", F.when(known, value(after))), keep("done", known),
    )


def _beside(facts: DataFrame, work: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Facts with the brackets of their group."""
    if not keys:
        return _with_row(facts, work)
    side = work.select(*[F.col(k).alias(f"_k{x}") for x, k in enumerate(keys)], *[c for c in work.columns if c not in keys])
    return facts.join(side, _all([F.col(k).eqNullSafe(F.col(f"_k{x}")) for x, k in enumerate(keys)]))


def _with_row(df: DataFrame, one: DataFrame) -> DataFrame:
    """Every column of a one-row table as a constant column."""
    found = one.first()
    return df.select("*", *[_constant(found[f.name], f.dataType).alias(f.name) for f in one.schema.fields])


def _constant(value, kind) -> Column:
    if isinstance(kind, StructType):
        if value is None:
            return F.lit(None).cast(kind)
        return F.struct(*[_constant(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
    return F.lit(value).cast(kind)


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out

"""The best items of every user without scoring every pair.

A score is a scalar product, so it is at most the product of the two lengths. Items are taken in blocks of
falling length; a user whose n-th best score is not below the bound of the next block is done, and meets no
further item. The results are those of scoring all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.session import staged

BLOCK_ITEMS = 4096
SLACK = 1 + 1e-5  # scores are sums of 32-bit products
STATE = "user int, features array<float>, items array<int>, scores array<float>, done boolean"


def item_blocks(items: DataFrame, block: int) -> list[tuple[float, list[DataFrame]]]:
    """(largest length, parts) of item blocks in falling length; no part has many more than ``block`` items.

    Bounds come from a quantile sketch. Items of nearly equal length that a bound cannot part are parted by a hash.
    """
    total = items.count()
    steps = [k * block / total for k in range(1, -(-total // block))] if total else []
    found = items.agg(F.percentile_approx("length", F.array(*map(F.lit, steps)), 100_000)).first()[0] if steps else []
    bounds = [float("inf"), *sorted(set(found), reverse=True), -1.0]
    inside = F.size(F.filter(F.array(*map(F.lit, bounds[1:-1])), lambda b: b >= F.col("length"))) if len(bounds) > 2 else F.lit(0)
    numbered = staged(items.withColumn("block", inside), "item-blocks")
    out = []
    for r in numbered.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("top")).orderBy("block").collect():  # a row per block
        own, parts = numbered.where(F.col("block") == r.block), -(-r.n // (2 * block))
        out.append((r.top, [own.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == k) for k in range(parts)]))
    return out


def top_items(model: ALSModel, n: int, users: DataFrame | None = None, block: int = BLOCK_ITEMS) -> tuple[DataFrame, float]:
    """The ``n`` best items of all users, or of those with an id in ``users.user``: user, place, item, prediction.

    Also the share of all pairs that was scored. Every block of items goes to the tasks as one
    matrix of at most about ``2 * block`` rows.
    """
    length = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    items = staged(model.itemFactors.select("id", "features", length("features").alias("length")), "item-factors")
    factors = model.userFactors.select(F.col("id").alias("user"), "features")
    if users is not None:
        factors = factors.join(users.select("user").distinct(), "user", "left_semi")
    empty = lambda kind: F.array().cast(f"array<{kind}>")
    state = staged(factors.select("user", "features", empty("int").alias("items"), empty("float").alias("scores"), F.lit(False).alias("done")), "top-items", spread=True)
    blocks = item_blocks(items, block)
    n_users, scored, finished = state.count(), 0, []
    for k, (_, parts) in enumerate(blocks):
        bound = blocks[k + 1][0] * SLACK if k + 1 < len(blocks) else None
        for j, part in enumerate(parts):
            rows = part.select("id", "features").orderBy("id").collect()  # one block
            scored += len(rows) * state.count()
            step = met(n, np.array([r.id for r in rows], np.int32), np.array([r.features for r in rows], np.float32), bound if j + 1 == len(parts) else float("inf"))
            state = staged(state.mapInArrow(step, STATE), "top-items")
        finished.append(state.where("done"))
        state = state.where(~F.col("done"))
        if not state.limit(1).count():
            break
    out = state if not blocks else None
    for part in finished:
        out = part if out is None else out.unionByName(part)
    best = out.select("user", F.posexplode(F.arrays_zip("items", "scores")).alias("at", "b"))
    total = n_users * items.count()
    return best.select("user", (F.col("at") + 1).alias("place"), F.col("b.items").alias("item"), F.col("b.scores").alias("prediction")), scored / total if total else 0.0


def met(n: int, ids: np.ndarray, factors: np.ndarray, bound: float | None):
    """A step over users (``STATE``): their best items so far and those of one block. ``bound``: the length of the longest item to come."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            own = np.array(batch.column(1).to_pylist(), np.float32)
            scores = own @ factors.T
            lengths = np.sqrt((own.astype(np.float64) ** 2).sum(axis=1))
            out_items, out_scores, done = [], [], []
            for i, (items, best) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                at = np.argpartition(-scores[i], n - 1)[:n] if len(ids) > n else np.arange(len(ids))
                every, value = np.concatenate([np.array(items, np.int32), ids[at]]), np.concatenate([np.array(best, np.float32), scores[i][at]])
                order = np.lexsort((every, -value))[:n]
                out_items.append(every[order])
                out_scores.append(value[order])
                done.append(bound is None or (len(order) == n and bool(value[order[-1]] >= lengths[i] * bound)))
            columns = [batch.column(0), batch.column(1), pa.array(out_items, pa.list_(pa.int32())), pa.array(out_scores, pa.list_(pa.float32())), pa.array(done)]
            yield pa.RecordBatch.from_arrays(columns, ["user", "features", "items", "scores", "done"])

    return run

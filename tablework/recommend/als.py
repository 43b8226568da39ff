"""Rating factorisation: fit, rank sweep, scoring and per-user recommendations."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablework.operators.joins import score_pairs
from tablework.session import ensure_checkpoint_dir, staged


def rating_triples(
    ratings: DataFrame, user: str = "User_ID", item: str = "Movie_ID", score: str = "Rating"
) -> DataFrame:
    """Integer ids and float scores; rows without an id or a score are left out, as they cannot be factorised.

    An id that is no 32-bit integer stops the job; :func:`indexed_triples` takes ids of any kind.
    """

    def whole(c: str):
        refused = F.raise_error(F.concat(F.lit(f"{c} is no 32-bit integer, use indexed_triples: "), F.col(c).cast("string")))
        return F.when(F.col(c).isNull() | F.col(c).try_cast("int").isNotNull(), F.col(c).try_cast("int")).otherwise(refused.cast("int"))

    return ratings.select(
        whole(user).alias("user"), whole(item).alias("item"), F.col(score).try_cast("float").alias("rating")
    ).na.drop("any")


def number_ids(ids: DataFrame, col: str, out: str, buckets: int = 1024) -> DataFrame:
    """Distinct non-null values of a column with numbers from 0, as a stored table: ``col``, ``out``.

    Values are numbered inside hash buckets, whose sizes (one row per bucket) give each its first number.
    """
    spark = ids.sparkSession
    distinct = ids.select(col).where(F.col(col).isNotNull()).distinct().withColumn("_b", F.pmod(F.xxhash64(col), F.lit(buckets)))
    placed = staged(distinct.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy(col))), "ids")
    first, starts = 0, []
    for b, n in placed.groupBy("_b").agg(F.max("_r")).orderBy("_b").collect():
        starts.append((b, first))
        first += n
    if first > 2**31 - 1:
        raise ValueError(f"{first} values of {col} do not fit 32-bit numbers")
    offsets = spark.createDataFrame(starts, "_b long, _first long")
    return staged(placed.join(offsets, "_b").select(col, (F.col("_first") + F.col("_r") - 1).cast("int").alias(out)), "ids")


def indexed_triples(
    ratings: DataFrame, user: str = "User_ID", item: str = "Movie_ID", score: str = "Rating"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Triples with numbered ids of any kind, and the tables that lead back: (user id, user), (item id, item)."""
    users, items = number_ids(ratings, user, "user"), number_ids(ratings, item, "item")
    rows = ratings.select(user, item, F.col(score).try_cast("float").alias("rating")).na.drop("any")
    return rows.join(users, user).join(items, item).select("user", "item", "rating"), users, items


def named(df: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Replace numbered users and items by their ids."""
    out = df.join(users, "user").join(items, "item")
    return out.select(*[c for c in users.columns + items.columns if c not in ("user", "item")], *[c for c in df.columns if c not in ("user", "item")])


def als(
    triples: DataFrame,
    rank: int = 10,
    iterations: int = 15,
    reg: float = 0.01,
    seed: int = 42,
    blocks: int | None = None,
) -> ALSModel:
    """Alternating least squares on (user, item, rating); unseen users and items score nothing.

    ``blocks`` should grow with the cluster. The lineage is cut every fifth iteration in the
    shared checkpoint folder, so a lost executor does not replay the whole fit.
    """
    ensure_checkpoint_dir(triples.sparkSession)
    est = ALS(
        rank=rank,
        maxIter=iterations,
        regParam=reg,
        seed=seed,
        userCol="user",
        itemCol="item",
        ratingCol="rating",
        coldStartStrategy="drop",
        checkpointInterval=5,
        intermediateStorageLevel="MEMORY_AND_DISK",
        finalStorageLevel="MEMORY_AND_DISK",
    )
    if blocks:
        est = est.setNumBlocks(blocks)
    return est.fit(triples)


def held_out_error(model: ALSModel, test: DataFrame) -> DataFrame:
    """One row: mean squared error over the pairs the model can score, and the share of these."""
    predicted = model.transform(test)
    total = test.agg(F.count(F.lit(1)).alias("n_test"))
    gap = F.col("rating") - F.col("prediction")
    return predicted.agg(F.avg(gap * gap).alias("mse"), F.count(F.lit(1)).alias("n_scored")).select(
        "mse", "n_scored", total.scalar().alias("n_test")
    ).withColumn("coverage", F.try_divide(F.col("n_scored"), F.col("n_test")))


def als_sweep(
    train: DataFrame, test: DataFrame, ranks: Sequence[int] = (10, 20, 50, 100, 200), iterations: int = 15, seed: int = 42
) -> DataFrame:
    """Held-out error per rank. Train and test are read once per fit, so pass stored tables.

    Ranks above the number of items are fitted by :func:`few_items_error`.
    """
    out, by_user = None, None
    items = sorted(r.item for r in train.select("item").distinct().limit(max(ranks)).collect())  # all of them, if fewer than a rank
    for rank in ranks:
        if 0 < len(items) < rank:
            by_user = by_user or ratings_by_user(train, test)
            row = few_items_error(by_user, items, rank, iterations, seed=seed)
            row = row.withColumn("n_test", test.agg(F.count(F.lit(1)).alias("n")).scalar()).withColumn("coverage", F.try_divide(F.col("n_scored"), F.col("n_test")))
        else:
            row = held_out_error(als(train, rank, iterations, seed=seed), test)
        row = row.select(F.lit(rank).alias("rank"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def ratings_by_user(train: DataFrame, test: DataFrame) -> DataFrame:
    """A stored row per user with the count, sum and sum of squares of the ratings of each item, held out or not.

    A rating to train on that is null or no number stops the job, as it stops :func:`als`.
    """
    checked = F.when(F.col("rating").isNull() | F.isnan("rating"), F.raise_error(F.lit("Ratings MUST NOT be Null or NaN")).cast("float")).otherwise(F.col("rating"))
    both = train.withColumn("rating", checked).withColumn("held", F.lit(False)).unionByName(test.withColumn("held", F.lit(True)))
    score = F.col("rating").cast("double")
    cells = both.groupBy("user", "item", "held").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(score).alias("s"), F.sum(score * score).alias("q"))
    return staged(cells.groupBy("user").agg(F.collect_list(F.struct("item", "held", "n", "s", "q")).alias("cells")), "by-user", spread=True)


def few_items_error(by_user: DataFrame, items: Sequence[int], rank: int, iterations: int = 15, reg: float = 0.01, seed: int = 42) -> DataFrame:
    """One row: mean squared error and number of scored pairs of a fit whose rank exceeds the number of items.

    The steps are those of :func:`als`: users start at random unit vectors of ``rank`` numbers, then items and users are
    solved in turn. A user's solution is a combination of item vectors, so after the first step all vectors lie in the span
    of the items. They are written in coordinates of that span, as many as there are items, which changes no product
    of two vectors and no length. Each step is one pass over the users, whose sums per item are added up by item.
    """
    known, m = np.array(items), len(items)

    def passes(y: np.ndarray | None, score: bool):
        d = rank if y is None else y.shape[1]

        def chunks(batches):
            for batch in batches:
                for a in range(0, batch.num_rows, size := max(1, (1 << 21) // (d * d))):
                    part = batch.slice(a, size)
                    lists = part.column(1)
                    flat, row = lists.flatten(), np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
                    item, held, n, s, q = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("item", "held", "n", "s", "q"))
                    at = np.minimum(np.searchsorted(known, item), m - 1)
                    told = ~held
                    count, total = np.zeros((part.num_rows, m)), np.zeros((part.num_rows, m))
                    count[row[told], at[told]], total[row[told], at[told]] = n[told], s[told]
                    if y is None:
                        first = part.column(0)[0].as_py()
                        x = np.random.default_rng([seed, first & 0xFFFFFFFF]).standard_normal((part.num_rows, d))
                        x /= np.linalg.norm(x, axis=1, keepdims=True)
                    else:
                        seen = count.sum(1)
                        gram = (count @ (y[:, :, None] * y[:, None, :]).reshape(m, -1)).reshape(-1, d, d)
                        gram += np.where(seen > 0, reg * seen, 1.0)[:, None, None] * np.eye(d)
                        x = np.linalg.solve(gram, (total @ y)[:, :, None])[:, :, 0]
                    asked = held & (known[at] == item) & (count.sum(1)[row] > 0)
                    yield x, count, total, [v[asked] for v in (row, at, n, s, q)]

        def sums(batches):
            a, b, n = np.zeros((m, d * d)), np.zeros((m, d)), np.zeros(m)
            for x, count, total, _ in chunks(batches):
                a += count.T @ (x[:, :, None] * x[:, None, :]).reshape(len(x), -1)
                b += total.T @ x
                n += count.sum(0)
            whole = np.hstack([n[:, None], b, a])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(m)), pa.array(list(whole), pa.list_(pa.float64()))], ["k", "sums"])

        def errors(batches):
            for x, _, _, (row, at, n, s, q) in chunks(batches):
                p = np.einsum("ij,ij->i", x[row], y[at])
                yield pa.RecordBatch.from_arrays([pa.array([float((q - 2 * p * s + n * p * p).sum())]), pa.array([int(n.sum())])], ["e", "n"])

        def solved(table):
            whole = np.sum(table.column("sums").to_pylist(), axis=0)
            n, b, a = whole[0], whole[1 : d + 1], whole[d + 1 :].reshape(d, d)
            factor = np.linalg.solve(a + reg * n * np.eye(d), b)
            return pa.table({"k": table.column("k")[:1], "factor": pa.array([factor], pa.list_(pa.float64()))})

        if score:
            return by_user.mapInArrow(errors, "e double, n long")
        return by_user.mapInArrow(sums, "k long, sums array<double>").groupBy("k").applyInArrow(solved, "k long, factor array<double>")

    y = None
    for _ in range(iterations):
        y = np.array([r.factor for r in passes(y, False).orderBy("k").collect()])  # a vector per item
        values, vectors = np.linalg.eigh(y @ y.T)
        kept = values > max(values.max(), 0.0) * 1e-14
        y = (vectors * np.sqrt(np.maximum(values, 0.0)))[:, kept] if kept.any() else np.zeros((m, 1))
    return passes(y, True).agg(F.try_divide(F.sum("e"), F.sum("n")).alias("mse"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_scored"))


def scored_pairs(model: ALSModel, test: DataFrame) -> DataFrame:
    """Actual and predicted scores side by side, by (user, item)."""
    predictions = model.transform(test.select("user", "item").distinct())
    return score_pairs(predictions, test, ["user", "item"])


def above(predictions: DataFrame, minimum: float = 3.0, col: str = "prediction") -> DataFrame:
    return predictions.where(F.col(col) > minimum)


def recommend(model: ALSModel, n: int, users: DataFrame | None = None) -> DataFrame:
    """The ``n`` best items per user, for all users or for the given ones, one row each."""
    best = model.recommendForAllUsers(n) if users is None else model.recommendForUserSubset(users, n)
    return best.select("user", F.posexplode("recommendations").alias("_pos", "_r")).select(
        "user", (F.col("_pos") + 1).alias("place"), F.col("_r.item").alias("item"), F.col("_r.rating").alias("prediction")
    )

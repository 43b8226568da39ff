"""Quality classifier by co-training: two views of a document teach each other.

The content view sees the text only: shares of its octets, of classes of signs and of hashed three-octet
strings, and how much repeats. The page view sees metadata only: language, source and the recorded
length. Both are logistic regressions. They start from a
bounded sample of labelled rows; in each round either view labels the unlabelled rows it is surest of,
in the proportion of the labelled classes, and hands them to the other view. Then each view is
calibrated on rows that no view was fitted on, and the scores of all documents combine both views'
calibrated odds.

Only the sample (``MAX_LABELLED`` and ``MAX_POOL`` rows of a few hundred numbers) reaches the driver; all
documents are scored where they lie.

Results in odd cases: a null text counts as an empty one; null metadata is a value of its own; labels
that are null or have no document teach nothing; without labels of both classes every document has score
1 and is kept; of rows whose confidences tie (in 32 bits) the first in the sample's order go first; repeated rows are scored alike; an empty table gives an empty result. Very long texts are
read whole. ``reject`` returns the input's columns, whatever their names; ``classify`` carries no extra
columns.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from tablework.llm.common import free_name, groups_of, map_batches, stored

MAX_LABELLED, MAX_POOL = 8000, 8000  # rows of the samples, by a hash of the id
ROUNDS, SHARE = 3, 0.1  # part of the pool that each view labels in a round, if it is sure enough
SURE = 0.95
CUT = 0.25  # documents are rejected only where a bad one is three times as likely as a good one
HASHED, META = 256, 64
RIDGE = 1e-2
GROUP_BYTES = 1 << 20

FEATURES = HASHED + 256 // 4 + 8


def content_features(texts: list[str]) -> np.ndarray:
    """One row per text; every number is a share or a logarithm, so long texts are not heavier."""
    data = [t.encode("utf-8") for t in texts]
    out = np.zeros((len(texts), FEATURES), np.float32)
    sizes = np.array([len(d) for d in data], np.int64)
    if not sizes.sum():
        return out
    octets = np.frombuffer(b"".join(data), np.uint8)
    row = np.repeat(np.arange(len(texts)), sizes)
    total = np.maximum(sizes, 1)[:, None]
    three = octets.astype(np.uint32) * 0x9E3779B1
    three[1:] += octets[:-1] * np.uint32(0x85EBCA77)
    three[2:] += octets[:-2] * np.uint32(0xC2B2AE3D)
    inside = np.ones(len(octets), bool)  # strings of three octets never reach into the text before
    begin = (np.cumsum(sizes) - sizes)[sizes > 0]
    inside[begin] = False
    inside[np.minimum(begin + 1, len(octets) - 1)] = False
    cell = row[inside] * HASHED + (three[inside] >> np.uint32(24)).astype(np.int64)
    out[:, :HASHED] = np.sqrt(np.bincount(cell, minlength=len(texts) * HASHED).reshape(-1, HASHED) / total)
    single = np.bincount(row * 256 + octets, minlength=len(texts) * 256).reshape(-1, 256)
    share = lambda low, high: single[:, low:high].sum(1) / total[:, 0]
    out[:, HASHED : HASHED + 64] = np.sqrt(single[:, 32:96] / total)  # signs, digits and capitals one by one
    k = HASHED + 64
    out[:, k + 0] = np.log1p(sizes) / 10
    out[:, k + 1] = share(65, 91)
    out[:, k + 2] = share(97, 123)
    out[:, k + 3] = share(48, 58)
    out[:, k + 4] = share(10, 11)
    out[:, k + 5] = share(128, 256)
    lines = [d.split(b"\n") for d in data]
    out[:, k + 6] = [1 - len(set(x)) / len(x) for x in lines]
    words = [d.split() for d in data]
    out[:, k + 7] = [1 - len(set(zip(x, x[1:], x[2:], strict=False))) / (len(x) - 2) if len(x) > 2 else 0.0 for x in words]
    return out


def page_features(langs: list, sources: list, lengths: list) -> np.ndarray:
    """Hashed language and source, and the recorded length in steps of half a power of two."""
    out = np.zeros((len(langs), META), np.float32)
    for i, (lang, source, n) in enumerate(zip(langs, sources, lengths, strict=True)):
        out[i, zlib.crc32(f"lang {lang}".encode()) % 16] = 1
        out[i, 16 + zlib.crc32(f"source {source}".encode()) % 24] = 1
        out[i, 40 if n is None or n < 0 else min(63, 41 + int(2 * np.log2(n + 1)) // 2)] = 1
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 12) -> np.ndarray:
    """Weights of a ridge-penalised logistic regression by Newton's method; the last one is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge * len(x) / 100)
    penalty[-1] = 1e-9
    for _ in range(steps):
        p = sigmoid(x @ w)
        curve = np.maximum(p * (1 - p), 1e-6)
        move = np.linalg.solve((x * curve[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        w -= move
        if np.abs(move).max() < 1e-6:
            break
    return w


def odds(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1].astype(np.float32) + np.float32(w[-1])


@dataclass(frozen=True)
class Model:
    """Weights of both views, (slope, intercept) that calibrate each, log odds of the classes, and the cut."""

    weights: tuple[np.ndarray, np.ndarray]
    calibration: tuple[np.ndarray, np.ndarray]
    prior: float
    cut: float = CUT

    def scores(self, views: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Probability that a document is good: both views' evidence beyond the prior adds up."""
        calibrated = [c[0] * odds(x, w) + c[1] for x, w, c in zip(views, self.weights, self.calibration, strict=True)]
        return sigmoid(calibrated[0] + calibrated[1] - self.prior)


def calibrate(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope and intercept that turn a view's odds into the odds seen on rows it was not fitted on. A view that
    does not tell the classes apart gets a slope near zero, never below."""
    scaled = np.clip(z, -35, 35)[:, None]
    w = fit_logistic(scaled, y, ridge=1.0)
    if w[0] <= 0:
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        return np.array([0.0, np.log(share / (1 - share))])
    return w


def co_train(views: tuple[np.ndarray, np.ndarray], y: np.ndarray, held: np.ndarray, pool: tuple[np.ndarray, np.ndarray], rounds: int = ROUNDS) -> Model | None:
    """Fit from labelled rows (``held`` ones only calibrate) and a pool of unlabelled rows."""
    fit = ~held
    if len(set(y[fit])) < 2 or len(set(y[held])) < 2:
        fit, held = np.ones(len(y), bool), np.ones(len(y), bool)  # too few rows to keep some back
    if len(set(y)) < 2:
        return None
    taught = [([x[fit]], [y[fit]]) for x in views]
    free = np.ones(len(pool[0]), bool)
    good = y[fit].mean()
    weights = [fit_logistic(np.vstack(x), np.concatenate(t)) for x, t in taught]
    for _ in range(rounds if len(free) else 0):
        chosen = []
        for k in (0, 1):
            p = sigmoid(odds(pool[k], weights[k]))
            for label, sure, part in ((1.0, p, good), (0.0, 1 - p, 1 - good)):
                able = np.flatnonzero(free & (sure >= SURE))
                most = able[np.argsort(-sure[able], kind="stable")][: int(np.ceil(SHARE * part * len(free)))]
                chosen.append((1 - k, most, label))
        for k, rows, label in chosen:  # to the other view
            taught[k][0].append(pool[k][rows])
            taught[k][1].append(np.full(len(rows), label))
            free[rows] = False
        if not any(len(rows) for _, rows, _ in chosen):
            break
        weights = [fit_logistic(np.vstack(x), np.concatenate(t)) for x, t in taught]
    calibration = tuple(calibrate(odds(x[held], w), y[held]) for x, w in zip(views, weights, strict=True))
    share = np.clip(y[held].mean(), 1e-3, 1 - 1e-3)
    return Model(tuple(weights), calibration, float(np.log(share / (1 - share))))


def column_or_null(docs: DataFrame, name: str, kind: str):
    return F.col(name).cast(kind) if name in docs.columns else F.lit(None).cast(kind)


def featured(docs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """content, page (arrays of numbers) and the columns in ``extra`` (long) of a sample of documents."""

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            meta = [batch.column(k).to_pylist() for k in (1, 2, 3)]
            for a, b in groups_of([len(t) for t in texts], GROUP_BYTES):
                content, page = content_features(texts[a:b]), page_features(*(m[a:b] for m in meta))
                columns = [pa.array(list(content), pa.list_(pa.float32())), pa.array(list(page), pa.list_(pa.float32()))]
                columns += [batch.column(4 + i).slice(a, b - a) for i in range(len(extra))]
                yield pa.RecordBatch.from_arrays(columns, ["content", "page", *extra])

    chosen = docs.select("text", "lang", "source", "n_chars", *(F.col(c).cast("long").alias(c) for c in extra))
    return map_batches(chosen, run, "content array<float>, page array<float>" + "".join(f", {c} long" for c in extra))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_pool: int = MAX_POOL, id_col: str = "doc_id", label_col: str = "quality") -> Model | None:
    """Fit on samples by a hash of the id: at most about ``max_labelled`` labelled and ``max_pool`` other documents."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("label_id")).agg(F.min(label_col).cast("long").alias("y"))
    ids = docs.select(F.col(id_col).alias("doc_id"))
    n_docs, n_known = ids.count(), known.count()
    spot = F.pmod(F.xxhash64(F.lit("quality"), F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    chance = min(1.0, max_labelled / max(n_known, 1)), min(1.0, max_pool / max(n_docs - n_known, 1))
    picked = ids.where((spot < max(chance)) & F.col("doc_id").isNotNull()).distinct().join(known, F.col("doc_id") == F.col("label_id"), "left")
    picked = picked.where(F.when(F.col("y").isNotNull(), spot < chance[0]).otherwise(spot < chance[1]))
    sample = stored(picked.select(F.col("doc_id").alias("picked_id"), "y", (F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(4)) == 0).cast("long").alias("held")), "quality-sample")
    meta = [column_or_null(docs, c, t).alias(c) for c, t in (("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "long"))]
    rows = docs.select(F.col(id_col).alias("doc_id"), *meta).join(sample, F.col("doc_id") == F.col("picked_id"))
    found = featured(rows, ("y", "held")).orderBy("y", "held", F.hash("content", "page")).toArrow()  # bounded by the two limits
    grid = lambda name, width: np.array(found.column(name).combine_chunks().flatten(), np.float32).reshape(-1, width) if found.num_rows else np.zeros((0, width), np.float32)
    views = grid("content", FEATURES), grid("page", META)
    y = np.array([np.nan if v is None else v for v in found.column("y").to_pylist()])
    told = ~np.isnan(y)
    held = np.array(found.column("held").to_pylist(), bool)[told] if found.num_rows else np.zeros(0, bool)
    return co_train((views[0][told], views[1][told]), y[told], held, (views[0][~told], views[1][~told]))


def scored(docs: DataFrame, model: Model | None, score: str, kept: str) -> DataFrame:
    """All columns of the frame, and score and kept under the given names."""
    at = {c: docs.columns.index(c) for c in ("text", "lang", "source", "n_chars") if c in docs.columns}

    def run(batches):
        for batch in batches:
            column = lambda c, batch=batch: batch.column(at[c]).to_pylist() if c in at else [None] * batch.num_rows
            texts, meta = [t or "" for t in column("text")], [column(c) for c in ("lang", "source", "n_chars")]
            scores = [np.empty(0)]
            for a, b in groups_of([len(t) for t in texts], GROUP_BYTES):
                scores.append(np.ones(b - a) if model is None else model.scores((content_features(texts[a:b]), page_features(*(m[a:b] for m in meta)))))
            s = np.concatenate(scores).astype(np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array(s >= (0 if model is None else model.cut))], [*batch.schema.names, score, kept])

    return map_batches(docs, run, StructType([*docs.schema.fields, StructField(score, DoubleType()), StructField(kept, BooleanType())]))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **limits: int) -> DataFrame:
    """doc_id, score (0 to 1: how likely it is good), kept."""
    model = fit(docs, labels, id_col=id_col, **limits)
    meta = [column_or_null(docs, c, t).alias(c) for c, t in (("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "long"))]
    return scored(docs.select(F.col(id_col).alias("doc_id"), *meta), model, "score", "kept").select("doc_id", "score", "kept")


def reject(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **limits: int) -> DataFrame:
    """The documents that the classifier keeps."""
    model = fit(docs, labels, id_col=id_col, **limits)
    score = free_name(docs, "quality_score")
    kept = free_name(docs, "quality_kept")
    return scored(docs, model, score, kept).where(F.col(kept)).select(*docs.columns)

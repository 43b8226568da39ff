"""Feature preparation: indexing, assembling, scaling, splitting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.functions.expressions import hash_fraction


def feature_pipeline(
    df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], use_indexed: bool = True
) -> PipelineModel:
    """Index the categorical columns by falling frequency (ties by value) and assemble ``features``.

    With ``use_indexed=False`` the raw columns are assembled and the indexes only added.
    """
    indexed = [f"{c}_index" for c in categorical]
    indexer = StringIndexer(
        inputCols=list(categorical), outputCols=indexed, stringOrderType="frequencyDesc", handleInvalid="keep"
    )
    inputs = [*numeric, *(indexed if use_indexed else categorical)]
    return Pipeline(stages=[indexer, VectorAssembler(inputCols=inputs, outputCol="features")]).fit(df)


def string_index(df: DataFrame, col: str) -> DataFrame:
    """The index of each value as a table, 0 for the most frequent one."""
    known = df.select(col).where(F.col(col).isNotNull())  # null is no value and gets no index
    model = StringIndexer(inputCol=col, outputCol="_i", stringOrderType="frequencyDesc").fit(known)
    return model.transform(known.distinct()).select(
        F.col(col).cast("string").alias("value"), F.col("_i").cast("int").alias("index")
    )


def assemble(df: DataFrame, label: str, features: Sequence[str] | None = None) -> DataFrame:
    """Vector of all columns but the label; rows with a null must be gone before."""
    inputs = list(features) if features else [c for c in df.columns if c != label]
    return VectorAssembler(inputCols=inputs, outputCol="features").transform(df)


def one_hot_vector(df: DataFrame, col: str) -> DataFrame:
    """Sparse one-hot vector for columns with too many values for one column each."""
    indexed = StringIndexer(inputCol=col, outputCol=f"{col}_index").fit(df).transform(df)
    encoder = OneHotEncoder(inputCol=f"{col}_index", outputCol=f"{col}_vector", dropLast=False)
    return encoder.fit(indexed).transform(indexed)


def random_split(df: DataFrame, weights: Sequence[float], seed: int | None = None) -> list[DataFrame]:
    """Random disjoint parts; the weights need not sum to one."""
    return df.randomSplit([float(w) for w in weights], seed=seed)


def hash_split(df: DataFrame, keys: Sequence[str], weights: Sequence[float]) -> list[DataFrame]:
    """Disjoint parts by the hash of a key: the same on every run, and lost tasks recompute the same rows."""
    total = float(sum(weights))
    u = hash_fraction(*keys)
    parts, low = [], 0.0
    for i, w in enumerate(weights):
        high = 2.0 if i == len(weights) - 1 else low + w / total
        parts.append(df.where((u >= low) & (u < high)))
        low = high
    return parts


def scaling(train: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, two numbers each."""
    row = train.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)],
    ).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}


def standardize(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Scale both parts by the statistics of the first; a constant column is only centred."""
    stats = scaling(train, cols)

    def apply(df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s if s else 1.0) for c, (m, s) in stats.items()})

    return apply(train), apply(test)

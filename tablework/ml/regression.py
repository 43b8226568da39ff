"""Fitted regressions: least squares, penalised, boosted trees, single trees, clusters."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    LinearRegressionModel,
)
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.functions.expressions import hash_fraction
from tablework.ml.features import assemble
from tablework.operators.clean import complete_rows
from tablework.session import ensure_checkpoint_dir


def ols(df: DataFrame, label: str, features: Sequence[str]) -> LinearRegressionModel:
    """Ordinary least squares by the normal equations: one pass over the data."""
    data = assemble(df.select(label, *features), label, features)
    return LinearRegression(labelCol=label, regParam=0.0, solver="normal").fit(data)


def elastic_net(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    max_iter: int = 20,
    reg: float = 0.3,
    mix: float = 0.8,
) -> LinearRegressionModel:
    data = assemble(df.select(label, *features), label, features)
    return LinearRegression(labelCol=label, maxIter=max_iter, regParam=reg, elasticNetParam=mix).fit(data)


def coefficient_table(df: DataFrame, model: LinearRegressionModel, features: Sequence[str]) -> DataFrame:
    """Intercept and coefficients, one row per term."""
    rows = [("(intercept)", float(model.intercept))]
    rows += [(f, float(b)) for f, b in zip(features, model.coefficients)]
    return df.sparkSession.createDataFrame(rows, "term string, coefficient double")


def predict(model: Transformer, df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    return model.transform(assemble(df, label, features)).drop("features")


def with_fold(df: DataFrame, keys: Sequence[str], folds: int) -> DataFrame:
    """Fold number by key hash, so that every candidate sees the same folds."""
    return df.withColumn("fold", F.floor(hash_fraction(*keys) * folds).cast("int"))


def gbt_cv(
    df: DataFrame,
    label: str = "target",
    features: str = "features",
    depths: Sequence[int] = (2, 6),
    bins: Sequence[int] = (30, 32),
    folds: int = 5,
    max_iter: int = 20,
    seed: int = 42,
    parallelism: int = 2,
    fold_col: str | None = None,
) -> CrossValidatorModel:
    """Boosted trees over a grid of depth and bins, chosen by cross-validated RMSE."""
    ensure_checkpoint_dir(df.sparkSession)
    gbt = GBTRegressor(labelCol=label, featuresCol=features, maxIter=max_iter, seed=seed, checkpointInterval=5)
    grid = ParamGridBuilder().addGrid(gbt.maxDepth, list(depths)).addGrid(gbt.maxBins, list(bins)).build()
    cv = CrossValidator(
        estimator=gbt,
        estimatorParamMaps=grid,
        evaluator=RegressionEvaluator(labelCol=label, metricName="rmse"),
        numFolds=folds,
        seed=seed,
        parallelism=parallelism,
    )
    return (cv.setFoldCol(fold_col) if fold_col else cv).fit(df)


def cv_table(df: DataFrame, model: CrossValidatorModel) -> DataFrame:
    """Mean RMSE per grid point."""
    rows = []
    for params, rmse in zip(model.getEstimatorParamMaps(), model.avgMetrics):
        named = {p.name: int(v) for p, v in params.items()}
        rows.append((named["maxDepth"], named["maxBins"], float(rmse)))
    return df.sparkSession.createDataFrame(rows, "max_depth int, max_bins int, rmse double")


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_new(pipeline: PipelineModel, model: Transformer, df: DataFrame, label: str = "target") -> DataFrame:
    """Score rows that have no label yet: the label column is a constant 0, the feature steps are
    those fitted on the training rows."""
    return model.transform(pipeline.transform(df.withColumn(label, F.lit(0.0))))


def regularized_path(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    mix: float,
    lambdas: Sequence[float],
    folds: int = 10,
    keys: Sequence[str] | None = None,
    seed: int = 42,
) -> CrossValidatorModel:
    """Ridge (``mix=0``) or lasso (``mix=1``) with the penalty chosen by cross-validation."""
    use = df if keys is None else with_fold(df, keys, folds)
    extra = ["fold"] if keys else []
    data = assemble(use.select(label, *features, *extra), label, features)
    lr = LinearRegression(labelCol=label, elasticNetParam=mix)
    grid = ParamGridBuilder().addGrid(lr.regParam, [float(x) for x in lambdas]).build()
    cv = CrossValidator(
        estimator=lr,
        estimatorParamMaps=grid,
        evaluator=RegressionEvaluator(labelCol=label, metricName="mse"),
        numFolds=folds,
        seed=seed,
    )
    return (cv.setFoldCol("fold") if keys else cv).fit(data)


def path_table(df: DataFrame, model: CrossValidatorModel) -> DataFrame:
    rows = [
        (float(next(iter(p.values()))), float(m)) for p, m in zip(model.getEstimatorParamMaps(), model.avgMetrics)
    ]
    return df.sparkSession.createDataFrame(rows, "lambda double, mse double")


def fold_products(df: DataFrame, cols: Sequence[str]) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Means of the columns, and per ``fold`` the sums of products of (1, columns minus their means). Two aggregations."""
    means = np.array(df.agg(*[F.avg(c).alias(f"c{i}") for i, c in enumerate(cols)]).first(), float)
    centred = [F.lit(1.0), *[F.col(c) - F.lit(float(m)) for c, m in zip(cols, means)]]
    pairs = [(i, j) for i in range(len(centred)) for j in range(i, len(centred))]
    out = {}
    for row in df.groupBy("fold").agg(*[F.sum(centred[i] * centred[j]).alias(f"p{i}_{j}") for i, j in pairs]).collect():
        s = np.zeros((len(centred), len(centred)))
        for (i, j), v in zip(pairs, row[1:]):
            s[i, j] = s[j, i] = v
        out[row[0]] = s
    return means, out


def shrunk(s: np.ndarray, mix: float, lambdas: Sequence[float], steps: int = 1000, close: float = 1e-10) -> list[np.ndarray]:
    """Coefficients (intercept first, in centred columns, the label last in ``s``) per penalty, from sums of products.

    Columns and label are scaled by their deviations, as MLlib does; coordinate descent starts from the
    penalty before, so a falling path needs few steps.
    """
    n, mean = s[0, 0], s[0, 1:] / s[0, 0]
    cov = s[1:, 1:] / n - np.outer(mean, mean)
    sd = np.sqrt(np.diag(cov))
    scale = np.where(sd > 0, sd, 1.0)
    corr = cov / np.outer(scale, scale)
    r, target, beta, out = corr[:-1, :-1], corr[:-1, -1], np.zeros(len(sd) - 1), []
    for reg in lambdas:
        weight = reg / scale[-1]
        for _ in range(steps):
            before = beta.copy()
            for j in range(len(beta)):
                if sd[j] > 0:
                    z = target[j] - r[j] @ beta + r[j, j] * beta[j]
                    beta[j] = np.sign(z) * max(abs(z) - mix * weight, 0.0) / (r[j, j] + (1 - mix) * weight)
            if np.abs(beta - before).max() < close:
                break
        raw = beta * scale[-1] / scale[:-1]
        out.append(np.concatenate([[mean[-1] - raw @ mean[:-1]], raw]))
    return out


def penalised_path(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    mix: float,
    lambdas: Sequence[float] | None = None,
    folds: int = 10,
    keys: Sequence[str] = (),
    points: int = 100,
    ratio: float = 1e-4,
) -> DataFrame:
    """Cross-validated error per penalty for ridge (``mix=0``), lasso (``mix=1``) or between: lambda, mse.

    All fits and errors follow from one table of sums of products per fold, so the data are read twice,
    however long the path is. By default the path has ``points`` penalties that fall from the smallest one
    that removes every feature (for a mix of at least 0.001) to ``ratio`` times it.
    """
    data = with_fold(complete_rows(df.select(*keys, label, *features)), keys, folds)
    _, products = fold_products(data, [*features, label])
    total = sum(products.values())
    if lambdas is None:
        n, mean = total[0, 0], total[0, 1:] / total[0, 0]
        cov = total[1:, 1:] / n - np.outer(mean, mean)
        top = np.abs(cov[:-1, -1] / np.sqrt(np.diag(cov)[:-1])).max() / max(mix, 1e-3)
        lambdas = [float(x) for x in top * np.geomspace(1, ratio, points)]
    falling = sorted(lambdas, reverse=True)
    errors = np.zeros((len(products), len(falling)))
    for k, held in enumerate(products.values()):
        for x, b in enumerate(shrunk(total - held, mix, falling)):
            gap = np.concatenate([-b, [1.0]])  # label minus intercept minus features
            errors[k, x] = gap @ held @ gap / held[0, 0]
    return df.sparkSession.createDataFrame([(x, float(e)) for x, e in zip(falling, errors.mean(0))], "lambda double, mse double")


TREE_ROWS = 1 << 20  # of one task


def in_parts(data: DataFrame) -> DataFrame:
    """Deal the rows over more tasks if these would hold more than ``TREE_ROWS`` each: tree fits keep each task's rows as objects."""
    parts = -(-data.count() // TREE_ROWS)
    return data.repartition(parts) if parts > data.rdd.getNumPartitions() else data


def tree(df: DataFrame, label: str, features: Sequence[str], depth: int = 5) -> DecisionTreeRegressionModel:
    data = in_parts(assemble(df.select(label, *features), label, features))
    return DecisionTreeRegressor(labelCol=label, maxDepth=depth, maxBins=64).fit(data)


def spatial_clusters(df: DataFrame, cols: Sequence[str], k: int = 10, seed: int = 42, bisecting: bool = True) -> DataFrame:
    """Assign ``cluster`` on coordinates scaled by their deviation.

    A full distance matrix is quadratic, so the hierarchy is built from the top by bisection. The
    scale starts at the minimum instead of being centred: the bisection places its first two centres
    relative to the length of the mean, which would be zero.
    """
    stats = df.agg(
        *[F.min(c).alias(f"lo{i}") for i, c in enumerate(cols)], *[F.stddev_samp(c).alias(f"sd{i}") for i, c in enumerate(cols)]
    ).first()
    scaled = df.withColumns(
        {f"_s{i}": (F.col(c) - F.lit(stats[f"lo{i}"])) / F.lit(stats[f"sd{i}"] or 1.0) for i, c in enumerate(cols)}
    )
    names = [f"_s{i}" for i in range(len(cols))]
    data = VectorAssembler(inputCols=names, outputCol="_scaled").transform(scaled)
    algo = BisectingKMeans if bisecting else KMeans
    model = algo(k=k, seed=seed, featuresCol="_scaled", predictionCol="cluster").fit(data)
    return model.transform(data).drop("_scaled", *names)

"""Metrics of scored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablework.functions.expressions import correlation
from tablework.session import staged


def residuals(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    return df.withColumn("difference", F.col(prediction) - F.col(label))


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row: n, MAE, MSE, RMSE, r2, prediction range, and RMSE in percent of that range."""
    e = F.col(label) - F.col(prediction)
    one = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("mse"),
        F.var_pop(label).alias("_var"),
        F.min(prediction).alias("prediction_min"),
        F.max(prediction).alias("prediction_max"),
    )
    rmse = F.sqrt("mse")
    return one.select(
        "n",
        "mae",
        "mse",
        rmse.alias("rmse"),
        (1 - F.try_divide(F.col("mse"), F.col("_var"))).alias("r2"),
        "prediction_min",
        "prediction_max",
        (100 * F.try_divide(rmse, F.col("prediction_max") - F.col("prediction_min"))).alias("percent_rmse"),
    )


def binary_metrics(df: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.5) -> DataFrame:
    """One row: areas under the ROC and precision-recall curves, and F1 at a threshold. Rows without a label or score are left out.

    The scored table is read once. Positive and negative labels are counted per distinct score, the scores are
    sorted in ranges, and running counts are carried over the ranges by one row for each, so every distinct
    score is a point of both curves (trapezoids between them, equal scores are one point). Without a negative label
    the ROC area is 1, without a positive one both areas are 0, as in Spark's evaluator.
    """
    data = df.select(F.col(label).cast("double").alias("label"), F.col(score).cast("double").alias("score")).na.drop("any")
    said, true = F.col("score") >= threshold, F.col("label") > 0.5
    counts = data.groupBy("score").agg(F.count_if(true).alias("p"), F.count_if(~true).alias("q"))
    placed = counts.repartitionByRange(F.desc("score")).sortWithinPartitions(F.desc("score")).withColumn("at", F.monotonically_increasing_id())
    placed = staged(placed.withColumn("part", F.shiftright("at", 33)), "curve")
    parts = placed.groupBy("part").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))  # one row for each range
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("p", "q")))
    inside = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = placed.withColumns({"p_sum": F.sum("p").over(inside), "q_sum": F.sum("q").over(inside)}).join(base, "part")
    tp, fp = F.col("p_sum") + F.col("p_before"), F.col("q_sum") + F.col("q_before")
    precision = F.try_divide(tp, tp + fp)
    before = F.coalesce(F.try_divide(tp - F.col("p"), tp - F.col("p") + fp - F.col("q")), precision)
    one = summed.agg(
        F.sum(F.col("q") * (2 * tp - F.col("p")) / 2).alias("roc"),
        F.sum(F.col("p") * (precision + before) / 2).alias("pr"),
        F.coalesce(F.sum(F.when(said, F.col("p"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(said, F.col("q"))), F.lit(0)).alias("fp"),
        F.sum("p").alias("np"),
        F.sum("q").alias("nq"),
    )
    none = F.when((F.col("nq") == 0) & (F.col("np") > 0), 1.0).otherwise(0.0)
    missed = F.col("np") - F.col("tp")
    f1 = F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + missed)
    return one.select(
        F.coalesce(F.try_divide(F.col("roc"), F.col("np") * F.col("nq")), none).alias("auroc"),
        F.coalesce(F.try_divide(F.col("pr"), F.col("np")), F.lit(0.0)).alias("auprc"),
        F.coalesce(f1, F.lit(0.0)).alias("f1"),
    )


def compare_models(predictions: DataFrame, actual: str, models: list[str], exponentiate: bool = False) -> DataFrame:
    """Squared correlation with the actual value per prediction column, all in one pass."""

    def value(m: str):
        return F.exp(m) if exponentiate else F.col(m)

    one = predictions.agg(*[correlation(value(m), actual).alias(f"_c{i}") for i, m in enumerate(models)])
    items = [
        F.struct(F.lit(m).alias("model_name"), (F.col(f"_c{i}") * F.col(f"_c{i}")).alias("r_squared"))
        for i, m in enumerate(models)
    ]
    return one.select(F.explode(F.array(*items)).alias("r")).select("r.*")

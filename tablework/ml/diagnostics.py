"""Linear-model diagnostics from one moment aggregate.

Everything here needs only the counts, means and covariances of the columns. Spark computes those
in one pass; what reaches the driver is a k-by-k matrix whose size depends on the columns alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Moments:
    """Count, means and population covariances of some columns."""

    cols: tuple[str, ...]
    n: int
    mean: np.ndarray
    cov: np.ndarray

    def pick(self, cols: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        i = [self.cols.index(c) for c in cols]
        return self.mean[i], self.cov[np.ix_(i, i)]


@dataclass(frozen=True)
class Fit:
    """Least squares with intercept: coefficients, residual and total sums of squares."""

    label: str
    features: tuple[str, ...]
    n: int
    intercept: float
    beta: np.ndarray
    rss: float
    tss: float
    inverse: np.ndarray  # of the feature covariance

    @property
    def aic(self) -> float:
        return self.n * (math.log(2 * math.pi) + math.log(self.rss / self.n) + 1) + 2 * (len(self.features) + 2)

    @property
    def dof(self) -> int:
        return self.n - len(self.features) - 1

    def t_values(self) -> np.ndarray:
        scale = self.rss / self.dof / self.n
        return self.beta / np.sqrt(scale * np.diag(self.inverse))


def gram(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Means and covariances as a table: a, b, n, mean_a, mean_b, cov. One pass, complete rows only."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    data = df.select([F.col(c).cast("double").alias(c) for c in cols]).na.drop("any")
    one = data.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)],
        *[F.covar_pop(a, b).alias(f"_c{i}") for i, (a, b) in enumerate(pairs)],
    )
    pos = {c: i for i, c in enumerate(cols)}
    items = [
        F.struct(
            F.lit(a).alias("a"),
            F.lit(b).alias("b"),
            F.col("_n").alias("n"),
            F.col(f"_m{pos[a]}").alias("mean_a"),
            F.col(f"_m{pos[b]}").alias("mean_b"),
            F.col(f"_c{i}").alias("cov"),
        )
        for i, (a, b) in enumerate(pairs)
    ]
    return one.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def moments(df: DataFrame, cols: Sequence[str]) -> Moments:
    k = len(cols)
    mean, cov, n = np.zeros(k), np.zeros((k, k)), 0
    pos = {c: i for i, c in enumerate(cols)}
    for r in gram(df, cols).collect():  # k * (k + 1) / 2 rows
        i, j, n = pos[r.a], pos[r.b], r.n
        mean[i], mean[j] = r.mean_a, r.mean_b
        cov[i, j] = cov[j, i] = r["cov"]
    return Moments(tuple(cols), n, mean, cov)


def fit(m: Moments, label: str, features: Sequence[str]) -> Fit:
    features = tuple(features)
    mean, cov = m.pick([*features, label])
    sxx, sxy, syy = cov[:-1, :-1], cov[:-1, -1], cov[-1, -1]
    inverse = np.linalg.inv(sxx) if features else np.zeros((0, 0))
    beta = inverse @ sxy
    rss = m.n * float(syy - beta @ sxy)
    return Fit(label, features, m.n, float(mean[-1] - beta @ mean[:-1]), beta, max(rss, 0.0), m.n * float(syy), inverse)


def backward_aic(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Drop the feature whose removal lowers AIC most, until none does. One row per step."""
    m = moments(df, [*features, label])
    now = fit(m, label, features)
    steps = [(0, "", now.aic, now.rss, len(now.features))]
    while now.features:
        trials = [(fit(m, label, [f for f in now.features if f != out]), out) for out in now.features]
        best, out = min(trials, key=lambda t: t[0].aic)
        if best.aic >= now.aic:
            break
        now = best
        steps.append((len(steps), out, now.aic, now.rss, len(now.features)))
    return df.sparkSession.createDataFrame(steps, "step int, removed string, aic double, rss double, n_features int")


def backward_p(df: DataFrame, label: str, features: Sequence[str], level: float = 0.3) -> DataFrame:
    """Drop the feature with the highest p-value while it is above ``level``. One row per step."""
    m = moments(df, [*features, label])
    left, steps = list(features), []
    while left:
        f = fit(m, label, left)
        p = [student_tail(t, f.dof) for t in f.t_values()]
        worst = int(np.argmax(p))
        if p[worst] <= level:
            break
        steps.append((len(steps) + 1, left.pop(worst), float(p[worst])))
    return df.sparkSession.createDataFrame(steps, "step int, removed string, p_value double")


def anova(df: DataFrame, label: str, small: Sequence[str], large: Sequence[str]) -> DataFrame:
    """F test of a model against a larger one that contains it."""
    if not set(small) < set(large):
        raise ValueError("the small model must be nested in the large one")
    m = moments(df, [*large, label])
    a, b = fit(m, label, small), fit(m, label, large)
    extra = len(b.features) - len(a.features)
    f = ((a.rss - b.rss) / extra) / (b.rss / b.dof)
    row = (a.rss, b.rss, extra, b.dof, float(f), f_tail(f, extra, b.dof))
    return df.sparkSession.createDataFrame(
        [row], "rss_small double, rss_large double, df_extra int, df_resid long, f double, p_value double"
    )


def vif(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Variance inflation factors: the diagonal of the inverse correlation matrix."""
    m = moments(df, cols)
    sd = np.sqrt(np.diag(m.cov))
    diag = np.diag(np.linalg.inv(m.cov / np.outer(sd, sd)))
    return df.sparkSession.createDataFrame([(c, float(v)) for c, v in zip(cols, diag)], "term string, vif double")


def boxcox_profile(
    df: DataFrame, label: str, features: Sequence[str], lambdas: Sequence[float] | None = None
) -> DataFrame:
    """Profile log-likelihood of the power transform of the label, for all lambdas in one pass.

    The label is divided by its geometric mean first, which keeps the powers near one. Every row
    meets the fixed list of lambdas and is added up per lambda before the shuffle.
    """
    lambdas = [round(-1 + 0.05 * i, 2) for i in range(41)] if lambdas is None else list(lambdas)
    cols = list(features)
    data = df.select(F.col(label).cast("double").alias("_y"), *[F.col(c).cast("double").alias(c) for c in cols])
    data = data.na.drop("any").where(F.col("_y") > 0)
    mean_log = data.agg(F.avg(F.ln("_y")).alias("g")).scalar()
    grid = F.explode(F.array(*[F.lit(float(x)) for x in lambdas])).alias("lambda")
    rows = data.withColumn("_y", F.col("_y") / F.exp(mean_log)).select("*", grid)
    lam = F.col("lambda")
    z = F.when(lam == 0, F.ln("_y")).otherwise(F.try_divide(F.pow("_y", lam) - 1, lam))
    sums = (
        rows.withColumn("_z", z)
        .groupBy("lambda")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.var_pop("_z").alias("_v"),
            *[F.covar_pop(c, "_z").alias(f"_c{i}") for i, c in enumerate(cols)],
        )
        .collect()  # one row per lambda
    )
    _, sxx = moments(data, cols).pick(cols) if cols else (None, np.zeros((0, 0)))
    out = []
    for row in sorted(sums, key=lambda r: r["lambda"]):
        sxy = np.array([row[f"_c{i}"] for i in range(len(cols))])
        rss = row["_n"] * (row["_v"] - (float(sxy @ np.linalg.solve(sxx, sxy)) if cols else 0.0))
        out.append((row["lambda"], float(-row["_n"] / 2 * math.log(rss / row["_n"]))))
    return df.sparkSession.createDataFrame(out, "lambda double, log_likelihood double")


def fitted(df: DataFrame, f: Fit, out: str = "fitted") -> DataFrame:
    value = F.lit(f.intercept)
    for c, b in zip(f.features, f.beta):
        value = value + F.col(c) * F.lit(float(b))
    return df.withColumn(out, value)


def breusch_pagan(df: DataFrame, label: str, features: Sequence[str], on_fitted: bool = False) -> DataFrame:
    """Does the residual variance depend on the features (or on the fitted value)?

    ``statistic`` is half the explained sum of squares of the scaled squared residuals,
    ``studentized`` is n times their R squared; both are chi-squared under equal variance.
    """
    f = fit(moments(df, [*features, label]), label, features)
    e = F.col(label) - F.col("fitted")
    data = fitted(df.na.drop("any", subset=[*features, label]), f).withColumn("_u", e * e / F.lit(f.rss / f.n))
    regressors = ["fitted"] if on_fitted else list(features)
    g = fit(moments(data, [*regressors, "_u"]), "_u", regressors)
    stat, stud, dof = (g.tss - g.rss) / 2, g.n * (1 - g.rss / g.tss), len(regressors)
    row = (float(stat), chi2_tail(stat, dof), float(stud), chi2_tail(stud, dof), dof)
    return df.sparkSession.createDataFrame(
        [row], "statistic double, p_value double, studentized double, p_studentized double, df int"
    )


def influence(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Leverage, standardised residual and Cook's distance per row, as column expressions."""
    m = moments(df, [*features, label])
    f = fit(m, label, features)
    data = fitted(df.na.drop("any", subset=[*features, label]), f)
    centre, _ = m.pick(list(features))
    h = F.lit(1.0 / f.n)
    for i, a in enumerate(features):
        for j, b in enumerate(features):
            h = h + (F.col(a) - float(centre[i])) * (F.col(b) - float(centre[j])) * float(f.inverse[i, j] / f.n)
    s2, k = f.rss / f.dof, len(f.features) + 1
    e, lev = F.col("residual"), F.col("leverage")
    return (
        data.withColumn("residual", F.col(label) - F.col("fitted"))
        .withColumn("leverage", h)
        .withColumn("std_residual", e / F.sqrt(F.lit(s2) * (1 - lev)))
        .withColumn("cooks_distance", e * e * lev / (F.lit(k * s2) * (1 - lev) * (1 - lev)))
    )


# Tail probabilities come from the mathematics library among Spark's own jars, whatever the degrees of freedom.


def _special():
    return SparkSession.active().sparkContext._jvm.org.apache.commons.math3.special


def f_tail(f: float, d1: float, d2: float) -> float:
    """Upper tail of the F distribution."""
    return float(_special().Beta.regularizedBeta(float(d2 / (d2 + d1 * f)), d2 / 2, d1 / 2)) if f > 0 else 1.0


def student_tail(t: float, dof: float) -> float:
    """Two-sided."""
    return f_tail(t * t, 1, dof)


def chi2_tail(x: float, dof: float) -> float:
    """Upper tail."""
    return float(_special().Gamma.regularizedGammaQ(dof / 2, x / 2)) if x > 0 else 1.0

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablework.ml import diagnostics as D
from tablework.ml import features as FE
from tablework.ml import metrics as ME
from tablework.ml import regression as RG
from tablework.session import scratch_dir
from tests.conftest import rows

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3)) * [1, 5, 0.2] + [10, 0, 3]
    x[:, 2] += 0.05 * x[:, 1]
    y = 50 + 4 * x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=400) * (1 + 0.2 * np.abs(x[:, 1]))
    return x, y


@pytest.fixture(scope="module")
def frame(spark, data):
    x, y = data
    return spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, y double").cache()


def design(x):
    return np.column_stack([np.ones(len(x)), x])


def rss(x, y):
    z = design(x)
    return float(np.sum((y - z @ np.linalg.lstsq(z, y, rcond=None)[0]) ** 2))


def test_ols_equals_lstsq(frame, data):
    want = np.linalg.lstsq(design(data[0]), data[1], rcond=None)[0]
    model = RG.ols(frame, "y", COLS)
    assert np.allclose([model.intercept, *model.coefficients], want)
    f = D.fit(D.moments(frame, [*COLS, "y"]), "y", COLS)
    assert np.allclose([f.intercept, *f.beta], want) and math.isclose(f.rss, rss(*data), rel_tol=1e-9)


def test_backward_elimination(frame, data):
    x, y = data
    n = len(y)

    def aic(cols):
        return n * (math.log(2 * math.pi) + math.log(rss(x[:, cols], y) / n) + 1) + 2 * (len(cols) + 2)

    left, removed = [0, 1, 2], []
    while left:
        best = min(left, key=lambda c: aic([k for k in left if k != c]))
        if aic([k for k in left if k != best]) >= aic(left):
            break
        left.remove(best)
        removed.append(COLS[best])
    steps = D.backward_aic(frame, "y", COLS).orderBy("step").collect()
    assert [s.removed for s in steps[1:]] == removed
    assert math.isclose(steps[0].aic, aic([0, 1, 2]), rel_tol=1e-9)
    assert [r.removed for r in D.backward_p(frame, "y", COLS).collect()] == removed


def test_anova_and_vif(frame, data):
    x, y = data
    r1, r2 = rss(x[:, :1], y), rss(x, y)
    got = D.anova(frame, "y", ["a"], COLS).first()
    f = ((r1 - r2) / 2) / (r2 / (len(y) - 4))
    assert math.isclose(got.f, f, rel_tol=1e-8) and 0 <= got.p_value <= 1
    for i, c in enumerate(COLS):
        others = np.delete(x, i, axis=1)
        r_sq = 1 - rss(others, x[:, i]) / np.sum((x[:, i] - x[:, i].mean()) ** 2)
        assert math.isclose(dict(rows(D.vif(frame, COLS)))[c], 1 / (1 - r_sq), rel_tol=1e-8)
    with pytest.raises(ValueError):
        D.anova(frame, "y", ["a", "b"], ["a"])


def test_boxcox(frame, data):
    x, y = data
    gm = math.exp(np.mean(np.log(y)))
    for r in D.boxcox_profile(frame, "y", COLS, [-1.0, 0.0, 0.5, 2.0]).collect():
        lam, s = r["lambda"], y / gm
        z = np.log(s) if lam == 0 else (s**lam - 1) / lam
        assert math.isclose(r.log_likelihood, -len(y) / 2 * math.log(rss(x, z) / len(y)), rel_tol=1e-9)
    assert D.boxcox_profile(frame, "y", ["a"]).count() == 41


def test_breusch_pagan(frame, data):
    x, y = data
    z = design(x)
    fit = z @ np.linalg.lstsq(z, y, rcond=None)[0]
    u = (y - fit) ** 2 / (rss(x, y) / len(y))
    tss = np.sum((u - u.mean()) ** 2)
    got = D.breusch_pagan(frame, "y", COLS).first()
    assert math.isclose(got.statistic, (tss - rss(x, u)) / 2, rel_tol=1e-7) and got.df == 3
    assert math.isclose(got.studentized, len(y) * (1 - rss(x, u) / tss), rel_tol=1e-7)
    fitted = D.breusch_pagan(frame, "y", COLS, on_fitted=True).first()
    assert math.isclose(fitted.statistic, (tss - rss(fit[:, None], u)) / 2, rel_tol=1e-7) and fitted.df == 1


def test_influence(frame, data):
    x, y = data
    z = design(x)
    hat = z @ np.linalg.inv(z.T @ z) @ z.T
    h, e = np.diag(hat), y - hat @ y
    s2 = e @ e / (len(y) - 4)
    cook = e**2 * h / (4 * s2 * (1 - h) ** 2)
    got = D.influence(frame, "y", COLS).orderBy("y").select("leverage", "std_residual", "cooks_distance").toPandas()
    order = np.argsort(y)
    assert np.allclose(got.leverage, h[order]) and np.allclose(got.cooks_distance, cook[order])
    assert np.allclose(got.std_residual, (e / np.sqrt(s2 * (1 - h)))[order])


def test_tails(spark):
    assert math.isclose(D.chi2_tail(3.841458820694124, 1), 0.05, rel_tol=1e-9)
    assert math.isclose(D.chi2_tail(18.307038053275146, 10), 0.05, rel_tol=1e-9)
    assert math.isclose(D.student_tail(2.2281388519649385, 10), 0.05, rel_tol=1e-9)
    assert math.isclose(D.f_tail(3.3258345304130112, 5, 10), 0.05, rel_tol=1e-9)
    assert math.isclose(D.student_tail(1.959963984540054, 1e9), 0.05, rel_tol=1e-6)
    assert math.isclose(D.student_tail(1.96, 9e4), D.student_tail(1.96, 1.1e5), rel_tol=1e-4)
    assert D.f_tail(0.0, 1, 5) == 1.0 and D.chi2_tail(0.0, 2) == 1.0


def test_elastic_net_optimality(frame, data):
    """The gradient of the squared loss balances the penalty at every coefficient.

    Spark scales the label as well, which divides the quadratic part by the label's deviation.
    """
    x, y = data
    reg, mix = 0.3, 0.8
    model = RG.elastic_net(frame, "y", COLS, max_iter=200, reg=reg, mix=mix)
    sx = x.std(axis=0, ddof=1)
    xs = (x - x.mean(axis=0)) / sx
    beta = np.array(model.coefficients) * sx
    grad = xs.T @ (y - y.mean() - xs @ beta) / len(y)
    for g, b in zip(grad, beta):
        if b != 0:
            assert abs(g - reg * mix * np.sign(b) - reg * (1 - mix) * b / y.std(ddof=1)) < 0.005
        else:
            assert abs(g) <= reg * mix + 0.005


def test_penalised_paths(frame):
    for mix in (0.0, 1.0):
        best = RG.regularized_path(frame, "y", COLS, mix, [0.0, 1000.0], folds=3, keys=["y"])
        table = dict(rows(RG.path_table(frame, best)))
        assert table[0.0] < table[1000.0] and best.bestModel.getRegParam() == 0.0


def test_boosted_trees_saved_and_scored(spark, frame):
    steps = FE.feature_pipeline(frame.withColumn("k", F.when(F.col("a") > 10, "x").otherwise("z")), ["k"], COLS)
    rows_in = RG.with_fold(steps.transform(frame.withColumn("k", F.when(F.col("a") > 10, "x").otherwise("z"))), ["y"], 2)
    cv = RG.gbt_cv(rows_in, "y", depths=(1, 3), bins=(16,), folds=2, max_iter=4, fold_col="fold")
    table = RG.cv_table(frame, cv).collect()
    assert len(table) == 2 and all(r.rmse > 0 for r in table)
    path = scratch_dir(spark, "model")
    RG.save_model(cv.bestModel, f"{path}/m")
    RG.save_model(steps, f"{path}/s")
    again = type(cv.bestModel).load(f"{path}/m")
    new = frame.drop("y").withColumn("k", F.lit("unseen"))
    out = RG.score_new(RG.load_pipeline(f"{path}/s"), again, new, "y")
    assert out.where("y = 0 AND prediction IS NOT NULL").count() == 400


def test_tree_and_clusters(spark, frame):
    pred = RG.predict(RG.tree(frame, "y", COLS, 3), frame, "y", COLS)
    assert ME.regression_metrics(pred, "y").first().r2 > 0.5
    points = spark.createDataFrame(
        [(float(i % 3) * 10 + (i % 7) * 0.01, float(i % 3) * -10 + (i % 5) * 0.01) for i in range(300)], "lat double, long double"
    )
    for bisecting in (True, False):
        found = RG.spatial_clusters(points, ["lat", "long"], 3, bisecting=bisecting)
        assert sorted(r["count"] for r in found.groupBy("cluster").count().collect()) == [100, 100, 100]


def test_scaling(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, k double")
    test = spark.createDataFrame([(5.0, 5.0)], "x double, k double")
    a, b = FE.standardize(train, test, ["x", "k"])
    assert rows(a) == [(-1.0, 0.0), (1.0, 0.0)] and rows(b) == [(3.0, 0.0)]


def test_index_order_and_vectors(spark):
    df = spark.createDataFrame([("b",), ("b",), ("c",), ("a",)], "s string")
    assert rows(FE.string_index(df, "s")) == [("a", 1), ("b", 0), ("c", 2)]
    assert FE.one_hot_vector(df, "s").select("s_vector").first()[0].size == 3


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (4.0, 3.0)], "label double, prediction double")
    r = ME.regression_metrics(df, "label").first()
    assert math.isclose(r.mae, 2 / 3) and math.isclose(r.mse, 2 / 3) and math.isclose(r.percent_rmse, 100 * math.sqrt(2 / 3))
    assert rows(ME.residuals(df, "label"), "difference") == [(-1.0,), (0.0,), (1.0,)]
    table = dict(rows(ME.compare_models(df.withColumn("flat", F.lit(1.0)), "label", ["prediction", "flat"])))
    assert table["flat"] is None and math.isclose(table["prediction"], np.corrcoef([1, 2, 4], [2, 2, 3])[0, 1] ** 2)


def test_binary_metrics(spark):
    rng = np.random.default_rng(1)
    label, score = rng.integers(0, 2, 300), np.round(rng.random(300), 1)
    df = spark.createDataFrame([(int(a), float(s)) for a, s in zip(label, score)], "label int, score double")
    pos, neg = score[label == 1], score[label == 0]
    auc = np.mean((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg))
    tp, fp, fn = (sum((score >= 0.5) & (label == 1)), sum((score >= 0.5) & (label == 0)), sum((score < 0.5) & (label == 1)))
    got = ME.binary_metrics(df).first()
    assert math.isclose(got.auroc, auc, rel_tol=1e-9) and math.isclose(got.f1, 2 * tp / (2 * tp + fp + fn), rel_tol=1e-9)
    assert ME.binary_metrics(df, threshold=2.0).first().f1 == 0.0


def test_penalised_path_equals_cross_validation_by_mllib(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 3)) * [1, 5, 0.2] + [0, 100, 3]
    data = [(i, *map(float, r), float(r @ [2, -0.5, 4] + rng.normal())) for i, r in enumerate(x)]
    frame = spark.createDataFrame(data, "k int, a double, b double, c double, y double")
    penalties = [0.01, 0.5, 2.0]
    for mix in (0.0, 0.5, 1.0):
        mine = dict(rows(RG.penalised_path(frame, "y", ["a", "b", "c"], mix, penalties, folds=3, keys=["k"])))
        theirs = dict(rows(RG.path_table(frame, RG.regularized_path(frame, "y", ["a", "b", "c"], mix, penalties, folds=3, keys=["k"]))))
        assert all(math.isclose(mine[p], theirs[p], rel_tol=1e-3) for p in penalties), (mix, mine, theirs)
    path = rows(RG.penalised_path(frame, "y", ["a", "b", "c"], 1.0, keys=["k"]))
    assert len(path) == 100 and math.isclose(path[0][0] / path[-1][0], 1e-4, rel_tol=1e-6)


@pytest.mark.parametrize("kind", ["ties", "distinct", "perfect", "no negatives", "no positives", "one row"])
def test_curve_areas_equal_the_evaluator(spark, kind):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    draw = np.random.default_rng(6)
    n = 1 if kind == "one row" else 500
    labels = draw.integers(0, 2, n) if kind not in ("no negatives", "no positives") else np.full(n, int(kind == "no negatives"))
    scores = np.round(draw.random(n) + labels * 0.3, 1) if kind == "ties" else draw.random(n) + labels * (2 if kind == "perfect" else 0.3)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(labels, scores, strict=True)], "label double, score double").repartition(7)
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    got = ME.binary_metrics(df.unionByName(spark.createDataFrame([(None, 0.5), (1.0, None)], df.schema))).first()
    assert math.isclose(got.auroc, ev.evaluate(df, {ev.metricName: "areaUnderROC"}), abs_tol=1e-9)
    assert math.isclose(got.auprc, ev.evaluate(df, {ev.metricName: "areaUnderPR"}), abs_tol=1e-9)


def test_metrics_of_an_empty_table(spark):
    assert tuple(ME.binary_metrics(spark.createDataFrame([], "label double, score double")).first()) == (0.0, 0.0, 0.0)


def test_tree_rows_are_dealt_over_tasks_of_bounded_size(spark, monkeypatch):
    frame = spark.range(100).repartition(2)
    assert RG.in_parts(frame) is frame
    monkeypatch.setattr(RG, "TREE_ROWS", 9)
    dealt = RG.in_parts(frame)
    assert dealt.rdd.getNumPartitions() == 12 and sorted(r.id for r in dealt.collect()) == list(range(100))


def test_least_squares_rows_are_not_dealt_out_first(spark, tmp_path, monkeypatch):
    """Dealing out sorts and moves every row once more, for a fit that reads them once."""
    from tablework.workload import models
    from tablework.workload.fixtures import Fixtures

    spark.sql("SELECT id AS o_orderkey, timestamp'2024-01-01' AS o_orderdate FROM range(200)").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql(
        """SELECT id AS l_orderkey, n AS l_linenumber, 'N' AS l_returnflag, timestamp'2024-01-01' + make_dt_interval(CAST(3 * (id % 11) + n AS INT)) AS l_shipdate,
          CAST(id % 11 AS DOUBLE) AS l_quantity, CAST(id % 7 AS DOUBLE) AS l_extendedprice, CAST(id % 5 AS DOUBLE) AS l_tax, CAST(id % 3 AS DOUBLE) AS l_discount
          FROM range(200), (SELECT explode(sequence(1, 3)) AS n)"""
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    asked = []
    keep = models.staged
    monkeypatch.setattr(models, "staged", lambda df, label, **more: asked.append(more) or keep(df, label, **more))
    found = {r.term: r.coefficient for r in models.m06_causes(Fixtures(spark, str(tmp_path))).collect()}
    assert asked == [{}]
    assert len(found) == 12 and 2.5 < found["AirTime"] <= 3 and found["(r2)"] > 0.9

"""Queries over feature preparation, fitted models and diagnostics."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.functions.expressions import parse_number, sentinel_to_zero
from tablework.ml import diagnostics as D
from tablework.ml import features as FE
from tablework.ml import metrics as ME
from tablework.ml import regression as RG
from tablework.operators.clean import complete_rows
from tablework.operators.joins import latest_blocks
from tablework.session import scratch_dir, staged
from tablework.workload.fixtures import Fixtures
from tablework.workload.joins import rounded
from tablework.workload.registry import query

FEATURES = ["county", "is_business", "product_type", "is_consumption"]


@query(
    "m01_string_index",
    """SELECT c_mktsegment AS value, CAST(row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS INT) AS index FROM customer GROUP BY 1""",
)
def m01(fx: Fixtures) -> DataFrame:
    return FE.string_index(fx.table("customer"), "c_mktsegment")


@query(
    "m02_assemble",
    """SELECT row_id, round(target, 6) AS target, CAST(county AS DOUBLE) AS f0, CAST(is_business AS DOUBLE) AS f1, CAST(product_type AS DOUBLE) AS f2,
      CAST(is_consumption AS DOUBLE) AS f3 FROM readings WHERE target IS NOT NULL""",
    ("readings",),
)
def m02(fx: Fixtures) -> DataFrame:
    data = complete_rows(fx.readings()).select("row_id", "target", *FEATURES)
    out = FE.assemble(data, "target", FEATURES).withColumn("v", vector_to_array("features"))
    return out.select("row_id", F.round("target", 6).alias("target"), *[F.col("v")[i].alias(f"f{i}") for i in range(4)])


HASH = "CAST('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE"


@query(
    "m03_hash_split",
    f"""SELECT CASE WHEN {HASH.format(k="o_orderkey")} < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS part, o_orderkey FROM orders""",
)
def m03(fx: Fixtures) -> DataFrame:
    train, test = FE.hash_split(fx.table("orders").select("o_orderkey"), ["o_orderkey"], [0.8, 0.2])
    return train.select(F.lit("train").alias("part"), "*").unionByName(test.select(F.lit("test").alias("part"), "*"))


@query("m03_random_split", "SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_distinct, TRUE AS fits_weights FROM orders")
def m03_random(fx: Fixtures) -> DataFrame:
    """The random parts hold every row once, without overlap, and about in the proportion of the weights."""
    a, b = FE.random_split(fx.table("orders").select("o_orderkey"), [0.3, 0.05], 42)
    both = a.withColumn("first", F.lit(1)).unionByName(b.withColumn("first", F.lit(0)))
    share = F.abs(F.avg("first") - 0.3 / 0.35) < 0.03
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_orderkey").alias("n_distinct"), share.alias("fits_weights"))


@query(
    "m04_standardize",
    f"""WITH p AS (SELECT *, {HASH.format(k="o_orderkey")} < 0.75::DOUBLE AS is_train FROM orders),
      s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS d FROM p WHERE is_train)
      SELECT o_orderkey, round((o_totalprice - m) / d, 6) AS o_totalprice FROM p, s WHERE NOT is_train""",
)
def m04(fx: Fixtures) -> DataFrame:
    train, test = FE.hash_split(fx.table("orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], [0.75, 0.25])
    return rounded(FE.standardize(train, test, ["o_totalprice"])[1], 6)


@query(
    "m05_ols_simple",
    """SELECT '(intercept)' AS term, round(regr_intercept(price_num, sqft_lot), 3) AS coefficient FROM houses
      UNION ALL SELECT 'sqft_lot', round(regr_slope(price_num, sqft_lot), 3) FROM houses""",
    ("houses",),
)
def m05(fx: Fixtures) -> DataFrame:
    fitted = RG.ols(fx.houses(), "price_num", ["sqft_lot"])
    return rounded(RG.coefficient_table(fx.houses(), fitted, ["sqft_lot"]), 3)


TWO = """WITH c AS (SELECT count(*) AS n, avg(price_num) AS my, avg(sqft_lot) AS m1, avg(sqft_living) AS m2, var_pop(price_num) AS vy,
  var_pop(sqft_lot) AS v1, var_pop(sqft_living) AS v2, covar_pop(sqft_lot, sqft_living) AS c12, covar_pop(price_num, sqft_lot) AS c1,
  covar_pop(price_num, sqft_living) AS c2 FROM houses),
  b AS (SELECT *, (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1, (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2 FROM c)"""
PAIR = ["sqft_lot", "sqft_living"]


@query(
    "m05_ols_two",
    TWO
    + """ SELECT '(intercept)' AS term, round(my - b1 * m1 - b2 * m2, 3) AS coefficient FROM b
      UNION ALL SELECT 'sqft_lot', round(b1, 3) FROM b UNION ALL SELECT 'sqft_living', round(b2, 3) FROM b""",
    ("houses",),
)
def m05_two(fx: Fixtures) -> DataFrame:
    fitted = RG.ols(fx.houses(), "price_num", PAIR)
    return rounded(RG.coefficient_table(fx.houses(), fitted, PAIR), 3)


DELAY_FEATURES = ["AirTime", "Distance", "TaxiIn", "TaxiOut", "CarrierDelay"]


def delay_model_rows(fx: Fixtures) -> DataFrame:
    """Flown flights with numeric delay and causes; unknown causes count as 0."""
    kept = fx.flights().where((F.col("Cancelled") == 0) & F.col("AirTime").isNotNull())
    return complete_rows(
        kept.select(
            parse_number("ArrDelay", "double").alias("ArrDelay"),
            "AirTime",
            "Distance",
            "TaxiIn",
            "TaxiOut",
            sentinel_to_zero("CarrierDelay").alias("CarrierDelay"),
        )
    )


@query("m06_elastic_net")
def m06(fx: Fixtures) -> DataFrame:
    rows = staged(delay_model_rows(fx), "m06")
    fitted = RG.elastic_net(rows, "ArrDelay", DELAY_FEATURES)
    quality = [("(rmse)", fitted.summary.rootMeanSquaredError), ("(r2)", fitted.summary.r2)]
    return RG.coefficient_table(rows, fitted, DELAY_FEATURES).union(
        fx.spark.createDataFrame(quality, "term string, coefficient double")
    )


CAUSES = ["CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay"]


def delay_causes(fx: Fixtures) -> DataFrame:
    """Flown flights with all five causes of delay; ``'NA'`` and unknown ones count as 0."""
    li, o = fx.table("lineitem"), fx.table("orders")
    line, key = F.col("l_linenumber"), F.col("l_orderkey")
    cause = lambda n, value: F.when(line == n, "NA").when((key + n) % 3 != 0, value.cast("string"))
    flights = li.join(o, li.l_orderkey == o.o_orderkey).where("l_returnflag <> 'R'").select(
        F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).cast("string").alias("ArrDelay"),
        F.col("l_quantity").alias("AirTime"),
        F.col("l_extendedprice").alias("Distance"),
        F.col("l_tax").alias("TaxiIn"),
        F.col("l_discount").alias("TaxiOut"),
        *(cause(n, (key * n + line) % (10 * n)).alias(c) for n, c in enumerate(CAUSES, 1)),
        F.concat_ws("|", key, line).alias("flight"),
    )
    numbers = [parse_number("ArrDelay", "double").alias("ArrDelay"), "AirTime", "Distance", "TaxiIn", "TaxiOut"]
    return complete_rows(flights.select("flight", *numbers, *(sentinel_to_zero(c).alias(c) for c in CAUSES)))


@query("m06_elastic_net_causes")
def m06_causes(fx: Fixtures) -> DataFrame:
    """All five causes, fitted to a share of the rows and judged on another (weights 0.3 and 0.05, scaled to one)."""
    features = ["AirTime", "Distance", "TaxiIn", "TaxiOut", *CAUSES]
    rows = staged(delay_causes(fx), "m06c")  # least squares read them once: no reason to deal them out first
    train, test = FE.hash_split(rows, ["flight"], [0.3, 0.05])
    fitted = RG.elastic_net(train, "ArrDelay", features)
    judged = ME.regression_metrics(RG.predict(fitted, test, "ArrDelay", features), "ArrDelay").select(F.explode(F.array(*(F.struct(F.lit(f"({m})").alias("term"), F.col(m).alias("coefficient")) for m in ("rmse", "r2")))).alias("m"))
    return RG.coefficient_table(rows, fitted, features).unionByName(judged.select("m.*"))


# One predictor has a closed form: a soft-thresholded correlation on scaled columns, where the penalty
# is divided by the label's deviation.
PENALISED = """WITH c AS (SELECT count(*) AS n, avg(price_num) AS my, avg(sqft_lot) AS mx, stddev_samp(price_num) AS sy,
    stddev_samp(sqft_lot) AS sx, corr(price_num, sqft_lot) AS r FROM houses),
  b AS (SELECT *, (n - 1) / n AS k, {reg} / sy AS l FROM c),
  s AS (SELECT *, sign(r) * greatest(abs(r * k) - {mix} * l, 0) / (k + (1 - {mix}) * l) * sy / sx AS slope FROM b)
  SELECT '(intercept)' AS term, round(my - slope * mx, 0) AS coefficient FROM s UNION ALL SELECT 'sqft_lot', round(slope, 1) FROM s"""


def penalised(fx: Fixtures, reg: float, mix: float) -> DataFrame:
    rows = fx.houses()
    fitted = RG.elastic_net(rows, "price_num", ["sqft_lot"], max_iter=100, reg=reg, mix=mix)
    table = RG.coefficient_table(rows, fitted, ["sqft_lot"])
    digits = F.when(F.col("term") == "sqft_lot", F.round("coefficient", 1)).otherwise(F.round("coefficient", 0))
    return table.withColumn("coefficient", digits)


@query("m06_elastic_net_simple", PENALISED.format(reg="100.0::DOUBLE", mix="0.8::DOUBLE"), ("houses",))
def m06_simple(fx: Fixtures) -> DataFrame:
    return penalised(fx, 100.0, 0.8)


@query("m13_ridge_simple", PENALISED.format(reg="5000.0::DOUBLE", mix="0.0::DOUBLE"), ("houses",))
def m13_ridge_simple(fx: Fixtures) -> DataFrame:
    return penalised(fx, 5000.0, 0.0)


@query("m13_lasso_simple", PENALISED.format(reg="50.0::DOUBLE", mix="1.0::DOUBLE"), ("houses",))
def m13_lasso_simple(fx: Fixtures) -> DataFrame:
    return penalised(fx, 50.0, 1.0)


def training_rows(fx: Fixtures) -> DataFrame:
    return complete_rows(latest_blocks(fx.readings(), "data_block_id", 5)).where(F.col("target") != 0)


@query("m07_gbt")
def m07(fx: Fixtures) -> DataFrame:
    """A small grid on the latest blocks; the defaults of ``gbt_cv`` are the full one."""
    rows = training_rows(fx)
    data = FE.feature_pipeline(rows, FEATURES, []).transform(rows)
    data = RG.with_fold(data, ["row_id"], 2).select("target", "features", "fold")
    stored = staged(data, "m07", spread=True)
    best = RG.gbt_cv(stored, depths=(2, 4), bins=(32,), folds=2, max_iter=3, fold_col="fold")
    return RG.cv_table(rows, best)


@query("m07_gbt_grid")
def m07_grid(fx: Fixtures) -> DataFrame:
    """The full grid: two depths, two numbers of bins, 20 rounds, five folds; 21 fits."""
    rows = training_rows(fx)
    data = FE.feature_pipeline(rows, FEATURES, []).transform(rows)
    stored = staged(RG.with_fold(data, ["row_id"], 5).select("target", "features", "fold"), "m07g", spread=True)
    return RG.cv_table(rows, RG.gbt_cv(stored, fold_col="fold"))


@query(
    "m09_reg_metrics",
    """WITH p AS (SELECT target, avg(target) OVER (PARTITION BY county) AS prediction FROM readings WHERE target IS NOT NULL),
      m AS (SELECT count(*) AS n, avg(abs(target - prediction)) AS mae, avg((target - prediction) * (target - prediction)) AS mse,
        var_pop(target) AS v, min(prediction) AS lo, max(prediction) AS hi FROM p)
      SELECT n, round(mae, 6) AS mae, round(mse, 6) AS mse, round(sqrt(mse), 6) AS rmse, round(1 - mse / v, 6) AS r2,
        round(lo, 6) AS prediction_min, round(hi, 6) AS prediction_max, round(100 * sqrt(mse) / (hi - lo), 6) AS percent_rmse FROM m""",
    ("readings",),
)
def m09(fx: Fixtures) -> DataFrame:
    return rounded(ME.regression_metrics(county_means(fx), "target"), 6)


def county_means(fx: Fixtures) -> DataFrame:
    """The mean of the county as the prediction."""
    data = complete_rows(fx.readings())
    means = data.groupBy("county").agg(F.avg("target").alias("prediction"))
    return data.join(means, "county")


@query("m08_m10_score_new", "SELECT row_id, 0.0::DOUBLE AS target, TRUE AS scored FROM readings", ("readings",))
def m10(fx: Fixtures) -> DataFrame:
    """Fit, save, reload, then score all rows as if unlabelled, with the saved feature steps."""
    rows = complete_rows(fx.readings())
    steps = FE.feature_pipeline(rows, FEATURES, [])
    fitted = RG.LinearRegression(labelCol="target", regParam=0.0).fit(steps.transform(rows))
    folder = scratch_dir(fx.spark, "m10")
    RG.save_model(steps, f"{folder}/steps")
    RG.save_model(fitted, f"{folder}/model")
    again = RG.LinearRegressionModel.load(f"{folder}/model")
    out = RG.score_new(RG.load_pipeline(f"{folder}/steps"), again, fx.readings().drop("target"))
    return out.select("row_id", "target", F.col("prediction").isNotNull().alias("scored"))


@query(
    "m11_residuals",
    """SELECT row_id, round(avg(target) OVER (PARTITION BY county) - target, 6) AS difference FROM readings WHERE target IS NOT NULL""",
    ("readings",),
)
def m11(fx: Fixtures) -> DataFrame:
    return rounded(ME.residuals(county_means(fx), "target").select("row_id", "difference"), 6)


@query("m12_clusters")
def m12(fx: Fixtures) -> DataFrame:
    """Cluster sizes and mean label, the mean per cluster being the group mean of the clustered rows."""
    points = fx.table("embeddings").select(
        "vec_id", "label", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(["lat", "long"])]
    )
    found = RG.spatial_clusters(points, ["lat", "long"], 10)
    return found.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("avg_label"))


def house_rows(fx: Fixtures) -> DataFrame:
    """Stored once: every fit below reads its rows several times."""
    rows = fx.houses().select("id", "price_num", "sqft_living", "sqft_lot", "sqft_basement", "grade")
    return staged(rows, "houses", spread=True)


HOUSE_FEATURES = ["sqft_living", "sqft_lot", "sqft_basement", "grade"]


PATH_SQL = "SELECT CAST(100 AS BIGINT) AS points, TRUE AS falls, TRUE AS best_within_path, count(*) > 0 AS top_is_mean FROM houses"


def path_facts(fx: Fixtures, mix: float) -> DataFrame:
    """A hundred penalties and ten folds: the path falls, its best point is no worse than its top, where nothing but the mean is left."""
    rows = house_rows(fx)
    path = RG.penalised_path(rows, "price_num", HOUSE_FEATURES, mix, keys=["id"])
    spread = rows.agg(F.var_pop("price_num")).first()[0]
    best, top = F.min("mse"), F.max_by("mse", "lambda")
    facts = path.agg(F.count(F.lit(1)).alias("points"), F.max("lambda").alias("hi"), F.min("lambda").alias("lo"), best.alias("best"), top.alias("top"))
    return facts.select("points", (F.col("hi") > F.col("lo")).alias("falls"), (F.col("best") <= F.col("top")).alias("best_within_path"), (F.abs(F.col("top") / spread - 1) < 0.02).alias("top_is_mean"))


@query("m13_ridge", PATH_SQL, ("houses",))
def m13_ridge(fx: Fixtures) -> DataFrame:
    return path_facts(fx, 0.0)


@query("m13_lasso", PATH_SQL, ("houses",))
def m13_lasso(fx: Fixtures) -> DataFrame:
    return path_facts(fx, 1.0)


@query("m14_tree")
def m14(fx: Fixtures) -> DataFrame:
    data = house_rows(fx)
    return ME.regression_metrics(
        RG.predict(RG.tree(data, "price_num", HOUSE_FEATURES, 4), data, "price_num", HOUSE_FEATURES), "price_num"
    )


GRAM = ["price_num", "sqft_lot", "sqft_living"]


@query(
    "m15_gram",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, count(*) AS n, round(avg({a}), 5) AS mean_a, round(avg({b}), 5) AS mean_b, round(covar_pop({a}, {b}), 3) AS cov FROM houses"
        for i, a in enumerate(GRAM)
        for b in GRAM[i:]
    ),
    ("houses",),
)
def m15(fx: Fixtures) -> DataFrame:
    return D.gram(fx.houses(), GRAM).select(
        "a", "b", "n", F.round("mean_a", 5).alias("mean_a"), F.round("mean_b", 5).alias("mean_b"), F.round("cov", 3).alias("cov")
    )


@query("m15_backward_aic")
def m15_aic(fx: Fixtures) -> DataFrame:
    return D.backward_aic(house_rows(fx), "price_num", HOUSE_FEATURES)


@query("m15_backward_p")
def m15_p(fx: Fixtures) -> DataFrame:
    return D.backward_p(house_rows(fx), "price_num", HOUSE_FEATURES)


@query(
    "m16_anova",
    TWO
    + """, r AS (SELECT n, n * (vy - c1 * c1 / v1) AS r1, n * (vy - b1 * c1 - b2 * c2) AS r2 FROM b)
      SELECT round((r1 - r2) / (r2 / (n - 3)), 4) AS f, n - 3 AS df_resid FROM r""",
    ("houses",),
)
def m16(fx: Fixtures) -> DataFrame:
    out = D.anova(fx.houses(), "price_num", ["sqft_lot"], PAIR)
    return out.select(F.round("f", 4).alias("f"), "df_resid")


@query(
    "m17_vif",
    """SELECT term, round(1 / (1 - r * r), 6) AS vif FROM (SELECT corr(sqft_lot, price_num) AS r FROM houses),
      (SELECT unnest(['sqft_lot', 'price_num']) AS term)""",
    ("houses",),
)
def m17(fx: Fixtures) -> DataFrame:
    return rounded(D.vif(fx.houses(), ["sqft_lot", "price_num"]), 6)


LAMBDAS = [-1.0, -0.5, 0.0, 0.5, 1.0]
POWER = "CASE WHEN l = 0 THEN ln(y) ELSE (pow(y, l) - 1) / l END"


@query(
    "m18_boxcox",
    f"""WITH g AS (SELECT exp(avg(ln(price_num))) AS gm FROM houses), lam AS (SELECT unnest([-1.0, -0.5, 0.0, 0.5, 1.0])::DOUBLE AS l),
      d AS (SELECT price_num / gm AS y, sqft_lot AS x FROM houses, g),
      m AS (SELECT l, count(*) AS n, var_pop({POWER}) AS v, covar_pop({POWER}, x) AS c, var_pop(x) AS vx FROM d, lam GROUP BY l)
      SELECT l AS lambda, round(-n / 2.0 * ln(v - c * c / vx), 3) AS log_likelihood FROM m""",
    ("houses",),
)
def m18(fx: Fixtures) -> DataFrame:
    return rounded(D.boxcox_profile(fx.houses(), "price_num", ["sqft_lot"], LAMBDAS), 3)


@query("m18_boxcox_full")
def m18_full(fx: Fixtures) -> DataFrame:
    return D.boxcox_profile(house_rows(fx), "price_num", HOUSE_FEATURES)


@query(
    "m19_corr2",
    """SELECT model_name, round(r * r, 7) AS r_squared FROM (
      SELECT 'by_lot' AS model_name, corr(exp(9 + 0.03 * sqft_lot), price_num) AS r FROM houses
      UNION ALL SELECT 'by_living', corr(exp(9 + 0.01 * sqft_living), price_num) FROM houses)""",
    ("houses",),
)
def m19(fx: Fixtures) -> DataFrame:
    scored = fx.houses().select(
        "price_num",
        (9 + F.col("sqft_lot") * 0.03).alias("by_lot"),
        (9 + F.col("sqft_living") * 0.01).alias("by_living"),
    )
    return rounded(ME.compare_models(scored, "price_num", ["by_lot", "by_living"], exponentiate=True), 7)


@query("m19_log_target")
def m19_log(fx: Fixtures) -> DataFrame:
    """Models of the log price, compared on the price itself."""
    data = house_rows(fx).withColumn("log_price", F.ln("price_num"))
    train, test = FE.hash_split(data, ["id"], [0.7, 0.3])
    train = staged(train, "m19")
    scored = test
    for name, fitted in (
        ("linear_model", RG.ols(train, "log_price", HOUSE_FEATURES)),
        ("ridge", RG.elastic_net(train, "log_price", HOUSE_FEATURES, 50, 0.01, 0.0)),
        ("lasso", RG.elastic_net(train, "log_price", HOUSE_FEATURES, 50, 0.01, 1.0)),
        ("regression_tree", RG.tree(train, "log_price", HOUSE_FEATURES, 4)),
    ):
        scored = RG.predict(fitted, scored, "log_price", HOUSE_FEATURES).withColumnRenamed("prediction", name)
    return ME.compare_models(scored, "price_num", ["regression_tree", "linear_model", "lasso", "ridge"], True)


@query(
    "m20_bp_simple",
    """WITH b AS (SELECT regr_slope(price_num, sqft_lot) AS s, regr_intercept(price_num, sqft_lot) AS i FROM houses),
      e AS (SELECT sqft_lot AS x, pow(price_num - i - s * sqft_lot, 2) AS u FROM houses, b)
      SELECT round(count(*) * regr_r2(u, x), 3) AS studentized, round(count(*) * regr_r2(u, x) * var_pop(u) / pow(avg(u), 2) / 2, 3) AS statistic FROM e""",
    ("houses",),
)
def m20(fx: Fixtures) -> DataFrame:
    out = D.breusch_pagan(fx.houses(), "price_num", ["sqft_lot"])
    return out.select(F.round("studentized", 3).alias("studentized"), F.round("statistic", 3).alias("statistic"))


@query(
    "m21_influence",
    """WITH b AS (SELECT count(*) AS n, regr_slope(price_num, sqft_lot) AS s, regr_intercept(price_num, sqft_lot) AS i,
        avg(sqft_lot) AS mx, var_pop(sqft_lot) AS vx, count(*) * var_pop(price_num) * (1 - regr_r2(price_num, sqft_lot)) AS rss FROM houses),
      r AS (SELECT id, line, price_num - i - s * sqft_lot AS e, 1 / n + pow(sqft_lot - mx, 2) / (n * vx) AS h, rss / (n - 2) AS s2 FROM houses, b)
      SELECT id, line, round(h * 1e6, 4) AS leverage_ppm, round(e / sqrt(s2 * (1 - h)), 6) AS std_residual,
        round(e * e * h / (2 * s2 * (1 - h) * (1 - h)) * 1e6, 3) AS cooks_ppm FROM r""",
    ("houses",),
)
def m21(fx: Fixtures) -> DataFrame:
    out = D.influence(fx.houses().select("id", "line", "price_num", "sqft_lot"), "price_num", ["sqft_lot"])
    return out.select(
        "id",
        "line",
        F.round(F.col("leverage") * 1e6, 4).alias("leverage_ppm"),
        F.round("std_residual", 6).alias("std_residual"),
        F.round(F.col("cooks_distance") * 1e6, 3).alias("cooks_ppm"),
    )


@query(
    "m22_auc_f1",
    """WITH t AS (SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q FROM scored GROUP BY 1),
      c AS (SELECT score, p, q, sum(p) OVER w AS tp, sum(q) OVER w AS fp FROM t WINDOW w AS (ORDER BY score DESC)),
      n AS (SELECT sum(p) AS np, sum(q) AS nq FROM t),
      v AS (SELECT score, tp / np AS recall, tp / (tp + fp) AS prec, tp / np AS tpr, fp / nq AS fpr FROM c, n),
      z AS (SELECT *, lag(recall, 1, 0) OVER o AS r0, lag(prec, 1) OVER o AS p0, lag(tpr, 1, 0) OVER o AS t0, lag(fpr, 1, 0) OVER o AS f0
        FROM v WINDOW o AS (ORDER BY score DESC)),
      f AS (SELECT count(*) FILTER (score >= 400 AND label = 1) AS tp, count(*) FILTER (score >= 400 AND label = 0) AS fp,
        count(*) FILTER (score < 400 AND label = 1) AS fn FROM scored)
      SELECT round(sum((fpr - f0) * (tpr + t0) / 2), 6) AS auroc, round(sum((recall - r0) * (prec + coalesce(p0, prec)) / 2), 6) AS auprc,
        round((SELECT 2 * tp / (2 * tp + fp + fn) FROM f), 6) AS f1 FROM z""",
    ("scored",),
)
def m22(fx: Fixtures) -> DataFrame:
    return rounded(ME.binary_metrics(fx.scored(), threshold=400.0), 6)

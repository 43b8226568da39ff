import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablework.operators import aggregates as A
from tablework.operators.quantiles import exact_quantiles
from tests.conftest import rows


@pytest.mark.parametrize("accuracy, small", [(100_000, 100_000), (50, 0), (200, 100)])
def test_quantiles_equal_sorting(spark, accuracy, small):
    """With a coarse sketch and no small-group shortcut the brackets do the work."""
    rng = np.random.default_rng(7)
    groups = {
        "hot": np.round(rng.normal(size=6000), 3),
        "dup": np.repeat([1.0, 2.0, 2.0, 9.0], 500),
        "wide": rng.exponential(size=2001) * 1e6,
        "one": np.array([4.5]),
    }
    if small == 0:
        groups = {k: v for k, v in groups.items() if len(v) >= 2000}
    data = [(k, float(x)) for k, v in groups.items() for x in v] + [("empty", None)]
    df = spark.createDataFrame(data, "k string, x double").repartition(5)
    probs = [0.1, 0.5, 0.9]
    got = {r.k: r for r in exact_quantiles(df, ["k"], ["x"], probs, accuracy, small).collect()}
    assert got["empty"].n == 0 and got["empty"].q1 is None and got["empty"].n_rows == 1
    for k, v in groups.items():
        want = np.quantile(v, probs)
        assert np.allclose([got[k].q0, got[k].q1, got[k].q2], want, rtol=1e-12, atol=0), k
        assert got[k].n == len(v) and math.isclose(got[k]["mean"], v.mean(), rel_tol=1e-9)


def test_quantiles_without_keys_and_with_null_key(spark):
    df = spark.createDataFrame([(None, 1.0, 4), (None, 3.0, 6), ("a", 5.0, None)], "k string, x double, y int")
    got = {(r.k, r["_col"]): r.q0 for r in exact_quantiles(df, ["k"], ["x", "y"], [0.5]).collect()}
    assert got == {(None, "x"): 2.0, (None, "y"): 5.0, ("a", "x"): 5.0, ("a", "y"): None}
    assert {r["_col"]: r.q0 for r in exact_quantiles(df, [], ["x", "y"], [0.5]).collect()} == {"x": 3.0, "y": 5.0}


def test_price_stats_keep_days_without_values(spark):
    d = dt.date
    df = spark.createDataFrame([(d(2024, 1, 1), 1.0), (d(2024, 1, 1), 2.0), (d(2024, 1, 2), None)], "t date, p double")
    assert rows(A.price_stats(df, "t", {"p": "p"})) == [(d(2024, 1, 1), 1.5, 1.5), (d(2024, 1, 2), None, None)]


def test_consumption_production(spark):
    t = dt.datetime
    df = spark.createDataFrame(
        [
            (t(2024, 1, 1, 1), 1, 5.0), (t(2024, 1, 1, 2), 0, 7.0), (t(2024, 1, 2), 1, 1.0),
            (t(2024, 1, 3), 1, None), (t(2024, 1, 3), 0, 2.0), (None, 1, 9.0),
        ],
        "datetime timestamp_ntz, is_consumption int, target double",
    )
    inner = A.consumption_production(df)
    assert rows(inner) == [(dt.date(2024, 1, 1), 5.0, 7.0, 2.0), (dt.date(2024, 1, 3), None, 2.0, None)]
    assert A.consumption_production(df, "full").count() == 3


def test_delay_rates(spark):
    data = [("a", 0, "5"), ("a", 0, "-1"), ("a", 1, "NA"), ("a", 0, None), ("b", 1, "NA")]
    df = spark.createDataFrame(data, "k string, Cancelled int, ArrDelay string")
    assert rows(A.delay_rates(df, "k")) == [("a", 0.25, 0.5, 0.5, 4), ("b", 1.0, None, None, 1)]
    assert rows(A.delay_rates(df, "k", min_sample=0), "k") == [("a",)]
    as_int = df.withColumn("ArrDelay", F.expr("try_cast(ArrDelay AS int)"))
    assert rows(A.delay_rates(as_int, "k")) == rows(A.delay_rates(df, "k"))


def test_histogram(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]] + [(None,)], "x double")
    out = A.histogram(df, "x", 5).orderBy("bin").collect()
    counts, edges = np.histogram(np.arange(11), 5)
    assert [r["count"] for r in out] == list(counts) and [r.bin_start for r in out] == list(edges[:-1])
    flat = A.histogram(spark.createDataFrame([(2.0,)] * 3, "x double"), "x", 4)
    assert flat.agg(F.sum("count")).first()[0] == 3 and flat.agg(F.min("bin_start")).first()[0] == 1.5
    assert A.histogram(df.limit(0), "x").count() == 0


def test_density(spark):
    values = [1.0, 1.0, 2.0, 5.0]
    points, h = [0.0, 1.5, 5.0], 0.7
    got = dict(rows(A.density(spark.createDataFrame([(v,) for v in values], "x double"), "x", points, h)))
    for p in points:
        want = sum(math.exp(-0.5 * ((p - v) / h) ** 2) for v in values) / (len(values) * h * math.sqrt(2 * math.pi))
        assert math.isclose(got[p], want, rel_tol=1e-12)
    below = A.density(spark.createDataFrame([(1.0,), (100.0,)], "x double"), "x", [1.0], 1.0, below=50)
    assert math.isclose(below.first()["density"], 1 / math.sqrt(2 * math.pi))


def test_profile_and_null_counts(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, None), (None, None), (4.0, "b")], "x double, s string")
    r = A.profile(df, ["x"]).first()
    assert (r["count"], r.nulls, r.min, r.p50, r.max) == (3, 1, 1.0, 2.0, 4.0)
    assert rows(A.null_counts(df)) == [("s", 2), ("x", 1)]
    assert rows(A.fill_rates(df)) == [("s", 0.5), ("x", 0.75)]
    assert rows(A.fill_rates(df.limit(0)))[0][1] is None


def test_constant_raters(spark):
    data = [("u", i, 3) for i in range(4)] + [("v", i, i) for i in range(4)] + [("w", 1, 2)]
    df = spark.createDataFrame(data, "User_ID string, Movie_ID int, Rating int")
    assert rows(A.constant_raters(df, ["User_ID"], 3)) == [("u", 4, 1)]


def test_shares(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] + [(None,)], "c string")
    assert rows(A.share_of_total(df, "c"), "c", "count", "total", "share") == [("a", 3, 4, 0.75), ("b", 1, 4, 0.25)]
    assert rows(A.class_balance(df, "c")) == [(None, 1, 20.0), ("a", 3, 60.0), ("b", 1, 20.0)]


def test_duplicates_and_corr(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 9.0)], "k int, v double")
    assert rows(A.key_duplicates(df, ["k"])) == [(1, 2)] and rows(A.key_uniques(df, ["k"])) == [(2, 1)]
    got = {(r.a, r.b): r["corr"] for r in A.corr_matrix(df, ["k", "v"]).collect()}
    assert math.isclose(got["k", "v"], np.corrcoef([1, 1, 2], [2, 4, 9])[0, 1])


def test_hot_group_counts(spark):
    n = 60000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"), "id")
    got = dict(rows(A.distinct_counts(df, ["k"], {"n": "id"})))
    assert got["hot"] == n // 3 and sum(got.values()) == n


def test_profile_of_any_column(spark):
    import datetime as dt

    day = dt.date(2024, 1, 1)
    data = [("b", True, day, 1), ("a", None, day, 1), ("a", False, None, 1), ("b", True, day + dt.timedelta(1), 1), (None, None, None, 1), ("", None, None, 1)]
    df = spark.createDataFrame([(*r, None) for r in data], "t string, b boolean, d date, n int, void string")
    found = rows(A.profile_values(df))
    assert found == sorted(
        [
            ("t", 5, 1, 3, "a", 2, "", "b"),
            ("b", 3, 3, 2, "true", 2, "false", "true"),
            ("d", 3, 3, 2, "2024-01-01", 2, "2024-01-01", "2024-01-02"),
            ("n", 6, 0, 1, "1", 6, "1", "1"),
            ("void", 0, 6, 0, None, None, None, None),
        ]
    )
    empty = rows(A.profile_values(df.limit(0), ["t"]))
    assert empty == [("t", 0, 0, 0, None, None, None, None)]

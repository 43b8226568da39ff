import datetime as dt

from pyspark.sql import functions as F

from tablework.operators import joins as J
from tests.conftest import rows


def test_latest_version_keeps_ties_and_drops_null_keys(spark):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, 1, "d"), (None, 9, "e")], "k int, ts int, v string"
    )
    once = J.latest_version(df, ["k"], "ts")
    assert rows(once, "k", "v") == [(1, "b"), (1, "c"), (2, "d")]
    assert rows(J.latest_version(once, ["k"], "ts"), "k", "v") == rows(once, "k", "v")
    assert J.latest_version(df.limit(0), ["k"], "ts").count() == 0


def test_latest_version_with_a_hot_key(spark):
    """A third of all rows share one key."""
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), (F.col("id") % 11).alias("ts"), "id"
    )
    got = J.latest_version(df, ["k"], "ts")
    hot = [i for i in range(0, n, 3) if i % 11 == 10]
    assert got.where("k = 0").count() == len(hot)
    assert got.count() == len(hot) + n - n // 3


def test_blocks(spark):
    df = spark.createDataFrame([(b, i) for b in (1, 2, 3, 4) for i in range(3)] + [(None, 9)], "b int, i int")
    assert rows(J.latest_blocks(df, "b", 2).select("b").distinct()) == [(3,), (4,)]
    assert rows(J.latest_blocks(df, "b", 2, distinct=False).select("b").distinct()) == [(4,)]
    assert rows(J.latest_blocks(df, "b", 4, distinct=False).select("b").distinct()) == [(3,), (4,)]


def test_shift_and_multiplicity(spark):
    d = dt.datetime
    facts = spark.createDataFrame([(1, d(2024, 1, 2, 5)), (2, d(2024, 1, 3, 5)), (3, None)], "id int, ts timestamp_ntz")
    prices = spark.createDataFrame([(d(2024, 1, 1, h), h * 1.0) for h in range(24)], "pt timestamp_ntz, p double")
    hourly = J.join_shifted(facts, prices, "ts", "pt", 1, "hour")
    daily = J.join_shifted(facts, prices, "ts", "pt", 1, "day")
    assert rows(hourly, "id", "p") == [(1, 5.0), (2, None), (3, None)]
    assert daily.count() == 26
    assert rows(J.check_multiplicity(facts, hourly)) == [(3, 3, 1.0)]
    assert rows(J.check_multiplicity(facts, daily))[0][2] > 1


def test_lookups(spark):
    facts = spark.createDataFrame([(1, 10, 5), (2, None, 6), (3, 99, 5)], "id int, a int, b int")
    la = spark.createDataFrame([(10, "ten")], "k int, name string")
    lb = spark.createDataFrame([(5, "five")], "k int, word string")
    out = J.enrich(facts, [("a", la, "k", ["name"]), ("b", lb, "k", ["word"])])
    assert rows(out) == [(1, 10, 5, "ten", "five"), (2, None, 6, None, None), (3, 99, 5, None, "five")]
    assert rows(J.enrich_default(facts, "a", la, "k", "name"), "id", "a", "name") == [(1, 10, "ten"), (2, 0, None), (3, 99, None)]


def test_states(spark):
    facts = spark.createDataFrame([(6037,), (36061,), (None,)], "fips int")
    states = spark.createDataFrame([(6, "CA"), (36, "NY")], "state_fips int, code string")
    assert rows(J.enrich_state(facts, states, "fips", "state_fips"), "fips", "state_fips", "code") == [
        (None, None, None), (6037, "06", "CA"), (36061, "36", "NY"),
    ]


def test_set_like_joins(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (None, "n")], "k int, v string")
    b = spark.createDataFrame([(2,), (2,), (None,)], "k int")
    assert rows(J.new_rows(a, b, ["k"]), "v") == [("n",), ("x",)]
    assert rows(J.in_set(a, b, "k"), "v") == [("y",), ("z",)]
    one = spark.createDataFrame([(7, 8)], "t int, u int")
    assert rows(J.with_total(a.where("k = 1"), one)) == [(1, "x", 7, 8)]
    full = J.full_outer_by_key(
        spark.createDataFrame([(1, 1)], "k int, a int"), spark.createDataFrame([(2, 2)], "k int, b int"), ["k"]
    )
    assert rows(full) == [(1, 1, None), (2, None, 2)]


def test_top_titles(spark):
    scores = spark.createDataFrame([(i, s) for i, s in enumerate([5.0, 3.0, 5.0, 1.0])], "k int, s double")
    titles = spark.createDataFrame([(0, "a"), (2, "c"), (3, "d")], "k int, t string")
    assert rows(J.top_titles(scores, titles, "k", "s", 2), "k", "t") == [(0, "a"), (2, "c")]
    assert rows(J.top_titles(scores, titles, "k", "s", 2, ascending=True), "k", "t") == [(1, None), (3, "d")]

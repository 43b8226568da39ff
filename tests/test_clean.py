import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablework.operators import clean as C
from tablework.schemas import table
from tests.conftest import rows


def test_mode_takes_smallest_on_ties_and_ignores_nulls(spark):
    df = spark.createDataFrame([(1, 3, "b"), (2, 2, "b"), (3, 2, "a"), (4, 3, None), (5, None, None), (6, None, None)], "id int, n int, s string")
    assert rows(C.column_modes(df, ["n", "s"])) == [(2, "b")]
    assert rows(C.fill_mode(df, ["n", "s"]).where("id > 3")) == [(4, 3, "b"), (5, 2, "b"), (6, 2, "b")]


def test_mode_of_an_all_null_column_stays_null(spark):
    df = spark.createDataFrame([(1, None)], "id int, n int")
    assert rows(C.fill_mode(df, ["n"])) == [(1, None)]


def test_first_per_key_equals_row_number(spark):
    df = spark.range(5000).select((F.col("id") % 7).alias("k"), (F.col("id") * 7919 % 97).alias("o"), F.col("id").alias("v"))
    w = Window.partitionBy("k").orderBy("o", "v")
    want = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert rows(C.first_per_key(df, ["k"], ["o", "v"])) == rows(want)


def test_first_per_key_descending(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("b", 2)], "k string, v int")
    assert rows(C.first_per_key(df, ["k"], [-F.col("v")])) == [("a", 5), ("b", 2)]


def test_fills_do_not_undo_each_other(spark):
    df = spark.createDataFrame([(None, None)], "a int, b string")
    assert rows(C.fill_nulls(df, {"a": 0, "b": "x"})) == [(0, "x")]


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "x y"), (2, "z"), (3, None)], "id int, c string")
    out = C.one_hot(df, "c")
    assert out.columns == ["id", "c_x_y", "c_z"]
    assert rows(out) == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]
    assert len(C.one_hot(spark.range(300), "id").columns) == 300
    assert C.one_hot(df, "c", levels=["z"]).columns == ["id", "c_z"]
    same = spark.createDataFrame([(1, "a b"), (2, "a_b")], "id int, c string")
    assert rows(C.one_hot(same, "c")) == [(1, 1, 0), (2, 0, 1)] and C.one_hot(same, "c").columns == ["id", "c_a_b", "c_a_b_2"]


def test_enforce_schema(spark):
    df = spark.createDataFrame([("1", "2.5"), ("x", "1"), (None, "1"), ("2", None), ("3", "bad")], "id string, v string")
    ok, rejected = C.enforce_schema(df, table("id bigint not null", "v double"))
    assert rows(ok) == [(2, None), (1, 2.5)] or rows(ok) == [(1, 2.5), (2, None)]
    assert rows(rejected) == [(None, "1"), ("3", "bad"), ("x", "1")]
    assert ok.dtypes == [("id", "bigint"), ("v", "double")]


def test_hash_sample_and_split_agree(spark):
    from tablework.ml.features import hash_split, random_split

    df = spark.range(10000)
    sample = C.hash_sample(df, ["id"], 0.1)
    assert 850 < sample.count() < 1150
    assert rows(sample) == rows(C.hash_sample(df.repartition(7), ["id"], 0.1))
    a, b, c = hash_split(df, ["id"], [0.3, 0.05, 0.65])
    assert a.count() + b.count() + c.count() == 10000 and a.union(b).union(c).distinct().count() == 10000
    a, b = random_split(df, [0.3, 0.05], 1)
    assert a.count() + b.count() == 10000 and a.intersect(b).count() == 0


def test_cardinality(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("a"), "id", F.lit(None).cast("int").alias("n"))
    assert rows(C.detect_categoricals(df, 15)) == [("a", 3, True), ("id", 100, False), ("n", 0, True)]


def test_cast_and_prefix(spark):
    df = spark.createDataFrame([("1", 2.9), ("NA", None)], "a string, b double")
    assert rows(C.prefix_columns(C.cast_columns(df, {"a": "int", "b": "int"}), "t"), "t_a", "t_b") == [(None, None), (1, 2)]

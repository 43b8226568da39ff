"""A key that holds a third of all rows must not end in one task."""

import pytest
from pyspark.sql import functions as F

from tablework.operators import joins as J
from tablework.operators.aggregates import price_stats
from tests.conftest import rows

N = 300_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def no_broadcast(spark):
    """Thresholds scaled down to test data, so that the plans are those of large tables."""
    keep = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in keep.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def facts(spark):
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000)
    return spark.range(0, N, 1, 8).select(key.alias("k"), "id", F.md5(F.col("id").cast("string")).alias("pad"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_join_splits_the_hot_key(spark, no_broadcast):
    lookup = spark.range(1000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("name"))
    out = J.enrich(facts(spark), [("k", lookup, "key", ["name"])])
    assert len(out.collect()) == N
    assert "skewed" in plan(out)


def test_anti_and_semi_joins_split_the_hot_key(spark, no_broadcast):
    keys = spark.range(500).select(F.col("id").alias("k"))
    kept = J.in_set(facts(spark), keys, "k")
    left = J.new_rows(facts(spark), keys, ["k"])
    n_kept, n_left = len(kept.collect()), len(left.collect())
    assert n_kept + n_left == N and n_kept > N // 3
    assert "skewed" in plan(kept)


def test_latest_version_without_broadcast(spark, no_broadcast):
    df = facts(spark).withColumn("ts", F.col("id") % 5)
    got = J.latest_version(df, ["k"], "ts")
    want = df.groupBy("k").agg(F.max("ts").alias("m"))
    check = df.join(want, "k").where("ts = m").count()
    assert got.count() == check


def test_median_of_a_hot_group(spark, no_broadcast):
    df = spark.range(N).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("d"), (F.col("id") * 17 % 1009).alias("v"))
    got = price_stats(df, "d", {"v": "p"}, "d")
    want = df.groupBy("d").agg(F.median("v").alias("m"), F.avg("v").alias("a"))
    assert rows(got) == rows(want)

from pyspark.sql import functions as F

from tablework.functions import expressions as X
from tablework.plans import property as P
from tests.conftest import rows


def one(spark, value, expr, dtype="double"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr).first()[0]


def test_bucket_edges(spark):
    left = X.bucketize("x", [200, 300], ["a", "b", "c"])
    right = X.bucketize("x", [200, 300], ["a", "b", "c"], closed="right")
    assert [one(spark, v, left) for v in (199.0, 200.0, 299.0, 300.0)] == ["a", "b", "b", "c"]
    assert [one(spark, v, right) for v in (200.0, 201.0, 300.0, 301.0)] == ["a", "b", "b", "c"]
    assert one(spark, None, left) is None


def test_property_categories(spark):
    assert [one(spark, v, P.patio_size("x")) for v in (None, 0.0, -1.0, 5.0, 200.0, 399.0, 400.0)] == [
        "none", "none", None, "small", "medium", "large", "extra_large",
    ]
    assert [one(spark, v, P.room_category("x")) for v in (None, 0.0, 4.0, 5.0, 8.0, 9.0)] == [
        "none", "none", "small", "medium", "medium", "large",
    ]
    assert [one(spark, v, P.unit_category("x"), "int") for v in (None, 0, 3, 5, 77)] == [0, 0, 3, 5, 5]
    assert [one(spark, v, P.built_category("x"), "int") for v in (None, 0, 1959, 1960, 2009, 2010)] == [
        "No Structure", "No Structure", "Over 60 Years", "10 to 50 years old", "10 to 50 years old", "Newer than 10 years",
    ]
    today = F.lit("2024-05-01").cast("date")
    assert [one(spark, v, P.age_group("x", today), "int") for v in (None, 2014, 2013, 1964, 1963)] == [
        None, P.AGE_LABELS[0], P.AGE_LABELS[1], P.AGE_LABELS[1], P.AGE_LABELS[2],
    ]


def test_numbers_from_text(spark):
    assert [one(spark, v, X.parse_money("x"), "string") for v in (" $1,234 ", "$5", "free", None)] == [1234.0, 5.0, None, None]
    assert [one(spark, v, X.parse_number("x", "int"), "string") for v in ("7", "NA", "", "x", None)] == [7, None, None, None, None]
    assert [one(spark, v, X.sentinel_to_zero("x"), "string") for v in ("7", "NA", None)] == [7.0, 0.0, 0.0]


def test_flags_and_ratios(spark):
    assert [one(spark, v, X.late_flag("x")) for v in (1.0, 0.0, None)] == [True, False, None]
    assert [one(spark, v, X.binary_flag("x")) for v in (0.0, 3.0, None)] == [0, 1, None]
    assert one(spark, 0.0, X.ratio(F.lit(1.0), "x")) is None
    assert [one(spark, v, X.parity_estimate("x")) for v in (100.0, 101.0)] == [103.0, 101.0 * 0.98]
    df = spark.createDataFrame([(None, None), (1, None), (None, 2)], "a int, b int")
    assert rows(df.select(X.presence_flag("a", "b").alias("f"))) == [(0,), (1,), (1,)]


def test_years_since_renewal(spark):
    df = spark.createDataFrame([(2015, 1990, 0), (2015, 1990, 2005)], "s int, b int, r int")
    assert rows(df.select(X.years_since_renewal("s", "b", "r"))) == [(10,), (25,)]


def test_county_to_state(spark):
    assert [one(spark, v, X.padded_prefix("x", 5, 2), "int") for v in (6037, 36061)] == ["06", "36"]


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)], "a double, b double")
    got = df.agg(X.correlation("a", "b"), X.correlation("b", "b")).first()
    assert got[0] is None and abs(got[1] - 1) < 1e-12


def test_hash_fraction_is_uniform_and_stable(spark):
    df = spark.range(20000).select(X.hash_fraction("id").alias("u"))
    lo, hi, mean = df.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= lo and hi < 1 and abs(mean - 0.5) < 0.01
    assert one(spark, 1, X.hash_fraction("x"), "int") == int("c4ca4238", 16) / 2**32  # md5("1")

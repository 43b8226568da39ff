import numpy as np
import pytest
from pyspark.sql import functions as F

from tablework.recommend import als as R
from tablework.recommend import baskets as B
from tests.conftest import rows


def ratings(spark):
    data = [("u1", "a", 5), ("u1", "a", 4), ("u1", "b", 5), ("u1", "c", 1), ("u2", "a", 4), ("u2", "b", 4), ("u3", "a", 5), ("u4", "d", 2)]
    return spark.createDataFrame(data, "User_ID string, Movie_ID string, Rating int")


def test_baskets(spark):
    assert rows(B.baskets(ratings(spark))) == [("u1", ["a", "b"]), ("u2", ["a", "b"]), ("u3", ["a"])]
    assert B.baskets(ratings(spark), min_rating=None).count() == 4


def test_itemsets_and_rules(spark):
    basket = B.baskets(ratings(spark))
    model = B.fit_itemsets(basket, 0.5, 0.5)
    assert rows(B.frequent_itemsets(model)) == [("a", 1, 3), ("a,b", 2, 2), ("b", 1, 2)]
    found = rows(B.rules(model))
    assert [r[:2] for r in found] == [("a", "b"), ("b", "a")] and all(r[2] <= 1 for r in found)
    assert rows(B.apply_rules(model, basket), "User_ID", "prediction") == [("u1", []), ("u2", []), ("u3", ["b"])]


def test_both_ways_of_applying_rules_agree(spark):
    rng = np.random.default_rng(5)
    data = [(int(u), f"i{i}", 5) for u in range(200) for i in range(8) if rng.random() < 0.6]
    df = spark.createDataFrame(data, "User_ID int, Movie_ID string, Rating int")
    basket = B.baskets(df).cache()
    model = B.fit_itemsets(basket, 0.1, 0.5)
    assert model.associationRules.where(F.size("antecedent") > 2).count() > 0
    shipped = model.transform(basket).select("User_ID", "items", F.sort_array("prediction").alias("prediction"))
    assert rows(B.apply_rules(model, basket)) == rows(shipped)


def test_als(spark):
    rng = np.random.default_rng(2)
    u, v = rng.random((30, 2)) + 0.5, rng.random((12, 2)) + 0.5
    cells = [(a, b, float(u[a] @ v[b])) for a in range(30) for b in range(12)]
    train = spark.createDataFrame([c for i, c in enumerate(cells) if i % 5], "user int, item int, rating float")
    test = spark.createDataFrame([c for i, c in enumerate(cells) if i % 5 == 0] + [(999, 1, 3.0)], "user int, item int, rating float")
    model = R.als(train, rank=2, iterations=10)
    err = R.held_out_error(model, test).first()
    assert err.mse < 0.02 and err.n_scored == 72 and err.n_test == 73 and 0.98 < err.coverage < 1
    assert R.scored_pairs(model, test).count() == 72
    best = R.recommend(model, 3)
    assert best.count() == 90 and best.where("place = 1").count() == 30
    assert R.recommend(model, 3, spark.createDataFrame([(1,), (2,)], "user int")).count() == 6
    assert R.als_sweep(train, test, ranks=(1, 2), iterations=3).count() == 2
    low = spark.createDataFrame([(1.0,), (3.0,), (3.5,)], "prediction double")
    assert rows(R.above(low)) == [(3.5,)]


def test_ids_that_do_not_fit_are_refused_or_numbered(spark):
    df = spark.createDataFrame([("1", "2", "3"), ("5000000000", "2", "4"), ("x", "y", "5"), (None, "2", "1")], "User_ID string, Movie_ID string, Rating string")
    fitting = spark.createDataFrame([("1", "2", "3"), (None, "2", "1"), ("1", "2", "none")], df.schema)
    assert rows(R.rating_triples(fitting)) == [(1, 2, 3.0)]
    with pytest.raises(Exception, match="indexed_triples"):
        R.rating_triples(df).collect()
    triples, users, items = R.indexed_triples(df)
    assert triples.count() == 3 and users.count() == 3 and items.count() == 2
    assert rows(R.named(triples, users, items)) == [("1", "2", 3.0), ("5000000000", "2", 4.0), ("x", "y", 5.0)]
    wide = spark.range(5_000_000_000, 5_000_003_000).withColumnRenamed("id", "k")
    assert rows(R.number_ids(wide, "k", "n"), "n") == [(i,) for i in range(3000)]


def test_mined_itemsets_equal_those_of_fp_growth_and_are_counted_once(spark):
    rng = np.random.default_rng(6)
    data = [(int(u), f"i{i}", 5) for u in range(150) for i in range(9) if rng.random() < 0.75 - 0.07 * i] + [(None, "i0", 5), (None, "i1", 4)]
    basket = B.baskets(spark.createDataFrame(data, "User_ID int, Movie_ID string, Rating int")).cache()
    for support in (0.08, 0.3, 0.99):
        ours, theirs = B.mine_itemsets(basket, support, 0.5), B.fit_itemsets(basket, support, 0.5)
        assert rows(B.frequent_itemsets(ours)) == rows(B.frequent_itemsets(theirs))
        near = lambda model: rows(B.rules(model).select("antecedent", "consequent", *(F.round(c, 9) for c in ("confidence", "lift", "support"))))
        assert near(ours) == near(theirs)
        assert rows(B.apply_rules(ours, basket)) == rows(B.apply_rules(theirs, basket))
        assert ours.associationRules.inputFiles() or not ours.associationRules.count()
    assert B.mine_itemsets(basket.limit(0)).freqItemsets.count() == 0


def test_ranks_above_the_number_of_items_are_fitted_in_the_span_of_the_items(spark):
    rng = np.random.default_rng(8)
    u, v = rng.random((120, 2)) + 0.5, rng.random((5, 2)) + 0.5
    cells = [(a, b, float(u[a] @ v[b])) for a in range(120) for b in range(5)] + [(0, 0, 1.0)]
    train = spark.createDataFrame([c for i, c in enumerate(cells) if i % 7], "user int, item int, rating float")
    test = spark.createDataFrame([c for i, c in enumerate(cells) if i % 7 == 0] + [(999, 1, 3.0), (3, 77, 2.0)], "user int, item int, rating float")
    found = R.als_sweep(train, test, ranks=(2, 12), iterations=15).orderBy("rank").collect()
    plain = R.held_out_error(R.als(train, 12, 15), test).first()
    few = found[1]
    assert (few.n_scored, few.n_test, few.coverage) == (plain.n_scored, plain.n_test, plain.coverage) and found[0].n_test == few.n_test
    assert abs(few.mse - plain.mse) < 0.3 * plain.mse + 0.002
    own = R.few_items_error(R.ratings_by_user(train, train), range(5), 12).first().mse
    theirs = R.held_out_error(R.als(train, 12, 15), train).first().mse
    assert abs(own - theirs) < 0.2 * theirs + 1e-4 and own < 0.01
    assert R.als_sweep(train, test.limit(0), ranks=(12,), iterations=2).first().mse is None
    with pytest.raises(Exception, match="Null or NaN"):
        R.als_sweep(train.unionByName(train.limit(1).withColumn("rating", F.lit(None).cast("float"))), test, ranks=(12,), iterations=1)

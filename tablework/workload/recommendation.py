"""Queries over ratings: baskets, rules and factorisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablework.recommend import als as R
from tablework.recommend import baskets as B
from tablework.recommend.topn import top_items
from tablework.session import staged
from tablework.workload.fixtures import Fixtures
from tablework.workload.joins import rounded
from tablework.workload.registry import query

SUPPORT, CONFIDENCE = 0.15, 0.5
LARGEST = 6  # size of sets up to which the twin looks; the given tables have sets of up to four

LIKED = "l AS (SELECT DISTINCT User_ID, Movie_ID FROM ratings WHERE Rating >= 4), n AS (SELECT count(DISTINCT User_ID) AS users FROM l)"
# u: who has a set whose part without the last item is frequent; s: the frequent sets
LEVELS = ", ".join(
    [f"u1 AS (SELECT User_ID, [Movie_ID] AS s FROM l), s1 AS (SELECT s, count(*) AS freq FROM u1 GROUP BY s HAVING count(*) >= ceil({SUPPORT}::DOUBLE * (SELECT users FROM n)))"]
    + [
        f"""u{k} AS (SELECT u.User_ID, list_append(s, Movie_ID) AS s FROM u{k - 1} u SEMI JOIN s{k - 1} USING (s) JOIN l ON l.User_ID = u.User_ID AND Movie_ID > s[-1]),
        s{k} AS (SELECT s, count(*) AS freq FROM u{k} GROUP BY s HAVING count(*) >= ceil({SUPPORT}::DOUBLE * (SELECT users FROM n)))"""
        for k in range(2, LARGEST + 1)
    ]
)
SETS = f"""{LIKED}, {LEVELS},
  sets AS ({" UNION ALL ".join(f"SELECT * FROM s{k}" for k in range(1, LARGEST + 1))}),
  cand AS (SELECT list_filter(s, lambda x: x <> c) AS ante, c AS consequent, freq FROM (SELECT s, freq, unnest(s) AS c FROM sets WHERE len(s) > 1)),
  rules AS (SELECT p.ante, p.consequent, p.freq / x.freq AS confidence,
    (p.freq / x.freq) / (y.freq / (SELECT users FROM n)) AS lift, p.freq / (SELECT users FROM n) AS support
    FROM cand p JOIN sets x ON p.ante = x.s JOIN s1 y ON y.s = [p.consequent] WHERE p.freq / x.freq >= {CONFIDENCE})"""


@query(
    "a20_baskets",
    f"WITH {LIKED} SELECT User_ID, count(*) AS n_items, array_to_string(list_sort(list(Movie_ID)), ',') AS items FROM l GROUP BY 1",
    ("ratings",),
)
def a20(fx: Fixtures) -> DataFrame:
    b = B.baskets(fx.ratings())
    return b.select("User_ID", F.size("items").cast("long").alias("n_items"), F.array_join("items", ",").alias("items"))


def stored_baskets(fx: Fixtures) -> DataFrame:
    """Fitting and applying both read the baskets, so they are stored once."""
    return staged(B.baskets(fx.ratings()), "baskets", spread=True)


def model(fx: Fixtures):
    return B.mine_itemsets(stored_baskets(fx), SUPPORT, CONFIDENCE)


@query(
    "r05_itemsets",
    f"""WITH {SETS} SELECT array_to_string(s, ',') AS itemset, CAST(len(s) AS INT) AS size, freq FROM sets""",
    ("ratings",),
)
def r05(fx: Fixtures) -> DataFrame:
    return B.frequent_itemsets(model(fx))


@query(
    "r06_rules",
    f"""WITH {SETS} SELECT array_to_string(ante, ',') AS antecedent, consequent, round(confidence, 9) AS confidence, round(lift, 9) AS lift, round(support, 9) AS support FROM rules""",
    ("ratings",),
)
def r06(fx: Fixtures) -> DataFrame:
    return rounded(B.rules(model(fx)), 9)


@query(
    "r07_apply_rules",
    f"""WITH {SETS}, b AS (SELECT User_ID, list(Movie_ID) AS items FROM l GROUP BY 1),
      hits AS (SELECT DISTINCT User_ID, consequent FROM b JOIN rules ON list_has_all(items, ante) AND NOT list_contains(items, consequent))
      SELECT b.User_ID, coalesce(array_to_string(list_sort(list(consequent) FILTER (consequent IS NOT NULL)), ','), '') AS prediction
      FROM b LEFT JOIN hits USING (User_ID) GROUP BY 1""",
    ("ratings",),
)
def r07(fx: Fixtures) -> DataFrame:
    basket = stored_baskets(fx)
    out = B.apply_rules(B.mine_itemsets(basket, SUPPORT, CONFIDENCE), basket)
    return out.select("User_ID", F.array_join("prediction", ",").alias("prediction"))


@query("r08_likes", "SELECT * FROM ratings WHERE Rating >= 4", ("ratings",))
def r08(fx: Fixtures) -> DataFrame:
    return B.likes(fx.ratings())


@query(
    "r03_threshold",
    """WITH p AS (SELECT Movie_ID, avg(Rating) AS prediction FROM ratings GROUP BY 1)
      SELECT DISTINCT User_ID, Movie_ID, round(prediction, 6) AS prediction FROM ratings JOIN p USING (Movie_ID) WHERE prediction > 3""",
    ("ratings",),
)
def r03(fx: Fixtures) -> DataFrame:
    predicted = fx.ratings().groupBy("Movie_ID").agg(F.avg("Rating").alias("prediction"))
    pairs = fx.ratings().select("User_ID", "Movie_ID").distinct()
    return rounded(R.above(pairs.join(predicted, "Movie_ID")), 6)


SPLIT = """t AS (SELECT User_ID, Movie_ID, avg(Rating) AS rating, CAST('0x' || substr(md5(concat(CAST(User_ID AS VARCHAR), '|', Movie_ID)), 1, 8) AS BIGINT)
    / 4294967296.0::DOUBLE < 0.8::DOUBLE AS in_train FROM ratings GROUP BY 1, 2),
  train AS (SELECT * FROM t WHERE in_train), test AS (SELECT * FROM t WHERE NOT in_train),
  known AS (SELECT * FROM test WHERE User_ID IN (SELECT User_ID FROM train) AND Movie_ID IN (SELECT Movie_ID FROM train))"""


def split_triples(fx: Fixtures, label: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Train and test triples, stored once since each fit reads them, and the tables of ids. The split is by pair hash."""
    pairs = fx.ratings().groupBy("User_ID", "Movie_ID").agg(F.avg("Rating").alias("Rating"))
    held = pairs.withColumn("part", F.when(pair_fraction() < 0.8, "train").otherwise("test"))
    held = staged(held, label)
    users, items = R.number_ids(held, "User_ID", "user"), R.number_ids(held, "Movie_ID", "item")
    rows = held.join(users, "User_ID").join(items, "Movie_ID").select("user", "item", F.col("Rating").cast("float").alias("rating"), "part")
    stored = staged(rows, label, spread=True)
    return stored.where("part = 'train'").drop("part"), stored.where("part = 'test'").drop("part"), users, items


def pair_fraction() -> F.Column:
    """The same fraction of one that the SQL twin takes from a digest of the pair."""
    digest = F.md5(F.concat(F.col("User_ID").cast("string"), F.lit("|"), F.col("Movie_ID")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


@query(
    "r01_als",
    f"WITH {SPLIT} SELECT User_ID, Movie_ID, round(rating, 4) AS actual, TRUE AS scored, TRUE AS fits_train FROM known",
    ("ratings",),
)
def r01(fx: Fixtures) -> DataFrame:
    """All test pairs whose user and item were trained on get a score, and the fit beats the mean on what it was fitted to."""
    train, test, users, items = split_triples(fx, "r01")
    model = R.als(train, rank=10, iterations=15)
    error = R.held_out_error(model, train).first().mse
    spread = train.agg(F.var_pop("rating")).first()[0]
    found = R.named(model.transform(test), users, items)
    return found.select(
        "User_ID", "Movie_ID", F.round(F.col("rating").cast("double"), 4).alias("actual"), F.col("prediction").isNotNull().alias("scored"), F.lit(error < spread).alias("fits_train")
    )


RANKS = (10, 20, 50, 100, 200)


@query(
    "r02_als_sweep",
    f"""WITH {SPLIT} SELECT rank, (SELECT count(*) FROM known) AS n_scored, (SELECT count(*) FROM test) AS n_test, TRUE AS has_error
      FROM (SELECT unnest([{", ".join(map(str, RANKS))}]) AS rank)""",
    ("ratings",),
)
def r02(fx: Fixtures) -> DataFrame:
    train, test, _, _ = split_triples(fx, "r02")
    found = R.als_sweep(train, test, ranks=RANKS, iterations=15)
    return found.select("rank", "n_scored", "n_test", (F.col("mse") >= 0).alias("has_error"))


@query(
    "r04_recommend",
    f"""WITH {SPLIT} SELECT User_ID, CAST(place AS INT) AS place, TRUE AS falling
      FROM (SELECT DISTINCT User_ID FROM train), (SELECT unnest(range(1, 1 + least(5, (SELECT count(DISTINCT Movie_ID) FROM train)))) AS place)""",
    ("ratings",),
)
def r04(fx: Fixtures) -> DataFrame:
    """Five different items per user, best first."""
    train, _, users, items = split_triples(fx, "r04")
    best, _ = top_items(R.als(train, rank=10, iterations=15), 5)
    by_place = Window.partitionBy("user").orderBy("place")
    falling = F.coalesce(F.lag("prediction").over(by_place) >= F.col("prediction"), F.lit(True))
    return R.named(best.withColumn("falling", falling), users, items).select("User_ID", F.col("place").cast("int").alias("place"), "falling")

"""Frequent itemsets and association rules over liked items."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.session import staged


def likes(ratings: DataFrame, minimum: int = 4, score: str = "Rating") -> DataFrame:
    return ratings.where(F.col(score) >= minimum)


def baskets(
    ratings: DataFrame, user: str = "User_ID", item: str = "Movie_ID", min_rating: int | None = 4, score: str = "Rating"
) -> DataFrame:
    """One row per user with the sorted distinct items.

    Repeats are removed by (user, item) before the items meet, so a basket is never longer than
    the catalogue, however many ratings one user has.
    """
    kept = likes(ratings, min_rating, score) if min_rating is not None else ratings
    pairs = kept.select(user, item).where(F.col(item).isNotNull()).distinct()
    return pairs.groupBy(user).agg(F.sort_array(F.collect_list(item)).alias("items"))


def fit_itemsets(
    basket: DataFrame, min_support: float = 0.15, min_confidence: float = 0.5, partitions: int | None = None
) -> FPGrowthModel:
    fp = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence)
    if partitions:
        fp = fp.setNumPartitions(partitions)
    return fp.fit(basket)


def frequent_itemsets(model: FPGrowthModel | Itemsets) -> DataFrame:
    """Itemsets as sorted text with size and frequency."""
    items = F.sort_array("items")
    return model.freqItemsets.select(
        F.array_join(items, ",").alias("itemset"), F.size("items").alias("size"), F.col("freq")
    )


def rules(model: FPGrowthModel | Itemsets) -> DataFrame:
    return model.associationRules.select(
        F.array_join(F.sort_array("antecedent"), ",").alias("antecedent"),
        F.array_join("consequent", ",").alias("consequent"),
        "confidence",
        "lift",
        "support",
    )


def apply_rules(model: FPGrowthModel | Itemsets, basket: DataFrame, user: str = "User_ID") -> DataFrame:
    """Per basket the consequents of all rules it satisfies that it does not hold yet.

    Each rule waits at the rarest item of its antecedent, so popular items do not fan out; the basket
    that holds that item is then tested against the whole antecedent.
    """
    count = basket.select(F.explode("items").alias("_key")).groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    found = model.associationRules.select("antecedent", F.col("consequent")[0].alias("_c"))
    rarest = F.min(F.struct("_n", "_key"))["_key"].alias("_key")
    rule = found.withColumn("_key", F.explode("antecedent")).join(count, "_key").groupBy("antecedent", "_c").agg(rarest)
    held = basket.select(user, "items", F.explode("items").alias("_key"))
    hits = (
        held.join(rule, "_key")
        .where((F.size(F.array_except("antecedent", "items")) == 0) & ~F.array_contains("items", F.col("_c")))
        .select(user, "_c")
        .distinct()
        .groupBy(user)
        .agg(F.sort_array(F.collect_list("_c")).alias("prediction"))
    )
    none = F.array().cast(basket.schema["items"].dataType)
    return basket.join(hits, user, "left").select(user, "items", F.coalesce("prediction", none).alias("prediction"))


class Itemsets(NamedTuple):
    """What a fitted FPGrowthModel offers to the functions of this module."""

    freqItemsets: DataFrame  # items, freq
    associationRules: DataFrame  # antecedent, consequent, confidence, lift, support


def mine_itemsets(basket: DataFrame, min_support: float = 0.15, min_confidence: float = 0.5) -> Itemsets:
    """Frequent itemsets and rules as FPGrowth finds them, level by level and each level counted once.

    Baskets lose their rare items, then equal ones are counted together. A frequent set is extended by the later items of
    each basket that holds it; the extensions combine before they are shuffled, so a shuffle has as many rows as
    there are candidates, not baskets. The sets are stored, so rules do not count them again. Items must be distinct
    inside a basket, as those of :func:`baskets` are.
    """
    total = basket.count()
    least = math.ceil(min_support * total)
    common = staged(basket.select(F.explode("items").alias("_i")).groupBy("_i").agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= least), "common")
    names = common.agg(F.collect_list("_i").alias("i")).select("i").scalar()  # no more than the mean basket's size over the support
    kept = basket.select(F.sort_array(F.array_intersect("items", names)).alias("held"))
    held = staged(kept.groupBy("held").agg(F.count(F.lit(1)).alias("_w")), "held", spread=True)
    level = common.select(F.array("_i").alias("items"), "freq")
    sets, size = level, 1
    found = held.select("held", "_w", F.explode("held").alias("_i")).select("held", "_w", F.array("_i").alias("items"))
    while True:
        later = F.filter("held", lambda x: x > F.element_at("items", -1))
        found = found.select("held", "_w", "items", F.explode(later).alias("_i")).select("held", "_w", F.concat("items", F.array("_i")).alias("items"))
        level = staged(found.groupBy("items").agg(F.sum("_w").alias("freq")).where(F.col("freq") >= least), f"sets-{size + 1}")
        if not level.limit(1).count():
            break
        sets, size = sets.unionByName(level), size + 1
        found = found.join(level.select("items"), "items", "left_semi")
    sets = staged(sets, "itemsets")
    single = sets.where(F.size("items") == 1).select(F.col("items").alias("consequent"), F.col("freq").alias("_c"))
    parts = sets.where(F.size("items") > 1).select("items", "freq", F.explode("items").alias("_i"))
    parts = parts.select("freq", F.array("_i").alias("consequent"), F.array_remove("items", F.col("_i")).alias("antecedent"))
    known = sets.select(F.col("items").alias("antecedent"), F.col("freq").alias("_a"))
    confidence = F.col("freq") / F.col("_a")
    rule = parts.join(known, "antecedent").where(confidence >= min_confidence).join(single, "consequent")
    rule = rule.select("antecedent", "consequent", confidence.alias("confidence"), (confidence / (F.col("_c") / total)).alias("lift"), (F.col("freq") / total).alias("support"))
    return Itemsets(sets, staged(rule, "rules"))

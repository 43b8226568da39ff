"""Benchmark decontamination: find items of a benchmark inside documents.

1. Item-sized windows: a window that is similar to an item shares one of its shingles, so windows are
   laid where a shared shingle puts the item's beginning. A document without shared shingles has none.
2. Fingerprints: a 64-bit SimHash of each window and item, shingles weighted by how often they occur.
3. Multi-index blocks: the bits are cut into ``radius + 1`` blocks; fingerprints within the radius agree
   on at least one of them, so an equality join on blocks loses no pair within the radius.
4. Exact check: weighted Jaccard similarity of the two bags of shingles, at least ``threshold``.

Everything is SQL functions and joins. Only positions of shared shingles and windows are shuffled, and
texts once, to cut windows from the documents that have any.

Results in odd cases: null, empty and word-less texts or items match nothing; items shorter than a
shingle are one shingle of all their words; a window that reaches over an end of the document is cut
there; equal items are all reported; equal rows (id and text) give one result; a null id is kept as
null; an empty table gives an empty result. Very long texts are searched whole. ``remove`` returns the
input's columns, whatever their names; the rest carries no extra columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.llm.common import free_name, let, stored, words_of

SHINGLE, THRESHOLD = 5, 0.8
RADIUS = 24  # differing bits out of 64; a similarity of 0.8 leaves about nine


def shingles(words: Column, size: int) -> Column:
    """Hashes of every window of ``size`` words."""
    last = F.greatest(F.size(words) - (size - 1), F.lit(0))
    return F.transform(F.slice(words, F.lit(1), last), lambda x, i: F.xxhash64(x, *(F.get(words, i + k) for k in range(1, size))))


def text_words(text: Column) -> Column:
    return words_of(F.lower(F.coalesce(text, F.lit(""))))


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def simhash(hashes: Column) -> Column:
    """Bits set in over half of the hashes, each as often as it occurs."""
    ones = lambda b: F.aggregate(hashes, F.lit(0), lambda n, h: n + F.call_function("shiftrightunsigned", h, b).bitwiseAND(F.lit(1)).cast("int"))
    bit = lambda b: F.when(2 * ones(b) > F.size(hashes), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda out, b: out.bitwiseOR(bit(b)))


def block_keys(fp: Column, radius: int) -> Column:
    """(number, bits) of each of ``radius + 1`` blocks of nearly equal width."""
    blocks = radius + 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    cut = lambda a, b: F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long"))
    return F.array(*(F.struct(F.lit(i).alias("block"), cut(a, b).alias("bits")) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))))


def prepared_items(bench: DataFrame, size: int = SHINGLE, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, item_key (equal for equal words), n_words, size of its shingles, hashes."""
    rows = bench.select(F.col(id_col).alias("item_id"), F.inline(F.array(F.struct(text_words(F.col(text_col)).alias("words")))))
    rows = rows.where(F.size("words") > 0).withColumn("n_words", F.size("words")).withColumn("size", F.least(F.size("words"), F.lit(size)))
    hashes = F.lit(None).cast("array<bigint>")
    for k in range(1, size + 1):
        hashes = F.when(F.col("size") == k, shingles(F.col("words"), k)).otherwise(hashes)
    return rows.select("item_id", F.xxhash64("words").alias("item_key"), "n_words", "size", hashes.alias("hashes"))


def window_starts(threshold: float) -> Column:
    """Starts of all windows that may reach the threshold: from places (sorted), n_words, size and room (shingles in the document).

    An item has m = n_words - size + 1 shingles. A window with w of its own needs t (w + m) / (1 + t) shared ones; whole windows have
    w = m, those that an end of the document cuts need t m at least. Of the windows whose first shared
    shingle is the i-th, those have so many that also hold the one that many places on.
    """
    def starts(m: Column, least: Column, low: Column, high: Column) -> Column:
        def of(p: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get("places", i - 1))
            first = F.greatest(before + 1, F.get("places", i + least - 1) - m + 1, low)
            last = F.least(p, high)
            enough = F.get("places", i + least - 1).isNotNull() & (first <= last)
            return F.when(enough, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

        return F.flatten(F.transform("places", of))

    m, room = F.col("n_words") - F.col("size") + 1, F.col("room")
    at_least = lambda share: F.greatest(F.ceil(share * m - 1e-9).cast("int"), F.lit(1))
    whole, cut = at_least(2 * threshold / (1 + threshold)), at_least(threshold)
    return F.concat(starts(m, whole, F.lit(0), room - m), starts(m, cut, 1 - m, F.least(F.lit(-1), room - 1)), starts(m, cut, F.greatest(room - m + 1, F.lit(0)), room - 1))


def contaminated(
    docs: DataFrame, bench: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, text_key, item_id, start_word (from 0), n_words, similarity, distance: the best window per document and item."""
    items = stored(prepared_items(bench, size), "items")
    distinct = items.dropDuplicates(["item_key"]).select("item_key", "n_words", "size", "hashes")
    places = stored(distinct.select("item_key", "n_words", "size", F.posexplode("hashes").alias("at", "h")), "item-shingles")
    wanted = stored(places.select("size", "h").distinct(), "item-hashes")
    sizes = sorted(r[0] for r in wanted.select("size").distinct().collect())  # at most ``size`` values

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    words = F.inline(F.array(F.struct(text_words(F.col("text")).alias("words"))))
    split = texts.select("doc_id", text_key(F.col("text")).alias("text_key"), words)
    found = None
    for k in sizes or [size]:
        placed = split.select("doc_id", "text_key", (F.size("words") - (k - 1)).alias("room"), F.posexplode(shingles(F.col("words"), k)).alias("pos", "h"))
        hit = placed.join(wanted.where(F.col("size") == k).select("h"), "h", "left_semi").withColumn("size", F.lit(k))
        found = hit if found is None else found.unionByName(hit)
    hits = stored(found, "shared-shingles")

    # Every window of an item's length with so many shared shingles as the threshold asks for at least, whatever their order.
    shared = hits.join(places.select("size", "h", "item_key", "n_words").distinct(), ["size", "h"])
    places_of = shared.groupBy("doc_id", "text_key", "item_key", "n_words", "size", "room").agg(F.array_sort(F.collect_set("pos")).alias("places"))
    laid = places_of.select("doc_id", "text_key", "n_words", "size", F.explode(window_starts(threshold)).alias("start")).distinct()
    per_doc = laid.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("n_words", "size", "start")).alias("windows"))
    per_doc = stored(per_doc.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "windows"), "windows-of-documents")
    keyed = texts.withColumn("text_key", text_key(F.col("text")))
    chosen = keyed.join(per_doc, keyed["doc_id"].eqNullSafe(per_doc["id"]) & (keyed["text_key"] == per_doc["key"]))

    def cut(w: Column) -> Column:
        """Bags of shingles of all windows of one document; its text is split once for each shingle size in use."""

        def bag(all_hashes: dict[int, Column]) -> Column:
            def build(x: Column) -> Column:
                first = F.greatest(x["start"], F.lit(0))
                out = F.lit(None).cast("array<bigint>")
                for k, hashes in all_hashes.items():
                    count = F.greatest(x["start"] + x["n_words"] - (k - 1) - first, F.lit(0))
                    out = F.when(x["size"] == k, F.slice(hashes, first + 1, count)).otherwise(out)
                return F.struct(x["n_words"].alias("n_words"), x["start"].alias("start"), F.least(x["start"] + x["n_words"], F.size(w)).alias("end"), out.alias("hashes"))

            return F.transform(F.col("windows"), build)

        together = F.struct(*(shingles(w, k).alias(f"s{k}") for k in sizes or [size]))
        return let(together, lambda s: bag({k: s[f"s{k}"] for k in sizes or [size]}))

    bags = chosen.select("doc_id", "text_key", F.inline(let(text_words(F.col("text")), cut)))
    bags = bags.select("doc_id", "text_key", "n_words", F.greatest("start", F.lit(0)).alias("start"), "end", "hashes").dropDuplicates(["doc_id", "text_key", "n_words", "start", "end"])
    prints = bags.where(F.size("hashes") > 0).select("*", F.inline(F.array(F.struct(simhash(F.col("hashes")).alias("fp")))))
    prints = stored(prints, "window-fingerprints")
    item_prints = distinct.select("item_key", "n_words", F.size("hashes").alias("item_size"), F.inline(F.array(F.struct(simhash(F.col("hashes")).alias("item_fp")))))
    item_prints = stored(item_prints, "item-fingerprints")

    # Pairs that agree on a block and lie within the radius. The first block on which they agree names the pair once.
    left = prints.select("doc_id", "text_key", "n_words", "start", "end", "fp", F.inline(block_keys(F.col("fp"), radius)))
    right = item_prints.select("item_key", "n_words", "item_fp", F.inline(block_keys(F.col("item_fp"), radius)))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    first_block = first_common_block(F.col("fp").bitwiseXOR(F.col("item_fp")), radius)
    pairs = left.join(right, ["n_words", "block", "bits"]).where((near <= radius) & (F.col("block") == first_block))
    place = ["doc_id", "text_key", "n_words", "start", "end"]
    window = [*place, "item_key"]
    pairs = stored(pairs.select(*window, near.alias("distance")), "near-windows")

    # Exact weighted Jaccard: sums of the smaller and of the larger count of each shingle.
    same = [prints[c].eqNullSafe(pairs[c]) for c in place]
    bag = prints.join(pairs, (same[0] & same[1] & same[2] & same[3] & same[4])).select(*(pairs[c] for c in window), "distance", "hashes")
    in_window = bag.select(*window, "distance", F.size("hashes").alias("window_size"), F.explode("hashes").alias("h"))
    counts = in_window.groupBy(*window, "distance", "window_size", "h").agg(F.count(F.lit(1)).alias("n"))
    item_counts = places.groupBy("item_key", "h").agg(F.count(F.lit(1)).alias("m"))
    shared = counts.join(stored(item_counts, "item-counts"), ["item_key", "h"]).groupBy(*window, "distance", "window_size").agg(F.sum(F.least("n", "m")).alias("shared"))
    scored = shared.join(item_prints.select("item_key", "item_size"), "item_key")
    scored = scored.withColumn("similarity", F.col("shared") / (F.col("window_size") + F.col("item_size") - F.col("shared"))).where(F.col("similarity") >= threshold)
    best = F.min(F.struct((-F.col("similarity")).alias("minus"), "start", "end", "distance")).alias("best")
    per_item = scored.groupBy("doc_id", "text_key", "item_key").agg(best)
    named = per_item.join(items.select("item_id", "item_key").distinct(), "item_key")
    return named.select(
        "doc_id", "text_key", "item_id", F.col("best.start").alias("start_word"), (F.col("best.end") - F.col("best.start")).alias("n_words"),
        (-F.col("best.minus")).alias("similarity"), F.col("best.distance").alias("distance"),
    )


def first_common_block(differing: Column, radius: int) -> Column:
    """Number of the first block in which no bit differs; null if all do."""
    blocks = radius + 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    out = F.lit(None).cast("int")
    for i in reversed(range(blocks)):
        a, b = edges[i], edges[i + 1]
        clear = F.shiftrightunsigned(differing, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long")) == 0
        out = F.when(clear, F.lit(i)).otherwise(out)
    return out


def remove(docs: DataFrame, bench: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that hold no item."""
    bad = contaminated(docs, bench, size, threshold, radius, id_col, text_col).select(F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key")).distinct()
    name = free_name(docs, "text_key")
    keyed, bad = docs.withColumn(name, text_key(F.col(text_col))), stored(bad, "contaminated")
    return keyed.join(bad, keyed[id_col].eqNullSafe(bad["bad_id"]) & (keyed[name] == bad["bad_key"]), "left_anti").select(*docs.columns)

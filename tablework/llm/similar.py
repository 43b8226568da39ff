"""Texts with similar sets of shingles: all links of a similarity, by SimHash, minima and an exact join of prefixes.

Texts with equal sets are one node. Links come from three searches, and each candidate is decided by the two
sets themselves.

1. SimHash: fingerprints of the sets within three bits, from the grid of ``simhash``.
2. Rounds of stars: a node has ``BANDS`` keys, each of the minima of a few permutations. Of the nodes that
   share a key the one with the lowest draw is head; every node that is not linked to it yet is paired with the one head that it shares
   most keys with. A bucket of any size gives as many pairs as it has members. New rounds draw anew, for what
   is still apart, until one links nothing or ``ROUNDS`` are over.
3. An exact join adds every link between what is still apart. Two sets that similar share a member of their
   prefixes in any order that both keep (common shingles come last). Members that only one group has are left out, so
   a group that is known to be one makes no pairs however large it is. Sizes, places and parities of the sets
   bound the similarity inside the join.

Before texts are fetched, sizes and parities in as many bins as the sets need bound the similarity of each pair.

Texts of candidates are read once for each search, by a broadcast of the wanted keys while these are at most
``BROADCAST_ROWS`` rows and by a shuffled join beyond. Two texts meet in one row only inside a join.

Results in odd cases: texts without words are one node that is similar to no other; null and empty texts are
equal; repeated rows are one; a null id counts as largest; an empty table gives an empty result; very long
texts count in full. Extra input columns are carried by ``keep_one``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.llm.common import discard, free_name, groups_of, map_batches, splitmix, stored
from tablework.llm.graphs import components
from tablework.llm.simhash import GROUP_BYTES, SEED, fingerprints, group_heads, groups, links, shingle_hashes
from tablework.llm.suffix import shared_rows

BANDS, ROWS = 24, 4  # a pair of similarity 0.8 shares one of 24 keys of four minima with a probability of 0.999997
ROUNDS = 6
SKETCH_WORDS = 8  # 64-bit words of parities
SAMPLE_DOCS, COMMON_DOCS, COMMON = 2_000, 3, 1 << 16  # shingles that so many of the sampled documents have come last in the order
BROADCAST_ROWS = 1 << 20  # keys of 16 octets
PARTNERS = 1000  # of one head in a row


def bounded(keys: DataFrame) -> DataFrame:
    """A stored table of keys as the side of a join: broadcast if it is measured to be small."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def band_keys(hashes: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Keys of each text: in every band a hash of the smallest values that ``rows`` permutations give its shingles."""
    out = np.zeros((len(hashes), bands), np.uint64)
    sizes = np.array([len(h) for h in hashes], np.int64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    flat = np.concatenate([hashes[i] for i in full])
    starts = np.cumsum(sizes[full]) - sizes[full]
    factors = splitmix(np.arange(1, bands * rows + 1, dtype=np.uint64)) | np.uint64(1)
    for band in range(bands):
        key = np.full(len(full), band + 1, np.uint64)
        for factor in factors[band * rows : (band + 1) * rows]:
            key = splitmix(key ^ np.minimum.reduceat(flat * factor, starts))
        out[full, band] = key
    return out


def in_order(hashes: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Distinct hashes in the order that all texts share: by value, but those known to be common last, by how common."""
    own = np.unique(hashes.view(np.int64))
    known, counts = common
    if not len(known):
        return own
    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
    return own[np.lexsort((own, np.where(known[at] == own, counts[at], 0)))]


def prefix_size(n: int, similarity: float) -> int:
    """Two sets that similar share one of their first so many members in any order that both keep."""
    return n - math.ceil(similarity * n - 1e-9) + 1 if n else 0


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """For each set whether each of 512 bins holds an odd number of its members: two sets differ in as many members at least as in bins."""
    bins = 64 * SKETCH_WORDS
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    at = row * bins + (np.concatenate([np.empty(0, np.int64), *sets]) & (bins - 1))
    odd = np.bincount(at, minlength=len(sets) * bins).reshape(-1, bins) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)


def fine_parities(members: np.ndarray) -> np.ndarray:
    """Such parities in a number of bins that grows with the set: at least twice as many as members, a power of two of 64-bit words."""
    words = max(SKETCH_WORDS, 1 << max(0, (len(members) - 1) // 32).bit_length())
    odd = np.bincount(members & (64 * words - 1), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def common_shingles(docs: DataFrame, size: int, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of shingles that many documents of a sample have, and in how many.

    They only move to the end of the order, so that few sets have them in their prefix; any order finds all pairs.
    """
    every = max(1, docs.count() // SAMPLE_DOCS)
    sample = docs.select(F.col(text_col).cast("string").alias("text")).where("text is not null").where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0)

    def run(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in groups_of([len(t) for t in texts], GROUP_BYTES):
                found = np.concatenate([np.unique(shingle_hashes(t, size)) for t in texts[a:b]])
                h, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    counts = map_batches(sample.dropDuplicates(["text"]), run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    found = sorted((r.h, r.n) for r in counts.where(F.col("n") >= COMMON_DOCS).orderBy(F.desc("n")).limit(COMMON).collect())
    return np.array([h for h, _ in found], np.int64), np.array([n for _, n in found], np.int64)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, th (a hash of the text), text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))


def signatures(texts: DataFrame, size: int, similarity: float, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, th and what the searches need of a text's set of shingles.

    ``node`` is a hash of the set, ``fp`` its SimHash, ``keys`` its band keys, ``prefix`` its first members in
    the shared order, ``odd`` and ``fine`` its parities, ``n`` its size.
    """

    def run(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for a, b in groups_of([len(t) for t in texts], GROUP_BYTES):
                sets = [in_order(shingle_hashes(t, size), common) for t in texts[a:b]]
                hashes = [x.view(np.uint64) for x in sets]
                nodes = np.array([xxhash.xxh64_intdigest(x.tobytes(), SEED) if len(x) else 0 for x in sets], np.uint64)
                longs = pa.list_(pa.int64())
                made = [
                    batch.column(0).slice(a, b - a),
                    batch.column(1).slice(a, b - a),
                    pa.array(nodes.view(np.int64)),
                    pa.array(fingerprints(hashes).view(np.int64)),
                    pa.array(list(band_keys(hashes, BANDS, ROWS).view(np.int64)), longs),
                    pa.array([x[: prefix_size(len(x), similarity)] for x in sets], longs),
                    pa.array(list(parities(sets)), longs),
                    pa.array([fine_parities(x) for x in sets], longs),
                    pa.array([len(x) for x in sets], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(made, ["doc_id", "th", "node", "fp", "keys", "prefix", "odd", "fine", "n"])

    return map_batches(texts, run, "doc_id long, th long, node long, fp long, keys array<bigint>, prefix array<bigint>, odd array<bigint>, fine array<bigint>, n long")


def within(similarity: float):
    """Whether two sets x, y (n, odd) may be that similar: they differ in no fewer members than bins of their parities."""
    differing = sum((F.bit_count(F.col("x.odd")[i].bitwiseXOR(F.col("y.odd")[i])) for i in range(1, SKETCH_WORDS)), F.bit_count(F.col("x.odd")[0].bitwiseXOR(F.col("y.odd")[0])))
    return differing <= (1 - similarity) / (1 + similarity) * (F.col("x.n") + F.col("y.n")) + 1e-6


FOLDED = "IF(size({a}) = 2 * size({b}), zip_with(slice({a}, 1, size({b})), slice({a}, size({b}) + 1, size({b})), (p, q) -> p ^ q), {a})"


def within_fine(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Of pairs a, b those that may be that similar by their sizes and fine parities. The longer parities are folded to the shorter."""
    sizes = nodes.select("node", "n", "fine")
    both = pairs.join(sizes.alias("x"), F.col("a") == F.col("x.node")).join(sizes.alias("y"), F.col("b") == F.col("y.node"))
    both = both.where(F.least("x.n", "y.n") >= similarity * F.greatest("x.n", "y.n") - 1e-6)
    x, y = FOLDED.format(a="x.fine", b="y.fine"), FOLDED.format(a="y.fine", b="x.fine")
    differing = F.expr(f"aggregate(zip_with({x}, {y}, (p, q) -> bit_count(p ^ q)), 0, (s, d) -> s + coalesce(d, 0))")
    return both.where(differing <= (1 - similarity) / (1 + similarity) * (F.col("x.n") + F.col("y.n")) + 1e-6).select("a", "b")


def checked(pairs: DataFrame, texts: DataFrame, nodes: DataFrame, size: int, similarity: float) -> DataFrame:
    """The pairs a, b (a stored table) whose sets are that similar; stored. A node may have many partners as ``b``."""
    pairs = stored(within_fine(pairs, nodes, similarity), "possible-links")
    needed = stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "candidate-nodes")
    places = stored(nodes.select("node", "rep.*").join(bounded(needed), "node", "left_semi"), "candidate-places")
    one = (F.col("t.th") == F.col("p.th")) & F.col("t.doc_id").eqNullSafe(F.col("p.doc_id"))
    own = texts.alias("t").join(bounded(places).alias("p"), one).select("node", "text").groupBy("node").agg(F.first("text").alias("text"))
    own = stored(own, "candidate-texts")
    salts = F.floor(F.col("n") / PARTNERS).cast("long") + 1
    salted = pairs.join(pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n")), "b").select("a", "b", F.pmod(F.xxhash64("a"), salts).alias("salt"))
    salted = stored(salted, "candidate-pairs")
    # a head goes before its partners, which are dealt to several groups if they are many
    heads = salted.select("b", "salt").distinct().join(own, F.col("b") == F.col("node")).select("b", "salt", F.lit(None).cast("long").alias("a"), "text")
    partners = salted.join(own, F.col("a") == F.col("node")).select("b", "salt", "a", "text")
    ordered = heads.unionByName(partners).repartition("b", "salt").sortWithinPartitions("b", "salt", F.asc_nulls_first("a"))

    def run(batches):
        head = None
        for batch in batches:
            b, a, good = batch.column(0).to_pylist(), batch.column(2).to_pylist(), []
            for i, text in enumerate(batch.column(3)):
                own = np.unique(shingle_hashes(text.as_py(), size))
                if a[i] is None:
                    head = own
                    continue
                shared = len(np.intersect1d(own, head, assume_unique=True))
                if 0 < shared >= similarity * (len(own) + len(head) - shared):
                    good.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in good], pa.int64()), pa.array([b[i] for i in good], pa.int64())], ["a", "b"])

    found = stored(map_batches(ordered, run, "a long, b long"), "similar-links")
    discard(pairs, needed, places, own, salted)
    return found


def fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs a, b of nodes with equal or linked fingerprints: every node with the first of its fingerprint, and these along the links."""
    firsts = stored(nodes.groupBy("fp").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")), "fingerprint-heads")
    near = links(firsts.select("fp"))
    head = lambda c: firsts.select(F.col("fp").alias(c), F.col("head").alias(f"{c}_head"))
    along = near.join(head("a"), "a").join(head("b"), "b").select(F.col("a_head").alias("a"), F.col("b_head").alias("b"))
    same = nodes.join(firsts.where("n > 1"), "fp").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    return along.unionByName(same)


def star_pairs(members: DataFrame, labels: DataFrame, nodes: DataFrame, turn: int, similarity: float) -> DataFrame:
    """Pairs a, b: each node with the head that it shares most keys with, of those that it is not linked to. ``members``: key, node."""
    rooted = stored(members.join(labels, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root")), "band-members")
    draw = F.struct(F.xxhash64("node", F.lit(turn)).alias("draw"), "node", "root")
    heads = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min(draw).alias("head")).where("low <> high").select("key", "head.node", "head.root")
    heads = stored(heads.toDF("key", "b", "b_root"), "band-heads")
    shared = rooted.join(heads, "key").where("root <> b_root").groupBy(F.col("node").alias("a"), "b").agg(F.count(F.lit(1)).alias("keys"))
    sizes = nodes.select("node", "n", "odd")
    near = shared.join(sizes.alias("x"), F.col("a") == F.col("x.node")).join(sizes.alias("y"), F.col("b") == F.col("y.node")).where(within(similarity))
    best = stored(near.groupBy("a").agg(F.max(F.struct("keys", "b")).alias("best")).select("a", "best.b"), "star-pairs")
    discard(rooted, heads)
    return best


def prefix_pairs(nodes: DataFrame, labels: DataFrame, similarity: float) -> DataFrame:
    """Pairs a, b of nodes of different groups that may be similar: all of them, by the exact join of prefixes."""
    tokens = nodes.select(F.col("node").alias("doc"), F.posexplode("prefix").alias("at", "h"))
    shared, tables = shared_rows(tokens.select("h", "doc", "at"), "shared-prefixes")
    places = stored(shared.withColumnRenamed("doc", "node").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node")), "shared-places")
    discard(*tables)
    mixed = stored(places.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("h"), "mixed-shingles")
    mixed_places = stored(places.join(mixed, "h", "left_semi").join(nodes.select("node", "n", "odd"), "node"), "mixed-places")
    total = F.col("x.n") + F.col("y.n")
    left_over = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))
    may = (F.col("x.h") == F.col("y.h")) & (F.col("x.root") != F.col("y.root")) & (F.col("x.node") < F.col("y.node"))
    may = may & (left_over >= similarity / (1 + similarity) * total - 1e-6) & within(similarity)
    pairs = mixed_places.alias("x").join(mixed_places.alias("y"), may).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    found = stored(pairs, "prefix-pairs")
    discard(places, mixed, mixed_places)
    return found


def similar_links(texts: DataFrame, nodes: DataFrame, size: int, similarity: float) -> DataFrame:
    """Links a, b that connect all nodes whose texts are at least this similar; stored. ``nodes`` is stored, ``texts`` is :func:`keyed`."""
    edges = checked(stored(fingerprint_pairs(nodes), "fingerprint-pairs"), texts, nodes, size, similarity)
    labels = components(edges)
    by_key = stored(nodes.where("n > 0").select("node", F.explode("keys").alias("key")), "band-keys")
    several = stored(by_key.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "shared-keys")
    members = stored(by_key.join(several, "key", "left_semi"), "shared-members")
    discard(by_key, several)

    def joined(pairs):
        nonlocal edges, labels
        newer = checked(pairs, texts, nodes, size, similarity)
        if not newer.limit(1).count():
            return False
        edges, labels = stored(edges.unionByName(newer), "all-links"), None
        labels = components(edges)
        return True

    for turn in range(ROUNDS):
        if not joined(star_pairs(members, labels, nodes, turn, similarity)):
            break
    discard(members)
    joined(prefix_pairs(nodes, labels, similarity))
    return edges


def keep_one(docs: DataFrame, size: int, similarity: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without near copies: of each group of similar texts the row with the smallest id stays."""
    texts = keyed(docs, id_col, text_col)
    marks = stored(signatures(texts, size, similarity, common_shingles(docs, size, text_col)), "signatures")
    first = {c: F.first(c).alias(c) for c in ("fp", "keys", "prefix", "odd", "fine", "n")}
    nodes = stored(marks.groupBy("node").agg(F.min(F.struct("doc_id", "th")).alias("rep"), *first.values()), "nodes")
    ids = stored(marks.select("doc_id", "th", F.col("node").alias("fp")), "node-ids")
    discard(marks)
    edges = similar_links(texts, nodes, size, similarity)
    heads = stored(group_heads(groups(ids.select("doc_id", "fp"), edges=edges)), "group-heads")
    staying = ids.join(heads, (F.col("fp") == F.col("head_fp")) & F.col("doc_id").eqNullSafe(F.col("head_id"))).groupBy("fp").agg(F.min(F.struct("doc_id", "th")).alias("key"), F.max("head_rows").alias("n"))
    staying = stored(staying.select("key.doc_id", "key.th", "n"), "kept-keys")
    # what goes is the smaller part: rows whose key does not stay, and keys that may have several rows, of which one comes back
    every = ids.select("doc_id", "th").distinct()
    same = lambda a, b: (F.col(f"{a}.th") == F.col(f"{b}.th")) & F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id"))
    gone = stored(every.alias("e").join(staying.where("n = 1").alias("s"), same("e", "s"), "left_anti"), "dropped-keys")
    again = stored(staying.where("n > 1"), "repeated-keys")
    names = [free_name(docs, c) for c in ("text_hash", "document")]
    hashed = docs.withColumns({names[0]: F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), names[1]: F.col(id_col).cast("long")})
    on = (F.col(f"d.{names[0]}") == F.col("k.th")) & F.col(f"d.{names[1]}").eqNullSafe(F.col("k.doc_id"))
    once = hashed.alias("d").join(bounded(gone).alias("k"), on, "left_anti")
    back = hashed.alias("d").join(bounded(again).alias("k"), on, "left_semi").dropDuplicates(names)
    return once.unionByName(back).select(*docs.columns)

"""Phrase collocations: word pairs counted by direct addresses in tiles, frequent pairs ranked and paired again.

1. Texts become blocks of one language, each with its own word list and a row of word numbers (-1 where a
   piece of text ends). Words that reach ``MIN_COUNT`` over the corpus are numbered by falling frequency.
2. A phrase of k + 1 words is a pair of overlapping phrases of k words, one place apart. In each block the pairs are put in
   tiles of ``SIDE`` x ``SIDE`` numbers. A tile with many pairs (frequent numbers are small, so these are
   few) is counted by ``numpy.bincount`` over its direct addresses; the pairs of all other tiles are sorted
   as coordinates and counted by run. Spark adds up the counts of the blocks.
3. The pairs that reach ``MIN_COUNT`` are numbered by falling frequency in their turn, the blocks' rows are
   written in these numbers, and step 2 follows again, up to ``MAX_WORDS`` words. A phrase that is frequent
   has frequent parts, so nothing is lost.

Counts of blocks are added in hash buckets, whose number grows with the corpus; a pair has one entry for each block,
so a phrase in a third of all texts weighs no more than the number of blocks. Numbers go back to the blocks
through the same buckets, and pairs travel as arrays, not as rows. Nothing is broadcast or collected but
one row for each range of the rankings.

Results in odd cases: null and empty texts have no words; a null language is ``und``; repeated rows count
again; ties in the score of cuts go to the shortest first part, those in the list to the more frequent phrase,
then to the lesser phrase in byte order; an empty table gives an empty result; a very long text is a block of its own. Extra
input columns are not carried along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablework.llm.common import discard, groups_of, map_batches, splitmix, stored

MIN_COUNT, MAX_WORDS, TOP, SCALE, INSIDE_PERCENT = 30, 4, 2000, 2_000_000, 80
BLOCK_CHARS = 4 << 20
BUCKET_WORDS = 4_000_000  # pairs are dealt to one bucket for each so many words of the corpus
TASK_BLOCKS = 4  # a block is some MB; tasks that join blocks with their numbers get about so many
SIDE, DENSE = 512, 8  # a tile is counted by addresses if it has more than a DENSE-th as many pairs as addresses
END = b"\xff"  # ends a piece; no octet of UTF-8
FOLD = bytes.maketrans(b"\t.,;:!?\n\v\f\r" + bytes(range(65, 91)), b" " + END * 10 + bytes(range(97, 123)))


def words_and_ends(texts: list[str]) -> list[bytes]:
    """Words of all texts with ``END`` between pieces and texts."""
    return "\n".join(texts).encode("utf-8").translate(FOLD).replace(END, b" " + END + b" ").split()


def tile_counts(x: np.ndarray, y: np.ndarray, side: int = SIDE, dense: int = DENSE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs x, y of small numbers and how often each occurs."""
    if not len(x):
        return x, y, np.empty(0, np.int64)
    across = int(y.max()) // side + 1
    tile = x // side * across + y // side
    order = np.argsort(tile, kind="stable")
    x, y, tile = x[order], y[order], tile[order]
    begins = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
    sizes = np.diff(np.append(begins, len(tile)))
    full = sizes * dense > side * side
    out = []
    for a, n in zip(begins[full].tolist(), sizes[full].tolist(), strict=True):
        left, top = x[a] // side * side, y[a] // side * side
        counts = np.bincount((x[a : a + n] - left) * side + y[a : a + n] - top, minlength=side * side)
        at = np.flatnonzero(counts)
        out.append((left + at // side, top + at % side, counts[at]))
    sparse = np.repeat(~full, sizes)
    pairs = np.sort(x[sparse] << 32 | y[sparse])
    at = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.empty(0, np.int64)
    out.append((pairs[at] >> 32, pairs[at] & 0xFFFFFFFF, np.diff(np.append(at, len(pairs)))))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def pair_keys(ids: np.ndarray) -> np.ndarray:
    """For each place the pair of numbers there and one place on as one number, -1 where one of them is missing."""
    left, right = ids[:-1].astype(np.int64), ids[1:].astype(np.int64)
    return np.where((left >= 0) & (right >= 0), left << 32 | right, -1)


def blocks_of(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """block, lang, ids (places in the word list, 32 bits each), words, counts, n."""

    def run(batches):
        made = 0
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(langs, texts, strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, own in by_lang.items():
                for a, b in groups_of([len(t) for t in own], BLOCK_CHARS):
                    tokens = words_and_ends(own[a:b])
                    number = dict.fromkeys(tokens)
                    number.pop(END, None)
                    words = list(number)
                    number = dict(zip(words, range(len(words)), strict=True))
                    number[END] = -1
                    ids = np.fromiter(map(number.__getitem__, tokens), np.int32, len(tokens))
                    counts = np.bincount(ids[ids >= 0], minlength=len(words))
                    strings = pa.array([w.decode("utf-8") for w in words], pa.string())
                    columns = [
                        pa.array([TaskContext.get().partitionId() << 32 | made]),
                        pa.array([lang]),
                        binary(ids, np.int32),
                        pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), strings),
                        pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(counts, pa.int64())),
                        pa.array([int(counts.sum())]),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["block", "lang", "ids", "words", "counts", "n"])
                    made += 1

    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return map_batches(texts, run, "block long, lang string, ids binary, words array<string>, counts array<long>, n long")


def binary(values: np.ndarray, kind) -> pa.Array:
    """Numbers as octets: first the lowest octet of all, then the next, so that the high ones, which hardly change, compress to little."""
    octets = np.ascontiguousarray(values, kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize)
    return pa.array([octets.T.tobytes()])


def numbers_in(value: pa.BinaryScalar, kind) -> np.ndarray:
    octets = np.frombuffer(value.as_buffer(), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(octets.T).view(kind).ravel()


def packed(rows: DataFrame, group: str) -> DataFrame:
    """group, key, id as arrays in octets, a row for each group of a batch. ``rows``: group, key, id."""

    def run(batches):
        for batch in batches:
            of, key, value = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            order = np.argsort(of, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(of[order])) + 1) if len(of) else []:
                yield pa.RecordBatch.from_arrays([pa.array(of[part[:1]], pa.int64()), binary(key[part], np.int64), binary(value[part], np.int32)], [group, "key", "id"])

    return map_batches(rows.select(group, "key", "id"), run, f"{group} long, key binary, id binary")


def look_up(keys: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The numbers of keys by a list of (keys, numbers), -1 where a key is not known."""
    have, numbers = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (np.empty(0, np.int64), np.empty(0, np.int32))
    if not len(have):
        return np.full(len(keys), -1, np.int32)
    order = np.argsort(have)
    at = np.minimum(np.searchsorted(have, keys, sorter=order), len(have) - 1)
    return np.where(have[order[at]] == keys, numbers[order[at]], -1).astype(np.int32)


def renumbered(blocks: DataFrame, lists: DataFrame, pairs: bool) -> DataFrame:
    """block, ids: the blocks' rows in other numbers. ``lists``: block, key, id, each in octets, any number of rows for a block.

    A key is the old number or, if ``pairs``, two neighbouring ones; whatever is not known becomes -1.
    """
    tasks = max(1, -(-blocks.count() // TASK_BLOCKS))  # so a task has few blocks, whatever their size once compressed
    rows = blocks.select("block", F.lit(None).cast("binary").alias("key"), F.col("ids").alias("id"), F.lit(1).alias("last"))
    both = lists.withColumn("last", F.lit(0)).unionByName(rows).repartition(tasks, "block").sortWithinPartitions("block", "last")

    def run(batches):
        block, parts = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                of = batch.column(0)[i].as_py()
                if of != block:
                    block, parts = of, []
                value = numbers_in(batch.column(2)[i], np.int32)
                if not batch.column(3)[i].as_py():
                    parts.append((numbers_in(batch.column(1)[i], np.int64), value))
                    continue
                out = look_up(pair_keys(value) if pairs else value.astype(np.int64), parts)
                if (out >= 0).any():
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), binary(out, np.int32)], ["block", "ids"])

    return map_batches(both, run, "block long, ids binary")


def pair_pieces(blocks: DataFrame, buckets: int) -> DataFrame:
    """bucket, block, x, y, n: each pair x, y of numbers in a block and how often it is there, as arrays in octets; x in steps.

    Pairs are dealt to buckets by a hash, so a bucket has all pieces of its pairs and a bounded share of all.
    """

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                keys = pair_keys(numbers_in(batch.column(1)[i], np.int32))
                keys = keys[keys >= 0]
                x, y, n = tile_counts(keys >> 32, keys & 0xFFFFFFFF)
                bucket = bucket_of(x << 32 | y, buckets)
                order = np.lexsort((y, x, bucket))
                for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(x) else []:
                    columns = [pa.array(bucket[part[:1]]), batch.column(0).slice(i, 1), *(binary(c, np.int32) for c in (np.diff(x[part], prepend=0), y[part], n[part]))]
                    yield pa.RecordBatch.from_arrays(columns, ["bucket", "block", "x", "y", "n"])

    return map_batches(blocks.select("block", "ids"), run, "bucket long, block long, x binary, y binary, n binary")


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (splitmix(keys.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def keys_in(batch: pa.RecordBatch, i: int, column: int) -> np.ndarray:
    """The pairs of a piece; the steps of x and y are in this and the next column."""
    x = np.cumsum(numbers_in(batch.column(column)[i], np.int32), dtype=np.int64)
    y = numbers_in(batch.column(column + 1)[i], np.int32).astype(np.int64)
    return x << 32 | y


def frequent_pairs(pieces: DataFrame, buckets: int, min_count: int) -> DataFrame:
    """key, a: the pairs that occur often enough over all blocks."""
    dealt = pieces.select("bucket", "x", "y", "n").repartition(buckets, "bucket").sortWithinPartitions("bucket")

    def run(batches):
        bucket, keys, counts = None, [], []

        def total():
            if keys:
                key, n = np.concatenate(keys), np.concatenate(counts)
                order = np.argsort(key)
                key, n = key[order], n[order]
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                n = np.add.reduceat(n, first)
                often = n >= min_count
                yield pa.RecordBatch.from_arrays([pa.array(key[first][often]), pa.array(n[often])], ["key", "a"])

        for batch in batches:
            for i in range(batch.num_rows):
                of = batch.column(0)[i].as_py()
                if of != bucket:
                    yield from total()
                    bucket, keys, counts = of, [], []
                keys.append(keys_in(batch, i, 1))
                counts.append(numbers_in(batch.column(3)[i], np.int32).astype(np.int64))
        yield from total()

    return map_batches(dealt, run, "key long, a long")


def known_pairs(pieces: DataFrame, ids: DataFrame, buckets: int) -> DataFrame:
    """block, key, id in octets: what each piece has of the numbered pairs (``ids``: key, id)."""

    def dealt(batches):
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(bucket_of(key, buckets)), batch.column(0), batch.column(1)], ["bucket", "key", "id"])

    numbers = packed(map_batches(ids.select("key", F.col("id").cast("int").alias("id")), dealt, "bucket long, key long, id int"), "bucket")
    empty = F.lit(None).cast("binary")
    first = numbers.select("bucket", F.lit(-1).cast("long").alias("block"), empty.alias("x"), empty.alias("y"), "key", "id")
    both = first.unionByName(pieces.select("bucket", "block", "x", "y", empty.alias("key"), empty.alias("id")))

    def run(batches):
        bucket, parts, have = None, [], None
        for batch in batches:
            for i in range(batch.num_rows):
                of = batch.column(0)[i].as_py()
                if of != bucket:
                    bucket, parts, have = of, [], None
                if batch.column(1)[i].as_py() < 0:
                    parts.append((numbers_in(batch.column(4)[i], np.int64), numbers_in(batch.column(5)[i], np.int32)))
                    continue
                if have is None:  # the numbers come before the blocks
                    have = [tuple(np.concatenate(c) for c in zip(*parts, strict=True))] if parts else []
                keys = keys_in(batch, i, 2)
                found = look_up(keys, have)
                good = found >= 0
                if good.any():
                    yield pa.RecordBatch.from_arrays([batch.column(1).slice(i, 1), binary(keys[good], np.int64), binary(found[good], np.int32)], ["block", "key", "id"])

    return map_batches(both.repartition(buckets, "bucket").sortWithinPartitions("bucket", "block"), run, "block long, key binary, id binary")


def frequent_words(rows: DataFrame, min_count: int) -> DataFrame:
    """The rows (lang, word, n) whose word occurs often enough in its language over all blocks, with its count ``a``; stored."""
    total = F.sum("n").over(Window.partitionBy("lang", "word"))  # a word has one row for each block
    return stored(rows.withColumn("a", total).where(F.col("a") >= min_count).drop("n"), "frequent-words")


def ranked(hits: DataFrame, keys: list[str], label: str) -> DataFrame:
    """One row per key, with numbers ``id`` from 0 by falling count; stored. Only the sizes of sorted ranges meet in one place."""
    distinct = hits.groupBy(*keys).agg(F.max("a").alias("a"))
    spread = distinct.repartitionByRange(F.desc("a"), *keys).sortWithinPartitions(F.desc("a"), *keys)
    placed = stored(spread.withColumn("at", F.monotonically_increasing_id()), f"{label}-placed")
    part = F.shiftright("at", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"), F.min("at").alias("low"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = stored(sizes.select("part", (F.coalesce(before, F.lit(0)) - F.col("low")).alias("shift")), f"{label}-starts")
    found = stored(placed.join(starts, part == F.col("part")).select(*keys, "a", (F.col("at") + F.col("shift")).alias("id")), label)
    discard(placed, starts)
    return found


def phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, lang_col: str = "lang", text_col: str = "text") -> tuple[list[DataFrame], DataFrame]:
    """All frequent phrases, one stored table for each number of words, and the number of words of each language.

    A table has lang, phrase, a (its count), id and, from two words on, the ids ``left`` and ``right`` of its first
    words and its last words, one less each, and ``cuts``: counts (l, r) of the two parts for each cut, in order.
    """
    blocks = stored(blocks_of(docs, lang_col, text_col), "blocks")
    n_words = stored(blocks.groupBy("lang").agg(F.sum("n").alias("n")), "language-sizes")
    rows = blocks.select("block", "lang", F.explode(F.expr("transform(words, (w, i) -> struct(w AS word, i AS place, counts[i] AS n))")).alias("w"))
    hits = frequent_words(rows.select("block", "lang", "w.word", "w.place", "w.n"), min_count)
    ids = ranked(hits, ["lang", "word"], "word-numbers")
    places = hits.drop("a").join(ids, ["lang", "word"]).select("block", F.col("place").cast("long").alias("key"), F.col("id").cast("int").alias("id"))
    numbers = stored(renumbered(blocks, packed(places, "block"), pairs=False), "word-rows")
    discard(blocks, hits)
    buckets = max(1, (n_words.agg(F.sum("n")).first()[0] or 0) // BUCKET_WORDS)
    # ends: the count and text of the last word, counts of the first word and of the first and last two words
    table = ids.select("lang", F.col("word").alias("phrase"), "a", "id", F.col("a").alias("first_a"), F.col("a").alias("last_a"), F.col("word").alias("last_word"), *(F.lit(None).cast("long").alias(c) for c in ("first_two", "last_two")))
    found = [stored(table, "phrases-1")]
    discard(ids)
    for words in range(2, max_words + 1):
        pieces = stored(pair_pieces(numbers, buckets), "pair-pieces")
        hits = stored(frequent_pairs(pieces, buckets, min_count), "frequent-pairs")
        ids = ranked(hits, ["key"], "pair-numbers")
        if words < max_words:
            older, numbers = numbers, stored(renumbered(numbers, known_pairs(pieces, ids, buckets), pairs=True), "phrase-rows")
            discard(older)
        discard(hits, pieces)
        halves = ids.select("a", "id", F.shiftrightunsigned("key", 32).alias("left"), F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)).alias("right"))
        part = found[-1]
        x, y = (part.select(*(F.col(c).alias(f"{side}_{c}") for c in part.columns if c != "cuts")) for side in ("x", "y"))
        both = halves.join(x, F.col("left") == F.col("x_id")).join(y, F.col("right") == F.col("y_id"))
        cut = lambda l, r: F.struct(F.col(l).alias("l"), F.col(r).alias("r"))
        cuts = {2: [cut("x_a", "y_a")], 3: [cut("x_first_a", "y_a"), cut("x_a", "y_last_a")], 4: [cut("x_first_a", "y_a"), cut("x_first_two", "y_last_two"), cut("x_a", "y_last_a")]}[words]
        made = both.select(
            F.col("x_lang").alias("lang"),
            F.concat_ws(" ", "x_phrase", "y_last_word").alias("phrase"),
            "a", "id", "left", "right",
            F.array(*cuts).alias("cuts"),
            F.col("x_first_a").alias("first_a"),
            F.col("y_last_a").alias("last_a"),
            F.col("y_last_word").alias("last_word"),
            F.col("a" if words == 2 else "x_first_two").alias("first_two"),
            F.col("a" if words == 2 else "y_last_two").alias("last_two"),
        )
        found.append(stored(made, f"phrases-{words}"))
        discard(ids)
    discard(numbers)
    return found, n_words


def scored(tables: list[DataFrame], inside_percent: int = INSIDE_PERCENT) -> DataFrame:
    """lang, phrase, a, l, r, score of the phrases that no longer one stands for.

    The lowest score of the cuts counts. A phrase in a phrase two words longer is in one that is one
    word longer and at least as frequent, so one step is enough.
    """
    out = None
    for k in range(1, len(tables)):
        own = tables[k]
        if k + 1 < len(tables):
            longer = tables[k + 1].select("a", F.explode(F.array("left", "right")).alias("part")).groupBy("part").agg(F.max("a").alias("longer_a"))
            own = own.join(longer, F.col("id") == F.col("part"), "left").where(F.coalesce(100 * F.col("longer_a") < inside_percent * F.col("a"), F.lit(True)))
        wide = "CAST(a AS DECIMAL(19, 0))"
        best = F.expr(f"array_min(transform(cuts, (c, k) -> struct(({wide} * {SCALE}) div (c.l + c.r) AS score, k AS k, c.l AS l, c.r AS r)))").alias("best")
        own = own.select("lang", "phrase", "a", best).select("lang", "phrase", "a", "best.l", "best.r", "best.score")
        out = own if out is None else out.unionByName(own)
    return out


def collocations(
    docs: DataFrame, top: int | None = TOP, min_count: int = MIN_COUNT, inside_percent: int = INSIDE_PERCENT, lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of two to four words.

    ``a`` is the phrase's count, ``l`` and ``r`` those of its parts at the cut that counts, ``n`` the number of words.
    With ``top=None`` all of them, without ranks.
    """
    tables, n_words = phrases(docs, min_count, MAX_WORDS, lang_col, text_col)
    found = scored(tables, inside_percent).join(n_words, "lang")
    columns = ["phrase", "a", "l", "r", "n", "score"]
    if top is None:
        return found.select("lang", *columns)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    limited = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)  # Spark limits each partition before the exchange
    return limited.select("lang", F.col("rank").cast("long").alias("rank"), *columns)

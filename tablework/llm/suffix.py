"""Repeated passages by sparse suffix arrays.

1. Suffixes are kept only where the content selects them: a position is a minimiser if the hash of the
   ``GRAM`` words there is the smallest of some ``WINDOW`` consecutive ones. Every passage of
   ``MIN_WORDS`` words has a minimiser among its first ``WINDOW`` positions, whichever text it is in.
2. Sort and compare: all suffixes are sorted by their first ``MIN_WORDS - WINDOW + 1`` words (as a
   64-bit hash), then by document and place, and neighbours are compared in a stream. The sort ranges
   run over all three columns, so a passage that a third of all documents share fills many ranges;
   what cannot be told at the two ends of a range is settled by a small table of such ends.
3. Extend left and right: around each suffix that another document shares, the windows of
   ``MIN_WORDS`` words that begin up to ``WINDOW - 1`` words left of it are hashed, sorted and compared
   in the same way. A window counts only if another document has all of it. Windows that
   overlap or adjoin are merged to passages, and passages that share a window are one class.

Results in odd cases: null, empty and short texts have no passages; rows that share an id are one
document, so a repeated row or a passage that repeats inside one document is no repeat; rows with a null
id are told apart by their texts (a hash of 64 bits in place of the id) and keep the null; ids may be negative; an
empty table gives an empty result. Very long
texts are read whole. Words are compared in lower case of A-Z, by hashes of 64 bits. Extra input columns
are not carried along.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablework.llm.common import discard, groups_of, map_batches, splitmix, stored
from tablework.llm.graphs import components

MIN_WORDS, WINDOW, GRAM = 50, 16, 5
GROUP_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))


@functools.cache
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2 ** 64, for i below n."""
    inverse = pow(BASE, -1, 1 << 64)
    out = []
    for factor in (BASE, inverse):
        p = np.full(n, factor, np.uint64)
        p[:1] = 1
        out.append(np.multiply.accumulate(p, dtype=np.uint64))
    return out[0], out[1]


def room(n: int) -> int:
    """Sizes of the power tables go in steps, so few of them are kept."""
    return 1 << max(20, int(n).bit_length())


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of values[starts:ends], equal for equal runs wherever they lie."""
    up, down = powers(room(len(values) + 1))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return splitmix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and where each text's words begin (one more at the end)."""
    data = "\n".join(texts).encode("utf-8").translate(LOWER)
    octets = np.frombuffer(data, np.uint8)
    inside = ~WHITE[octets]
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sizes = np.array([len(t.encode("utf-8")) + 1 for t in texts], np.int64)
    first = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))
    lengths = (ends - starts).astype(np.uint64)
    return splitmix(span_hashes(octets.astype(np.uint64) + np.uint64(1), starts, ends) + lengths), first


def sliding(values: np.ndarray, size: int, smaller) -> np.ndarray:
    """Smallest (or largest) of each ``size`` consecutive values, by doubling."""
    out, have = values, 1
    while have < size:
        hop = min(have, size - have)
        out = smaller(out[: len(out) - hop], out[hop:])
        have += hop
    return out


def minimisers(words: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Positions whose gram is the smallest of some ``window`` consecutive grams of one text."""
    n = len(words) - gram + 1
    if n <= 0:
        return np.empty(0, np.int64)
    grams = span_hashes(words, np.arange(n), np.arange(n) + gram)
    size = min(window, n)
    lowest = sliding(grams, size, np.minimum)
    padded = np.concatenate([np.zeros(size - 1, np.uint64), lowest, np.zeros(size - 1, np.uint64)])
    return np.flatnonzero(sliding(padded, size, np.maximum) == grams)


def suffixes(texts: list[str], size: int, window: int, gram: int):
    """For each text: minimiser positions that have ``size`` words after them, and the hashes of those words."""
    words, first = word_hashes(texts)
    for a, b in zip(first.tolist(), first[1:].tolist(), strict=False):
        own = words[a:b]
        at = minimisers(own, window, gram)
        at = at[at + size <= len(own)]
        yield own, at, span_hashes(own, at, at + size) if len(at) else np.empty(0, np.uint64)


ROWS = "h long, doc long, at int, state int"
SHARED, OPEN, MARK = 0, 1, 2  # another document has it; not known at an end of the range; documents seen at an end


def shared_in_stream(batches):
    """Rows sorted by h, doc, at: pass on those whose h occurs in two documents or more.

    Of the run that is being read only its smallest document and the rows of its first document are kept.
    """

    def made(h, doc, at, state):
        state = np.full(len(h), state, np.int32)
        return pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(doc, pa.int64()), pa.array(at, pa.int32()), pa.array(state)], ["h", "doc", "at", "state"])

    run = None  # (h, smallest document, whether another one was seen, whether the range begins with it)
    many_doc = 0  # the largest document of that run so far
    waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def close(last: bool):
        h, low, many, first = run
        if many and (first or last):
            yield made([h, h], [low, many_doc], [0, 0], MARK)
        if not many:
            for w in waiting if first or last else []:
                yield made(*w, OPEN)

    for batch in batches:
        h, doc, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        if not len(h):
            continue
        begins = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        ends = np.append(begins[1:], len(h))
        low, high = doc[begins].copy(), doc[ends - 1]
        many = low != high
        if run is not None and run[0] == h[0]:
            many[0] = run[2] or high[0] != run[1]
            low[0] = run[1]
            first = run[3]
        else:
            if run is not None:
                yield from close(False)
            waiting, first = [], run is None
        if many[0]:
            for w in waiting:
                yield made(*w, SHARED)
            waiting = []
        told = np.repeat(many, ends - begins)
        yield made(h[told], doc[told], at[told], SHARED)
        if len(begins) > 1:  # the first run of this batch ends here
            if not many[0]:
                waiting.append((h[: ends[0]], doc[: ends[0]], at[: ends[0]]))
            run, many_doc = (h[0], low[0], many[0], first), high[0]
            yield from close(False)
            waiting, first = [], False
        if not many[-1]:
            waiting.append((h[begins[-1] :], doc[begins[-1] :], at[begins[-1] :]))
        run, many_doc = (h[-1], low[-1], many[-1], first), high[-1]
    if run is not None:
        yield from close(True)


def shared_rows(rows: DataFrame, label: str) -> tuple[DataFrame, list[DataFrame]]:
    """Of a table h, doc, at: the rows whose h occurs in two documents or more. Also the tables that they are read from."""
    ordered = rows.select("h", "doc", "at").repartitionByRange("h", "doc", "at").sortWithinPartitions("h", "doc", "at")
    found = stored(map_batches(ordered, shared_in_stream, ROWS), label)
    at_ends = found.where(F.col("state") != SHARED).groupBy("h").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low != high")
    at_ends = stored(at_ends.select("h"), f"{label}-ends")
    settled = found.where(F.col("state") == OPEN).join(at_ends, "h", "left_semi")
    return found.where(F.col("state") == SHARED).select("h", "doc", "at").unionByName(settled.select("h", "doc", "at")), [found, at_ends]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc (a number for every row; a hash of the text where the id is null), text, unknown (whether it is)."""
    text, known = F.coalesce(F.col(text_col), F.lit("")), F.col(id_col).cast("long")
    return docs.select(F.coalesce(known, F.xxhash64(text)).alias("doc"), text.alias("text"), known.isNull().alias("unknown"))


def suffix_rows(texts: DataFrame, size: int, window: int, gram: int) -> DataFrame:
    """h, doc, at of the kept suffixes of all texts."""

    def run(batches):
        for batch in batches:
            docs, data = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in groups_of([len(t) for t in data], GROUP_BYTES):
                found = [(h, np.full(len(h), d, np.int64), at) for d, (_, at, h) in zip(docs[a:b], suffixes(data[a:b], size, window, gram), strict=True)]
                h, doc, at = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(doc), pa.array(at.astype(np.int32))], ["h", "doc", "at"])

    return map_batches(texts.select("doc", "text"), run, "h long, doc long, at int")


def window_rows(texts: DataFrame, marked: DataFrame, size: int, min_words: int, window: int, gram: int) -> DataFrame:
    """h, doc, at of the windows of ``min_words`` words that have a marked minimiser among their first ``window`` places.

    A row of ``marked``: doc, places."""

    def run(batches):
        for batch in batches:
            docs, data, places = (batch.column(i).to_pylist() for i in range(3))
            for a, b in groups_of([len(t) for t in data], GROUP_BYTES):
                out = []
                for d, wanted, (own, at, _) in zip(docs[a:b], places[a:b], suffixes(data[a:b], size, window, gram), strict=True):
                    use = at[np.isin(at, np.array(wanted, np.int64))]
                    low = np.maximum(use - window + 1, np.concatenate([[0], use[:-1] + 1])[: len(use)])
                    count = use - low + 1
                    start = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    start = start[start + min_words <= len(own)]
                    out.append((span_hashes(own, start, start + min_words), np.full(len(start), d, np.int64), start))
                h, doc, at = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(doc), pa.array(at.astype(np.int32))], ["h", "doc", "at"])

    chosen = texts.join(marked.withColumnRenamed("doc", "marked_doc"), F.col("doc") == F.col("marked_doc")).select("doc", "text", "places")
    return map_batches(chosen, run, "h long, doc long, at int")


def repeated_passages(
    docs: DataFrame, min_words: int = MIN_WORDS, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, start_word, n_words, class_id, n_docs: passages that other documents have too.

    Each maximal run of shared windows in a document is one row. Runs that share a window are linked;
    ``class_id`` names the connected group of runs (by the smallest hash of its windows) and ``n_docs`` is
    the number of documents in it.
    """
    size = min_words - window + 1
    texts = keyed(docs, id_col, text_col)
    kept = stored(suffix_rows(texts, size, window, gram), "suffixes")
    shared, tables = shared_rows(kept, "shared-suffixes")
    discard(kept)
    marked = stored(shared.groupBy("doc").agg(F.collect_set("at").alias("places")), "marked-documents")  # bounded by one document
    discard(*tables)
    repeated, tables = shared_rows(window_rows(texts, marked, size, min_words, window, gram), "shared-windows")
    by_place = Window.partitionBy("doc").orderBy("at", "h")  # one document's windows
    fresh = F.coalesce(F.col("at") > F.lag("at").over(by_place) + min_words, F.lit(True))
    placed = repeated.select("doc", "at", "h", fresh.cast("int").alias("fresh"))
    runs = stored(placed.select(F.struct("doc", F.sum("fresh").over(by_place).alias("run")).alias("node"), "at", "h"), "passage-windows")
    discard(marked, *tables)
    merged = stored(runs.groupBy("node").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.min("h").alias("low")), "passages")
    # a run is linked to the least run that has one of its windows: runs are few for each document, and so are these links
    heads = stored(runs.groupBy("h").agg(F.min("node").alias("head")), "window-heads")
    linked = stored(runs.join(heads, "h").where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct(), "passage-links")
    discard(runs, heads)
    of_run = components(linked)
    classed = stored(merged.join(of_run, "node", "left").withColumn("root", F.coalesce("root", "node")), "passage-classes")
    discard(merged, linked, of_run)
    in_documents = classed.groupBy("root", "node.doc").agg(F.min("low").alias("low"))
    classes = stored(in_documents.groupBy("root").agg(F.min("low").alias("class"), F.count(F.lit(1)).alias("n_docs")), "classes")
    unknown = stored(texts.where("unknown").select("doc").distinct(), "unknown-ids")
    found = classed.join(classes, "root").select(F.col("node.doc").alias("doc"), "first", "last", "class", "n_docs")
    return found.join(unknown.withColumn("unknown", F.lit(True)), "doc", "left").select(
        F.when(F.col("unknown").isNull(), F.col("doc")).alias("doc_id"),
        F.col("first").cast("long").alias("start_word"),
        (F.col("last") + min_words - F.col("first")).cast("long").alias("n_words"),
        F.lower(F.hex("class")).alias("class_id"),
        "n_docs",
    )

"""Periodic runs of words: suffix trees answer how far two places agree, Lyndon roots say where to ask.

A run is a stretch of words with a smallest period q, of at least ``POWER`` periods and ``MIN_WORDS`` words,
that no neighbouring word extends with that period.

1. Every word of a run occurs in it ``POWER`` times, so a word that is rarer in its stretch cannot lie in a
   run and parts the stretch; what remains is parted in the same way until nothing changes. Most prose is
   gone then. No run is lost or cut by this.
2. What remains of a document, with a word of its own between the stretches, gets two suffix trees by
   Ukkonen's method: one of the words, one of the words in reverse order. An Euler tour of each tree, reduced to
   the shallowest node between neighbouring leaves, and a table of minima over powers of two give the
   longest common extension of any two places in constant time, to the right and to the left.
3. The root of each run has a rotation that is the longest Lyndon word from its first place, in the order
   of the words or in the reverse order. That word ends where the next smaller suffix begins, so each place gives
   one candidate per order; extended both ways by the trees, it is a run or not.

The trees grow in plain Python, everything else is numpy over all places of a document. Memory is in
proportion to one document's remaining words. Documents are independent: no shuffle.

Results in odd cases: null, empty and blank texts have no words, no runs and an empty collapsed text; words
are compared as they are, so case and marks matter; rows are told apart by nothing, so repeated rows and null or
repeated ids give one result row each; runs that tie in length are ordered by start, then period; an empty table gives
an empty result; very long texts are handled whole. Extra input columns are not carried along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablework.llm.common import groups_of, id_and_text, map_batches

MIN_WORDS, POWER = 6, 4
GROUP_BYTES = 1 << 20
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id long, n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def suffix_tree(word: list[int], letters: int) -> tuple[list[int], list[int], dict[int, int]]:
    """Ukkonen's tree of a word whose last letter occurs nowhere else: where each node's edge starts and stops, and the edges.

    Node 0 is the root; ``edges[node * letters + first letter]`` is the node below.
    """
    n = len(word)
    starts, stops, links = [0], [0], [0]
    edges: dict[int, int] = {}
    node = edge = length = due = 0  # the active place: a node, an edge (by its first letter's position) and a length on it
    for i, letter in enumerate(word):
        due += 1
        fresh = 0  # an inner node made in this round whose suffix link is open
        while due:
            if not length:
                edge = i
            key = node * letters + word[edge]
            below = edges.get(key)
            if below is None:
                edges[key] = len(starts)
                starts.append(i)
                stops.append(n)
                links.append(0)
                if fresh:
                    links[fresh] = node
                    fresh = 0
            else:
                start = starts[below]
                if length:
                    span = stops[below] - start
                    if length >= span:
                        node, edge, length = below, edge + span, length - span
                        continue
                if word[start + length] == letter:
                    if fresh:
                        links[fresh] = node
                    length += 1
                    break
                made = len(starts)
                edges[key] = made
                edges[made * letters + letter] = made + 1
                edges[made * letters + word[start + length]] = below
                starts += (start, i)
                stops += (start + length, n)
                links += (0, 0)
                starts[below] = start + length
                if fresh:
                    links[fresh] = made
                fresh = made
            due -= 1
            if node:
                node = links[node]
            elif length:
                length -= 1
                edge = i - due + 1
    return starts, stops, edges


class Extensions:
    """Longest common extensions of the suffixes of a word, and their order."""

    def __init__(self, word: list[int], letters: int):
        starts, stops, edges = suffix_tree(word, letters)
        n = len(word)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        below = np.fromiter(edges.values(), np.int64, len(edges))
        order = np.argsort(keys)[::-1]  # a stack gives the last one first
        parents = keys[order] // letters
        first = np.searchsorted(-parents, -np.arange(len(starts)), "left").tolist()
        last = np.searchsorted(-parents, -np.arange(len(starts)), "right").tolist()
        kids = below[order].tolist()
        # the Euler tour, of which only the leaves and the shallowest depth between two of them are kept
        depths = [0] * len(starts)
        stack, leaves, between = [0], [], []
        lowest = 0
        while stack:
            v = stack.pop()
            if v < 0:  # back at an inner node
                v = depths[~v]
                if v < lowest:
                    lowest = v
                continue
            a, b = first[v], last[v]
            depth = depths[v]
            if a == b:
                leaves.append(n - depth)
                between.append(lowest)
                lowest = depth
                continue
            for kid in kids[a:b]:
                depths[kid] = depth + stops[kid] - starts[kid]
                stack += (~v, kid)
        self.rank = np.empty(n, np.int64)
        self.rank[leaves] = np.arange(n)
        lows = np.array(between, np.int32)
        self.minima = [lows]
        size = 1
        while 2 * size <= n:
            self.minima.append(np.minimum(self.minima[-1][:-size], self.minima[-1][size:]))
            size *= 2

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of different places how many letters agree from there on."""
        x, y = self.rank[a], self.rank[b]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y) + 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level).tolist():
            own = level == k
            out[own] = np.minimum(self.minima[k][low[own]], self.minima[k][high[own] - (1 << k)])
        return out


def next_smaller(ranks: list[int]) -> np.ndarray:
    """For each place the next one with a smaller rank; the length where there is none."""
    n = len(ranks)
    out = [n] * n
    for i in range(n - 2, -1, -1):
        j, rank = i + 1, ranks[i]
        while j < n and ranks[j] > rank:
            j = out[j]
        out[i] = j
    return np.array(out, np.int64)


def runs_of(codes: np.ndarray, min_words: int = MIN_WORDS, power: int = POWER) -> np.ndarray:
    """Rows (start, length, period) of all runs of a word of numbers 0, 1, 2 ..., by start, then period."""
    n = len(codes)
    if n < min_words:
        return np.empty((0, 3), np.int64)
    letters = int(codes.max()) + 2
    word = (codes + 1).tolist()  # 0 is the end, the smallest letter
    right, left = Extensions([*word, 0], letters), Extensions([*word[::-1], 0], letters)
    ranks = right.rank[:n]
    found = []
    for order in (ranks, -ranks):
        stop = next_smaller(order.tolist())
        at = np.flatnonzero((stop < n) | (order is ranks))
        period = stop[at] - at
        near = power * period <= n
        at, period = at[near], period[near]
        other = at + period
        more = np.zeros(len(at), np.int64)
        inside = other < n
        more[inside] = right.of(at[inside], other[inside])
        less = np.zeros(len(at), np.int64)
        inside = at > 0
        less[inside] = left.of(n - at[inside], n - other[inside])
        length = less + period + more
        good = length >= np.maximum(min_words, power * period)
        found.append(np.stack([at - less, length, period], axis=1)[good])
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)  # one stretch has one smallest period
    rows = rows[new]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def possible(codes: np.ndarray, text: np.ndarray, min_words: int, power: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that may lie in runs, and a number for the stretch of each. ``codes``: of the words; ``text``: which text each is in."""
    at, code, part = np.arange(len(codes)), codes, text
    while True:
        often = np.bincount(code)[code] >= power if len(code) else np.zeros(0, bool)
        begins = np.ones(len(at), bool)
        begins[1:] = (part[1:] != part[:-1]) | (np.diff(at) != 1) | ~often[1:] | ~often[:-1]
        part = np.cumsum(begins)
        keep = often & (np.bincount(part)[part] >= min_words) if len(part) else often
        same = keep.all()
        at, code, part = at[keep], code[keep], part[keep]
        if same:
            return at, part
        code = np.unique(part * np.int64(len(codes) + 1) + code, return_inverse=True)[1] if len(code) else code


def analyse(texts: list[str], min_words: int, power: int):
    """For each text: number of words, runs, and the words joined without the repeats."""
    lists = [t.encode("utf-8").split() for t in texts]  # octets are split at ASCII white space only
    codes, known = [], 0
    for words in lists:
        of_word = dict.fromkeys(words)
        of_word = dict(zip(of_word, range(known, known + len(of_word)), strict=True))
        codes.append(np.fromiter(map(of_word.__getitem__, words), np.int64, len(words)))
        known += len(of_word)
    sizes = np.array([len(c) for c in codes], np.int64)
    first = np.cumsum(sizes) - sizes
    flat = np.concatenate([np.empty(0, np.int64), *codes])
    at, part = possible(flat, np.repeat(np.arange(len(sizes)), sizes), min_words, power)
    bounds = np.searchsorted(at, np.append(first, len(flat)))
    for i, words in enumerate(lists):
        own = slice(bounds[i], bounds[i + 1])
        if own.start == own.stop:
            yield len(words), np.empty((0, 3), np.int64), b" ".join(words)
            continue
        places = at[own] - first[i]
        gaps = np.concatenate([[0], np.cumsum(np.diff(part[own]) != 0)])
        squeezed = np.unique(flat[at[own]], return_inverse=True)[1]
        n_letters, joined = int(squeezed.max()) + 1, np.empty(len(places) + gaps[-1], np.int64)
        origin = np.full(len(joined), -1, np.int64)
        slots = np.arange(len(places)) + gaps
        joined[slots], origin[slots] = squeezed, places
        joined[origin < 0] = n_letters + np.arange(gaps[-1])  # between stretches: words that occur once
        rows = runs_of(joined, min_words, power)
        rows[:, 0] = origin[rows[:, 0]]
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, rows[:, 0] + rows[:, 2], 1)
        np.add.at(change, rows[:, 0] + rows[:, 1], -1)
        kept = np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()
        yield len(words), rows, b" ".join([words[k] for k in kept])


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, power: int = POWER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period; by start, then period), collapsed.

    ``collapsed`` is the text without the words that lie in some run after its first period.
    """
    if power < 2 or min_words < power:
        raise ValueError("a run has two periods or more, and as many words as periods")

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in groups_of([len(t) for t in texts], GROUP_BYTES):
                counts, rows, collapsed = zip(*analyse(texts[a:b], min_words, power), strict=True)
                flat = np.concatenate(rows)
                fields = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(RUN))
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(offsets, fields), pa.array([c.decode("utf-8") for c in collapsed], pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return map_batches(id_and_text(docs, id_col, text_col), run, SCHEMA)

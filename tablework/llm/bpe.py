"""Byte-level BPE: boundaries by class arrays and scans of transition functions, merges by a cache.

The usual splitting pattern (contractions, letters, numbers, other signs, white space) is a small
automaton over classes of code points. Each code point is a function from state to state; functions
compose associatively, so the states before all code points follow from a blocked prefix scan over
arrays, without a regular expression and without a loop over characters. The slices between
boundaries are looked up in a cache of merged slices; only new ones are merged.

Results in odd cases: a null or empty text has no tokens; very long texts are encoded whole, one group
of texts at a time; repeated rows each get their row; an empty table gives an empty table. Extra input
columns are not carried along, so their names cannot clash.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablework.llm.common import groups_of, id_and_text, map_batches

# White space of the Unicode standard, and the endings that follow an apostrophe.
WHITE = (*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
SHORT_ENDINGS, LONG_ENDINGS = ("s", "t", "m", "d"), ("re", "ve", "ll")

LETTER, NUMBER, OTHER, SHORT, LONG, INSIDE, SPACE, BLANK = range(8)  # what a code point is to the automaton
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, IN_WHITE, ONE_LEFT, TWO_LEFT = range(8)  # its states
STARTS = 8  # added to the symbol of a text's first code point

GROUP_CHARS = 1 << 18
CACHE_SLICES = 1 << 17  # about 200 octets each
BLOCK = 256


@functools.cache
def classes() -> np.ndarray:
    """Class of every code point: LETTER, NUMBER, OTHER, SPACE (the plain one) or BLANK."""
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    kinds = np.array([ord(unicodedata.category(chr(i))[0]) for i in range(sys.maxunicode + 1)], np.uint8)
    table[kinds == ord("L")] = LETTER
    table[kinds == ord("N")] = NUMBER
    table[list(WHITE)] = BLANK
    table[32] = SPACE
    return table


def step(state: int, symbol: int) -> tuple[int, bool]:
    """The automaton: next state, and whether a slice begins at this code point."""
    if symbol >= STARTS:
        state, symbol = FRESH, symbol - STARTS
    if state in (ONE_LEFT, TWO_LEFT):
        return (FRESH if state == ONE_LEFT else ONE_LEFT), False
    if symbol in (SHORT, LONG) and state not in (IN_OTHERS, AFTER_SPACE):
        return (ONE_LEFT if symbol == SHORT else TWO_LEFT), True
    if symbol in (SHORT, LONG):
        symbol = OTHER
    if symbol <= OTHER:
        inside = (IN_LETTERS, IN_NUMBERS, IN_OTHERS)[symbol]
        return inside, state not in (inside, AFTER_SPACE)
    if symbol == INSIDE:
        return IN_WHITE, state != IN_WHITE
    return (AFTER_SPACE if symbol == SPACE else FRESH), True  # the last of a run of white space


@functools.cache
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By (state, symbol): next state, plus 8 if a slice begins. Functions that arise from symbols, numbered from
    the identity: the product with a symbol by (symbol, function), with a function by (function, function), and
    the value by (function, state)."""
    moves = np.array([[(m := step(s, x))[0] + 8 * m[1] for x in range(2 * STARTS)] for s in range(8)], np.uint8)
    known = {tuple(range(8)): 0}
    generators = [tuple(int(f) % 8 for f in moves[:, x]) for x in range(2 * STARTS)]
    todo = list(known)
    while todo:
        f = todo.pop()
        for g in generators:
            h = tuple(g[v] for v in f)
            if h not in known:
                known[h] = len(known)
                todo.append(h)
    every = sorted(known, key=known.get)
    after = lambda g: [known[tuple(g[v] for v in f)] for f in every]
    by_symbol = np.array([after(g) for g in generators], np.int32)
    by_function = np.array([after(g) for g in every], np.int32).T.copy()
    return moves, by_symbol, by_function, np.array(every, np.uint8)


def boundaries(symbols: np.ndarray) -> np.ndarray:
    """Whether a slice begins at each code point: fold blocks to functions, scan the functions, run the blocks."""
    moves, by_symbol, by_function, value = automaton()
    n, size = len(symbols), len(value)
    rows = -(-n // BLOCK)
    padded = np.full(rows * BLOCK, STARTS + OTHER, np.uint8)
    padded[:n] = symbols
    columns = np.ascontiguousarray(padded.reshape(rows, BLOCK).T)
    table, folded = by_symbol.ravel(), np.zeros(rows, np.int32)
    for line in columns.astype(np.int32) * size:
        folded = table.take(line + folded)
    table, reach = by_function.ravel(), 1
    while reach < rows:  # prefix products of the blocks, by doubling
        folded = np.concatenate([folded[:reach], table.take(folded[:-reach] * size + folded[reach:])])
        reach *= 2
    state = np.full(rows, FRESH, np.uint8)
    state[1:] = value[folded[:-1], FRESH]
    table, out = moves.ravel(), np.empty((BLOCK, rows), np.uint8)
    for c in range(BLOCK):
        table.take(state * np.uint8(2 * STARTS) + columns[c], out=out[c], mode="clip")
        state = out[c] & np.uint8(7)
    return np.ascontiguousarray(out.T).ravel()[:n] >= 8


def symbols_of(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Symbols of the code points of several texts; ``starts`` has the first index of each text that has any."""
    sym = classes()[points]
    last = np.zeros(len(points), bool)
    last[starts[1:] - 1] = True
    last[-1] = True
    white = sym >= SPACE
    followed = np.empty(len(points), bool)  # by white space or nothing
    followed[:-1] = white[1:]
    followed |= last
    sym[white & followed] = INSIDE
    marks = np.flatnonzero(points == 39)
    if len(marks):
        ends = np.append(starts[1:], len(points))[np.searchsorted(starts, marks, "right") - 1]
        at = lambda k: np.where(marks + k < ends, points[np.minimum(marks + k, len(points) - 1)], 0)
        one, two = at(1), at(2)
        sym[marks[np.isin(one, [ord(x) for x in SHORT_ENDINGS])]] = SHORT
        for x in LONG_ENDINGS:
            sym[marks[(one == ord(x[0])) & (two == ord(x[1]))]] = LONG
    sym[starts] += STARTS
    return sym


def slices(texts: list[str]) -> tuple[list[bytes], list[int]]:
    """All slices of the texts in order as UTF-8, and for each text the index of its first slice (one more at the end)."""
    joined = "".join(texts)
    if not joined:
        return [], [0] * (len(texts) + 1)
    lengths = np.array([len(t) for t in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    data = joined.encode("utf-8")
    octets = np.frombuffer(data, np.uint8)
    points = octets if len(octets) == len(joined) else np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    first = np.flatnonzero(boundaries(symbols_of(points, offsets[:-1][lengths > 0])))
    of_text = np.searchsorted(first, offsets)
    if len(octets) != len(joined):
        first = np.flatnonzero((octets & 0xC0) != 0x80)[first]
    marked = np.full(len(octets) + len(first), 0xFF, np.uint8)  # 0xFF never occurs in UTF-8
    text = np.ones(len(marked), bool)
    text[first + np.arange(len(first))] = False
    marked[text] = octets
    return marked.tobytes()[1:].split(b"\xff"), of_text.tolist()


class Vocabulary:
    """Ranks of a byte-level vocabulary with a bounded cache of merged slices, empty again after a ``with`` block."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = max(self.ranks.values()) + 1
        self.octets = [b""] * size
        for token, i in self.ranks.items():
            self.octets[i] = token
        self.sizes = np.array([len(t) for t in self.octets], np.int64)
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = {}
        for token, i in self.ranks.items():
            for k in range(1, len(token)):
                a, b = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[(a << 20) | b] = i
        self.pairs = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in sorted(pairs)], np.int64)
        self.cache: dict[bytes, bytes] = {}

    def __enter__(self) -> Vocabulary:
        return self

    def __exit__(self, *_) -> None:
        self.cache = {}

    NONE = 1 << 40

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the token that a pair of tokens makes; NONE where it makes none."""
        key = (a << 20) | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (a >= 0) & (b >= 0), self.merged[at], self.NONE)

    def merge_many(self, parts: list[bytes]) -> list[bytes]:
        """Merge slices of one length class side by side: in each round every slice merges its lowest-ranked leftmost pair."""
        width = max(map(len, parts))
        grid = np.full((len(parts), width + 1), -1, np.int64)
        for n in {len(p) for p in parts}:
            rows = [i for i, p in enumerate(parts) if len(p) == n]
            grid[rows, :n] = self.single[np.frombuffer(b"".join(parts[i] for i in rows), np.uint8).reshape(len(rows), n)]
        rank = self.rank_of(grid[:, :-1], grid[:, 1:])
        live = np.arange(len(parts))
        while True:
            at = rank[live].argmin(1)
            best = rank[live, at]
            going = best < self.NONE
            live, at, best = live[going], at[going], best[going]
            if not len(live):
                break
            take = np.arange(width + 1)[None, :]
            move = take + (take > at[:, None])  # close the gap behind the merged pair
            np.minimum(move, width, out=move)
            sub = np.take_along_axis(grid[live], move, 1)
            sub[np.arange(len(live)), at] = best
            sub[:, -1] = -1
            sub_rank = np.take_along_axis(np.pad(rank[live], ((0, 0), (0, 1)), constant_values=self.NONE), move, 1)[:, :width]
            sub_rank[:, -1] = self.NONE
            here = np.arange(len(live))
            sub_rank[here, at] = self.rank_of(best, sub[here, at + 1])
            left = np.maximum(at - 1, 0)
            sub_rank[here, left] = np.where(at > 0, self.rank_of(sub[here, left], best), sub_rank[here, left])
            grid[live], rank[live] = sub, sub_rank
        counts = (grid >= 0).sum(1)
        flat = grid[grid >= 0].astype("<u4").tobytes()
        ends = np.cumsum(counts * 4)
        return [flat[a:b] for a, b in zip((ends - counts * 4).tolist(), ends.tolist(), strict=True)]

    def merge_long(self, part: bytes) -> bytes:
        """Merge one long slice with a heap of pairs, so the work grows as n log n."""
        ids = [self.ranks[part[i : i + 1]] for i in range(len(part))]
        before, after = list(range(-1, len(ids) - 1)), [*range(1, len(ids)), -1]
        lookup = self.ranks.get

        def pair(i: int):
            j = after[i]
            r = lookup(self.octets[ids[i]] + self.octets[ids[j]]) if j >= 0 else None
            return None if r is None else (r, i, ids[i], ids[j])

        heap = [p for p in map(pair, range(len(ids))) if p]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else -1
            if j < 0 or ids[i] != a or ids[j] != b:
                continue  # one of the two has merged meanwhile
            ids[i], ids[j], after[i] = r, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (p := pair(k)):
                    heapq.heappush(heap, p)
        return np.array([i for i in ids if i >= 0], "<u4").tobytes()

    def fill(self, missing: list[bytes]) -> None:
        """Merge the slices that the cache lacks."""
        for low, high in ((0, 8), (8, 16), (16, 32), (32, 64)):
            parts = [p for p in missing if low < len(p) <= high]
            for a in range(0, len(parts), 1 << 14):
                chunk = parts[a : a + (1 << 14)]
                self.cache.update(zip(chunk, self.merge_many(chunk), strict=True))
        for p in missing:
            if len(p) > 64:
                self.cache[p] = self.merge_long(p)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text as little-endian unsigned 32-bit integers."""
        parts, first = slices(texts)
        if len(self.cache) > CACHE_SLICES:
            self.cache.clear()
        found = list(map(self.cache.get, parts))
        if None in found:
            gaps = [i for i, f in enumerate(found) if f is None]
            self.fill(list({parts[i] for i in gaps}))
            for i in gaps:
                found[i] = self.cache[parts[i]]
        return [b"".join(found[a:b]) for a, b in zip(first, first[1:], strict=False)]

    def lengths(self, ids: bytes) -> np.ndarray:
        """Octets that each token stands for; their running sum gives the offset of each token in the text."""
        return self.sizes[np.frombuffer(ids, "<u4")]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.octets.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    """One per worker, kept between its tasks; these empty its cache, since the worker waits or does other work afterwards."""
    return Vocabulary(path)


SCHEMA = "doc_id long, n_tokens long, ids binary, offsets binary"


def encode_documents(docs: DataFrame, path: str, offsets: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text: doc_id, n_tokens, ids, offsets.

    ``ids`` are little-endian unsigned 32-bit integers; ``offsets`` are little-endian signed 64-bit
    octet offsets, one more than there are tokens: token i covers octets offsets[i] to offsets[i + 1].
    """

    def run(batches):
        with vocabulary(path) as vocab:
            for batch in batches:
                texts = [t or "" for t in batch.column(1).to_pylist()]
                for a, b in groups_of([len(t) for t in texts], GROUP_CHARS):
                    ids = vocab.encode(texts[a:b])
                    at = [np.concatenate([[0], np.cumsum(vocab.lengths(i))]).astype("<i8").tobytes() if offsets else None for i in ids]
                    columns = [batch.column(0).slice(a, b - a), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(at, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "offsets"])

    return map_batches(id_and_text(docs, id_col, text_col), run, SCHEMA)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """Back from ``ids`` to octets: doc_id, data."""

    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            data = [vocab.decode(i or b"") for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, data binary")


def round_trip(docs: DataFrame, path: str, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode and digest in one pass over the rows: doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids)."""

    def run(batches):
        with vocabulary(path) as vocab:
            for batch in batches:
                texts = [t or "" for t in batch.column(1).to_pylist()]
                for a, b in groups_of([len(t) for t in texts], GROUP_CHARS):
                    ids = vocab.encode(texts[a:b])
                    columns = [
                        batch.column(0).slice(a, b - a),
                        pa.array([len(i) // 4 for i in ids], pa.int64()),
                        pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
                        pa.array([hashlib.sha256(vocab.decode(i)).hexdigest() for i in ids]),
                        *([pa.array(ids, pa.binary())] if keep_ids else []),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * keep_ids])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids
    return map_batches(id_and_text(docs, id_col, text_col), run, schema)

"""Language identification by partial matching: one byte context tree per language, exact code lengths.

Training counts, for each language, which byte follows each context of up to ``ORDER`` bytes. A context
that was seen n times with q different successors codes a successor seen c times with c / (n + q), and
escapes to the context one byte shorter with q / (n + q); below the empty context all 256 bytes are
alike. Statistics are frozen, so the code length of a byte depends on the bytes before it only, and the
code length of a text is a sum over its bytes. The language with the shortest code wins.

All languages' trees become one table per order: its rows are the strings that occur in any language,
its columns the code length and the escape length in each language. A text walks the tables through
dense child arrays (row of a string and next byte to row of the longer string), so scoring is a few
array lookups per byte, for all texts of a batch at once.

Results in odd cases: a null text, or one without a letter, is ``und`` with score 0; equal code lengths
go to the language that comes first in the alphabet; without training rows everything is ``und``;
repeated rows are scored alike and count as often as they occur; an empty table gives an empty result.
Very long texts are scored whole. Extra input columns are not carried along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.llm.common import groups_of, map_batches

ORDER = 3  # bytes of context
TRAIN_DOCS = 1500  # training texts of each language, at most; chosen by a hash of their ids
GROUP_BYTES = 1 << 20


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The octets of all texts in a row, and where each begins (one more at the end)."""
    data = [t.encode("utf-8") for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)


def codes(octets: np.ndarray, offsets: np.ndarray, length: int) -> np.ndarray:
    """Strings of ``length`` bytes as numbers, for each text's positions that have that many bytes."""
    n = len(octets) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out = (out << np.uint64(8)) | octets[k : k + n]
    crosses = np.zeros(n + length, bool)
    for k in range(1, length):
        crosses[np.maximum(offsets[1:-1] - k, 0)] = True
    return out[~crosses[:n]] if length > 1 else out


def count_strings(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, length, code, n: how often each string of up to ``order + 1`` bytes occurs. Input: lang, text."""

    def run(batches):
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                own = [t for t, x in zip(texts, langs, strict=True) if x == lang]
                for a, b in groups_of([len(t) for t in own], 4 * GROUP_BYTES):
                    octets, offsets = joined(own[a:b])
                    for length in range(1, order + 2):
                        code, n = np.unique(codes(octets, offsets, length), return_counts=True)
                        columns = [pa.array([lang] * len(code), pa.string()), pa.array(np.full(len(code), length, np.int32)), pa.array(code.astype(np.int64)), pa.array(n.astype(np.int64))]
                        yield pa.RecordBatch.from_arrays(columns, ["lang", "length", "code", "n"])

    counted = map_batches(docs.select("lang", "text"), run, "lang string, length int, code long, n long")
    return counted.groupBy("lang", "length", "code").agg(F.sum("n").alias("n"))


class Model:
    """Frozen statistics: for each string length a sorted list of strings, and per language the code length of its
    last byte after the bytes before, and the length of the escape from it as a context."""

    def __init__(self, rows: list[tuple[str, int, int, int]], order: int = ORDER):
        self.order = order
        self.langs = sorted({r[0] for r in rows})
        column = {x: i for i, x in enumerate(self.langs)}
        width = len(self.langs)
        counts, self.strings = [], []
        for length in range(1, order + 2):
            own = [r for r in rows if r[1] == length]
            strings = np.unique(np.array([r[2] for r in own], np.int64))
            table = np.zeros((len(strings), width))
            if own:
                table[np.searchsorted(strings, [r[2] for r in own]), [column[r[0]] for r in own]] = [r[3] for r in own]
            self.strings.append(strings)
            counts.append(table)
        # As a context, a string is coded by the sums over the strings one byte longer.
        self.escapes, self.cost = [], []
        totals, kinds = counts[0].sum(0)[None, :], (counts[0] > 0).sum(0)[None, :]
        parents = np.zeros(len(self.strings[0]), np.int64)
        shorter = np.full((256, width), 8.0)  # bits of a byte below the empty context, by byte
        suffix = self.strings[0]
        for length in range(1, order + 2):
            table, strings = counts[length - 1], self.strings[length - 1]
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(totals > 0, -np.log2(kinds / (totals + kinds)), 0.0)  # an unseen context costs nothing to leave
                own = -np.log2(table / (totals + kinds)[parents])
            cost = np.where(table > 0, own, escape[parents] + shorter[suffix])
            self.escapes.append(escape)
            self.cost.append(cost)
            if length <= order:
                following = self.strings[length]
                up = np.searchsorted(strings, following >> 8) if len(following) else np.empty(0, np.int64)
                totals, kinds = np.zeros_like(table), np.zeros_like(table)
                np.add.at(totals, up, counts[length])
                np.add.at(kinds, up, (counts[length] > 0).astype(float))
                parents = up
                suffix = self.row_of(length, following & ((1 << (8 * length)) - 1))
                shorter = cost
        self.children = self.child_tables()

    def row_of(self, length: int, code: np.ndarray) -> np.ndarray:
        """Row of each string; every tail of a counted string was counted itself."""
        return np.searchsorted(self.strings[length - 1], code)

    def child_tables(self) -> list[np.ndarray]:
        """For each length the row of (row of a string, next byte) among strings one longer; -1 if it never occurred."""
        out = [np.full(256, -1, np.int32)]
        out[0][self.strings[0]] = np.arange(len(self.strings[0]))
        for length in range(1, self.order + 1):
            strings, longer = self.strings[length - 1], self.strings[length]
            table = np.full(len(strings) * 256, -1, np.int32)
            if len(longer):
                table[np.searchsorted(strings, longer >> 8) * 256 + (longer & 255)] = np.arange(len(longer))
            out.append(table)
        return out

    def bits(self, texts: list[str]) -> np.ndarray:
        """Code length in bits of each text in each language."""
        octets, offsets = joined(texts)
        out = np.zeros((len(texts), len(self.langs)))
        if not len(octets) or not self.langs:
            return out
        n = len(octets)
        since = np.arange(n) - np.repeat(offsets[:-1], np.diff(offsets))  # bytes before this one in its text
        rows = [self.children[0][octets]]  # of the string of length 1, 2, ... that ends here
        for length in range(1, self.order + 1):
            before = np.full(n, -1, np.int32)
            before[1:] = rows[-1][:-1]
            known = (before >= 0) & (since >= length)
            step = np.full(n, -1, np.int32)
            step[known] = self.children[length][before[known].astype(np.int64) * 256 + octets[known]]
            rows.append(step)
        cost = np.zeros((n, len(self.langs)), np.float32)
        pending = np.arange(n)
        for length in range(self.order + 1, 0, -1):  # from the longest context down, adding the escapes on the way
            row = rows[length - 1][pending]
            seen = row >= 0
            cost[pending[seen]] += self.cost[length - 1][row[seen]]
            pending = pending[~seen]
            if length > 1:  # the context of length - 1 bytes, if it ever occurred, must be left
                have = pending[since[pending] >= length - 1]
                context = rows[length - 2][have - 1]
                have, context = have[context >= 0], context[context >= 0]
                cost[have] += self.escapes[length - 1][context]
            else:
                cost[pending] += self.escapes[0][0] + 8.0
        full = np.flatnonzero(np.diff(offsets))
        out[full] = np.add.reduceat(cost, offsets[full], axis=0, dtype=np.float64)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and its share of the probability that all languages give the text."""
        langs, scores = [], []
        told = [t or "" for t in texts]
        for text, bits in zip(told, self.bits(told), strict=True):
            if not self.langs or not any(map(str.isalpha, text)):
                langs.append("und")
                scores.append(0.0)
                continue
            best = int(bits.argmin())
            langs.append(self.langs[best])
            scores.append(float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum()))
        return langs, scores


def training_rows(docs: DataFrame, at_most: int = TRAIN_DOCS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, text of about ``at_most`` texts of each language (all, if there are fewer), chosen by a hash of the id."""
    known = docs.where(F.col(lang_col).isNotNull() & (F.octet_length(text_col) > 0))
    share = known.groupBy(lang_col).agg(F.count(F.lit(1)).alias("n")).collect()  # a row per language
    chance = F.lit(0.0)
    for lang, n in share:
        chance = F.when(F.col(lang_col) == lang, min(1.0, at_most / n)).otherwise(chance)
    spot = F.pmod(F.xxhash64(F.lit("train"), id_col), F.lit(1 << 30)) / float(1 << 30)
    return known.where(spot < chance).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))


def fit(rows: DataFrame, order: int = ORDER) -> Model:
    """``rows``: lang, text. The strings that occur are gathered on the driver; their number is bounded by the sample."""
    return Model([tuple(r) for r in count_strings(rows, order).collect()], order)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in groups_of([len(t or "") for t in texts], GROUP_BYTES):
                langs, scores = shared.value.predict(texts[a:b])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return map_batches(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, "doc_id long, lang_pred string, score double")

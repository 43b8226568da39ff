import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from tablework.llm import collocations


def brute_force(rows, min_count, inside, top):
    """The contract in plain loops: rows of (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        n[lang] += 0
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = tuple(re.findall("[^ \t]+", piece))
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, words[i : i + k]] += 1
    often = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= min_count}
    inner = defaultdict(int)
    for (lang, g), a in often.items():
        for k in range(2, len(g)):
            for i in range(len(g) - k + 1):
                inner[lang, g[i : i + k]] = max(inner[lang, g[i : i + k]], a)
    out = defaultdict(list)
    for (lang, g), a in often.items():
        if 100 * inner[lang, g] >= inside * a and inner[lang, g]:
            continue
        score, _, left, right = min((int(Fraction(2_000_000 * a, f[lang, g[:k]] + f[lang, g[k:]])), k, f[lang, g[:k]], f[lang, g[k:]]) for k in range(1, len(g)))
        out[lang].append((-score, -a, " ".join(g).encode(), left, right))
    return sorted((lang, i + 1, g.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for i, (s, a, g, left, right) in enumerate(sorted(found)[:top]))


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def random_rows(seed, n):
    draw = random.Random(seed)
    words = ["a", "B", "c", "é", "Ü", "a\xa0b", "ß", "日本"]
    marks = [" ", " ", " ", "  ", "\t", ".", ", ", "\n", "\r\n", "\x0b", "! ?"]
    return [(draw.choice(["en", "de", None, "und"]), "".join(draw.choice(words) + draw.choice(marks) for _ in range(draw.randint(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize("min_count, inside, top", [(3, 80, 2000), (5, 50, 7)])
def test_equals_brute_force(spark, docs_of, min_count, inside, top):
    rows = [*random_rows(min_count, 150), ("en", None), (None, ""), ("fr", " .,"), ("en", "x y z w " * 40), ("en", "x y z w " * 40)]
    docs = docs_of([(i % 100 or None, text, lang, "s") for i, (lang, text) in enumerate(rows)]).withColumnRenamed("source", "phrase").withColumnRenamed("n_chars", "A").repartition(5)
    assert rows_of(collocations.collocations(docs, top, min_count, inside)) == brute_force(rows, min_count, inside, top)


def test_small_blocks_change_nothing(spark, docs_of, monkeypatch):
    rows = random_rows(9, 60)
    docs = docs_of([(i, text, lang) for i, (lang, text) in enumerate(rows)]).coalesce(2)
    monkeypatch.setattr(collocations, "BLOCK_CHARS", 300)
    assert rows_of(collocations.collocations(docs, 50, 3)) == brute_force(rows, 3, 80, 50)


def test_tiles_count_every_pair():
    draw = np.random.default_rng(4)
    for side, dense, high in ((4, 1, 40), (8, 3, 9), (16, 100, 300), (512, 8, 5000)):
        x, y = (np.minimum(draw.geometric(0.1, 4000), high).astype(np.int64) * draw.integers(0, 9, 4000) for _ in range(2))
        found = collocations.tile_counts(x, y, side, dense)
        assert {(a, b): n for a, b, n in zip(*(c.tolist() for c in found), strict=True)} == Counter(zip(x.tolist(), y.tolist(), strict=True))
    assert [len(c) for c in collocations.tile_counts(*[np.empty(0, np.int64)] * 2)] == [0, 0, 0]


def test_scores_beyond_64_bits(spark):
    big = 9_000_000_000_000_000
    words = spark.createDataFrame([("en", "x", big, 0)], "lang string, phrase string, a long, id long")
    pair = spark.createDataFrame([("en", "x y", big - 1, 0, [(big, big)])], "lang string, phrase string, a long, id long, cuts array<struct<l: bigint, r: bigint>>")
    (row,) = collocations.scored([words, pair]).collect()
    assert row.score == 2_000_000 * (big - 1) // (2 * big)


def test_empty_and_long(spark, docs_of):
    assert collocations.collocations(docs_of([])).count() == 0
    found = rows_of(collocations.collocations(docs_of([(1, "to be or not " * 30_000, "en")])))
    assert sorted(r[2] for r in found) == ["be or not to", "not to be or", "or not to be", "to be or not"]

import hashlib
import random
import zlib

import numpy as np
import pytest

from tablework.llm import queries, runs

SF = "/root/testdata/sf0.001"


def brute_force(words, min_words, power):
    """All runs by comparing every word with the one q places on, for every q."""
    n, out = len(words), []
    for q in range(1, n // power + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_words, power * q):
                part = words[i : i + length]
                if not any(part[: length - p] == part[p:] for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words, found):
    gone = {k for start, length, q in found for k in range(start + q, start + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def random_words(draw):
    n, k = draw.randint(0, 60), draw.choice([1, 2, 2, 3, 5])
    if draw.random() < 0.5:
        return [str(draw.randrange(k)) for _ in range(n)]
    out = []
    while len(out) < n:
        out += [str(draw.randrange(k)) for _ in range(draw.randint(1, 5))] * draw.randint(1, 6)
    return out


@pytest.mark.parametrize("min_words, power", [(6, 4), (4, 2), (6, 3)])
def test_equals_brute_force(min_words, power):
    draw = random.Random(power)
    many = [random_words(draw) for _ in range(1500)]
    for words, (n, rows, collapsed) in zip(many, runs.analyse([" ".join(w) for w in many], min_words, power), strict=True):
        expected = brute_force(words, min_words, power)
        assert n == len(words) and [tuple(r) for r in rows.tolist()] == expected
        assert collapsed.decode() == collapse(words, expected)


def test_tree_holds_every_suffix():
    draw = random.Random(2)
    for _ in range(200):
        word = [draw.randrange(1, 4) for _ in range(draw.randint(0, 40))] + [0]
        starts, stops, edges = runs.suffix_tree(word, 5)
        for i in range(len(word)):
            node, at = 0, i
            while at < len(word):
                node = edges[node * 5 + word[at]]
                assert word[starts[node] : stops[node]] == word[at : at + stops[node] - starts[node]]
                at += stops[node] - starts[node]
        assert sum(stop == len(word) for stop in stops[1:]) == len(word)


def test_extensions():
    draw = random.Random(3)
    word = [draw.randrange(1, 3) for _ in range(80)] + [0]
    reach = runs.Extensions(word, 3)
    pairs = [(a, b) for a in range(80) for b in range(80) if a != b]
    found = reach.of(*(np.array(x) for x in zip(*pairs, strict=True)))
    for (a, b), n in zip(pairs, found.tolist(), strict=True):
        assert word[a : a + n] == word[b : b + n] and word[a + n] != word[b + n]


def test_long_texts():
    phrase = [str(k % 97) for k in range(4000)]
    (n, rows, _), (_, same, _) = runs.analyse([" ".join(phrase * 5), "w " * 50_000], 6, 4)
    assert n == 20_000 and [0, 20_000, 4000] in rows.tolist()
    assert same.tolist() == [[0, 50_000, 1]]


def test_frame_odd_cases(spark, docs_of):
    texts = [(1, "a b a b a b a b c"), (2, None), (3, ""), (3, ""), (None, " \t\n"), (4, "x x x x x"), (5, "é é é é é é . y y y y y y"), (6, "p\xa0q " * 4)]
    docs = docs_of(texts).withColumnRenamed("lang", "runs").withColumnRenamed("source", "collapsed")
    found = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(docs).collect()), key=str)
    assert found == sorted(
        [
            (1, 9, [(0, 8, 2)], "a b c"),
            (2, 0, [], ""),
            (3, 0, [], ""),
            (3, 0, [], ""),
            (None, 0, [], ""),
            (4, 5, [], "x x x x x"),
            (5, 13, [(0, 6, 1), (7, 6, 1)], "é . y"),
            (6, 4, [], "p\xa0q p\xa0q p\xa0q p\xa0q"),
        ],
        key=str,
    )
    assert runs.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(docs, power=1)


def test_query_equals_brute_force(spark):
    docs = queries.table(spark, SF, "documents").collect()
    found = {r.doc_id: r for r in queries.op13_periodic_runs(spark, SF).collect()}
    assert len(found) == len(docs)
    some = 0
    for d in docs:
        words = [w.decode() for w in (d.text or "").encode().split()]
        h, n = zlib.crc32(str(d.doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        expected = brute_force(words, 6, 4)
        row = found[d.doc_id]
        best = min(expected, key=lambda r: (-r[1], r[0], r[2])) if expected else (None, None, None)
        assert (row.n_runs, row.start, row.length, row.period) == (len(expected), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if expected else None)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in expected).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapse(words, expected).encode()).hexdigest()
        some += bool(expected)
    assert some

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tablework.llm import suffix


def brute(rows, n):
    """{(doc, start, words)} of maximal runs of windows that another id has."""
    holders = defaultdict(set)
    split = {}
    for i, (d, t) in enumerate(rows):
        key = d if d is not None else ("null", t)
        ws = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").replace("\t", " ").replace("\n", " ").split(" ")
        split[key] = [w for w in ws if w]
        for s in range(len(split[key]) - n + 1):
            holders[tuple(split[key][s : s + n])].add(key)
    out = set()
    for key, ws in split.items():
        last = None
        for s in range(len(ws) - n + 1):
            if len(holders[tuple(ws[s : s + n])]) > 1:
                if last is None or s > last + n:
                    start = s
                    out.add((key if not isinstance(key, tuple) else None, start, s + n - start))
                else:
                    out.discard((key if not isinstance(key, tuple) else None, start, last + n - start))
                    out.add((key if not isinstance(key, tuple) else None, start, s + n - start))
                last = s
    return out


def corpus(seed, n=40):
    draw = random.Random(seed)
    pool = [f"w{i}" for i in range(60)]
    shared = [draw.choices(pool, k=draw.choice((20, 49, 50, 51, 60, 64, 120))) for _ in range(8)]
    rows = []
    for i in range(n):
        body = []
        for _ in range(draw.randint(0, 4)):
            body += draw.choices(pool, k=draw.randint(0, 60))
            if draw.random() < 0.5:
                body += draw.choice(shared)
        rows.append((i, draw.choice((" ", "\n", "  ", "\t")).join(body)))
    rows += [(n + i, rows[i][1]) for i in range(5)] + [(n + 9, rows[7][1].upper())]
    for i in range(6):  # near copies
        words = rows[12][1].split()
        if words:
            words[draw.randrange(len(words))] = "changed"
        rows.append((n + 20 + i, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, docs_of, seed):
    rows = corpus(seed) + [(300, None), (301, ""), (None, "x " * 70), (None, "x " * 70), (302, "y " * 500), (303, " ".join(map(str, range(3000)))), (None, " ".join(map(str, range(2900, 2990))))]
    docs = docs_of(rows).withColumnRenamed("lang", "at").withColumnRenamed("source", "h")
    got = {(r.doc_id, r.start_word, r.n_words) for r in suffix.repeated_passages(docs).collect()}
    assert got == brute(rows, 50) and len(got) > 10


def test_empty(spark, docs_of):
    assert suffix.repeated_passages(docs_of([])).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_stream_compares_across_batches_and_marks_ends(size):
    draw = random.Random(size)
    rows = sorted((draw.randint(0, 12), draw.randint(0, 2), k) for k in range(60))
    batches = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows[a : a + size]], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32()))], ["h", "doc", "at"]) for a in range(0, len(rows), size)]
    out = [tuple(r.values()) for b in suffix.shared_in_stream(iter(batches)) for r in b.to_pylist()]
    docs = defaultdict(set)
    for h, d, _ in rows:
        docs[h].add(d)
    ends = {rows[0][0], rows[-1][0]}
    assert sorted(r[:3] for r in out if r[3] == suffix.SHARED) == [r for r in rows if len(docs[r[0]]) > 1]
    assert sorted(r[:3] for r in out if r[3] == suffix.OPEN) == [r for r in rows if len(docs[r[0]]) == 1 and r[0] in ends]
    assert {r[0] for r in out if r[3] == suffix.MARK} == {h for h in ends if len(docs[h]) > 1}


def test_every_window_has_a_minimiser_near_its_beginning():
    words = np.random.default_rng(0).integers(0, 5, 2000).astype(np.uint64)
    at = suffix.minimisers(words, 16, 5)
    last = len(words) - 50
    assert all((at[np.searchsorted(at, s)] - s) < 16 for s in range(last))


def brute_classes(rows, n):
    """{(doc, start): all (doc, start) of runs linked to it by shared windows}."""
    words = {d: t.lower().split() for d, t in rows}
    holders = defaultdict(set)
    for d, ws in words.items():
        for s in range(len(ws) - n + 1):
            holders[tuple(ws[s : s + n])].add(d)
    run_of, head = defaultdict(list), {}
    for d, ws in words.items():
        last = start = None
        for s in range(len(ws) - n + 1):
            window = tuple(ws[s : s + n])
            if len(holders[window]) > 1:
                start = s if last is None or s > last + n else start
                last = s
                run_of[window].append((d, start))
                head.setdefault((d, start), (d, start))
    root = lambda x: x if head[x] == x else root(head[x])
    for runs in run_of.values():
        for r in runs[1:]:
            head[root(r)] = root(runs[0])
    groups = defaultdict(set)
    for r in head:
        groups[root(r)].add(r)
    return {r: groups[root(r)] for r in head}


def test_classes_join_all_documents_that_share_text(spark, docs_of):
    w = [f"w{i}" for i in range(150)]
    header, footer = [f"p{i}" for i in range(60)], [f"q{i}" for i in range(60)]
    texts = [w, w[:100], w[50:], header + footer, ["x"] + header, ["y"] + footer, [f"n{i}" for i in range(120)], ["z"] + [f"n{i}" for i in range(30, 90)]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(100 + i, t) for i, t in corpus(5) if t and len(t.split()) > 60]
    want = brute_classes(rows, 50)
    got = {(r.doc_id, r.start_word): (r.class_id, r.n_docs) for r in suffix.repeated_passages(docs_of(rows)).collect()}
    members = defaultdict(set)
    for place, (name, _) in got.items():
        members[name].add(place)
    assert {place: members[name] for place, (name, _) in got.items()} == want
    assert all(n == len({d for d, _ in members[name]}) for name, n in got.values())
    assert got[0, 0] == got[2, 0] and got[0, 0][1] == 3 and got[4, 1] == got[5, 1] and got[6, 30] == got[7, 1]


def test_negative_and_null_ids(spark, docs_of):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(-5, "a " + passage), (-(1 << 63), "b " + passage), (None, "c " + passage), (None, "d " + passage), (7, "e other")]
    got = suffix.repeated_passages(docs_of(rows)).collect()
    assert sorted((str(r.doc_id), r.start_word, r.n_words, r.n_docs) for r in got) == sorted((str(i), 1, 60, 4) for i, _ in rows[:4])
    assert len({r.class_id for r in got}) == 1

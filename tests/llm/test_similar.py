import random

import numpy as np

from tablework.llm import similar


def signature_rows(spark, sets):
    rows = [(k, len(s), similar.fine_parities(np.array(sorted(s), np.int64)).tolist()) for k, s in enumerate(sets)]
    return spark.createDataFrame(rows, "node long, n long, fine array<bigint>")


def test_fine_parities_never_part_similar_sets(spark):
    draw = random.Random(4)
    number = lambda: draw.getrandbits(64) - (1 << 63)
    sets = []
    for size in (0, 1, 5, 30, 200, 256, 257, 500, 1000, 1030, 4000):
        base = [number() for _ in range(size)]
        for share in (0.0, 0.05, 0.1, 0.2, 0.5):
            sets.append({x if draw.random() >= share else number() for x in base} | {number() for _ in range(int(size * share / 4))})
    nodes = signature_rows(spark, sets)
    pairs = [(a, b) for a in range(len(sets)) for b in range(len(sets)) if a != b]
    found = {tuple(r) for r in similar.within_fine(spark.createDataFrame(pairs, "a long, b long"), nodes, 0.8).collect()}
    true = {(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert true <= found
    wrong = [(a, b) for a, b in found - true if len(sets[a] & sets[b]) < 0.6 * len(sets[a] | sets[b])]
    assert not wrong  # enough bins that unlike sets are told apart, long ones too


def test_checked_decides_exactly_and_serves_a_head_with_many_partners(spark, monkeypatch):
    monkeypatch.setattr(similar, "PARTNERS", 7)
    monkeypatch.setattr(similar, "BROADCAST_ROWS", 0)
    draw = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    texts = [" ".join(base)]
    for k in range(60):
        copy = list(base)
        for at in draw.sample(range(5, 115), draw.randint(0, 9)):
            copy[at] = f"x{k}-{at}"
        texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    keyed = similar.keyed(docs, "doc_id", "text")
    marks = similar.signatures(keyed, 5, 0.8, (np.empty(0, np.int64), np.empty(0, np.int64))).collect()
    node = {r.doc_id: r.node for r in marks}
    nodes = spark.createDataFrame([(r.node, (r.doc_id, r.th), r.odd, r.fine, r.n) for r in marks], "node long, rep struct<doc_id: long, th: long>, odd array<bigint>, fine array<bigint>, n long").dropDuplicates(["node"])
    pairs = spark.createDataFrame([(node[k], node[0]) for k in range(1, 61) if node[k] != node[0]], "a long, b long")
    sets = {k: {tuple(t.split()[i : i + 5]) for i in range(116)} for k, t in enumerate(texts)}
    want = {(node[k], node[0]) for k in range(1, 61) if node[k] != node[0] and len(sets[k] & sets[0]) >= 0.8 * len(sets[k] | sets[0])}
    assert {tuple(r) for r in similar.checked(pairs, keyed, nodes, 5, 0.8).collect()} == want and 5 < len(want) < 55

import random
from collections import Counter

import pytest

from tablework.llm import decontam as D

ITEMS = "item_id long, text string, similarity double"


def words(seed, n):
    draw = random.Random(seed)
    return [f"w{draw.randint(0, 10**6)}" for _ in range(n)]


def bag(ws, size=5):
    size = min(size, len(ws))
    return Counter(tuple(ws[i : i + size]) for i in range(len(ws) - size + 1))


def best(doc, item):
    """Largest weighted similarity of all windows of the item's length, those cut by an end of the document as well."""
    n, size = len(item), min(5, len(item))
    b = bag(item)
    top = 0.0
    for s in range(1 - n, len(doc)):
        win = doc[max(s, 0) : max(s + n, 0)]
        if len(win) >= size:
            a = Counter(tuple(win[i : i + size]) for i in range(len(win) - size + 1))
            if a.keys() & b.keys():
                top = max(top, sum((a & b).values()) / sum((a | b).values()))
    return top


def found(spark, docs_of, docs, items, **more):
    rows = D.contaminated(docs_of(docs).withColumnRenamed("lang", "item_id").withColumnRenamed("source", "text_key"), spark.createDataFrame(items, ITEMS), **more).collect()
    return {(r.doc_id, r.item_id): round(r.similarity, 9) for r in rows}, rows


def test_against_brute_force(spark, docs_of):
    items = [(i, " ".join(words(i, n)), 0.0) for i, n in enumerate((5, 6, 20, 40, 59, 3, 1, 12))]
    items += [(8, "a b a b a b a b a b a b a b a b", 0.0), (9, items[2][1].upper(), 0.0), (10, None, 0.0), (11, " ", 0.0), (None, " ".join(words(99, 9)), 0.0)]
    docs = []
    draw = random.Random(7)
    for i, (_, text, _) in enumerate(items):
        body = (text or "").split()
        for k in range(4):
            changed = [w for w in body]
            for _ in range(k):
                if changed:
                    changed[draw.randrange(len(changed))] = f"x{draw.randint(0, 99)}"
            docs.append((len(docs), " ".join([*words(100 + i, draw.choice((0, 3, 80))), *changed, *words(200 + i, draw.choice((0, 50)))])))
    docs += [(500, None), (501, ""), (502, "a b " * 400), (503, " ".join(words(1, 2000)) + " " + items[3][1]), (503, " ".join(words(1, 2000)) + " " + items[3][1]), (None, items[4][1])]
    got, rows = found(spark, docs_of, docs, items)
    want = {}
    for d, text in docs:
        for j, item, _ in items:
            ws = (item or "").lower().split()
            if ws and (s := best((text or "").lower().split(), ws)) >= 0.8:
                want[d, j] = round(s, 9)
    assert got == want and len(want) > 15
    assert len(rows) == len(got)  # equal rows give one result
    assert all(r.distance <= D.RADIUS for r in rows)


def test_passages_in_another_order_are_found(spark, docs_of):
    item = words(5, 100)
    docs = [
        (1, " ".join([*words(6, 40), *item[50:], *item[:50], *words(7, 40)])),  # halves swapped
        (2, " ".join([*item[70:], *item[:70]])),
        (3, " ".join([*words(8, 9), *item[60:], *item[30:60], *item[:30]])),
        (4, " ".join(item[9:])),  # cut by the beginning of the document
        (5, " ".join([*words(9, 30), *item[:90]])),
        (6, " ".join([*item[:40], *words(10, 30), *item[40:]])),
    ]
    got, _ = found(spark, docs_of, docs, [(1, " ".join(item), 0.0)])
    want = {(d, 1): round(s, 9) for d, t in docs if (s := best(t.split(), item)) >= 0.8}
    assert got == want and {(1, 1), (2, 1), (3, 1), (4, 1), (5, 1)} <= set(got) and (6, 1) not in got


def test_blocks_guarantee_the_radius(spark):
    draw = random.Random(3)
    pairs = []
    for bits in range(0, 30):
        for _ in range(20):
            x = draw.getrandbits(64)
            pairs.append((x, x ^ sum(1 << b for b in draw.sample(range(64), bits)), bits))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    frame = spark.createDataFrame([(signed(a), signed(b), n) for a, b, n in pairs], "a long, b long, n int")
    F = D.F
    shared = F.size(F.array_intersect(D.block_keys(F.col("a"), 24), D.block_keys(F.col("b"), 24))) > 0
    rows = frame.select("n", shared.alias("hit"), D.first_common_block(F.col("a").bitwiseXOR(F.col("b")), 24).isNotNull().alias("first")).collect()
    assert all(r.hit for r in rows if r.n <= 24) and all(r.hit == r["first"] for r in rows)


def test_simhash_counts_bits(spark):
    draw = random.Random(1)
    hashes = [draw.getrandbits(64) for _ in range(31)] + [5] * 10
    signed = [x - (1 << 64) if x >> 63 else x for x in hashes]
    got = spark.createDataFrame([(signed,)], "h array<bigint>").select(D.simhash(D.F.col("h"))).first()[0]
    assert got & (2**64 - 1) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_remove(spark, docs_of):
    item = " ".join(words(1, 30))
    docs = docs_of([(1, "before " + item), (2, "clean " * 20), (None, item), (None, "clean"), (3, None)]).withColumnRenamed("lang", "text_key")
    kept = D.remove(docs, spark.createDataFrame([(1, item, 0.0)], ITEMS))
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(2, "clean " * 20), (None, "clean"), (3, None)], key=repr)


@pytest.mark.parametrize("docs, items", [([], [(1, "a b c d e f", 0.0)]), ([(1, "a b c d e f")], []), ([], [])])
def test_empty(spark, docs_of, docs, items):
    assert found(spark, docs_of, docs, items)[0] == {}

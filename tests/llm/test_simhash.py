import random

import pytest
import xxhash

from tablework.llm import simhash


def brute_fingerprint(text, size=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    windows = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in windows]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=3):
    """{doc_id: smallest id reachable} from [(doc_id, fingerprint)]."""
    label = list(range(len(prints)))
    root = lambda i: i if label[i] == i else root(label[i])
    for i, (_, x) in enumerate(prints):
        for j in range(i):
            if (x ^ prints[j][1]).bit_count() <= radius:
                label[root(i)] = root(j)
    heads = {}
    for i, (doc, _) in enumerate(prints):
        heads[root(i)] = min(heads.get(root(i), doc), doc)
    return [heads[root(i)] for i in range(len(prints))]


def texts(seed, n=60):
    draw = random.Random(seed)
    pool = [f"w{i}" for i in range(300)]
    out = []
    for _ in range(n):
        base = draw.choices(pool, k=draw.randint(0, 400))
        out.append(" ".join(base))
        for _ in range(draw.choice((0, 0, 1, 4))):
            copy = list(base)
            for _ in range(draw.randint(0, 3)):
                if copy:
                    copy[draw.randrange(len(copy))] = draw.choice(pool)
            out.append("\n".join(copy).upper() if draw.random() < 0.3 else "  ".join(copy))
    return out


def test_against_brute_force(spark, docs_of):
    rows = list(enumerate([*texts(3), None, "", " \t", "One", "one", "one two"]))
    docs = docs_of(rows).withColumnRenamed("lang", "component_id").withColumnRenamed("source", "fp")
    found = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in simhash.near_duplicates(docs).collect()}
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    assert {i: f for i, (f, _) in found.items()} == dict(prints)
    assert [found[i][1] for i, _ in rows] == brute_components(prints)


def test_links_find_every_pair(spark):
    draw = random.Random(8)
    values = {0, 2**64 - 1}
    while len(values) < 600:
        x = draw.getrandbits(64)
        values.add(x)
        for bits in (1, 2, 3, 4, 5):
            values.add(x ^ sum(1 << b for b in draw.sample(range(64), bits)))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    ordered = sorted(values, key=signed)
    want = {(signed(a), signed(b)) for i, a in enumerate(ordered) for b in ordered[i + 1 :] if (a ^ b).bit_count() <= 3}
    frame = spark.createDataFrame([(signed(v),) for v in ordered], "fp long")
    assert {tuple(r) for r in simhash.links(frame).collect()} == want and len(want) > 100


def test_radius_beyond_the_grid_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 4)


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (500, 502)], "a long, b long")
    found = {r.node: r.root for r in simhash.components(edges).collect()}
    assert found == {**{i: 0 for i in range(201)}, 500: 500, 501: 500, 502: 500}


def test_keep_one(spark, docs_of):
    base = " ".join(f"w{i}" for i in range(300))
    rows = [(5, base), (2, base.upper()), (2, base.upper()), (9, "else one two three"), (None, base), (None, None), (None, ""), (7, "other")]
    docs = docs_of(rows).withColumnRenamed("n_chars", "fp")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)[:3] == sorted([(2, base.upper()), (7, "other"), (9, "else one two three")], key=repr)
    assert kept.count() == 4  # and one of the two empty texts, whose ids are null


def test_empty(spark, docs_of):
    assert simhash.near_duplicates(docs_of([])).count() == 0
    assert simhash.keep_one(docs_of([])).count() == 0


def jaccard(a, b, size=5):
    x, y = (set(simhash.shingle_hashes(t, size).tolist()) for t in (a, b))
    return len(x & y) / max(1, len(x | y))


def test_keep_one_by_similarity(spark, docs_of):
    draw = random.Random(17)
    rows, groups = [], []
    for g in range(25):
        base = [f"w{draw.randint(0, 10**6)}" for _ in range(draw.randint(60, 300))]
        members = [" ".join(base)]
        for _ in range(g % 4):
            copy = list(base)
            for _ in range(draw.randint(1, 3)):
                copy[draw.randrange(len(copy))] = "x"
            members.append(" ".join(copy))
        members.append(" ".join(base[: len(base) // 2] + [f"v{draw.randint(0, 10**6)}" for _ in base]))  # half of it only
        groups.append([])
        for t in members:
            groups[-1].append((len(rows), t))
            rows.append((len(rows), t))
    kept = {r.doc_id for r in simhash.keep_one(docs_of(rows), size=5, similarity=0.8).collect()}
    for members in groups:
        label = {i: i for i, _ in members}
        for i, a in members:
            for j, b in members:
                if j < i and jaccard(a, b) >= 0.8:
                    old, new = label[i], label[j]
                    label = {k: min(old, new) if v in (old, new) else v for k, v in label.items()}
        assert {i for i, _ in members if i in kept} == set(label.values())
    assert len(kept) < len(rows) - 20


def test_copies_that_only_their_original_links(spark, docs_of):
    draw = random.Random(23)
    base = [f"w{i}" for i in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 1001):
        copy = list(base)
        for k in draw.sample(range(6, 294, 6), 5):  # far enough apart that no shingle holds two of them
            copy[k] = f"x{i}-{k}"
        rows.append((i, " ".join(copy)))
    assert all(jaccard(rows[0][1], t) >= 0.8 for _, t in rows) and jaccard(rows[1][1], rows[2][1]) < 0.8
    assert [r.doc_id for r in simhash.keep_one(docs_of(rows), size=5, similarity=0.8).collect()] == [0]


def test_repeated_lines_do_not_make_unlike_pages_one(spark, docs_of):
    rows = []
    for i in range(4):  # the line fills most of every page, so the pages share their fingerprints
        rows.append((i, " ".join([*(f"p{i}-{k}" for k in range(50)), *["the same short line here"] * 200])))
    rows.append((9, rows[3][1] + " the same short line here"))
    assert len({brute_fingerprint(t, 5) for _, t in rows}) == 1 and jaccard(rows[0][1], rows[1][1]) < 0.1
    assert sorted(r.doc_id for r in simhash.keep_one(docs_of(rows), size=5, similarity=0.8).collect()) == [0, 1, 2, 3]


def test_repeats_do_not_part_similar_sets(spark, docs_of):
    rows = []
    for g in range(12):
        page = " ".join(f"g{g}-{k}" for k in range(400))
        rows += [(2 * g, page), (2 * g + 1, " ".join([page, *["a line of five words"] * 200]))]
    assert all(jaccard(rows[2 * g][1], rows[2 * g + 1][1]) > 0.95 for g in range(12))
    assert any((brute_fingerprint(rows[2 * g][1], 5) ^ brute_fingerprint(rows[2 * g + 1][1], 5)).bit_count() > 26 for g in range(12))
    assert sorted(r.doc_id for r in simhash.keep_one(docs_of(rows), size=5, similarity=0.8).collect()) == list(range(0, 24, 2))

import hashlib
import os
import random

import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as entry
import corpus_pipeline as P
from tablework.llm import common, queries
from tests.llm.test_bpe import library  # noqa: F401
from tests.llm.test_pii import brute as pii_spans
from tests.llm.test_simhash import brute_components, brute_fingerprint, jaccard

SF = "/root/testdata/sf0.001"


def test_everything_is_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(queries.SQL) <= set(names) and len(P.STAGES) == 5


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with bad, copied, contaminated and private documents among clean ones."""
    draw = random.Random(11)
    word = lambda: "".join(draw.choice("abcdeghilmnorstu") for _ in range(draw.randint(3, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    item = text(30)
    docs, labels = [], []
    for i in range(300):
        bad = i % 5 == 0
        body = text(draw.randint(60, 120))
        docs.append((i, " ".join(f"{w.upper()}!!" for w in body.split()) if bad else body))
        labels.append((i, int(not bad), 0))
    docs += [(400, docs[1][1]), (401, docs[2][1].upper().lower()), (402, f"{text(50)} {item} {text(20)}"), (403, f"{text(70)} ann.lee@mail.example.com {text(20)}")]
    path = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "en", f"src{i % 7}", len(t)) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, dict(docs)


def test_stages_against_brute_force(spark, folder, library):  # noqa: F811
    path, texts = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, left = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in P.STAGES[:-1]:
        out = common.stored(stage(spark, docs, path), "test-stage")
        assert out.columns == columns
        found = {r.doc_id: r.text for r in out.collect()}
        assert out.count() == len(found)
        if name == "quality_classifier":
            want = {i: t for i, t in left.items() if i >= 300 or i % 5}
        elif name == "simhash_near_dedup":
            ids = sorted(left)
            want = {i: left[i] for k, i in enumerate(ids) if all(jaccard(left[i], left[j]) < 0.8 for j in ids[:k])}
            assert 400 not in want and 1 in want
        elif name == "benchmark_decontamination":
            want = {i: t for i, t in left.items() if i != 402}
        else:
            want = {i: t.replace("ann.lee@mail.example.com", "[EMAIL]") for i, t in left.items()}
            assert any(pii_spans(t) for t in left.values()) and not any(pii_spans(t) for t in found.values())
        assert found == want, name
        docs, left = out, found
    rows = {r.doc_id: r for r in P.byte_bpe(spark, docs, path).collect()}
    assert set(rows) == set(left)
    for i, t in left.items():
        assert np.frombuffer(rows[i].ids, "<u4").tolist() == library.encode_ordinary(t)
        assert rows[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_run_is_its_stages(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in P.STAGES:
        docs = common.stored(stage(spark, docs, path), "test-run")
    pick = lambda df: sorted(tuple(r) for r in df.select("doc_id", "n_tokens", "ids_sha256").collect())
    assert pick(P.run(spark, path)) == pick(docs)


def test_stages_take_empty_tables(spark, docs_of, folder):
    path, _ = folder
    docs = docs_of([])
    for _, stage in P.STAGES:
        docs = common.stored(stage(spark, docs, path), "test-empty")
        assert docs.count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")
def test_registered_queries_against_libraries(spark, library):  # noqa: F811
    import zlib

    from tokenizers import Tokenizer

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in queries.op7_byte_bpe(spark, SF).collect()}
    for i, t in docs.items():
        ids = np.array(library.encode_ordinary(t), "<u4")
        assert (rows[i].n_tokens, rows[i].ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start = 0
    for r in sorted(queries.op2_simple8b(spark, SF).collect(), key=lambda r: r.doc_id):
        ids = np.array([*tokenizer.encode(docs[r.doc_id], add_special_tokens=False).ids, 2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    prints = sorted((i, brute_fingerprint(t)) for i, t in docs.items())
    want = {i: (f"{f:016x}", c) for (i, f), c in zip(prints, brute_components(prints), strict=True)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op6_simhash_popcount(spark, SF).collect()} == want

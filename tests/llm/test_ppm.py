import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tablework.llm import ppm

TRAIN = [("de", "der die das und öl"), ("en", "the of and that"), ("en", "then than"), ("fr", "été là")]


def brute_bits(train, lang, text, order):
    """Code length by walking the contexts of every byte."""
    follow = defaultdict(Counter)
    for x, t in train:
        data = t.encode()
        if x == lang:
            for i in range(len(data)):
                for k in range(min(i, order) + 1):
                    follow[data[i - k : i]][data[i]] += 1
    total = 0.0
    data = text.encode()
    for i, byte in enumerate(data):
        for k in range(min(i, order), -1, -1):
            seen = follow.get(data[i - k : i])
            if seen is None:
                continue  # this context never occurred
            n, q = sum(seen.values()), len(seen)
            if byte in seen:
                total -= math.log2(seen[byte] / (n + q))
                break
            total -= math.log2(q / (n + q))
        else:
            total += 8.0
    return total


def rows_of(train, order):
    counts = Counter()
    for lang, t in train:
        data = t.encode()
        for length in range(1, order + 2):
            for i in range(len(data) - length + 1):
                counts[lang, length, int.from_bytes(data[i : i + length], "big")] += 1
    return [(*k, n) for k, n in counts.items()]


@pytest.mark.parametrize("order", [0, 1, 2, 3])
def test_code_lengths_against_brute_force(order):
    draw = random.Random(order)
    texts = ["".join(draw.choice(["a", "th", "e", "é", "und ", " ", "🙂", "xyz", "der", "été"]) for _ in range(draw.randint(0, 20))) for _ in range(200)]
    model = ppm.Model(rows_of(TRAIN, order), order)
    want = [[brute_bits(TRAIN, x, t, order) for x in model.langs] for t in texts]
    assert np.allclose(model.bits(texts), want, rtol=1e-4)


def test_counting_in_spark(spark):
    train = [*TRAIN, ("en", "x"), ("en", "ab")]
    got = {tuple(r) for r in ppm.count_strings(spark.createDataFrame(train, "lang string, text string"), 3).collect()}
    assert got == set(rows_of(train, 3))


def test_predict(spark, docs_of):
    docs = docs_of([(1, "that the", "xx"), (2, "und der", None), (3, None), (4, "12 !"), (5, ""), (6, "été"), (6, "été"), (None, "than " * 30000)]).withColumnRenamed("source", "score")
    model = ppm.fit(spark.createDataFrame(TRAIN, "lang string, text string"))
    rows = sorted(((r.doc_id or 0, r.lang_pred, r.score) for r in ppm.predict(docs, model).collect()), key=repr)
    assert [(i, x) for i, x, _ in rows] == [(0, "en"), (1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "fr"), (6, "fr")]
    assert all((s == 0) == (x == "und") and 0 <= s <= 1 for _, x, s in rows)
    assert ppm.predict(docs.limit(0), model).count() == 0


def test_nothing_learned(spark, docs_of):
    model = ppm.fit(ppm.training_rows(docs_of([(1, "a", None), (2, None, "en"), (3, "", "de")])))
    assert [r.lang_pred for r in ppm.predict(docs_of([(1, "abc")]), model).collect()] == ["und"]


def test_training_sample_is_bounded(spark, docs_of):
    docs = docs_of([(i, "word", "en" if i % 4 else "de") for i in range(4000)])
    sample = dict(ppm.training_rows(docs, 300).groupBy("lang").count().collect())
    assert all(200 < n < 400 for n in sample.values()) and len(sample) == 2
    assert ppm.training_rows(docs, 10**6).count() == 4000


def test_held_out_accuracy(spark):
    import os

    from tablework.llm import queries

    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("needs the generated tables")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = queries.op4_language_ppm(spark, sf).where("held_out").join(docs, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows) and len(rows) > 150


def test_empty_table(spark, docs_of):
    model = ppm.fit(ppm.training_rows(docs_of([])))
    assert ppm.predict(docs_of([]), model).count() == 0
    taught = ppm.fit(ppm.training_rows(docs_of([(1, "one two three", "en")])))
    assert ppm.predict(docs_of([]), taught).count() == 0

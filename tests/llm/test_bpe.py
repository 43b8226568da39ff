import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tablework.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


PIECES = ["'s", "'re", "'", "s", "re", "ll", "ve", " ", "  ", "\n", "\t", "a", "É", "１", "²", "!", "'t", "　", "\x85", "日本", "🙂", "́", "I'm", "\x1c", "​", "Ⅷ", "\xa0"]


def test_equals_library_on_random_texts(library):
    draw = random.Random(5)
    texts = ["".join(draw.choice(PIECES) for _ in range(draw.randint(0, 14))) for _ in range(5000)]
    assert [ids_of(i) for i in bpe.vocabulary(PATH).encode(texts)] == [library.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("text", ["ab" * 30000, "x" * 5000, "a b " * 20000, "é" * 999 + "'ll" * 300, " " * 4000, "\n" * 777 + "a"])
def test_equals_library_on_long_texts(library, text):
    assert ids_of(bpe.vocabulary(PATH).encode(["", text, "b"])[1]) == library.encode_ordinary(text)


def test_cache_is_bounded_and_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_SLICES", 3)
    vocab = bpe.Vocabulary(PATH)
    for text in ("one two three four five", "six seven eight", "one nine"):
        assert ids_of(vocab.encode([text])[0]) == library.encode_ordinary(text)


def test_frame(spark, docs_of, library):
    texts = [(1, "Hello world, it's 42!"), (2, None), (3, ""), (3, ""), (None, "día\n"), (4, "y" * 100_000)]
    docs = docs_of(texts).withColumnRenamed("lang", "ids").withColumnRenamed("source", "offsets")
    found = {r.doc_id: r for r in bpe.encode_documents(docs, PATH).collect()}
    assert bpe.encode_documents(docs, PATH).count() == len(texts)
    for i, text in texts:
        row = found[i]
        octets = (text or "").encode()
        assert ids_of(row.ids) == library.encode_ordinary(text or "")
        at = np.frombuffer(row.offsets, "<i8").tolist()
        assert b"".join(octets[a:b] for a, b in zip(at, at[1:], strict=False)) == octets and len(at) == row.n_tokens + 1
    assert {r.doc_id: bytes(r.data) for r in bpe.decode_documents(bpe.encode_documents(docs, PATH), PATH).collect()} == {i: (t or "").encode() for i, t in texts}
    trip = {r.doc_id: r for r in bpe.round_trip(docs, PATH).collect()}
    assert all(trip[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest() for i, t in texts)
    assert all(trip[i].ids_sha256 == hashlib.sha256(found[i].ids).hexdigest() for i, _ in texts)
    assert bpe.round_trip(docs.limit(0), PATH).count() == 0


def test_tasks_leave_no_merged_slices_in_their_workers(spark, docs_of):
    docs = docs_of([(i, f"slice{i} alone") for i in range(500)])

    def held(batches):
        for batch in batches:
            yield batch.from_arrays([[len(bpe.vocabulary(PATH).cache)] * batch.num_rows], ["n"])

    for encode in (bpe.round_trip, bpe.encode_documents):
        assert encode(docs, PATH).count() == 500
        encode(docs, PATH).collect()
        assert {r.n for r in docs.select("doc_id").mapInArrow(held, "n long").collect()} == {0}

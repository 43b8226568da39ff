import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tablework.llm import simple8b as S
from tablework.session import scratch_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")


@given(st.lists(st.integers(0, 64).flatmap(lambda b: st.integers(0, max(0, 2**b - 1))), max_size=400), st.integers(1, 40))
@settings(max_examples=150, deadline=None)
def test_pack_round_trip(values, times):
    flat = np.array(values * times, np.uint64)
    assert (S.unpack(*S.pack(flat), len(flat)) == flat).all()


@pytest.mark.parametrize("n", [0, 1, 119, 120, 121, 1023, 1024, 1025, 5000])
def test_runs_of_zeros_and_wide_values(n):
    for value in (0, 1, 2**60 - 1, 2**60, 2**64 - 1):
        flat = np.full(n, value, np.uint64)
        assert (S.unpack(*S.pack(flat), n) == flat).all()


def test_small_ids_take_little_room():
    assert len(S.pack(np.zeros(1024, np.uint64))[0]) == 9  # 120 to a word
    assert len(S.pack(np.full(1020, 3, np.uint64))[0]) == 34  # 30 to a word


def test_blocks_decode_alone():
    flat = np.random.default_rng(0).integers(0, 50000, 3000).astype(np.uint64)
    words, escapes, offsets = S.pack(flat)
    a, b = int(offsets[1, 0]), int(offsets[2, 0])
    alone = S.unpack(words[a:b], escapes, np.zeros((1, 2), np.uint64), 1024)
    assert (alone == flat[1024:2048]).all()


def test_broken_files_are_refused():
    whole = S.segment([1], [np.arange(5)]) + S.TRAILER.encode()
    assert [x[1].tolist() for x in S.segments(whole * 2)] == [[0, 1, 2, 3, 4]] * 2
    with pytest.raises(ValueError):
        list(S.segments(whole[:-8] + b"x" * 8))


def test_files(spark, docs_of):
    texts = [(5, "Hello world, it's 42!"), (2, None), (9, ""), (9, "again"), (None, "día\n"), (4, "word <|endoftext|> " * 5000), (3, "a\r\nS8B-END\n")]
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    folder = scratch_dir(spark, "test-ids")
    docs = docs_of(texts).withColumnRenamed("lang", "start").withColumnRenamed("source", "ids")
    S.write_token_files(docs, folder, PATH, end_id=2)
    rows = S.with_starts(S.read_token_files(spark, folder, with_ids=True)).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 2, 3, 4, 5, 9, 9]
    want = {(i, t): [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in texts}
    start = 0
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids in [v for (i, _), v in want.items() if i == r.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(r.ids))
        start += len(ids)
    assert start == sum(map(len, want.values()))


def test_empty_table(spark, docs_of):
    folder = scratch_dir(spark, "test-ids")
    S.write_token_files(docs_of([]), folder, PATH, end_id=2)
    assert S.with_starts(S.read_token_files(spark, folder)).count() == 0


def test_added_tokens_inside_texts_as_the_library_finds_them(spark, docs_of):
    texts = [(1, "word <|endoftext|> x"), (2, "plain words only"), (3, "<|endoftext|><|endoftext|> a<|endoftext|>\n b"), (4, None), (5, "<|endoftext| >")]
    tokenizer = Tokenizer.from_file(PATH)
    folder = scratch_dir(spark, "test-ids")
    S.write_token_files(docs_of(texts), folder, PATH, end_id=2, added_tokens=True)
    rows = S.with_starts(S.read_token_files(spark, folder, with_ids=True)).orderBy("start").collect()
    want = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for _, t in texts]
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in rows] == want and 50256 in want[0]
    assert [r.start for r in rows] == [sum(map(len, want[:i])) for i in range(len(want))]


def test_query_finds_added_tokens(spark, docs_of, tmp_path):
    from tablework.llm import queries

    docs_of([(1, "word <|endoftext|> x"), (2, "y")]).write.parquet(f"{tmp_path}/documents.parquet")
    ids = [*Tokenizer.from_file(PATH).encode("word <|endoftext|> x", add_special_tokens=False).ids, 2]
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op2_simple8b(spark, str(tmp_path)).collect()}
    assert found[1] == (0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) and found[2][0] == len(ids)


def test_files_are_ordered_by_number_beyond_five_digits(spark, monkeypatch):
    numbers = [0, 1, 2, 99_998, 99_999, 100_000, 100_001, 1_000_000]
    names = {k: f"part-{k:05d}-abc-c000.txt" for k in numbers}
    assert sorted(names.values()) != [names[k] for k in numbers]
    for group in (1, 2, 1000):
        monkeypatch.setattr(S, "FILE_GROUP", group)
        per_file = spark.createDataFrame([(names[k], k % 7 + 1) for k in numbers], "file string, in_file long")
        found = {r.file: r.base for r in S.file_starts(per_file).collect()}
        total = 0
        for k in numbers:
            assert found[names[k]] == total
            total += k % 7 + 1
    assert S.file_starts(per_file.limit(0)).count() == 0

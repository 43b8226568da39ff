import hashlib

from tablework.llm import warc
from tablework.llm.common import stored
from tablework.session import scratch_dir

PAGES = "page_id long, url string, html string, payload_digest string, file string"
LONG = "é" * 60  # 120 octets


def there_and_back(spark, rows, **more):
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)
    folder = scratch_dir(spark, "test-warc")
    warc.write_deduplicated(warc.records(pages), folder, **more)
    return stored(warc.read_records(spark, folder, with_payload=True), "test-warc-read")


def test_revisits(spark):
    tricky = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" + "x" * 100
    rows = [(7, "u7", LONG), (3, "u\r\nX: 3", LONG), (9, None, LONG), (1, "u1", "short"), (2, "u2", "short"), (4, "u4", None), (5, "u5", tricky), (6, "", tricky)]
    read = there_and_back(spark, rows, file_bytes=200)
    found = {r.page_id: r for r in warc.resolve_revisits(read).collect()}
    assert len(found) == len(rows)
    for i, _, html in rows:
        octets = (html or "").encode()
        assert (found[i].payload_bytes, found[i].payload_digest) == (len(octets), hashlib.sha256(octets).hexdigest())
    assert {i: (r.record_type, r.refers_to) for i, r in found.items()} == {
        1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("response", None), 5: ("response", None),
        6: ("revisit", 5), 7: ("revisit", 3), 9: ("revisit", 3),
    }
    assert sum(r.payload is not None and bytes(r.payload) == LONG.encode() for r in read.collect()) == 1  # stored once


def test_null_and_repeated_ids(spark):
    read = there_and_back(spark, [(None, "a", LONG), (2, "b", LONG), (2, "b", LONG), (5, "c", LONG), (None, "d", "z" * 200), (None, "e", "z" * 200)])
    found = sorted(((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in warc.resolve_revisits(read).collect()), key=repr)
    assert found == sorted([(0, "revisit", 2, 120), (2, "response", None, 120), (2, "response", None, 120), (5, "revisit", 2, 120), (0, "response", None, 200), (0, "response", None, 200)], key=repr)


def test_empty(spark):
    assert warc.resolve_revisits(there_and_back(spark, [])).count() == 0


def test_payload_octets_need_not_be_text(spark):
    pages = spark.createDataFrame([(1, "u", bytearray(range(256)))], "page_id long, url string, html binary")
    folder = scratch_dir(spark, "test-warc")
    warc.write_deduplicated(warc.records(pages), folder)
    assert bytes(warc.read_records(spark, folder, with_payload=True).first().payload) == bytes(range(256))

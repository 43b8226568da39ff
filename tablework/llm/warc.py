"""WARC archives: revisit resolution, deduplicated writing with fresh headers, and reading.

Writing hashes every payload where it lies and shuffles only headers (digest, id, length): the first
record of each digest is the original, the others become revisit records that refer to it and carry no
payload. Records are rows of UTF-8 or any other octets; Spark's text writer puts the record separator
behind each row, so its commit protocol covers lost tasks and any file system that Spark can write.

Reading parses each file by the lengths in its record headers, whatever octets a payload has, and
resolves revisits by a join with the originals' headers.

Results in odd cases: a null payload is an empty one; a null address leaves its header out; rows that
share the smallest id of a digest are all responses, since nothing orders them; a null id is written
without an id header, never is an original next to a row with an id, and reads back as null; payloads
below ``min_bytes`` are never compared; an empty table gives no file and an empty result. Extra
input columns are not carried along.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.llm.common import map_batches, stored

SEPARATOR = "\r\n\r\n"
MIN_BYTES = 100
FILE_BYTES = 32 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format

HEADER_SCHEMA = "file string, offset long, record_id string, record_type string, page_id long, url string, payload_digest string, refers_to_id string, payload_bytes long"


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Rows to be archived: page_id, url, payload (binary), payload_bytes, payload_digest."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    return rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha2("payload", 256))


def originals(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Digests that occur more than once, with the id of the original: payload_digest, original_id, copies.

    Counts are combined before the shuffle, so a digest that a third of all records share is no hot key.
    """
    found = headers.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
    return found.agg(F.min("page_id").alias("original_id"), F.count(F.lit(1)).alias("copies")).where("copies > 1")


def resolve(rows: DataFrame, first: DataFrame) -> DataFrame:
    """Add record_type and refers_to; ``first`` is a stored result of ``originals``.

    Rows meet only the digests that repeat: a broadcast while Spark measures those files to be small,
    else a join whose hot partitions adaptive execution splits.
    """
    joined = rows.join(first.select("payload_digest", "original_id"), "payload_digest", "left")
    revisit = F.col("original_id").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("original_id")))
    return joined.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(revisit, F.col("original_id"))
    )


def record_name(page_id: F.Column) -> F.Column:
    """A record id that follows from the row's id."""
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(page_id.cast("string"), F.lit("null"))))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def record_octets(rows: DataFrame, date: str) -> F.Column:
    """One record without its separator, as octets."""
    header = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")
    response = F.col("record_type") == "response"
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n")
    )
    block_bytes = F.when(response, F.octet_length(http) + F.col("payload_bytes")).otherwise(F.lit(0))
    one_line = F.regexp_replace("url", r"[\x00-\x20]", "%20")  # an address never breaks a header line
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        header("WARC-Type", F.col("record_type")),
        header("WARC-Record-ID", record_name(F.col("page_id"))),
        header("WARC-Date", F.lit(date)),
        header("WARC-Target-URI", one_line),
        header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        header("WARC-Refers-To", F.when(~response, record_name(F.col("refers_to")))),
        header("WARC-Profile", F.when(~response, F.lit(REVISIT_PROFILE))),
        header("X-Page-Id", F.col("page_id").cast("string")),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", block_bytes.cast("string")),
        F.lit("\r\n"),
    )
    return F.when(response, F.concat(head.cast("binary"), http.cast("binary"), F.col("payload"))).otherwise(head.cast("binary"))


def write_deduplicated(rows: DataFrame, folder: str, min_bytes: int = MIN_BYTES, file_bytes: int = FILE_BYTES, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write the result of ``records`` as archives in which every payload occurs once.

    Files hold about ``file_bytes`` each (by the mean length of payloads), since a reader takes a file whole.
    """
    headers = stored(rows.select("page_id", "payload_digest", "payload_bytes"), "warc-headers")
    first = stored(originals(headers, min_bytes), "warc-originals")
    n, total = headers.agg(F.count(F.lit(1)), F.sum("payload_bytes")).first()
    per_file = max(1, int(file_bytes * max(n, 1) / max(total or 0, 1)))
    resolved = resolve(rows, first)
    resolved.select(record_octets(resolved, date).cast("string").alias("value")).write.option("lineSep", SEPARATOR).option(
        "maxRecordsPerFile", per_file
    ).text(folder)


def parse(data: bytes):
    """Walk an archive: (offset, headers by lower-case name, start and end of the block)."""
    at = 0
    while at < len(data):
        if data[at : at + 5] != b"WARC/":
            raise ValueError(f"no record at octet {at}")
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        block = end + 4
        close = block + int(headers["content-length"])
        yield at, headers, block, close
        at = close + len(SEPARATOR)


def read_records(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """One row per record; digests and lengths of responses are computed from the octets that are there."""

    def run(batches):
        names = [c.split()[0] for c in HEADER_SCHEMA.split(", ")] + ["payload"] * with_payload
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]

        def made(rows):
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=False)], names)

        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data, rows, octets = content.as_py(), [], 0
                for at, h, block, close in parse(data):
                    digest, length, payload = h["warc-payload-digest"].partition(":")[2], None, None
                    if h["warc-type"] == "response":
                        payload = data[data.index(b"\r\n\r\n", block, close) + 4 : close]
                        digest, length = hashlib.sha256(payload).hexdigest(), len(payload)
                    page = h.get("x-page-id")
                    row = (file, at, h["warc-record-id"], h["warc-type"], None if page is None else int(page), h.get("warc-target-uri"), digest, h.get("warc-refers-to"), length)
                    rows.append(row + (payload,) * with_payload)
                    octets += (length or 0) * with_payload + 200
                    if octets > 8 << 20:
                        yield made(rows)
                        rows, octets = [], 0
                if rows:
                    yield made(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return map_batches(files.select(name.alias("file"), "content"), run, HEADER_SCHEMA + ", payload binary" * with_payload)


def resolve_revisits(read: DataFrame) -> DataFrame:
    """Give each revisit the length and the id of the response it refers to; ``read`` is stored.

    Originals are few per digest and combined before the shuffle; the records meet them in a join that
    adaptive execution can split at a hot digest.
    """
    targets = read.where("record_type = 'response'").join(
        read.where("record_type = 'revisit'").select(F.col("refers_to_id").alias("record_id")).distinct(), "record_id", "left_semi"
    )
    targets = targets.groupBy(F.col("record_id").alias("refers_to_id"), "payload_digest").agg(
        F.min("page_id").alias("refers_to"), F.min("payload_bytes").alias("original_bytes")
    )
    joined = read.join(stored(targets, "warc-targets"), ["refers_to_id", "payload_digest"], "left")
    return joined.withColumn("payload_bytes", F.coalesce("payload_bytes", "original_bytes")).drop("original_bytes")

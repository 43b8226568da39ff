"""Token ids in files of 64-bit words: a selector says how many ids of which width a word holds.

A file is a row of segments; all numbers are little-endian and every part is a multiple of eight octets:

    magic       8 octets  "S8B-IDS1"
    header      u64 x 5   documents, ids, blocks, words, escapes
    documents   i64 x 3n  id, 1 if the id is not null, number of ids
    blocks      u64 x 2n  first word, first escape (every block but the last holds BLOCK_IDS ids)
    words       u64 x n   selector in the upper four bits, ids from the lowest bits upwards
    escapes     u64 x n   values too wide for any selector; their word holds the escape's number
    trailer     8 octets  "S8B-END\\n"

Blocks are independent: packing walks all blocks of a segment in step, and decoding handles all words
of one selector at a time. Segments hold whole documents and are written by Spark's text writer, whose
line separator is the trailer, so a task that is lost and repeated commits its file once.

Results in odd cases: a null or empty text has only the end id; a null id is kept as null and comes
first; equal ids stay next to each other; an empty table gives no segment and an empty result.
"""

from __future__ import annotations

import functools
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablework.llm.bpe import slices
from tablework.llm.common import groups_of, id_and_text, map_batches, stored

MAGIC, TRAILER = b"S8B-IDS1", "S8B-END\n"
# Ids of a word and bits of an id for the selectors 1 to 15; selector 0 is the escape.
COUNTS = (1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (60, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 0
BLOCK_IDS = 1024
SEGMENT_CHARS = 1 << 21
FILE_BYTES = 32 << 20  # of text
FILE_GROUP = 1000


def bit_widths(values: np.ndarray) -> np.ndarray:
    """Bits that each unsigned value needs; halves of 32 bits are exact as floating-point numbers."""
    high = values >> np.uint64(32)
    out = np.frexp((values & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]
    return np.where(high > 0, 32 + np.frexp(high.astype(np.float64))[1], out).astype(np.uint8) if high.any() else out.astype(np.uint8)


def runs_that_fit(widths: np.ndarray, blocks: int) -> np.ndarray:
    """The selector of the fullest word that can begin at each id (rows are blocks, padded with zeros)."""
    grid = widths.reshape(blocks, BLOCK_IDS)
    best = np.full(grid.shape, ESCAPE, np.uint8)
    for s in range(15, 0, -1):  # from few wide ids to many narrow ones
        fits = grid <= WIDTHS[s]
        reach, have = COUNTS[s], 1
        while have < reach:  # all of the next ``reach`` ids, by doubling; beyond the block everything fits
            hop = min(have, reach - have)
            fits[:, :-hop] &= fits[:, hop:]
            have += hop
            if not fits.any():
                break
        best[fits] = s
    return best


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, escapes, and the first word and escape of each block."""
    n = len(values)
    blocks = -(-n // BLOCK_IDS)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty((0, 2), np.uint64)
    padded = np.zeros(blocks * BLOCK_IDS, np.uint64)
    padded[:n] = values
    choice = runs_that_fit(bit_widths(padded), blocks).ravel()
    edges = np.arange(blocks) * BLOCK_IDS
    following = np.arange(len(choice)) + np.array(COUNTS)[choice]
    ends = np.minimum(edges + BLOCK_IDS, n)
    begins, at = np.zeros(len(choice), bool), edges
    while len(at):  # one word of every block in each round
        begins[at] = True
        at = following[at]
        inside = at < ends
        at, ends = at[inside], ends[inside]
    first = np.flatnonzero(begins)
    chosen = choice[first]
    words = chosen.astype(np.uint64) << np.uint64(60)
    roomy = np.concatenate([padded, np.zeros(128, np.uint64)])
    block_end = (first // BLOCK_IDS + 1) * BLOCK_IDS
    for s in range(2, 16):
        rows = np.flatnonzero(chosen == s)
        word, place, end = words[rows], first[rows], block_end[rows]
        for k in range(COUNTS[s] if len(rows) else 0):
            word |= np.where(place + k < end, roomy[place + k], np.uint64(0)) << np.uint64(k * WIDTHS[s])
        words[rows] = word
    escaped = np.flatnonzero(chosen == ESCAPE)
    words[escaped] |= np.arange(len(escaped), dtype=np.uint64)
    offsets = np.stack([np.searchsorted(first, edges), np.searchsorted(first[escaped], edges)], 1).astype(np.uint64)
    return words, padded[first[escaped]], offsets


def unpack(words: np.ndarray, escapes: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """All ids of a segment. Any run of blocks decodes alike from its own words."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array(COUNTS)[selectors]
    block = np.searchsorted(offsets[:, 0], np.arange(len(words)), "right") - 1
    before = np.cumsum(counts) - counts
    begin = before - before[offsets[block, 0].astype(np.int64)] + block * BLOCK_IDS
    end = np.minimum((block + 1) * BLOCK_IDS, n)
    out = np.zeros(n + 128, np.uint64)
    for s in range(2, 16):
        rows = np.flatnonzero(selectors == s)
        mask = np.uint64((1 << WIDTHS[s]) - 1)
        for k in range(COUNTS[s] if len(rows) else 0):
            inside = rows[begin[rows] + k < end[rows]]
            out[begin[inside] + k] = (words[inside] >> np.uint64(k * WIDTHS[s])) & mask
    rows = np.flatnonzero(selectors == ESCAPE)
    out[begin[rows]] = escapes[(words[rows] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out[:n]


def segment(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """One segment without its trailer."""
    values = np.concatenate(ids).astype(np.uint64) if ids else np.empty(0, np.uint64)
    words, escapes, offsets = pack(values)
    header = np.array([len(doc_ids), len(values), len(offsets), len(words), len(escapes)], "<u8")
    about = np.array([(i or 0, i is not None, len(x)) for i, x in zip(doc_ids, ids, strict=True)], "<i8").reshape(-1, 3)
    return MAGIC + b"".join(x.astype(x.dtype.newbyteorder("<")).tobytes() for x in (header, about, offsets, words, escapes))


def segments(data: bytes):
    """Walk a file: (documents as id, known, count; all ids) of each segment."""
    at = 0
    while at < len(data):
        if data[at : at + 8] != MAGIC:
            raise ValueError(f"no segment at octet {at}")
        docs, n, blocks, words, escapes = np.frombuffer(data, "<u8", 5, at + 8).astype(int).tolist()
        at += 48
        about = np.frombuffer(data, "<i8", docs * 3, at).reshape(-1, 3)
        at += about.nbytes
        offsets = np.frombuffer(data, "<u8", blocks * 2, at).reshape(-1, 2)
        at += offsets.nbytes
        packed = np.frombuffer(data, "<u8", words, at)
        at += packed.nbytes
        beyond = np.frombuffer(data, "<u8", escapes, at)
        at += beyond.nbytes
        if data[at : at + 8] != TRAILER.encode():
            raise ValueError(f"segment not closed at octet {at}")
        at += 8
        yield about, unpack(packed, beyond, offsets, n)


CACHE_SLICES = 800_000


class LibraryEncoder(dict):
    """The tokenizers library's byte-level BPE behind a bounded cache of slices.

    The library's own model gets each distinct slice; splitting into slices and gluing the ids of slices
    are done here, since the library spends most of its time on them. Strings of the file's added tokens
    are ordinary text or, if ``added``, texts that hold one are left to the library's whole call.
    """

    def __init__(self, path: str, added: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()] if added else []
        signs = [*range(33, 127), *range(161, 173), *range(174, 256)]  # octets that byte-level vocabularies write as themselves
        others = [i for i in range(256) if i not in signs]
        self.written = {i: chr(i) for i in signs} | {i: chr(256 + k) for k, i in enumerate(others)}

    def __missing__(self, part: bytes) -> bytes:
        ids = self[part] = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(part.decode("latin-1").translate(self.written))])
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self) > CACHE_SLICES:
            self.clear()
        held = [any(t in text for t in self.added) for text in texts]
        parts, first = slices(["" if h else text for text, h in zip(texts, held, strict=True)])
        out = [b"".join(map(self.__getitem__, parts[a:b])) for a, b in zip(first, first[1:], strict=False)]
        for i in (i for i, h in enumerate(held) if h):
            out[i] = np.array(self.whole.encode(texts[i], add_special_tokens=False).ids, "<u4").tobytes()
        return out


@functools.cache
def library_encoder(path: str, added: bool = False) -> LibraryEncoder:
    return LibraryEncoder(path, added)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, file_bytes: int = FILE_BYTES, id_col: str = "doc_id", text_col: str = "text", added_tokens: bool = False
) -> None:
    """Encode whole texts and write them in ascending order of their ids, part files in the same order.

    The number of files follows the octets of text, so no file outgrows a task; ranges of ids are dealt
    by a sample of ids, not of texts. With ``added_tokens`` the tokenizer file's added tokens are found
    inside texts, as the library does by default.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // file_bytes))

    def run(batches):
        encoder = library_encoder(tokenizer, added_tokens)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            texts, ids = [t or "" for t in batch.column(1).to_pylist()], batch.column(0).to_pylist()
            made = []
            for a, b in groups_of([len(t) for t in texts], SEGMENT_CHARS // 8):
                made += [np.frombuffer(x + end, "<u4") for x in encoder.encode(texts[a:b])]
            cuts = list(groups_of([len(x) for x in made], SEGMENT_CHARS // 4))
            yield pa.RecordBatch.from_arrays([pa.array([segment(ids[a:b], made[a:b]) for a, b in cuts], pa.binary())], ["segment"])

    ordered = rows.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id")
    packed = map_batches(ordered, run, "segment binary")
    packed.select(F.col("segment").cast("string").alias("value")).write.option("lineSep", TRAILER).text(folder)


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Read the files back: file, position, doc_id, n_tokens, start_in_file, ids_crc32 (and ids)."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # one file at a time
                file, start, position = batch.column(0)[i].as_py(), 0, 0
                for about, ids in segments(batch.column(1)[i].as_py()):
                    flat = memoryview(ids.astype("<u4").tobytes())
                    ends = np.cumsum(about[:, 2])
                    begins = ends - about[:, 2]
                    parts = [flat[4 * a : 4 * b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                    columns = [
                        pa.array([file] * len(about), pa.string()),
                        pa.array(np.arange(position, position + len(about))),
                        pa.array(about[:, 0], mask=about[:, 1] == 0),
                        pa.array(about[:, 2]),
                        pa.array(start + begins),
                        pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                        *([pa.array([bytes(p) for p in parts], pa.binary())] if with_ids else []),
                    ]
                    names = ["file", "position", "doc_id", "n_tokens", "start_in_file", "ids_crc32", *["ids"] * with_ids]
                    yield pa.RecordBatch.from_arrays(columns, names)
                    start, position = start + len(ids), position + len(about)

    schema = "file string, position long, doc_id long, n_tokens long, start_in_file long, ids_crc32 long" + ", ids binary" * with_ids
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return map_batches(files.select(name.alias("file"), "content"), run, schema)


def file_starts(per_file: DataFrame) -> DataFrame:
    """file, base: what all earlier files hold, for a table of file, in_file. Files are ordered by the number in their names.

    Spark pads that number to five digits only, so names do not sort beyond. Files are summed up in groups of
    ``FILE_GROUP`` neighbours first; the driver sees none of them.
    """
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    placed = stored(per_file.select("file", "in_file", number.alias("number"), F.floor(number / FILE_GROUP).alias("group")), "token-files")
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    groups = placed.groupBy("group").agg(F.sum("in_file").alias("in_group"))
    groups = stored(groups.select("group", F.coalesce(F.sum("in_group").over(earlier.orderBy("group")), F.lit(0)).alias("before")), "token-file-groups")
    inside = F.coalesce(F.sum("in_file").over(earlier.partitionBy("group").orderBy("number", "file")), F.lit(0))
    return placed.withColumn("inside", inside).join(groups, "group").select("file", (F.col("before") + F.col("inside")).alias("base"))


def with_starts(read: DataFrame) -> DataFrame:
    """Add ``start``: ids of all documents before, over all files in the order of their numbers.

    Only one row per file is summed up in order, inside Spark; the rows of documents stay where they are.
    """
    read = stored(read, "token-rows")
    starts = stored(file_starts(read.groupBy("file").agg(F.sum("n_tokens").alias("in_file"))), "token-file-starts")
    return read.join(starts, "file").withColumn("start", F.col("base") + F.col("start_in_file"))

"""SimHash near-duplicates: fingerprints, links within a Hamming radius, connected groups.

Links come from the segment-popcount embedding. A fingerprint is cut into segments of a few bits, and
the bits set in each segment are its coordinates. One differing bit moves one coordinate by one, so the
Manhattan distance of two vectors is at most the Hamming distance. A pair within radius r has, in one
of the two halves of the segments, a distance of at most r // 2. That is a range join on a grid with
cells of width one: within one step a pair either shares the half's cell or lies in neighbouring cells
of different parity, so vectors with an odd sum visit the cells around them and those with an even sum
stay. Each candidate is checked exactly with the Hamming distance inside the join, so candidates that
fail are never rows.

Results in odd cases: null and empty texts have fingerprint zero, which links like any other; equal rows
share a fingerprint and are never expanded into pairs; a group whose ids are all null has a null
component; an empty table gives an empty result. Very long texts are hashed whole. Extra input columns
are carried by ``keep_one`` only, whose own column takes a name that is free.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tablework.llm.common import free_name, groups_of, id_and_text, map_batches, stored
from tablework.llm.graphs import components

SHINGLE, SEED, RADIUS = 3, 42, 3
LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
GROUP_BYTES = 1 << 20
LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of every window of ``size`` words, repeats included; a shorter text is one window, an empty one has none."""
    words = text.encode("utf-8").translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    windows = map(b" ".join, zip(*(words[k:] for k in range(size)), strict=False)) if len(words) >= size else [b" ".join(words)]
    return np.fromiter(map(xxhash.xxh64_intdigest, windows, repeat(SEED)), np.uint64)


def fingerprints(hashes: list[np.ndarray]) -> np.ndarray:
    """Bits that are set in over half of each text's hashes.

    Eight bits of every hash are counted at a time, one in each octet of a word, over runs of at most 255.
    """
    sizes = np.array([len(h) for h in hashes], np.int64)
    full = np.flatnonzero(sizes)
    out = np.zeros(len(hashes), np.uint64)
    if not len(full):
        return out
    flat = np.concatenate([hashes[i] for i in full])
    starts = np.cumsum(sizes[full]) - sizes[full]
    runs = -(-sizes[full] // 255)
    first_run = np.cumsum(runs) - runs
    run_starts = np.repeat(starts, runs) + (np.arange(runs.sum()) - np.repeat(first_run, runs)) * 255
    for k in range(8):
        lanes = np.add.reduceat((flat >> np.uint64(k)) & LANES, run_starts)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first_run, axis=0)
        for octet in range(8):
            out[full] |= (2 * counts[:, octet] > sizes[full]).astype(np.uint64) << np.uint64(8 * octet + k)
    return out


def with_fingerprints(docs: DataFrame, name: str, size: int = SHINGLE, text_col: str = "text") -> DataFrame:
    """All columns of the frame and a fingerprint (64 bits as a signed long) of a text column."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            made = [np.empty(0, np.uint64)]
            for a, b in groups_of([len(t) for t in texts], GROUP_BYTES):
                made.append(fingerprints([shingle_hashes(t, size) for t in texts[a:b]]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(made).view(np.int64))], [*batch.schema.names, name])

    return map_batches(docs, run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def fingerprint_documents(docs: DataFrame, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp."""
    return with_fingerprints(id_and_text(docs, id_col, text_col), "fp", size).select("doc_id", "fp")


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All pairs of different fingerprints at most ``radius`` bits apart, each once: a, b with a < b.

    ``distinct`` is a stored table with one row per fingerprint ``fp``. Segments have two bits, so both
    halves have sixteen coordinates of 0 to 2, written as two-bit fields of one number.
    """
    if radius > 3:
        raise ValueError("cells of width one serve radii up to 3")
    low = F.lit(0x55555555)
    part = lambda h: F.shiftrightunsigned("fp", 32 * h).bitwiseAND(low) + F.shiftrightunsigned("fp", 32 * h + 1).bitwiseAND(low)
    half = F.explode(F.array(*(F.struct(F.lit(h).alias("half"), part(h).alias("cell")) for h in (0, 1))))
    homes = distinct.select("fp", half.alias("h")).select("fp", "h.half", "h.cell")
    visits = F.expr(
        """concat(array(cell), if(bit_count(cell & 1431655765L) % 2 = 1, concat(
             transform(filter(sequence(0, 15), j -> (shiftrightunsigned(cell, 2 * j) & 3) < 2), j -> cell + shiftleft(1L, 2 * j)),
             transform(filter(sequence(0, 15), j -> (shiftrightunsigned(cell, 2 * j) & 3) > 0), j -> cell - shiftleft(1L, 2 * j))),
           cast(array() as array<bigint>)))"""
    )
    visitors = homes.select(F.col("fp").alias("x"), "half", F.col("cell").alias("own"), F.explode(visits).alias("cell"))
    near = F.bit_count(F.col("x").bitwiseXOR(F.col("fp"))) <= radius
    once = (F.col("own") != F.col("cell")) | (F.col("x") < F.col("fp"))
    found = visitors.join(homes.select(F.col("half").alias("h2"), F.col("cell").alias("c2"), "fp"), (F.col("half") == F.col("h2")) & (F.col("cell") == F.col("c2")) & near & once)
    return found.select(F.least("x", "fp").alias("a"), F.greatest("x", "fp").alias("b")).distinct()


def groups(rows: DataFrame, radius: int = RADIUS, edges: DataFrame | None = None) -> DataFrame:
    """One row per fingerprint of a stored table doc_id, fp: fp, first_id, n_rows, n_first, n_links, root.

    ``edges`` (a, b; stored) are the links; by default those within the radius.

    ``first_id`` is the smallest non-null id with that fingerprint, ``n_first`` how many rows have it (of
    all rows, if only null ids do), ``root`` the smallest fingerprint of the group it is linked to.
    """
    per_id = rows.groupBy("fp", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "n")).alias("best")
    distinct = stored(per_id.groupBy("fp").agg(best, F.sum("n").alias("n_rows")).select("fp", F.col("best.doc_id").alias("first_id"), "n_rows", F.col("best.n").alias("n_first")), "fingerprints")
    if edges is None:
        edges = stored(links(distinct.select("fp"), radius), "fingerprint-links")
    degree = edges.select(F.explode(F.array("a", "b")).alias("fp")).groupBy("fp").agg(F.count(F.lit(1)).alias("n_links"))
    linked = stored(components(edges).withColumnRenamed("node", "fp").join(degree, "fp"), "linked")
    found = distinct.join(linked, "fp", "left")
    return stored(found.select("fp", "first_id", "n_rows", "n_first", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "fp").alias("root")), "fingerprint-groups")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, n_links (of its fingerprint to others)."""
    rows = stored(fingerprint_documents(docs, size, id_col, text_col), "doc-fingerprints")
    per_fp = groups(rows, radius)
    smallest = stored(per_fp.where("n_links > 0").groupBy("root").agg(F.min("first_id").alias("component_id")), "group-heads")
    of_fp = per_fp.join(smallest, "root", "left").select("fp", F.when(F.col("n_links") > 0, F.col("component_id")).otherwise(F.col("first_id")).alias("component_id"), "n_links")
    joined = rows.join(stored(of_fp, "fingerprint-components"), "fp")
    return joined.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_links")


def keep_one(
    docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS, similarity: float | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents without near duplicates: of each group the row with the smallest id stays (null ids count as largest).

    Links are fingerprints within the radius. If a similarity is given, such links are checked by the texts'
    sets of shingles, and all other texts whose sets are at least that similar are linked too.
    """
    if similarity:
        from tablework.llm import similar  # which builds on this module

        return similar.keep_one(docs, size, similarity, id_col, text_col)
    name = free_name(docs, "fp")
    marked = stored(with_fingerprints(docs, name, size, text_col), "marked-documents")
    per_fp = groups(marked.select(F.col(id_col).cast("long").alias("doc_id"), F.col(name).alias("fp")), radius)
    heads = stored(group_heads(per_fp), "group-heads")
    staying = marked.alias("d").join(heads.alias("h"), (F.col(f"d.{name}") == F.col("h.head_fp")) & F.col(f"d.{id_col}").cast("long").eqNullSafe(F.col("h.head_id")))
    once = staying.where("h.head_rows = 1").select("d.*")
    again = staying.where("h.head_rows > 1").select("d.*").dropDuplicates([id_col, name])
    return once.unionByName(again).select(*docs.columns)


def group_heads(per_fp: DataFrame) -> DataFrame:
    """head_fp, head_id, head_rows of each group: the document that stays."""
    best = F.min(F.struct(F.col("first_id").isNull().alias("unknown"), "first_id", "fp", "n_first")).alias("best")
    return per_fp.groupBy("root").agg(best).select(F.col("best.fp").alias("head_fp"), F.col("best.first_id").alias("head_id"), F.col("best.n_first").alias("head_rows"))

"""Shards of even size by balanced label propagation: linked documents move to where their neighbours are.

Documents are linked if they have an equal value in one of the link columns (by default the text). Links
are never listed: a value is a group, and what a document hears of its neighbours are the group's counts
per shard, so a group of a third of all rows costs as much as its rows.

1. Linked documents start in shards drawn by hash.
2. A round: each group counts its members per shard; each document adds up what its groups say and wishes to be in
   the shard with most neighbours, ties by a draw that all members of its first group share. The bytes that wish to go
   from each shard to each other one (one number per pair of shards) give quotas: the largest shares of the
   wishes for which no shard gets more than its room and what leaves it. Shares are drawn by group, for large groups by
   document. Large groups, and in every other round all, may only wish for shards with room, so that a group
   which fits into no single shard fills one after the other.
3. What is above the even size leaves its shard again, and together with the documents without links, which cut
   nothing wherever they are, fills all shards to one level: the few very large ones by size, each to the
   emptiest shard, then the others in two classes of size along a running sum. The last class decides how even
   the shards are: to about a 4096th of a shard, if there are enough small documents.

Running sums and places in a shard (slots) are counted in hash buckets, whose sums are added up first, so no task has a
whole shard. The driver gets numbers per pair of shards and the sizes of at most 256 documents per shard.

Results in odd cases: a null or empty text has one byte and is a text like any other; documents are rows, so
repeated rows and null or repeated ids are rows of their own with a slot each, and a null value in a link column links
nothing; a document larger than an even shard has a shard that nothing else fills up; an empty table gives an
empty result; very long texts count in full. Extra input columns are carried by ``write_shards`` only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.llm.common import discard, free_name, stored

SHARDS, ROUNDS = 16, 8
BUCKET_ROWS = 20_000  # for running sums: about so many rows are one bucket
LARGE, MEDIUM = 256, 4096  # a document is large if it has more than such a part of an even shard
CROWD = 64  # a group with more than such a part of an even shard moves document by document
FULL = 10  # a shard with less than such a part of an even shard to spare is full
DRAWS = 1 << 20


def quotas(flows: dict[tuple[int, int], int], rooms: list[float]) -> list[float]:
    """For each shard the share of the wishes to go there that may be met.

    The largest shares for which what comes is at most the room and what leaves. From all wishes
    on they only shrink, so repeated correction finds them.
    """
    n = len(rooms)
    shares, wished = [1.0] * n, [sum(size for (_, b), size in flows.items() if b == k) for k in range(n)]
    for _ in range(200):
        leaving = [sum(size * shares[b] for (a, b), size in flows.items() if a == k) for k in range(n)]
        newer = [min(shares[k], max(0.0, rooms[k] + leaving[k]) / wished[k]) if wished[k] else 1.0 for k in range(n)]
        if max(a - b for a, b in zip(shares, newer, strict=True)) < 1e-6:
            return newer
        shares = newer
    return shares


def fill_to_level(loads: list[int], amount: int) -> list[float]:
    """How an amount is spread so that the least loaded shards reach one level."""
    order, level, left = sorted(loads), float(min(loads)), float(amount)
    for k, low in enumerate(order):
        upper = order[k + 1] if k + 1 < len(order) else float("inf")
        need = (upper - low) * (k + 1)
        level = min(upper, low + left / (k + 1))
        left -= min(left, need)
        if left <= 0:
            break
    return [max(0.0, level - load) for load in loads]


def sizes_by(df: DataFrame, shards: int) -> list[int]:
    """Bytes in each shard."""
    found = {r.shard: r.size for r in df.groupBy("shard").agg(F.sum("size").alias("size")).collect()}
    return [found.get(k, 0) for k in range(shards)]


def pick(values: list[float], at: Column) -> Column:
    return F.array(*map(F.lit, values))[at]


def propagated(members: DataFrame, even: float, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """row, size, shard, crowd of all rows of ``members`` (row, size, group; stored, one row for each group that a row is in).

    ``crowd``: the row's groups are large, so they move document by document.
    """
    start = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    state = stored(members.groupBy("row").agg(F.min("group").alias("anchor"), F.first("size").alias("size")).withColumns({"shard": start, "crowd": F.lit(False)}), "shards-start")
    loads, idle = sizes_by(state, shards), 0
    for turn in range(rounds):
        inside = [F.count(F.when(F.col("shard") == k, 1)) for k in range(shards)]
        votes = stored(members.join(state.select("row", "shard"), "row").groupBy("group").agg(F.array(*inside).alias("votes")), "group-votes")
        heard = members.join(votes, "group").groupBy("row").agg(F.array(*(F.sum(F.col("votes")[k]) for k in range(shards))).alias("votes"))
        rooms = [even - load for load in loads]
        is_open = [F.lit(room > even / FULL) | (F.lit(turn % 2 == 0) & ~F.col("crowd")) for room in rooms]
        choice = [
            F.when(is_open[k] | (F.col("shard") == k), F.struct(F.col("votes")[k].alias("n"), F.xxhash64("anchor", F.lit(k)).alias("draw"), F.lit(k).alias("k")))
            for k in range(shards)
        ]
        large = F.aggregate("votes", F.lit(0).cast("long"), lambda a, b: a + b) * F.col("size") > even / CROWD
        wishes = stored(state.join(heard, "row").select("row", "anchor", "size", "shard", F.array_max(F.array(*choice))["k"].alias("target"), large.alias("crowd")), "shard-wishes")
        flows = {(r.shard, r.target): r.size for r in wishes.where("shard <> target").groupBy("shard", "target").agg(F.sum("size").alias("size")).collect()}
        idle = 0 if flows else idle + 1
        if idle == 2:
            discard(votes, wishes)
            break
        draw = F.pmod(F.xxhash64(F.when(F.col("crowd"), F.col("row")).otherwise(F.col("anchor")), F.lit(turn)), F.lit(DRAWS)) / DRAWS
        moves = draw < pick(quotas(flows, rooms), F.col("target"))
        newer = stored(wishes.select("row", "anchor", "size", F.when(moves, F.col("target")).otherwise(F.col("shard")).alias("shard"), "crowd"), "shards-round")
        discard(votes, wishes, state)
        state, loads = newer, sizes_by(newer, shards)
    return state.select("row", "size", "shard", "crowd")


def running(rows: DataFrame, parts: list[str], value: Column, label: str) -> DataFrame:
    """A stored copy with ``before``: the sum of the values of the rows before it in its part, by hash buckets."""
    buckets = max(1, rows.count() // BUCKET_ROWS)
    dealt = stored(rows.withColumn("value", value).withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets))), f"{label}-dealt")
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    of_buckets = dealt.groupBy(*parts, "bucket").agg(F.sum("value").alias("value"))
    starts = F.coalesce(F.sum("value").over(earlier.partitionBy(*parts).orderBy("bucket")), F.lit(0))
    starts = stored(of_buckets.select(*parts, "bucket", starts.alias("start")), f"{label}-starts")
    own = F.coalesce(F.sum("value").over(earlier.partitionBy(*parts, "bucket").orderBy("row")), F.lit(0))
    found = stored(dealt.join(starts, [*parts, "bucket"]).withColumn("before", F.col("start") + own).drop("start", "value", "bucket"), label)
    discard(dealt, starts)
    return found


def settled(rows: DataFrame, placed: DataFrame, even: float, shards: int = SHARDS) -> DataFrame:
    """row, size, shard of all ``rows`` (row, size): those ``placed`` stay while their shard has room, rows of large groups last."""
    summed = running(placed, ["shard", "crowd"], F.col("size"), "shard-sums")
    first = F.when(F.col("crowd"), pick(sizes_by(placed.where("not crowd"), shards), F.col("shard"))).otherwise(0)
    staying = stored(summed.where(first + F.col("before") + F.col("size") <= even).select("row", "size", "shard"), "shards-kept")
    pool = stored(rows.join(staying.select("row"), "row", "left_anti"), "shard-pool")
    loads = sizes_by(staying, shards)
    large = F.col("size") > even / LARGE
    chosen = []
    for r in sorted(pool.where(large).collect(), key=lambda r: (-r.size, r.row)):  # fewer than LARGE * shards rows can be that large
        k = min(range(shards), key=lambda k: (loads[k], k))
        loads[k] += r.size
        chosen.append((r.row, r.size, k))
    out = staying.unionByName(rows.sparkSession.createDataFrame(chosen, "row long, size long, shard int"))
    medium = F.col("size") > even / MEDIUM
    for name, own in (("medium", ~large & medium), ("small", ~large & ~medium)):
        summed = running(pool.where(own), [], F.col("size"), f"shard-fill-{name}")
        amount = summed.agg(F.sum("size")).first()[0] or 0
        shares, bound, shard = fill_to_level(loads, amount), 0.0, None
        for k in range(shards):
            if shares[k] > 0:
                bound += shares[k]
                shard = F.when(F.col("before") < bound, k) if shard is None else shard.when(F.col("before") < bound, k)
                last = k
        filled = summed.select("row", "size", (F.lit(0) if shard is None else shard.otherwise(last)).cast("int").alias("shard"))
        loads = [a + b for a, b in zip(loads, sizes_by(filled, shards), strict=True)]
        out = out.unionByName(filled)
    return out


def assigned(rows: DataFrame, links: list[str], shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """row, shard, slot for a stored table with row (unique), size and link columns."""
    even = (rows.agg(F.sum("size")).first()[0] or 0) / shards
    values = rows.select("row", "size", F.explode(F.array(*(F.when(F.col(c).isNotNull(), F.xxhash64(F.lit(c), c)) for c in links))).alias("group")).where(F.col("group").isNotNull())
    several = stored(values.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("group"), "linked-groups")
    members = stored(values.join(several, "group", "left_semi"), "linked-rows")
    placed = propagated(members, even, shards, rounds)
    found = running(settled(rows.select("row", "size"), placed, even, shards), ["shard"], F.lit(1).cast("long"), "shard-slots")
    discard(several, members)
    return found.select("row", "shard", F.col("before").alias("slot"))


def size_of(text_col: str) -> Column:
    return F.octet_length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).cast("long") + 1


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot: documents in shards of even size, equal texts together as far as that allows."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), size_of(text_col).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("link"))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "shard-documents")
    found = rows.join(assigned(rows, ["link"], shards, rounds), "row")
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot")


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, rounds: int = ROUNDS, links: list[str] | None = None, text_col: str = "text") -> None:
    """Write the documents with all their columns to one folder per shard (``shard=k``), in the order of their slots.

    ``links`` are the columns whose equal values link documents, by default the text. Large shards have
    several files, each a range of slots.
    """
    row, shard, slot = (free_name(docs, c) for c in ("row", "shard", "slot"))
    kept = stored(docs.withColumn(row, F.monotonically_increasing_id()), "shard-rows")
    values = {f"link_{i}": F.when(F.col(c).isNotNull(), F.xxhash64(c)) for i, c in enumerate(links or [text_col])}
    rows = stored(kept.select(F.col(row).alias("row"), size_of(text_col).alias("size"), *(v.alias(k) for k, v in values.items())), "shard-documents")
    placed = kept.join(assigned(rows, list(values), shards, rounds).toDF(row, shard, slot), row).drop(row)
    placed.repartitionByRange(shard, slot).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(folder)
    discard(kept, rows)

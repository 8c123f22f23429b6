"""Shards from a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``nodes`` places on a ring of 2^32.  A row falls on the ring by a hash of its
id, text checksum and size, and belongs to the next node clockwise.  No shard takes more than its capacity: the rows that
a full shard cannot take go on clockwise to the next node whose shard has room.  The capacities add up
to the number of rows and differ by at most one, so the counts of rows do too (law ``rows``).  With one more
shard all other nodes stay where they are, so a row moves only if the new shard takes it or
if the smaller capacities push it on.

The rows of one node's arc form a queue by place on the ring.  Which part of a queue goes to which
shard depends on the lengths of the queues alone: ``shards * nodes`` numbers, whatever the data size.
They are worked out in the driver; rows learn their place in the queue from sums of counts and a
window over narrow slots of the ring, and meet the plan in a broadcast join.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern import settings
from quern.llm.common import repeated, text_column

RING = 1 << 32
#: virtual nodes of each shard, parts that an arc is cut into
NODES, SLOTS = 64, 16


def ring(shards: int, nodes: int = NODES) -> list[tuple[int, int]]:
    """(place, shard) of all virtual nodes in clockwise order; a shard's nodes do not depend on the others."""
    place = lambda s, v: int.from_bytes(hashlib.md5(f"{s}:{v}".encode()).digest()[:4], "big")
    return sorted((place(s, v), s) for s in range(shards) for v in range(nodes))


def allotted(lengths: dict[int, int], shards: int, nodes: int = NODES) -> list[tuple[int, int, int, int, int]]:
    """(arc, from, upto, shard, slot): which part of each arc's queue a shard takes, and its first free slot.

    ``lengths`` has the number of rows for every arc, numbered like the nodes in ``ring``.  First every
    queue fills its own shard, arc by arc; then what is left over moves on clockwise.
    """
    places, total = ring(shards, nodes), sum(lengths.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    filled, plan, over = [0] * shards, [], []
    for arc, (_, shard) in enumerate(places):
        n = lengths.get(arc, 0)
        take = min(n, room[shard] - filled[shard])
        if take:
            plan.append((arc, 0, take, shard, filled[shard]))
            filled[shard] += take
        if n > take:
            over.append((arc, take, n))
    for arc, low, n in over:
        at = arc
        while low < n:
            at = (at + 1) % len(places)
            shard = places[at][1]
            take = min(n - low, room[shard] - filled[shard])
            if take:
                plan.append((arc, low, low + take, shard, filled[shard]))
                filled[shard] += take
                low += take
    return plan


def arc_of(place: Column, shards: int, nodes: int) -> Column:
    """Number of the first node at or after a place, by halving an array of all nodes' places."""
    places = [p for p, _ in ring(shards, nodes)]
    table = F.array(*[F.lit(p).cast("bigint") for p in places])
    steps = [1 << i for i in range(len(places).bit_length() - 1, -1, -1)]
    below = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda low, s: F.when(
        F.coalesce(F.get(table, low + s - 1) < place, F.lit(False)), low + s).otherwise(low))
    return F.pmod(below, F.lit(len(places)))


def queued(rows: DataFrame, arc: str, order: list[str]) -> DataFrame:
    """Add ``first``: how many rows of the same arc come before the ``n`` rows of this line."""
    cut = F.pmod(F.shiftright("place", 8), F.lit(SLOTS))
    rows = rows.withColumn("cut", cut)
    counts = rows.groupBy(arc, "cut").agg(F.sum("n").alias("held"))  # arcs * SLOTS lines at most
    counts = counts.withColumn("before", F.sum("held").over(
        W.partitionBy(arc).orderBy("cut").rowsBetween(W.unboundedPreceding, -1))).select(
        F.col(arc).alias("_arc"), F.col("cut").alias("_cut"), F.coalesce("before", F.lit(0)).alias("before"))
    inside = F.sum("n").over(W.partitionBy(arc, "cut").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow))
    return rows.withColumn("inside", inside - F.col("n")).join(
        F.broadcast(counts), (F.col(arc) == F.col("_arc")) & (F.col("cut") == F.col("_cut"))).withColumn(
        "first", F.col("before") + F.col("inside")).drop("_arc", "_cut", "before", "inside", "cut")


def shard(docs: DataFrame, shards: int = 40, nodes: int = NODES) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per row of ``docs``.

    size is the number of UTF-8 bytes of the text plus 16 (a null text has none); slots count from 0
    without gaps in every shard; grown_shard is null under the law ``rows``.  A null id is hashed like any
    other value.  Rows with equal id, size and checksum cannot be told apart: they are counted as one
    line and written out as many times as they came.  Other columns play no part; an empty table gives no rows.
    """
    settings.ensure_checkpoint_dir(docs.sparkSession)
    text = docs["text"].cast("string")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("bigint")
    rows = docs.select(docs["doc_id"], size.alias("size"), F.crc32(text_column(docs).cast("binary")).alias("text_crc32"))
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    place = F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(RING))
    rows = rows.withColumn("place", place).withColumn("arc", arc_of(F.col("place"), shards, nodes)).checkpoint()
    lengths = {r["arc"]: r["n"] for r in rows.groupBy("arc").agg(F.sum("n").alias("n")).collect()}  # shards * nodes
    plan = docs.sparkSession.createDataFrame(
        allotted(lengths, shards, nodes), "p_arc int, low long, high long, shard int, base long")
    lines = queued(rows, "arc", ["place", "doc_id", "text_crc32", "size"])
    # parts of a line's rows that fall into one part of the plan
    parts = lines.join(F.broadcast(plan), (F.col("arc") == F.col("p_arc")) & (F.col("first") < F.col("high"))
                       & (F.col("first") + F.col("n") > F.col("low")))
    low = F.greatest("first", "low")
    n = F.least(F.col("first") + F.col("n"), F.col("high")) - low
    parts = parts.select("doc_id", "size", "text_crc32", "shard", (F.col("base") + low - F.col("low")).alias("slot"), n.alias("n"))
    out = repeated(parts, "n", "k", rows.filter("n > 1").isEmpty()).withColumn("slot", F.col("slot") + F.col("k"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

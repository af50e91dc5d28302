"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into ``2**BITS`` arcs. An arc belongs to the first virtual node at or
after it, clockwise. Every shard takes the rows of its own arcs up to its capacity;
rows that overflow continue clockwise to the next virtual node whose shard has room.
With no slack the capacities add up to the number of rows, so counts differ by one at
most. Only the counts of arcs (a fixed number) reach the driver; rows are ranked within
their arc, and the walk's result is a table of rank intervals bounded by the arcs.
"""

from __future__ import annotations

import bisect
import hashlib
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

#: Arcs of the ring as a power of two: fixes what is counted, collected and broadcast.
BITS = 16
#: Virtual nodes of each shard.
NODES = 128


def ring(shards: int, nodes: int = NODES, bits: int = BITS) -> list[tuple[int, int]]:
    """(arc, shard) of all virtual nodes, clockwise. A shard's nodes don't depend on the others."""
    def place(shard: int, node: int) -> int:
        return int.from_bytes(hashlib.blake2b(f"{shard}/{node}".encode(), digest_size=8).digest(), "big") >> (64 - bits)

    return sorted((place(s, n), s) for s in range(shards) for n in range(nodes))


def walk(counts: dict[int, int], shards: int, slack: float = 0.0, nodes: int = NODES, bits: int = BITS) -> list[tuple]:
    """(arc, first, last, shard, home, slot): rows of these ranks in the arc go to ``shard`` from ``slot`` on."""
    circle = ring(shards, nodes, bits)
    places = [p for p, _ in circle]
    total = sum(counts.values())
    if slack:
        room = [math.ceil((1 + slack) * total / shards)] * shards
    else:
        room = [total // shards + (s < total % shards) for s in range(shards)]
    taken, out, left = [0] * shards, [], []

    def take(arc: int, first: int, n: int, shard: int, home: int) -> None:
        if n:
            out.append((arc, first, first + n - 1, shard, home, taken[shard]))
            taken[shard] += n

    for arc in sorted(counts):
        at = bisect.bisect_left(places, arc) % len(circle)
        home = circle[at][1]
        n = min(counts[arc], room[home] - taken[home])
        take(arc, 0, n, home, home)
        if n < counts[arc]:
            left.append((arc, n, at))
    for arc, first, at in left:
        step = at
        while first < counts[arc]:
            shard = circle[step % len(circle)][1]
            n = min(counts[arc] - first, room[shard] - taken[shard])
            take(arc, first, n, shard, circle[at][1])
            first, step = first + n, step + 1
    return out


def assign_shards(docs: DataFrame, shards: int = 8, slack: float = 0.0, id_col: str = "doc_id", text_col: str = "text",
                  nodes: int = NODES, bits: int = BITS) -> DataFrame:
    """One row per input row: id, size, text_crc32, home (the ring's shard), shard, slot (gapless from 0 per shard).

    size is the text's UTF-8 bytes plus 1; a null text has no bytes (size 1, crc 0).
    A row's place on the ring depends on its id, size and checksum, so null or repeated
    ids spread as their texts do; rows equal in all three are interchangeable. Other
    columns are ignored, whatever their names; an empty table gives no rows.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    slim = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    slim = materialise(slim.withColumn("place", F.xxhash64("id", "size", "text_crc32")).withColumn(
        "arc", F.shiftrightunsigned("place", 64 - bits)), "sizes")
    counts = {r["arc"]: r["count"] for r in slim.groupBy("arc").count().collect()}
    plan = spark.createDataFrame(walk(counts, shards, slack, nodes, bits),
                                 "arc long, first long, last long, shard int, home int, base long")
    order = Window.partitionBy("arc").orderBy("place", "id", "size", "text_crc32")
    ranked = slim.withColumn("rank", F.row_number().over(order).cast("long") - 1)
    return ranked.join(F.broadcast(plan), (ranked["arc"] == plan["arc"]) & F.col("rank").between(F.col("first"), F.col("last"))).select(
        F.col("id").alias(id_col), "size", "text_crc32", "home", "shard", (F.col("base") + F.col("rank") - F.col("first")).alias("slot"))

"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``nodes`` points of a ring; a row belongs to the first point
clockwise of its own hash.  Shards have capacities that add up to the number of
rows and differ by at most one; what overflows a full shard goes on clockwise.
So row counts are at most one apart (the law is ``rows``), and another shard or
more rows move little beyond what the new shard or the overflow takes.

Only the number of rows per arc reaches the driver: ``shards * nodes`` numbers,
whatever the input.  It walks the arcs and cuts each into stretches by rank; a
row then finds its shard and slot from its rank on the ring, which comes from a
range partition.

Defined results: a NULL text has size 8, and the checksum of an empty text; rows
with NULL or equal ids meet at one point of the ring and are told apart by
checksum, size and position.  An empty table gives none.
"""

from __future__ import annotations

import pyspark.sql.functions as F
import xxhash
from pyspark.sql import Column, DataFrame

from shelfcast.llm.common import let, store
from shelfcast.operators.ordering import ranged_index

NODES = 64
OVERHEAD = 8


def ring(shards: int, nodes: int = NODES) -> list[tuple[int, int]]:
    """Points ``(position, shard)`` in ring order; positions are signed 64-bit, as Spark's hash is."""
    hashed = lambda name: xxhash.xxh64_intdigest(name.encode(), seed=42)
    signed = lambda h: h - 2**64 if h >= 2**63 else h
    return sorted((signed(hashed(f"shard-{s}-node-{n}")), s) for s in range(shards) for n in range(nodes))


def stretches(counts: list[int], owners: list[int], shards: int) -> list[tuple[int, int, int, int]]:
    """Cuts of the ring ``(first_rank, rows, shard, first_slot)``, for rows per arc in ring order.

    Arcs are served in ring order; each takes what is free in its own shard,
    then in the shards of the points that follow clockwise.
    """
    total = sum(counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    filled, cuts, rank = [0] * shards, [], 0
    for arc, rows in enumerate(counts):
        at = arc
        while rows:
            shard = owners[at % len(owners)]
            take = min(rows, room[shard] - filled[shard])
            if take:
                cuts.append((rank, take, shard, filled[shard]))
                filled[shard] += take
                rank += take
                rows -= take
            at += 1
    return cuts


def last_at_most(sorted_values: list[int], x: Column) -> Column:
    """Index of the last value that is at most ``x``, -1 if none: a binary search in unrolled steps."""
    steps = []
    size = 1
    while size <= len(sorted_values):
        size *= 2
    while size > 1:
        size //= 2
        steps.append(size)
    values = F.array(*[F.lit(v).cast("long") for v in sorted_values])
    found = F.lit(0)

    def jump(step: int):
        return lambda n: F.when(F.get(values, n + (step - 1)) <= x, n + step).otherwise(n)

    for step in steps:
        found = let(found, jump(step))
    return found - 1


def shard_rows(
    docs: DataFrame, shards: int = 24, id: str = "doc_id", text: str = "text", nodes: int = NODES
) -> DataFrame:
    """One row per document: ``id, size, text_crc32, law, shard, slot, grown_shard``."""
    points = ring(shards, nodes)
    own = F.coalesce(F.col(text), F.lit(""))
    rows = store(
        docs.select(
            F.monotonically_increasing_id().alias("_row"),
            F.col(id).alias("id"),
            (F.octet_length(own) + OVERHEAD).cast("long").alias("size"),
            F.crc32(own.cast("binary")).alias("text_crc32"),
            F.xxhash64(F.coalesce(F.col(id).cast("string"), F.lit(""))).alias("position"),
        ),
        "ring-rows",
    )
    # arc k holds the positions from point k - 1 on and before point k; the last arc leads round to point 0
    arc = last_at_most([p for p, _ in points], F.col("position")) + 1
    counts = [0] * (len(points) + 1)
    for k, n in rows.groupBy(arc.alias("arc")).count().collect():
        counts[k] = n
    owners = [s for _, s in points]
    cuts = stretches(counts, owners, shards)
    order = [F.col("position"), F.col("id").asc_nulls_first(), F.col("text_crc32"), F.col("size"), F.col("_row")]
    field = lambda k: F.array(*[F.lit(c[k]).cast("long") for c in cuts] or [F.lit(None).cast("long")])
    ranked = ranged_index(rows, order, name="rank").withColumn("cut", last_at_most([c[0] for c in cuts], F.col("rank")))
    return ranked.select(
        F.col("id").alias(id), "size", "text_crc32", F.lit("rows").alias("law"),
        F.get(field(2), F.col("cut")).cast("int").alias("shard"),
        (F.get(field(3), F.col("cut")) + F.col("rank") - F.get(field(0), F.col("cut"))).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

"""Sharding on a consistent-hash ring with bounded loads (operator 3).

Shards stand on a ring of ``2 ** RING_BITS`` cells at the hashes of their
virtual nodes; a row's hash gives its cell, and the next virtual node clockwise
asks for it.  A shard takes rows up to its quota, the rest go on clockwise to
the next node whose shard has room.  With quotas that sum up to the number of
rows, counts differ by one at most.

A node's place is the hash of its shard and its number there, so another shard
takes nodes' cells only where its own nodes stand: with one more shard, rows go
to it, and those that its taking or the smaller quotas push on.

Which shard takes a row follows from the row's rank inside its arc (the cells
between two nodes), so the walk around the ring needs the arcs' row counts
alone: ``shards * nodes`` numbers, whatever the table's size.  It yields rank
intervals of arcs with their shard and first slot, and the rows look those up.

Defined results: null texts have no bytes; a null id hashes by its text; rows
that agree in all they hash take neighbouring slots in any order; an empty
table gives an empty result.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialfold.llm.common import cut, literal_table, ranked

RING_BITS = 16
NODES = 64


def ring(spark: SparkSession, shards: int, nodes: int = NODES, seed: int = 0) -> list[tuple[int, int]]:
    """Sorted (cell, shard) of the virtual nodes (bounded by the parameters).  A
    node's cell follows from its shard and its number within the shard, so it
    stays where it is whatever the number of shards."""
    shard, replica = (F.col("id") % shards).alias("shard"), F.floor(F.col("id") / shards)
    cell = F.shiftrightunsigned(F.xxhash64(F.lit(seed), shard.cast("long"), replica.cast("long")), 64 - RING_BITS)
    found = spark.range(shards * nodes).select(cell.alias("cell"), shard).collect()
    return sorted((r["cell"], r["shard"]) for r in found)


def quotas(n: int, shards: int, balance: float = 1.0) -> list[int]:
    """Rows that each shard takes at most: equal up to one for ``balance`` 1,
    else ``balance`` times that."""
    if balance <= 1:
        return [n // shards + (s < n % shards) for s in range(shards)]
    return [-(-int(n * balance) // shards) + 1] * shards


def walk(counts: list[int], owners: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot).  First every arc's own
    shard takes what it has room for, arc by arc; then what is left goes round
    by round to the next node clockwise."""
    used, out, rest = [0] * len(room), [], []

    def give(arc: int, lo: int, hi: int, shard: int) -> int:
        n = min(hi - lo, room[shard] - used[shard])
        if n > 0:
            out.append((arc, lo, lo + n, shard, used[shard]))
            used[shard] += n
            return lo + n
        return lo

    for arc, n in enumerate(counts):
        lo = give(arc, 0, n, owners[arc])
        if lo < n:
            rest.append((arc, lo, n))
    step = 0
    while rest:
        step += 1
        rest = [(arc, lo, hi) for arc, was, hi in rest
                if (lo := give(arc, was, hi, owners[(arc + step) % len(owners)])) < hi]
    return out


def shard(docs: DataFrame, shards: int, nodes: int = NODES, balance: float = 1.0, seed: int = 0) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 8), text_crc32, shard, slot of each row."""
    spark = docs.sparkSession
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(seed + 1), "text")).otherwise(F.xxhash64(F.lit(seed + 1), "doc_id"))
    slim = cut(docs.select("doc_id", size.alias("size"), crc.alias("text_crc32"), key.alias("_h"))
               .withColumn("_cell", F.shiftrightunsigned("_h", 64 - RING_BITS)))

    stops = ring(spark, shards, nodes, seed)
    cells = [c for c, _ in stops]
    # the arc of node i: cells after node i - 1 up to its own; the last cells of the ring go to node 0
    spans = [(i, (cells[i - 1] + 1) if i else 0, c) for i, c in enumerate(cells)] + [(0, cells[-1] + 1, 2**RING_BITS - 1)]
    arcs = (literal_table(spark, "_arc, _from, _to", [x for x in spans if x[1] <= x[2]])
            .select("_arc", F.explode(F.sequence("_from", "_to")).alias("_cell")))
    # ranks start after the last node, so that the wrapped cells come first
    turned = F.col("_cell") <= F.lit(cells[-1])
    # equal rows may take each other's slots: their place tells them apart, so that no task gets all of them
    rows = slim.withColumn("_tie", F.monotonically_increasing_id()).join(F.broadcast(arcs), "_cell")  # 2 ** RING_BITS cells
    order = [F.col("_arc"), turned, F.col("_h"), F.col("doc_id"), F.col("text_crc32"), F.col("size"), F.col("_tie")]
    rows = cut(ranked(rows, order, "_rank").select("doc_id", "size", "text_crc32", "_arc", "_rank"))
    counts = [0] * len(stops)
    for r in rows.groupBy("_arc").agg(F.count("*").alias("n")).collect():  # one row for each node at most
        counts[r["_arc"]] = r["n"]
    starts = list(accumulate(counts, initial=0))
    taken = walk(counts, [s for _, s in stops], quotas(sum(counts), shards, balance))
    places = literal_table(spark, "_arc, _lo, _hi, _shard, _slot", [(arc, lo + starts[arc], hi + starts[arc], s, slot) for arc, lo, hi, s, slot in taken])
    at = (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi"))
    return (rows.join(F.broadcast(places), "_arc").where(at)  # one row for each node and each filled shard or overflow
            .select("doc_id", "size", "text_crc32", F.col("_shard").cast("int").alias("shard"),
                    (F.col("_slot") + F.col("_rank") - F.col("_lo")).alias("slot")))

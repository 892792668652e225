"""Resharding by minimum-cost flow.

The bytes of every old shard flow to the new shards: what stays costs nothing,
what moves costs its bytes, and no new shard takes more than its capacity. The
flow is solved over shard totals, a table of old times new shards. Each old
shard lays its documents out in blocks of falling size class, the part that
stays first and one part for every transfer after it; a document goes where its
middle lies, so new shards miss their capacity by a few small documents.

Positions come from two running sums, one over blocks and one within a block,
so no task holds a shard. Missing and empty texts have no bytes, and a document of
any size goes whole. Documents with a missing id are placed like others; repeated
rows each get a slot, and those of equal id, size and ``ties`` take theirs in any
order. Other columns stay; those named old_shard, shard or slot are an error. An
empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odflux.llm.place import stored

ROWS_PER_BLOCK = 32_768
BLOCK = ["old_shard", "size_class", "part"]


def min_cost_flow(supply: Sequence[int], capacity: Sequence[int], cost: Sequence[Sequence[int]]) -> list[list[int]]:
    """Flow from supplies to capacities of least total cost, by shortest augmenting paths."""
    if sum(supply) > sum(capacity):
        raise ValueError("the new shards hold less than the old ones")
    n, m = len(supply), len(capacity)
    flow = [[0] * m for _ in range(n)]
    left, room = list(supply), list(capacity)
    while any(left):
        # Least cost to reach each old shard (first n) and new shard, forward along any edge, back along flow.
        reach: list[float] = [0 if x else float("inf") for x in left] + [float("inf")] * m
        came = [-1] * (n + m)
        changed = True
        while changed:
            changed = False
            for i in range(n):
                for j in range(m):
                    if reach[i] + cost[i][j] < reach[n + j]:
                        reach[n + j], came[n + j], changed = reach[i] + cost[i][j], i, True
                    if flow[i][j] and reach[n + j] - cost[i][j] < reach[i]:
                        reach[i], came[i], changed = reach[n + j] - cost[i][j], n + j, True
        end = min((j for j in range(m) if room[j]), key=lambda j: reach[n + j])
        path = [n + end]
        while came[path[-1]] >= 0:
            path.append(came[path[-1]])
        path.reverse()
        steps = list(zip(path, path[1:]))
        amount = min(left[path[0]], room[end], *(flow[b][a - n] for a, b in steps if a >= n))
        for a, b in steps:
            if a < n:
                flow[a][b - n] += amount
            else:
                flow[b][a - n] -= amount
        left[path[0]] -= amount
        room[end] -= amount
    return flow


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (k < total % shards) for k in range(shards)]


def transfers(old_sizes: dict[int, int], capacity: Sequence[int]) -> dict[int, list[tuple[int, int]]]:
    """For each old shard, the new shards its bytes go to, its own first, with the place where each part ends."""
    olds = sorted(old_sizes)
    cost = [[int(i != j) for j in range(len(capacity))] for i in olds]
    flow = min_cost_flow([old_sizes[i] for i in olds], capacity, cost)
    parts = {}
    for i, row in zip(olds, flow):
        at, cuts = 0, []
        for j in sorted(range(len(capacity)), key=lambda j: (j != i, j)):
            if row[j]:
                at += row[j]
                cuts.append((j, at))
        parts[i] = cuts
    return parts


def _target(position: Column, parts: dict[int, list[tuple[int, int]]]) -> Column:
    """New shard of a document by its old shard and twice the place of its middle."""
    shard = F.lit(None).cast("int")
    for old, cuts in parts.items():
        part = F.lit(cuts[-1][0])
        for new, end in reversed(cuts[:-1]):
            part = F.when(position < 2 * end, new).otherwise(part)
        shard = F.when(F.col("old_shard") == old, part).otherwise(shard)
    return shard


def reshard(docs: DataFrame, old_shard: Column, shards: int, ties: Sequence[str] = (), rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``docs`` (doc_id, size, more) with old_shard, shard and slot.

    ``size`` is a positive number of bytes. ``old_shard`` is an expression over
    ``docs`` and never missing. ``ties`` are columns that order documents of one id.
    """
    taken = {"old_shard", "shard", "slot"} & set(docs.columns)
    if taken:
        raise ValueError(f"columns in use: {sorted(taken)}")
    n_sub = max(4, -(-docs.count() // (shards * rows_per_block)))
    laid = docs.select(
        F.struct(*docs.columns).alias("doc"),
        old_shard.cast("int").alias("old_shard"),
        (-F.floor(4 * F.log2("size"))).cast("int").alias("size_class"),
        F.pmod(F.xxhash64("doc_id", "size", *ties, F.lit("part")), F.lit(n_sub)).cast("int").alias("part"),
    )
    blocks = laid.groupBy(*BLOCK).agg(F.sum("doc.size").alias("block_bytes"))
    blocks = stored(blocks, "blocks")
    totals = blocks.groupBy("old_shard").agg(F.sum("block_bytes").alias("bytes")).collect()
    sizes = {r["old_shard"]: r["bytes"] for r in totals}
    parts = transfers(sizes, equal_capacities(sum(sizes.values()), shards))
    before = Window.partitionBy("old_shard").orderBy("size_class", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(*BLOCK, F.coalesce(F.sum("block_bytes").over(before), F.lit(0)).alias("block_start"))
    in_block = Window.partitionBy(*BLOCK).orderBy("doc.doc_id", *(f"doc.{t}" for t in ties))
    through = F.sum("doc.size").over(in_block.rowsBetween(Window.unboundedPreceding, 0))
    placed = laid.join(starts, BLOCK).withColumns(
        {"row": F.row_number().over(in_block), "position": 2 * (F.col("block_start") + through) - F.col("doc.size")}
    )
    placed = stored(placed.withColumn("shard", _target(F.col("position"), parts)).drop("block_start", "position"), "placed")
    pieces = placed.groupBy("shard", *BLOCK).agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first_row"))
    earlier = Window.partitionBy("shard").orderBy(*BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select("shard", *BLOCK, (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first_row")).alias("offset"))
    slotted = placed.join(offsets, ["shard", *BLOCK]).withColumn("slot", F.col("offset") + F.col("row"))
    return slotted.select("doc.*", "old_shard", "shard", "slot")


def affected_shards(placed: DataFrame) -> list[int]:
    """Shards that give or take a document; there are as many rows as shards."""
    moved = placed.where("old_shard != shard").select(F.explode(F.array("old_shard", "shard")).alias("s")).distinct()
    return sorted(r["s"] for r in moved.collect())


def rewrite_affected(docs: DataFrame, placed: DataFrame, path: str) -> list[int]:
    """Write the affected shards below ``path`` as ``shard=`` folders in slot order, and no others; gives those written.

    ``doc_id`` is unique here and present.
    """
    shards = affected_shards(placed)
    if shards:
        rows = docs.join(placed.where(F.col("shard").isin(shards)).select("doc_id", "shard", "slot"), "doc_id")
        rows = rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path)
    return shards

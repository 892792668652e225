"""Pairs within large groups, tile by tile.

The members of a group are dealt to tiles by a hash. Every pair of tiles is one
piece of work, so a member is sent once for each tile of its group and no task
holds more than two tiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = ["group", "tile_a", "tile_b"]


def tile_pairs(members: DataFrame, sizes: DataFrame, member: str, tile_size: int) -> DataFrame:
    """``members`` (group, member, more) with tile, tile_a and tile_b, once for each piece of work they belong to.

    ``sizes`` has group and n, its number of members.
    """
    tiles: Column = F.ceil(F.col("n") / tile_size).cast("int")
    dealt = members.join(sizes.select("group", tiles.alias("tiles")), "group")
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64(member), F.col("tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    rows = dealt.select(*members.columns, "tile", other)
    return rows.withColumns({"tile_a": F.least("tile", "other"), "tile_b": F.greatest("tile", "other")}).drop("other")


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole pieces of work from batches sorted by ``PIECE``."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*(batch.column(c).to_pylist() for c in PIECE)))
        start = 0
        for i in range(len(keys)):
            if keys[i] != key:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, key, start = [], keys[i], i
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)

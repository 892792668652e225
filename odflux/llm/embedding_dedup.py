"""Near-duplicate vectors by int8 tile products.

Vectors of one label are compared tile by tile. A vector is scaled to length one
and rounded to 8-bit numbers; ``e`` is the length of what the rounding changed.
For u and v the product of the rounded vectors differs from the cosine by at
most ``e_u + e_v + e_u * e_v``, so only pairs within that of the threshold can
be links, and these alone are computed again in double precision.

Equal vectors of a label are compared once and counted with their number. A
vector that is missing, zero, or has a missing or non-finite component, a
missing label or a missing id links with nothing and stays. Repeated rows are
vectors of their own; an id with several vectors has the links of each of them.
A cosine at the threshold (a tie) is a link. Other columns do not matter; an
empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflux.llm.components import components, local_roots
from odflux.llm.place import shuffles, stored
from odflux.llm.tiles import PIECE, pieces, tile_pairs

TILE = 2048
STRIP = 256
# The products of the rounded vectors are sums of this many terms at most, exact in single precision.
EXACT_TERMS = (1 << 24) // (127 * 127)
# More than the rounding of the sums below it.
SLACK = 1e-9


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """8-bit codes, the scale of each row and the length of its rounding error."""
    scale = np.abs(unit).max(1) / 127
    codes = np.rint(unit / scale[:, None])
    error = np.sqrt(((unit - codes * scale[:, None]) ** 2).sum(1))
    return codes.astype(np.int8), scale, error


def linked(vectors: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a row of ``left`` and one of ``right`` whose cosine reaches the threshold."""
    length = np.sqrt((vectors**2).sum(1))
    codes, scale, error = quantise(vectors / length[:, None])
    kind = np.float32 if vectors.shape[1] <= EXACT_TERMS else np.float64
    right_codes = codes[right].astype(kind).T
    found = []
    for at in range(0, len(left), STRIP):
        strip = left[at : at + STRIP]
        product = (codes[strip].astype(kind) @ right_codes) * np.outer(scale[strip], scale[right])
        bound = error[strip][:, None] + error[right] + np.outer(error[strip], error[right])
        a, b = np.nonzero(product + bound >= threshold - SLACK)
        a, b = strip[a], right[b]
        for part in range(0, len(a), 1 << 16):
            i, j = a[part : part + (1 << 16)], b[part : part + (1 << 16)]
            cosine = (vectors[i] * vectors[j]).sum(1) / (length[i] * length[j])
            fits = cosine >= threshold
            found.append((i[fits], j[fits]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def near_vectors(vectors: DataFrame, threshold: float = 0.98, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors`` (vec_id, embedding, label).

    Vectors of different lengths have no cosine and do not link.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"), "label")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False)
    )
    good = rows.where(usable)
    classes = good.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = stored(classes.withColumn("group", F.struct("label", F.size("v").alias("length"))), "classes")
    sizes = classes.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    work = tile_pairs(classes.select("group", "rep", "copies", "v"), sizes, "rep", tile)
    work = work.withColumn("group", F.concat_ws(":", F.col("group.label").cast("string"), F.col("group.length").cast("string")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            piece = piece.combine_chunks()
            reps, copies = piece["rep"].to_numpy(), piece["copies"].to_numpy()
            values = piece["v"].combine_chunks().flatten().to_numpy().reshape(piece.num_rows, -1)
            first = piece["tile"].to_numpy() == piece["tile_a"].to_numpy()
            same = piece["tile_a"][0].as_py() == piece["tile_b"][0].as_py()
            left = np.flatnonzero(first)
            right = left if same else np.flatnonzero(~first)
            a, b = linked(values, left, right, threshold)
            if same:
                a, b = a[a < b], b[a < b]
            if not len(a):
                continue
            links = np.bincount(a, copies[b], len(reps)) + np.bincount(b, copies[a], len(reps))
            root = local_roots(len(reps), a, b)
            some = np.flatnonzero(links)
            yield pa.record_batch(
                [pa.array(reps[some]), pa.array(links[some].astype(np.int64)), pa.array(reps[root[some]])], names=["rep", "links", "root"]
            )

    ordered = work.repartition(shuffles(work), *PIECE).sortWithinPartitions(*PIECE)
    found = stored(ordered.mapInArrow(compare, "rep long, links long, root long"), "vector-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    component = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep")
    judged = classes.select("label", "v", "rep", "copies").join(links, "rep", "left").join(component, "rep", "left")
    judged = judged.select(
        "label", "v", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    inside = good.join(judged, ["label", "v"]).select("vec_id", "n_links", "component_id")
    outside = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return inside.union(outside).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

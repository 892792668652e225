"""Near-duplicate texts by a chosen-path join over word shingles.

A text is the set of its distinct shingles of five words (a shorter text: one
shingle of all its words), and two texts are linked when the Jaccard similarity
of their sets is at least the threshold. Texts with equal sets are one class
and compared once.

Chosen paths: a class has 128 sampled tokens, one for each coordinate of a
one-permutation minhash. A run starts from some coordinates; classes that share
the token there fall into one bucket. A bucket of more than ``BUCKET`` members
is split again: a hash of its path picks further coordinates, on average
``BRANCH`` of them, and members go on into a bucket for each of their tokens
there. Small buckets are compared by brute force on the low bytes of the
tokens, with five standard deviations to spare, and what passes is checked on
the whole sets. Runs repeat until a pair at the threshold is missed with a
chance below one in a million when its buckets are small, and about one in a
thousand when every one of them has to be split to the full depth.

A large bucket whose members are mostly like one text, voted for token by token by
some of them, would not come apart however often it were split, and neither does
one still large at full depth.
The members that such buckets connect are a group. A group is compared in
tiles, all members with all, and its pairs are left out of the brute force.

An empty or missing text, or one without an id, links with nothing. Rows of one
id and one text are one document; n_links counts rows.
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
from odflux.llm.words import ROLL_B, U, Words, as_bytes, mix, slices

SHINGLE = 5
THRESHOLD = 0.8
COORDINATES = 128
RUNS = 10
STARTS_PER_RUN = 2
BRANCH = 1 / 0.7
BUCKET = 96
# Rows of a table of large buckets that goes to every task; a row has at most some 200 bytes.
BROADCAST_ROWS = 100_000
DEPTH = 5
TILE = 256
# A large bucket is not split if this part of it looks like what so many of its members have in common.
ALIKE_PART, VOTERS = 0.5, 9
DEVIATIONS = 5.0
# Columns of the token matrix of a tile that are multiplied at a time.
STRIP = 4096

_random = np.random.default_rng(12345)
STARTS = _random.permutation(COORDINATES)[: RUNS * STARTS_PER_RUN]
# For each coordinate, the order in which others stand in for it while it is empty.
STAND_IN = np.stack([np.r_[j, _random.permutation(np.delete(np.arange(COORDINATES), j))] for j in range(COORDINATES)])
SALTS = _random.integers(1, 1 << 62, COORDINATES).astype(np.uint64)
PICKED = U(int(BRANCH / COORDINATES * 2**64))
NONE = np.iinfo(np.uint64).max


def shingles(texts: list[bytes], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and hashes of all distinct shingles, sorted by text and hash."""
    words = Words(texts)
    hashes = words.hashes()
    starts, found = words.windows(hashes, k)
    of = words.text_of[starts]
    counts = words.counts
    for size in range(1, k):
        short = np.flatnonzero(counts == size)
        at = words.first[short]
        value = np.full(len(short), size, U)
        for j in range(size):
            value = value * U(ROLL_B) + hashes[at + j]
        of, found = np.r_[of, short], np.r_[found, mix(value)]
    order = np.lexsort((found, of))
    of, found = of[order], found[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (found[1:] != found[:-1])
    return of[new], found[new]


def sampled_tokens(n: int, of: np.ndarray, found: np.ndarray) -> np.ndarray:
    """For each of n texts and each coordinate, the least hash of the shingles that fall on it."""
    coordinate = (found >> U(57)).astype(np.int64)
    first = np.ones(len(of), bool)
    first[1:] = (of[1:] != of[:-1]) | (coordinate[1:] != coordinate[:-1])
    tokens = np.full((n, COORDINATES), NONE, U)
    tokens[of[first], coordinate[first]] = found[first]
    gaps = np.flatnonzero((tokens == NONE).any(1) & (tokens != NONE).any(1))
    for part in np.array_split(gaps, len(gaps) // 256 + 1):
        filled = tokens[part] != NONE
        donor = np.stack([STAND_IN[j][filled[:, STAND_IN[j]].argmax(1)] for j in range(COORDINATES)], 1)
        tokens[part] = np.take_along_axis(tokens[part], donor, 1)
    return (tokens >> U(20)).astype(np.uint32)


def _set_sums(n: int, of: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two sums of hashes that name a set, and its size."""
    first = np.searchsorted(of, np.arange(n + 1))
    sums = []
    for salt in (1, 2):
        running = np.r_[U(0), np.cumsum(mix(found + U(salt)))]
        sums.append((running[first[1:]] - running[first[:-1]]).view(np.int64))
    return sums[0], sums[1], np.diff(first)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, key and check (names of the shingle set), its size, and the tokens by low and by higher bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n = batch.num_rows
            of, found = shingles(as_bytes(batch.column("text")))
            tokens = sampled_tokens(n, of, found)
            raw = tokens.view(np.uint8).reshape(n, COORDINATES, 4)
            key, check, size = _set_sums(n, of, found)
            low = [r.tobytes() for r in raw[:, :, 0]]
            high = [r.tobytes() for r in raw[:, :, 1:]]
            columns = [batch.column("doc_id"), pa.array(key), pa.array(check), pa.array(size), pa.array(low, pa.binary()), pa.array(high, pa.binary())]
            yield pa.record_batch(columns, names=["doc_id", "key", "check", "size", "low", "high"])

    schema = "doc_id long, key long, check long, size long, low binary, high binary"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def _matrix(column: pa.Array, shape: tuple[int, ...]) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, *shape)


def _tokens(batch: pa.RecordBatch) -> np.ndarray:
    raw = np.concatenate([_matrix(batch.column("low"), (COORDINATES, 1)), _matrix(batch.column("high"), (COORDINATES, 3))], 2)
    return np.ascontiguousarray(raw).view(np.uint32)[:, :, 0].astype(np.uint64)


def start_paths(classes: DataFrame) -> DataFrame:
    """path and key of every class in the first bucket of each start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path = mix(_tokens(batch)[:, STARTS] ^ SALTS[STARTS]).view(np.int64)
            key = np.repeat(batch.column("key").to_numpy(), len(STARTS))
            yield pa.record_batch([pa.array(path.ravel()), pa.array(key)], names=["path", "key"])

    return classes.select("key", "low", "high").mapInArrow(run, "path long, key long")


def next_paths(rows: DataFrame) -> DataFrame:
    """Members of large buckets in the buckets that these are split into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            above = batch.column("path").to_numpy().view(np.uint64)[:, None]
            row, coordinate = np.nonzero(mix(above + SALTS) < PICKED)
            value = _tokens(batch)[row, coordinate]
            path = mix(mix(value ^ SALTS[coordinate]) + above[row, 0]).view(np.int64)
            same = batch.select(["key", "size", "low", "high"]).take(pa.array(row))
            yield pa.record_batch([pa.array(path), *same.columns], names=["path", "key", "size", "low", "high"])

    return rows.select("path", "key", "size", "low", "high").mapInArrow(run, "path long, key long, size long, low binary, high binary")


def _if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table that is sent to every task when it has few rows, and joined by a shuffle otherwise."""
    return F.broadcast(df) if df.count() <= rows else df


def _with_counts(rows: DataFrame) -> DataFrame:
    """Members of buckets of two or more, with the size of their bucket. ``rows`` are written.

    Members of large buckets stay in their tasks: only the paths are counted, and
    those above ``BUCKET`` go to the members. All other buckets are small.
    """
    counts = rows.groupBy("path").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    counts = stored(counts, "bucket-sizes")
    hot = _if_small(counts.where(F.col("members") > BUCKET))
    cold = counts.where(F.col("members") <= BUCKET)
    rest = rows.join(hot.select("path"), "path", "left_anti")
    return rows.join(hot, "path").unionByName(rest.join(cold, "path"))


def _alike(low_a: np.ndarray, low_b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the sets may reach the threshold, judged by the shared tokens."""
    least = np.minimum(size_a, size_b)
    fits = least >= threshold * np.maximum(size_a, size_b)
    spread = DEVIATIONS * np.sqrt(threshold * (1 - threshold) / np.minimum(least, COORDINATES))
    fits[fits] = (low_a[fits] == low_b[fits]).mean(1) >= threshold - spread[fits]
    return fits


def alike_buckets(large: DataFrame, threshold: float) -> DataFrame:
    """Paths of large buckets that splitting would not take apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, pivot = (_matrix(batch.column(c), (COORDINATES,)) for c in ("low", "pivot"))
            size, pivot_size = (batch.column(c).to_numpy() for c in ("size", "pivot_size"))
            alike = _alike(low, pivot, size, pivot_size, threshold)
            yield pa.record_batch([batch.column("path"), pa.array(alike.astype(np.int64))], names=["path", "alike"])

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivots, sizes = [], []
            for voters in batch.column("voters").to_pylist():
                lows = np.stack([np.frombuffer(v["low"], np.uint8) for v in voters])
                uses = (lows[:, None] == lows).sum(1)  # of each voter's token, by how many
                pivots.append(lows[uses.argmax(0), np.arange(COORDINATES)].tobytes())
                sizes.append(int(np.median([v["size"] for v in voters])))
            columns = [batch.column("path"), pa.array(pivots, pa.binary()), pa.array(sizes, pa.int64())]
            yield pa.record_batch(columns, names=["path", "pivot", "pivot_size"])

    # Voters by hash, so a few odd members do not speak for all.
    voters = [F.min_by(F.struct("low", "size"), F.xxhash64("key", F.lit(k))) for k in range(VOTERS)]
    chosen = large.groupBy("path").agg(F.array(*voters).alias("voters"))
    first = stored(chosen.mapInArrow(vote, "path long, pivot binary, pivot_size long"), "pivots")
    rows = large.select("path", "size", "low").join(_if_small(first), "path")
    judged = rows.mapInArrow(run, "path long, alike long").groupBy("path").agg(F.avg("alike").alias("part"))
    return judged.where(F.col("part") >= ALIKE_PART).select("path")


def small_bucket_pairs(rows: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of keys of a bucket that may be linked; those of one ``group`` are left out."""

    def compare(path: np.ndarray, table: pa.Table) -> pa.RecordBatch:
        key, size = table["key"].to_numpy(), table["size"].to_numpy()
        group = table["group"].to_numpy()
        low = _matrix(table["low"].combine_chunks(), (COORDINATES,))
        found = []
        for step in range(1, len(path)):
            at = np.flatnonzero(path[step:] == path[:-step])
            if not len(at):
                break
            to = at + step
            apart = (group[at] != group[to]) | (group[at] == 0)
            at, to = at[apart], to[apart]
            good = _alike(low[at], low[to], size[at], size[to], threshold)
            found.append(np.stack([np.minimum(key[at[good]], key[to[good]]), np.maximum(key[at[good]], key[to[good]])], 1))
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
        return pa.record_batch([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            path = table["path"].to_numpy()
            cut = int(np.flatnonzero(path == path[-1])[0])  # the last bucket may go on
            held = table.slice(cut)
            if cut:
                yield compare(path[:cut], table.slice(0, cut))
        if held is not None:
            yield compare(held["path"].to_numpy(), held)

    ordered = rows.select("path", "key", "size", "group", "low").repartition(shuffles(rows), "path").sortWithinPartitions("path", "key")
    return ordered.mapInArrow(run, "a long, b long").distinct()


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, size, copies and the sorted shingle hashes of the classes in ``wanted`` (key, name, check, first_id, copies)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n = batch.num_rows
            of, found = shingles(as_bytes(batch.column("text")))
            name, check, size = _set_sums(n, of, found)
            sets = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)], pa.int32()), pa.array(found.view(np.int64)))
            # An id may come with several texts.
            mine = (name == batch.column("name").to_numpy()) & (check == batch.column("check").to_numpy())
            yield pa.record_batch([batch.column("key"), batch.column("copies"), pa.array(size), sets], names=["key", "copies", "size", "tokens"]).filter(pa.array(mine))

    texts = docs.select(F.col("doc_id").cast("long").alias("first_id"), "text").join(wanted, "first_id").select("key", "name", "check", "copies", "text")
    found = texts.mapInArrow(run, "key long, copies long, size long, tokens array<long>")
    return stored(found.dropDuplicates(["key"]), "sets")


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose similarity reaches the threshold, with the copies on both sides."""
    a = sets.select(F.col("key").alias("a"), F.col("copies").alias("copies_a"), F.col("tokens").alias("tokens_a"))
    b = sets.select(F.col("key").alias("b"), F.col("copies").alias("copies_b"), F.col("tokens").alias("tokens_b"))
    both = F.size(F.array_intersect("tokens_a", "tokens_b"))
    either = F.size("tokens_a") + F.size("tokens_b") - both
    return pairs.join(a, "a").join(b, "b").where(both >= threshold * either - 1e-9).select("a", "b", "copies_a", "copies_b")


def shared_counts(tokens: np.ndarray, first: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Shared tokens of each left and each right set; set s holds tokens first[s] to first[s + 1]."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    _, column, uses = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = uses[column] > 1
    owner, column = owner[shared], column[shared]
    names, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(names), STRIP):
        low, high = np.searchsorted(column, (at, at + STRIP))
        present = np.zeros((len(first) - 1, min(STRIP, len(names) - at)), np.float32)
        present[owner[low:high], column[low:high] - at] = 1
        total += present[left] @ present[right].T
    return total


def group_links(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """key, its number of linked rows and a linked root, for each tile of each group (group, key)."""
    sizes = members.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    work = tile_pairs(members, sizes, "key", TILE).join(sets, "key")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            keys, copies, size = (piece[c].to_numpy() for c in ("key", "copies", "size"))
            tokens = piece["tokens"].combine_chunks()
            inside = piece["tile"].to_numpy() == piece["tile_a"].to_numpy()
            same = piece["tile_a"][0].as_py() == piece["tile_b"][0].as_py()
            left = np.flatnonzero(inside)
            right = left if same else np.flatnonzero(~inside)
            shared = shared_counts(tokens.flatten().to_numpy(), np.r_[0, np.cumsum(size)], left, right).astype(np.float64)
            either = size[left][:, None] + size[right] - shared
            a, b = np.nonzero(shared >= threshold * either - 1e-9)
            a, b = left[a], right[b]
            if same:
                a, b = a[a < b], b[a < b]
            if not len(a):
                continue
            links = np.bincount(a, copies[b], len(keys)) + np.bincount(b, copies[a], len(keys))
            root = local_roots(len(keys), a, b)
            some = np.flatnonzero(links)
            yield pa.record_batch([pa.array(keys[some]), pa.array(links[some].astype(np.int64)), pa.array(keys[root[some]])], names=["key", "links", "root"])

    ordered = work.repartition(shuffles(work), *PIECE).sortWithinPartitions(*PIECE)
    return ordered.mapInArrow(compare, "key long, links long, root long")


def apart(classes: DataFrame) -> DataFrame:
    """Classes with a key of their own; ``name`` is the one their texts give. Different sets of one name get a new key."""
    alike = stored(classes.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("key").alias("name"), F.lit(True).alias("shared")), "alike-keys")
    named = classes.withColumnRenamed("key", "name")
    if _is_empty(alike):
        return named.withColumn("key", F.col("name"))
    named = named.join(alike, "name", "left")
    return named.withColumn("key", F.when(F.col("shared"), F.xxhash64("name", "check", "size")).otherwise(F.col("name"))).drop("shared")


def _is_empty(df: DataFrame) -> bool:
    return not df.limit(1).count()


def near_texts(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, copy_class (least id of the rows with an equal set), class_id (least id reachable by links) and n_links."""
    marked = stored(signatures(docs), "signatures")
    usable = F.col("doc_id").isNotNull() & (F.col("size") > 0)
    classes = marked.where(usable).groupBy("key", "check", "size").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("low").alias("low"), F.first("high").alias("high")
    )
    classes = apart(stored(classes, "classes"))

    # Split large buckets level by level.
    tokens = classes.select("key", "size", "low", "high")
    level = _with_counts(stored(start_paths(classes), "starts")).join(tokens, "key")
    small, whole = [], []
    for depth in range(DEPTH):
        higher = F.when(F.col("members") > BUCKET, F.col("high")).alias("high")
        level = stored(level.select("path", "members", "key", "size", "low", higher), f"level-{depth}")
        small.append(level.where(F.col("members") <= BUCKET).select("path", "key", "size", "low"))
        large = level.where(F.col("members") > BUCKET)
        if _is_empty(large):
            break
        if depth + 1 == DEPTH:
            whole.append(large.select("path", "key"))
            break
        alike = stored(alike_buckets(large, threshold), f"alike-{depth}")
        alike = _if_small(alike)
        whole.append(large.join(alike, "path", "left_semi").select("path", "key"))
        # Written, as counting the buckets and joining the counts would split twice.
        level = _with_counts(stored(next_paths(large.join(alike, "path", "left_anti")), f"split-{depth}"))

    # Groups of classes that share large buckets which stay whole.
    kept = whole[0] if whole else small[0].where("false").select("path", "key")
    for more in whole[1:]:
        kept = kept.union(more)
    least = stored(kept.groupBy("path").agg(F.min("key").alias("least")), "least")
    to_least = kept.join(_if_small(least), "path")
    star = components(to_least.select(F.col("key").alias("a"), F.col("least").alias("b")).distinct())
    members = stored(star.select(F.col("node").alias("key"), F.col("component").alias("group")).union(
        star.select(F.col("component").alias("key"), F.col("component").alias("group")).distinct()
    ), "groups")

    rows = small[0]
    for more in small[1:]:
        rows = rows.union(more)
    rows = rows.join(members, "key", "left").withColumn("group", F.coalesce("group", F.lit(0)))
    pairs = stored(small_bucket_pairs(rows, threshold), "pairs")
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).union(members.select("key")).distinct()
    sets = shingle_sets(docs, wanted.join(classes.select("key", "name", "check", "first_id", "copies"), "key"))
    sure = stored(verified(pairs, sets, threshold), "verified")
    tiled = stored(group_links(members, sets, threshold), "tiled")

    one_way = sure.select(F.col("a").alias("key"), F.col("copies_b").alias("links"))
    other_way = sure.select(F.col("b").alias("key"), F.col("copies_a").alias("links"))
    links = one_way.union(other_way).union(tiled.select("key", "links")).groupBy("key").agg(F.sum("links").alias("links"))
    joined = components(sure.select("a", "b").union(tiled.select("key", "root"))).withColumnRenamed("node", "key")
    judged = classes.select("key", "name", "check", "size", "first_id", "copies").join(links, "key", "left").join(joined, "key", "left")
    judged = judged.withColumn("component", F.coalesce("component", "key"))
    judged = stored(judged.withColumn("links", F.col("copies") - 1 + F.coalesce("links", F.lit(0))), "judged")
    first = judged.groupBy("component").agg(F.min("first_id").alias("class_id"))
    judged = judged.join(first, "component").select(F.col("name").alias("key"), "check", "size", F.col("first_id").alias("copy_class"), "class_id", F.col("links").alias("n_links"))
    found = marked.where(usable).select("doc_id", "key", "check", "size").join(judged, ["key", "check", "size"])
    found = found.select("doc_id", "copy_class", "class_id", "n_links")
    alone = marked.where(~usable).select("doc_id", F.col("doc_id").alias("copy_class"), F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return found.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without those that another one of their class stands for; rows without an id stay."""
    gone = near_texts(docs.select("doc_id", "text"), threshold).where(~F.col("kept")).select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)

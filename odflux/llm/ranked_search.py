"""Ranked lexical search by presence masks.

1. Postings: every document is read once; of its terms, those that some item
   asks for are kept, with how often they occur. Documents are held in blocks,
   a row each; document frequencies and lengths are sums over blocks.
2. In a block, the bitmaps of an item's terms are laid over each other: bit j of
   a document's mask tells whether it holds term j. Documents of equal masks
   form a group. A group scores at most what its terms can give at best within
   the block, so groups are evaluated from the highest such bound down, until
   the k-th best score so far is above the bound of all that are left.
3. A task keeps the k best of each item over all its blocks; the best of all
   tasks are merged in two steps.

Items go through in portions of ``ITEM_BYTES`` of text; a portion's terms go to
every task. Documents and their postings never leave their block.

Scores are whole numbers and exact. A missing or empty text holds no term: such
a document is never found, such an item finds nothing. Texts of any length are
cut between terms. Equal scores go by the lesser id, a missing id after all
others; repeated documents each take a rank, repeated items are each ranked.
Columns other than ids and texts do not matter. No documents or no items give
no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odflux.llm.place import stored
from odflux.llm.words import as_bytes, slices

# Text of the items that are searched for at a time.
ITEM_BYTES = 1 << 20
# Documents of a block at most, and postings after which it ends.
BLOCK_DOCS, BLOCK_HITS = 1 << 14, 1 << 22
# Text that is split into terms at a time.
PIECE_BYTES = 1 << 20
# Documents evaluated at a time.
AT_ONCE = 64
# Groups the tasks' lists are merged in first.
MERGES = 64

# Fixed values of the score: scale of weights, of the saturated frequency, and its constants.
WEIGHT_SCALE, SATURATION = 1000, 1_000_000_000
LENGTH_BASE, LENGTH_SHARE, LENGTH_FACTOR = 100, 75, 8


def _as_terms() -> bytes:
    """Byte table: letters and digits stay, A to Z become lower-case, other ASCII bytes become blanks."""
    return bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


TERM_BYTES = _as_terms()


def terms(raw: bytes, piece: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """Terms of a text, piece by piece."""
    text = raw.translate(TERM_BYTES)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + piece)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


POSTINGS = "doc_id array<long>, n array<long>, n_docs long, n_terms long, term array<int>, df array<long>, place binary, tf binary"


class Postings:
    """Postings of the documents of a block."""

    def __init__(self) -> None:
        self.doc_ids: list[int | None] = []
        self.n: list[int] = []
        self.hits: list[np.ndarray] = []
        self.n_hits = 0

    def add(self, doc_id: int | None, raw: bytes, number: dict[bytes, int]) -> None:
        n = 0
        for words in terms(raw):
            n += len(words)
            found = np.fromiter(map(number.get, words, repeat(-1)), np.int64, len(words))
            found = found[found >= 0]
            self.hits.append(found * BLOCK_DOCS + len(self.n))
            self.n_hits += len(found)
        self.doc_ids.append(doc_id)
        self.n.append(n)

    def full(self) -> bool:
        return len(self.n) == BLOCK_DOCS or self.n_hits >= BLOCK_HITS

    def row(self) -> pa.RecordBatch:
        keys, tf = np.unique(np.concatenate([np.zeros(0, np.int64), *self.hits]), return_counts=True)
        term, df = np.unique(keys // BLOCK_DOCS, return_counts=True)
        place = (keys % BLOCK_DOCS).astype(np.uint16).tobytes()
        values = [self.doc_ids, self.n, sum(n > 0 for n in self.n), sum(self.n), term, df, place, tf.astype(np.int32).tobytes()]
        long, longs = pa.int64(), pa.list_(pa.int64())
        kinds = [longs, longs, long, long, pa.list_(pa.int32()), longs, pa.binary(), pa.binary()]
        names = ["doc_id", "n", "n_docs", "n_terms", "term", "df", "place", "tf"]
        return pa.record_batch([pa.array([v], t) for v, t in zip(values, kinds)], names=names)


def postings(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """Blocks of documents with the postings of the numbered terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Postings()
        for batch in slices(batches):
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text"))):
                block.add(doc_id, raw, number)
                if block.full():
                    yield block.row()
                    block = Postings()
        if block.n:
            yield block.row()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, POSTINGS)


@dataclass
class Corpus:
    """Documents with terms, and all their terms."""

    n_docs: int
    n_terms: int

    def weight(self, df: int) -> int:
        return math.floor(WEIGHT_SCALE * math.log((2 * self.n_docs + 2) / (2 * df + 1)))

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """Length measure of documents of n terms."""
        if LENGTH_SHARE * int(n.max(initial=0)) * self.n_docs >= 1 << 63:
            n = n.astype(object)
        measure = LENGTH_BASE - LENGTH_SHARE + LENGTH_SHARE * n * self.n_docs // max(1, self.n_terms)
        return measure.astype(np.int64)


@dataclass
class Item:
    number: int
    weights: dict[int, int]  # of its terms, times how often it holds them
    best: list[tuple[int, bool, int]] = field(default_factory=list)  # minus score, whether the id is missing, id

    def take(self, scores: np.ndarray, doc_ids: list[int | None], k: int) -> None:
        found = [(-s, d is None, d or 0) for s, d in zip(scores.tolist(), doc_ids) if s > 0]
        self.best = sorted(self.best + found)[:k]

    def finished(self, bound: int, k: int) -> bool:
        """Whether no document of at most this score can still come in."""
        return bound <= 0 or len(self.best) == k and -self.best[-1][0] > bound


class Block:
    """Postings of a block, ready to be scored."""

    def __init__(self, row: dict, corpus: Corpus):
        self.doc_ids: list[int | None] = row["doc_id"]
        length = corpus.lengths(np.array(row["n"], np.int64))
        place, tf = np.frombuffer(row["place"], np.uint16), np.frombuffer(row["tf"], np.int32).astype(np.int64)
        part = SATURATION * tf // (WEIGHT_SCALE * tf + LENGTH_FACTOR * length[place])
        cuts = np.cumsum(row["df"])[:-1] if row["df"] else []
        self.place = dict(zip(row["term"], np.split(place, cuts)))
        self.part = dict(zip(row["term"], np.split(part, cuts)))

    def bitmap(self, term: int) -> np.ndarray:
        bits = np.zeros(len(self.doc_ids), bool)
        bits[self.place[term]] = True
        return bits

    def masks(self, held: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents that hold one of the terms, the number of each one's mask, and all distinct masks as rows of bits."""
        words = np.zeros((len(held) + 63 >> 6, len(self.doc_ids)), np.uint64)
        for j, term in enumerate(held):
            words[j >> 6] |= self.bitmap(term).astype(np.uint64) << np.uint64(j & 63)
        places = np.flatnonzero(words.any(0))
        if len(words) == 1:
            distinct, group = np.unique(words[0, places], return_inverse=True)
            distinct = distinct[:, None]
        else:
            distinct, group = np.unique(words[:, places].T, axis=0, return_inverse=True)
        bits = np.stack([distinct[:, j >> 6] >> np.uint64(j & 63) & np.uint64(1) for j in range(len(held))], 1)
        return places, group.reshape(-1), bits.astype(bool)

    def scores(self, places: np.ndarray, weights: dict[int, int], held: list[int]) -> np.ndarray:
        total = np.zeros(len(places), np.int64)
        for term in held:
            own = self.place[term]
            at = np.minimum(np.searchsorted(own, places), len(own) - 1)
            total += np.where(own[at] == places, weights[term] * self.part[term][at], 0)
        return total

    def rank(self, item: Item, k: int) -> int:
        """Merge the block's best documents into the item's; the number of documents evaluated."""
        held = [t for t in item.weights if t in self.place]
        if not held:
            return 0
        best = np.array([item.weights[t] * int(self.part[t].max()) for t in held], np.int64)
        if item.finished(int(best.sum()), k):
            return 0
        places, group, bits = self.masks(held)
        bound = bits @ best
        falling = np.argsort(-bound, kind="stable")
        # Documents by falling bound of their group.
        turn = np.empty(len(falling), np.int64)
        turn[falling] = np.arange(len(falling))
        order = np.argsort(turn[group], kind="stable")
        places, bound = places[order], bound[group[order]]
        done = 0
        while done < len(places) and not item.finished(int(bound[done]), k):
            some = places[done : done + AT_ONCE]
            item.take(self.scores(some, item.weights, held), [self.doc_ids[p] for p in some], k)
            done += len(some)
        return done


FOUND = "item long, doc_id long, score long"


def candidates(blocks: DataFrame, weights: list[tuple[int, dict[int, int]]], corpus: Corpus, k: int) -> DataFrame:
    """The k best documents of each item, for every task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = [Item(number, own) for number, own in weights]
        for batch in batches:
            for at in range(batch.num_rows):
                block = Block(batch.slice(at, 1).to_pylist()[0], corpus)
                for item in items:
                    block.rank(item, k)
        rows = [(item.number, None if missing else d, -score) for item in items for score, missing, d in item.best]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["item", "doc_id", "score"])

    return blocks.select("doc_id", "n", "term", "df", "place", "tf").mapInArrow(run, FOUND)


def _first(found: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _portion(docs: DataFrame, rows: list, k: int) -> DataFrame:
    """item, doc_id and score of the best documents of each task, for items (item, text)."""
    asked = [(row["item"], Counter(t for some in terms(row["text"].encode()) for t in some)) for row in rows]
    number = {t: n for n, t in enumerate(sorted({t for _, own in asked for t in own}))}
    blocks = stored(postings(docs, number), "postings")
    size = blocks.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    corpus = Corpus(size["n"] or 0, size["l"] or 0)
    # At most a row for each term of the items.
    counts = blocks.select(F.explode(F.arrays_zip("term", "df")).alias("t")).groupBy("t.term").agg(F.sum("t.df").alias("df")).collect()
    df = {row["term"]: row["df"] for row in counts}
    weights = [(item, {number[t]: n * corpus.weight(df[number[t]]) for t, n in own.items() if number[t] in df}) for item, own in asked]
    return candidates(blocks, weights, corpus, k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the k best documents of every item (item_id, text)."""
    asked = items.select("item_id", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("item"))
    asked = stored(asked, "items")
    size = asked.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    portions = max(1, -(-size // item_bytes))
    found = []
    for portion in range(portions):
        rows = asked.where(F.pmod(F.xxhash64("item"), F.lit(portions)) == portion).select("item", "text") if portions > 1 else asked.select("item", "text")
        part = _portion(docs, rows.orderBy("item").collect(), k)
        found.append(stored(part, "found") if portions > 1 else part)
    merged = reduce(DataFrame.unionByName, found).withColumn("merge", F.pmod(F.xxhash64("doc_id"), F.lit(MERGES)))
    best = _first(_first(merged, k, "item", "merge").drop("rank", "merge"), k, "item")
    return best.join(asked.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")

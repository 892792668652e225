"""Tokens of two tokenizers over the same text, aligned by the bytes they cover.

Side A is a byte-level vocabulary (JSON) run on a blank and the text, side B a
piece vocabulary (SentencePiece) run on the text, before which it sets a blank
itself; so both sides cover blank + text. Texts are encoded by the stretches
between single blanks, which no token of either side crosses; equal stretches
are encoded once a worker.

Per batch, ``merge_asof`` keyed by document finds for each token start the token
of the other side that covers it. The union of both directions holds all
overlaps; overlaps with equal ends are links, and their ends cut both sides into
groups.

How often an id pair is linked in the whole corpus is counted by blocks: a block
is a row of some documents with its distinct pairs. Only these are shuffled, so
a pair that every document holds costs a row a block. Each block then gets the
totals of its own pairs.

Nulls, empty texts, and texts that either side does not give back byte for byte
have no tokens: zeros, no groups. A text of any length is one row; repeated rows
and equal or missing ids are each a document of their own and count as such. A
pair that ties for the most links of its B id is a best one. Columns other than
doc_id and text do not matter; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflux.llm.bpe import byte_letters
from odflux.llm.place import stored
from odflux.llm.words import slices

# Text aligned at a time, and text of a block.
SLICE_BYTES = 1 << 20
BLOCK_BYTES = 4 << 20
# Distinct stretches a worker remembers between batches; more are encoded anew in each batch.
REMEMBERED = 250_000
# Longer stretches go to the vocabulary's own library.
LONG_STRETCH = 10_000

# How a byte-level vocabulary takes text apart, the blank of pieces, and pieces of one byte.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLANK = "▁"
BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")

CUT = re.compile(f"(?<=[^\\s{BLANK}]) (?=[^\\s{BLANK}])")
# Letters whose kind does not depend on the edition of Unicode.
RARE = re.compile("[^\x00-ɏ‐-‧€]")


def _stands_alone(stretch: str) -> bool:
    """Whether a stretch between blanks is cut off by blanks that no token crosses."""
    return bool(stretch) and not stretch[0].isspace() and not stretch[-1].isspace() and BLANK not in stretch


class ByteLevel:
    """Side A."""

    def __init__(self, path: str):
        self.own = tokenizers.Tokenizer.from_file(path)
        self.own.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        self.bytes_of = [b""] * self.own.get_vocab_size()
        for text, number in self.own.get_vocab().items():
            self.bytes_of[number] = bytes(byte_of[c] for c in text) if all(c in byte_of for c in text) else text.encode()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # Where ids go by rank, the same vocabulary can be run by the faster library.
        ranked = [model["vocab"][left + right] for left, right in merges] == list(range(256, 256 + len(merges)))
        ranks = {self.bytes_of[i]: i for i in range(256 + len(merges))}
        plain = ranked and len(ranks) == 256 + len(merges)
        self.fast = tiktoken.Encoding("ranks", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}) if plain else None

    def encode(self, stretches: list[str]) -> list[list[int]]:
        """Ids of each stretch with a blank before it."""
        if self.fast is None:
            return [e.ids for e in self.own.encode_batch_fast([" " + s for s in stretches], add_special_tokens=False)]
        ids = []
        for stretch in stretches:
            if len(stretch) > LONG_STRETCH or RARE.search(stretch):
                ids.append(self.own.encode(" " + stretch, add_special_tokens=False).ids)
            else:
                ids.append(self.fast.encode_ordinary(" " + stretch))
        return ids


class Pieces:
    """Side B."""

    def __init__(self, path: str):
        self.own = sentencepiece.SentencePieceProcessor(model_file=path)
        texts = [self.own.id_to_piece(i) for i in range(self.own.get_piece_size())]
        self.bytes_of = [self._bytes(t) for t in texts]
        crossing = any(BLANK in t[1:] and t.strip(BLANK) for t in texts)
        if crossing:
            raise ValueError("a piece goes on after a blank, so texts cannot be cut at blanks")

    @staticmethod
    def _bytes(piece: str) -> bytes:
        byte = BYTE_PIECE.fullmatch(piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace(BLANK, " ").encode()

    def encode(self, stretches: list[str]) -> list[list[int]]:
        return self.own.encode(stretches, num_threads=1) if stretches else []


@dataclass
class Tokens:
    """Tokens of one side of some texts, laid end to end."""

    ids: np.ndarray
    text: np.ndarray  # number of the text
    end: np.ndarray  # in bytes, on through all texts
    start: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, text: np.ndarray, sizes: np.ndarray) -> Tokens:
        end = np.cumsum(sizes[ids])
        return cls(ids, text, end, end - sizes[ids])

    def frame(self, name: str) -> pd.DataFrame:
        return pd.DataFrame({"text": self.text, "at": self.start, name: np.arange(len(self.ids))})


@dataclass
class Aligned:
    """Texts with tokens on both sides, by their numbers; links are pairs of tokens that end together."""

    a: Tokens
    b: Tokens
    n: int
    overlap_a: np.ndarray
    overlap_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray

    @classmethod
    def of(cls, a: Tokens, b: Tokens, n: int) -> Aligned:
        left, right = a.frame("a"), b.frame("b")
        forth = pd.merge_asof(left, right, on="at", by="text")
        back = pd.merge_asof(right, left, on="at", by="text")
        # Tokens that begin together are found both ways.
        once = a.start[back["a"].to_numpy()] != b.start[back["b"].to_numpy()]
        over_a = np.concatenate([forth["a"].to_numpy(), back["a"].to_numpy()[once]])
        over_b = np.concatenate([forth["b"].to_numpy(), back["b"].to_numpy()[once]])
        linked = a.end[over_a] == b.end[over_b]
        return cls(a, b, n, over_a, over_b, np.sort(over_a[linked]), np.sort(over_b[linked]))

    def count(self, side: Tokens) -> np.ndarray:
        return np.bincount(side.text, minlength=self.n)

    @property
    def n_links(self) -> np.ndarray:
        return np.bincount(self.a.text[self.link_a], minlength=self.n)

    def groups(self, names: tuple[np.ndarray, np.ndarray, np.ndarray]) -> list[bytes]:
        """Groups of each text as ``a1,a2|b1;a3|b2,b3``. ``names`` are ids followed by a comma, a bar and a semicolon."""
        comma, bar, semicolon = names
        closes_a, closes_b = np.zeros(len(self.a.ids), bool), np.zeros(len(self.b.ids), bool)
        closes_a[self.link_a] = closes_b[self.link_b] = True
        group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
        place_a = np.arange(len(self.a.ids)) + np.r_[0, self.link_b + 1][group_a]
        place_b = np.arange(len(self.b.ids)) + (self.link_a + 1)[group_b]
        parts = np.empty(len(place_a) + len(place_b), object)
        parts[place_a], parts[place_b] = comma[self.a.ids], comma[self.b.ids]
        parts[place_a[self.link_a]] = bar[self.a.ids[self.link_a]]
        parts[place_b[self.link_b]] = semicolon[self.b.ids[self.link_b]]
        ends = np.cumsum(self.count(self.a) + self.count(self.b)).tolist()
        return [b"".join(parts[start:end].tolist())[:-1] for start, end in zip([0, *ends], ends)]


class Remembered:
    """Ids of numbered stretches, end to end."""

    def __init__(self) -> None:
        self.ids, self.first = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def add(self, encoded: list[list[int]]) -> np.ndarray:
        ends = np.cumsum(np.fromiter(map(len, encoded), np.int64, len(encoded)))
        ids = np.fromiter(chain.from_iterable(encoded), np.int64)
        self.first = np.r_[self.first, len(self.ids) + ends]
        self.ids = np.r_[self.ids, ids]
        return ids

    def keep(self, n: int) -> None:
        self.first = self.first[: n + 1]
        self.ids = self.ids[: self.first[-1]]

    def take(self, numbers: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some stretches, and the text of each id."""
        start = self.first[numbers]
        n = self.first[numbers + 1] - start
        before = np.cumsum(n) - n
        return self.ids[np.repeat(start - before, n) + np.arange(n.sum())], np.repeat(text, n)


class Aligner:
    """Two vocabularies, and what a worker remembers of them."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.sizes = [np.array([len(x) for x in side.bytes_of]) for side in (self.a, self.b)]
        most = max(map(len, self.sizes))
        self.names = tuple(np.array([b"%d%c" % (i, mark) for i in range(most)], object) for mark in b",|;")
        self.number: dict[str, int] = {}
        self.known = Remembered(), Remembered()
        self.lossy = np.zeros(0, bool)  # stretches whose bytes differ from those of their ids

    def pair_ids(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a * len(self.b.bytes_of) + b

    def learn(self, stretches: list[str]) -> None:
        raw = [b" " + s.encode() for s in stretches]
        length = np.fromiter(map(len, raw), np.int64, len(raw))
        lossy = np.zeros(len(raw), bool)
        for side, sizes, known in zip((self.a, self.b), self.sizes, self.known):
            encoded = side.encode(stretches)
            ids = known.add(encoded)
            ends = known.first[-len(raw) :] - known.first[-len(raw) - 1] if raw else known.first[:0]
            covered = np.diff(np.r_[0, np.r_[0, np.cumsum(sizes[ids])][ends]])
            if not np.array_equal(covered, length) or b"".join(map(side.bytes_of.__getitem__, ids.tolist())) != b"".join(raw):
                lossy |= [b"".join(map(side.bytes_of.__getitem__, e)) != r for e, r in zip(encoded, raw)]
        self.number.update(zip(stretches, range(len(self.number), len(self.number) + len(raw))))
        self.lossy = np.r_[self.lossy, lossy]

    def forget(self, stretches: list[str]) -> None:
        """Forget the stretches learnt last."""
        for stretch in stretches:
            del self.number[stretch]
        n = len(self.number)
        self.lossy = self.lossy[:n]
        for known in self.known:
            known.keep(n)

    def align(self, texts: list[str]) -> tuple[np.ndarray, Aligned]:
        """Numbers of the texts that have tokens, and their alignment."""
        cuts = [t.split(" ") if t else [] for t in texts]
        new = set().union(*cuts).difference(self.number)
        odd = {s for s in new if not _stands_alone(s)}
        if odd:
            for k, stretches in enumerate(cuts):
                if not odd.isdisjoint(stretches):
                    cuts[k] = CUT.split(texts[k])
            new = set().union(*cuts).difference(self.number)
            odd = {s for s in new if not _stands_alone(s)}
        learnt = [*(new - odd), *odd]
        self.learn(learnt)
        text = np.repeat(np.arange(len(texts)), list(map(len, cuts)))
        numbers = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cuts)), np.int64, len(text))
        good = np.bincount(text, minlength=len(texts)) > 0
        good[text[self.lossy[numbers]]] = False
        numbers, text = numbers[good[text]], (np.cumsum(good) - 1)[text[good[text]]]
        sides = [Tokens.of(*known.take(numbers, text), sizes) for known, sizes in zip(self.known, self.sizes)]
        self.forget(learnt if len(self.number) > REMEMBERED else learnt[len(new) - len(odd) :])
        return np.flatnonzero(good), Aligned.of(*sides, int(good.sum()))


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


ALIGNED = "doc_id long, a_ids array<int>, b_ids array<int>, overlaps array<struct<a: int, b: int>>, groups string"


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Ids of both sides, which tokens overlap (by their numbers in the document) and the groups, of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        for batch in slices(batches, most=SLICE_BYTES):
            there, found = both.align([t or "" for t in batch.column("text").to_pylist()])
            groups = found.groups(both.names)
            first_a, first_b = np.searchsorted(found.a.text, np.arange(found.n + 1)), np.searchsorted(found.b.text, np.arange(found.n + 1))
            order = np.lexsort((found.overlap_b, found.overlap_a))
            over_a, over_b = found.overlap_a[order], found.overlap_b[order]
            cuts = np.searchsorted(over_a, first_a)
            rows = [{"doc_id": d, "a_ids": [], "b_ids": [], "overlaps": [], "groups": ""} for d in batch.column("doc_id").to_pylist()]
            for k, row in enumerate(there.tolist()):
                some = slice(cuts[k], cuts[k + 1])
                pairs = zip((over_a[some] - first_a[k]).tolist(), (over_b[some] - first_b[k]).tolist())
                rows[row] |= {
                    "a_ids": found.a.ids[first_a[k] : first_a[k + 1]].tolist(),
                    "b_ids": found.b.ids[first_b[k] : first_b[k + 1]].tolist(),
                    "overlaps": [{"a": a, "b": b} for a, b in pairs],
                    "groups": groups[k].decode(),
                }
            yield pa.RecordBatch.from_pylist(rows, schema=_arrow_schema())

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ALIGNED)


def _arrow_schema() -> pa.Schema:
    ids = pa.list_(pa.int32())
    overlaps = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    return pa.schema([("doc_id", pa.int64()), ("a_ids", ids), ("b_ids", ids), ("overlaps", overlaps), ("groups", pa.string())])


# Columns of a block with a value for each of its documents.
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
BLOCKS = (
    "block long, doc_id array<long>, "
    + ", ".join(f"{c} array<long>" for c in COUNTS)
    + ", groups_sha256 array<string>, links binary, pair array<long>, pair_links array<long>"
)


class Block:
    """Documents that are counted together."""

    def __init__(self) -> None:
        self.doc_ids: list[int | None] = []
        self.counts: list[np.ndarray] = []
        self.digests: list[str] = []
        self.pairs: list[np.ndarray] = []

    def add(self, doc_ids: list[int | None], texts: list[str], both: Aligner) -> None:
        there, found = both.align(texts)
        counts = np.zeros((len(COUNTS), len(texts)), np.int64)
        n_links = found.n_links  # a link closes a group
        for row, values in zip(counts, (found.count(found.a), found.count(found.b), n_links, n_links)):
            row[there] = values
        digests = [""] * len(texts)
        for k, groups in zip(there.tolist(), found.groups(both.names)):
            digests[k] = hashlib.sha256(groups).hexdigest()
        self.doc_ids += doc_ids
        self.counts.append(counts)
        self.digests += digests
        self.pairs.append(both.pair_ids(found.a.ids[found.link_a], found.b.ids[found.link_b]))

    def row(self, number: int) -> pa.RecordBatch:
        link, pair = pd.factorize(np.concatenate(self.pairs))
        n = np.bincount(link, minlength=len(pair))
        links = zstandard.ZstdCompressor(level=1).compress(link.astype(np.uint32).tobytes())
        counts = np.concatenate(self.counts, axis=1)
        values = [number, self.doc_ids, *counts, self.digests, links, pair, n]
        long, longs = pa.int64(), pa.list_(pa.int64())
        types = [long, longs, *[longs] * len(COUNTS), pa.list_(pa.string()), pa.binary(), longs, longs]
        names = ["block", "doc_id", *COUNTS, "groups_sha256", "links", "pair", "pair_links"]
        return pa.record_batch([pa.array([v], t) for v, t in zip(values, types)], names=names)


def blocks_of(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Aligned documents, a row for each block. ``links`` are places in ``pair``, link by link, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        number, block, size = TaskContext.get().partitionId() << 32, Block(), 0
        for batch in slices(batches, most=min(SLICE_BYTES, block_bytes)):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            block.add(batch.column("doc_id").to_pylist(), texts, both)
            size += sum(map(len, texts)) + batch.num_rows
            if size >= block_bytes:
                yield block.row(number)
                number, block, size = number + 1, Block(), 0
        if block.doc_ids:
            yield block.row(number)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, BLOCKS)


SCORED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _scored(left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents of a block, with the totals of its pairs."""
    columns = {c: left.column(c)[0].values for c in ("doc_id", *COUNTS, "groups_sha256")}
    n_links = columns["n_links"].to_numpy()
    links = np.frombuffer(zstandard.ZstdDecompressor().decompress(left.column("links")[0].as_py()), np.uint32)
    total = np.zeros(right.num_rows, np.int64)
    best = np.zeros(right.num_rows, np.int64)
    place = right.column("place").to_numpy()
    total[place], best[place] = right.column("total").to_numpy(), right.column("best").to_numpy()
    ends = np.cumsum(n_links)
    sums = [np.diff(np.r_[0, np.r_[0, np.cumsum(value[links])][ends]]) for value in (best, total)]
    values = [columns["doc_id"], *(columns[c] for c in COUNTS), *(pa.array(s) for s in sums), columns["groups_sha256"]]
    return pa.table(values, names=["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"])


def score_links(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Counts of tokens, groups and links of every document, and its links by how often the corpus links their ids."""
    blocks = stored(blocks_of(docs, path_a, path_b, block_bytes), "blocks")
    pairs = blocks.select("block", F.posexplode(F.arrays_zip("pair", "pair_links")).alias("place", "p"))
    pairs = pairs.select("block", "place", F.col("p.pair").alias("pair"), F.col("p.pair_links").alias("n"))
    totals = pairs.groupBy("pair").agg(F.sum("n").alias("total"))
    totals = totals.withColumn("b", F.col("pair") % F.lit(sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()))
    # At most a row for each id of the vocabulary.
    top = totals.groupBy("b").agg(F.max("total").alias("top"))
    ranked = totals.join(F.broadcast(top), "b").select("pair", "total", (F.col("total") == F.col("top")).cast("long").alias("best"))
    found = pairs.select("block", "place", "pair").join(ranked, "pair")
    found = found.select(F.col("block").alias("of_block"), F.col("place").cast("long").alias("place"), "total", "best")
    return blocks.groupBy("block").cogroup(found.groupBy("of_block")).applyInArrow(_scored, SCORED)

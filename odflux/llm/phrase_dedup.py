"""Removal of repeated passages by relative Lempel-Ziv parsing against all documents.

Documents are cut into reference blocks. The index over all blocks tells, for a
phrase of ``WIDTH`` words, the least document that has it. A document is parsed
from left to right: a factor begins at a phrase that a lesser document has, and
goes on while the next phrase, one word further, is in that same source. Where
it ends, the phrases that reach over the boundary are looked up as well, so a
repeat made up of several sources is found whole. All words of factors go.

The index is built in two rounds, each a shuffle of packed arrays rather than
rows. Every phrase has an anchor, the least hash of the runs of ``ANCHOR`` words
in it; equal phrases have equal anchors. Round one finds the anchors that occur
in two documents. Round two looks up only phrases with such an anchor. What a
block sends for a hash is one entry however often the block has it, and what
comes back is one bit (and the source), so a passage in a third of all documents
costs an entry for each block. Phrases are named by 64 bits and as many more as
number the parts of the index.

A missing or empty text has no words. A document without an id keeps all its
words and is no source. Rows of one id are one document: none is a source for
another, so of repeated rows (ties) all stay. Texts of any length are parsed
whole. Columns other than doc_id and text do not matter; an empty table gives an
empty one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflux.llm.place import shuffles, stored
from odflux.llm.words import BASE_B, ROLL_B, U, Words, as_bytes, covered, mix, slices

WIDTH = 13
ANCHOR = 4
BLOCK_BYTES = 4 << 20
# Entries of the index held by a task at a time, about.
PART_ENTRIES = 2_000_000
LEAST_PARTS = 32
# Distinct entries that a thousand words make in each round, about.
ANCHORS_PER_WORDS, PHRASES_PER_WORDS = 0.2, 0.3

BLOCK_SCHEMA = "block long, n_words long, ids array<long>, lengths array<int>, texts binary"


def blocks_of(docs: DataFrame) -> DataFrame:
    """Documents in reference blocks, packed and written once, so a block stays the same block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        ids: list[int | None] = []
        texts: list[bytes] = []

        def block() -> pa.RecordBatch:
            whole = b"".join(texts)
            row = {
                "block": [uuid.uuid4().int >> 65], "n_words": [sum(len(t.split()) for t in texts)], "ids": [ids[:]],
                "lengths": [[len(t) for t in texts]], "texts": [pack(whole)],
            }
            types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
            made = pa.record_batch([pa.array(v, t) for v, t in zip(row.values(), types)], names=list(row))
            ids.clear()
            texts.clear()
            return made

        held = 0
        for batch in slices(batches, most=BLOCK_BYTES // 4):
            ids += batch.column("doc_id").to_pylist()
            new = as_bytes(batch.column("text"))
            texts += new
            held += sum(map(len, new))
            if held >= BLOCK_BYTES:
                yield block()
                held = 0
        if ids:
            yield block()

    return stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, BLOCK_SCHEMA), "blocks")


@dataclass
class Block:
    """Phrases of a block: the number of the first word, the document and the anchor of each."""

    texts: list[bytes]
    words: Words
    hashes: np.ndarray
    start: np.ndarray
    doc: np.ndarray
    anchor: np.ndarray

    @classmethod
    def of(cls, ids: list[int | None], lengths: list[int], packed: bytes) -> Block:
        whole = zstandard.ZstdDecompressor().decompress(packed) if sum(lengths) else b""
        ends = np.cumsum(lengths).tolist()
        texts = [whole[end - n : end] for end, n in zip(ends, lengths)]
        words = Words(texts)
        hashes = words.hashes()
        n = len(hashes) - WIDTH + 1
        named = np.array([i is not None for i in ids])
        if n <= 0:
            none = np.zeros(0, np.int64)
            return cls(texts, words, hashes, none, none, none.astype(U))
        text = words.text_of
        start = np.flatnonzero((text[:n] == text[WIDTH - 1 :]) & named[text[:n]])
        runs = np.zeros(len(hashes) - ANCHOR + 1, U)
        for j in range(ANCHOR):
            runs = runs * U(ROLL_B) + hashes[j : j + len(runs)]
        # Least over the runs of a phrase, by doubling.
        least, span = mix(runs), 1
        wanted = WIDTH - ANCHOR + 1
        while 2 * span <= wanted:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        rest = wanted - span
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
        numbers = np.array([-1 if i is None else i for i in ids], np.int64)
        return cls(texts, words, hashes, start, numbers[text[start]], least[start])

    def phrases(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the phrases at ``chosen`` places of ``start``."""
        first = self.start[chosen]
        more = self.words.hashes(BASE_B)
        one, two = np.zeros(len(first), U), np.zeros(len(first), U)
        for j in range(WIDTH):
            one = one * U(ROLL_B) + self.hashes[first + j]
            two = two * U(ROLL_B) + more[first + j]
        return mix(one), mix(two)


def _parts(values: np.ndarray, bits: int) -> np.ndarray:
    """Where each part begins among sorted values; a part has equal leading bits."""
    return np.searchsorted(values, np.arange(1 << bits, dtype=U) << U(64 - bits)).tolist() + [len(values)]


def _anchor_entries(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Distinct anchors in order, and whether two documents of the block have them."""
    if not len(block.anchor):
        return block.anchor, np.zeros(0, bool)
    new = np.ones(len(block.anchor), bool)
    new[1:] = (block.anchor[1:] != block.anchor[:-1]) | (block.doc[1:] != block.doc[:-1])
    anchor, doc = block.anchor[new], block.doc[new]
    order = np.argsort(anchor, kind="stable")
    anchor, doc = anchor[order], doc[order]
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    return anchor[first], np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first)


def _sent(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"part": pa.int32(), "block": pa.int64()}
    return pa.record_batch([pa.array([r[k] for r in rows], kinds.get(n, pa.binary())) for k, n in enumerate(names)], names=names)


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of each part from batches sorted by part."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["part"] != row["part"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _flags(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)


def shared_anchors(blocks: DataFrame, bits: int) -> DataFrame:
    """block and, for each part, a bit for each of its distinct anchors: whether two documents have it."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                anchor, twice = _anchor_entries(Block.of(row["ids"], row["lengths"], row["texts"]))
                cut = _parts(anchor, bits)
                # 32 bits of an anchor are enough within a part: a false match only costs a lookup.
                short = (anchor << U(bits) >> U(32)).astype(np.uint32)
                rows = [
                    (p, row["block"], short[a:b].tobytes(), np.packbits(twice[a:b]).tobytes())
                    for p, (a, b) in enumerate(zip(cut, cut[1:])) if b > a
                ]
                yield _sent(rows, ["part", "block", "anchors", "twice"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_part(batches):
            each = [np.frombuffer(r["anchors"], np.uint32) for r in rows]
            values = np.concatenate(each)
            shared = np.concatenate([_flags(r["twice"], len(e)) for r, e in zip(rows, each)])
            order = np.argsort(values, kind="stable")
            ordered = values[order]
            same = ordered[1:] == ordered[:-1]
            shared[order[1:][same]] = True
            shared[order[:-1][same]] = True
            # One document in two blocks, or two anchors of equal bits, also count; a lookup settles them.
            whole = np.zeros(len(values), bool)
            groups = np.cumsum(np.r_[0, ~same])
            any_shared = np.zeros(groups[-1] + 1, bool)
            any_shared[groups[shared[order]]] = True
            whole[order] = any_shared[groups]
            ends = np.cumsum([0, *map(len, each)])
            yield _sent(
                [(r["part"], r["block"], np.packbits(whole[a:b]).tobytes()) for r, a, b in zip(rows, ends, ends[1:])],
                ["part", "block", "shared"],
            )

    sent = blocks.select("block", "ids", "lengths", "texts").mapInArrow(send, "part int, block long, anchors binary, twice binary")
    dealt = sent.repartition(max(shuffles(sent), LEAST_PARTS), "part").sortWithinPartitions("part", "block")
    marks = dealt.mapInArrow(answer, "part int, block long, shared binary")
    return stored(marks.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("part", "shared"))).alias("anchor_marks")), "anchor-marks")


def _looked_up(block: Block, marks: list[dict] | None, bits: int) -> np.ndarray:
    """Places of ``start`` whose anchor two documents have."""
    anchor, _ = _anchor_entries(block)
    cut = _parts(anchor, bits)
    shared = np.zeros(len(anchor), bool)
    for mark in marks or []:
        a, b = cut[mark["part"]], cut[mark["part"] + 1]
        shared[a:b] = _flags(mark["shared"], b - a)
    return np.flatnonzero(shared[np.searchsorted(anchor, block.anchor)])


def _phrase_entries(block: Block, chosen: np.ndarray, bits: int) -> tuple[np.ndarray, list[int], np.ndarray, np.ndarray]:
    """Distinct phrases in order of their part: name, where parts begin, least document; and the entry of each chosen place."""
    one, two = block.phrases(chosen)
    # Within a part the leading bits are equal; bits of the second hash take their place at the end.
    name = (one << U(bits)) | (two >> U(64 - bits))
    part = (one >> U(64 - bits)).astype(np.int64)
    order = np.lexsort((name, part))
    name, part, doc = name[order], part[order], block.doc[chosen][order]
    new = np.ones(len(order), bool)
    new[1:] = (name[1:] != name[:-1]) | (part[1:] != part[:-1])
    first = np.flatnonzero(new)
    least = np.minimum.reduceat(doc, first) if len(first) else doc
    entry = np.zeros(len(order), np.int64)
    entry[order] = np.cumsum(new) - 1
    cut = np.searchsorted(part[first], np.arange((1 << bits) + 1)).tolist()
    return name[first], cut, least, entry


def phrase_sources(blocks: DataFrame, anchor_marks: DataFrame, bits: int) -> DataFrame:
    """block and, for each part, a bit for each of its distinct phrases: whether a document less than all of the block's has it; and which."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block.of(row["ids"], row["lengths"], row["texts"])
                name, cut, least, _ = _phrase_entries(block, _looked_up(block, row["anchor_marks"], bits), bits)
                pack = zstandard.ZstdCompressor(level=1).compress
                rows = []
                for p, (a, b) in enumerate(zip(cut, cut[1:])):
                    if b > a:
                        # Ids lie near each other, so their bytes, column by column, pack well.
                        docs = np.ascontiguousarray(least[a:b].view(np.uint8).reshape(-1, 8).T)
                        rows.append((p, row["block"], name[a:b].tobytes(), pack(docs.tobytes())))
                yield _sent(rows, ["part", "block", "names", "docs"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, unpack = zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress
        for rows in _by_part(batches):
            each = [np.frombuffer(r["names"], U) for r in rows]
            docs = [np.ascontiguousarray(np.frombuffer(unpack(r["docs"]), np.uint8).reshape(8, -1).T).view(np.int64)[:, 0] for r in rows]
            names, own = np.concatenate(each), np.concatenate(docs)
            order = np.argsort(names, kind="stable")
            ordered = names[order]
            new = np.r_[True, ordered[1:] != ordered[:-1]]
            first = np.flatnonzero(new)
            least = np.zeros(len(names), np.int64)
            least[order] = np.minimum.reduceat(own[order], first)[np.cumsum(new) - 1]
            hit = least < own
            ends = np.cumsum([0, *map(len, each)])
            yield _sent(
                [
                    (r["part"], r["block"], np.packbits(hit[a:b]).tobytes(), pack(least[a:b][hit[a:b]].tobytes()))
                    for r, a, b in zip(rows, ends, ends[1:])
                ],
                ["part", "block", "hits", "sources"],
            )

    marked = blocks.join(anchor_marks, "block").select("block", "ids", "lengths", "texts", "anchor_marks")
    sent = marked.mapInArrow(send, "part int, block long, names binary, docs binary")
    dealt = sent.repartition(max(shuffles(sent), LEAST_PARTS), "part").sortWithinPartitions("part", "block")
    found = dealt.mapInArrow(answer, "part int, block long, hits binary, sources binary")
    return found.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("part", "hits", "sources"))).alias("phrase_marks"))


FACTOR = pa.struct([("start", pa.int32()), ("words", pa.int32()), ("source", pa.int64())])
PARSED = "doc_id long, n_words long, n_removed long, kept_text string, factors array<struct<start:int, words:int, source:long>>"


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (words joined by one blank) and the factors of every document.

    A factor has its first word (from 0), its number of words and the document
    that has its phrases.
    """
    blocks = blocks_of(docs)
    n_words = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]

    def bits_for(share: float) -> int:
        return max(LEAST_PARTS, int(n_words * share) // PART_ENTRIES + 1).bit_length()

    anchor_bits, phrase_bits = bits_for(ANCHORS_PER_WORDS), bits_for(PHRASES_PER_WORDS)
    bits = max(anchor_bits, phrase_bits)
    anchor_marks = shared_anchors(blocks, bits)
    phrase_marks = stored(phrase_sources(blocks, anchor_marks, bits), "phrase-marks")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row in batch.to_pylist():
                block = Block.of(row["ids"], row["lengths"], row["texts"])
                chosen = _looked_up(block, row["anchor_marks"], bits)
                name, cut, least, entry = _phrase_entries(block, chosen, bits)
                for mark in row["phrase_marks"] or []:
                    a, b = cut[mark["part"]], cut[mark["part"] + 1]
                    hits = np.flatnonzero(_flags(mark["hits"], b - a))
                    least[a + hits] = np.frombuffer(unpack(mark["sources"]), np.int64)
                source = least[entry]
                repeated = source < block.doc[chosen]
                yield _parsed(row["ids"], block, block.start[chosen][repeated], source[repeated])

    marks = anchor_marks.join(phrase_marks, "block", "left")
    return blocks.join(marks, "block", "left").select("ids", "lengths", "texts", "anchor_marks", "phrase_marks").mapInArrow(parse, PARSED)


def _parsed(ids: list[int | None], block: Block, start: np.ndarray, source: np.ndarray) -> pa.RecordBatch:
    """Rows of a block from the places and sources of its repeated phrases, in order."""
    words, n = block.words, len(block.texts)
    gone = covered(start, WIDTH, len(words))
    text = words.text_of[start]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1] + 1) | (source[1:] != source[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    length = np.diff(np.r_[first, len(start)]) + WIDTH - 1
    of_text = np.searchsorted(text[first], np.arange(n + 1))
    values = pa.StructArray.from_arrays(
        [
            pa.array((start[first] - words.first[text[first]]).astype(np.int32)), pa.array(length.astype(np.int32)),
            pa.array(source[first]),
        ],
        fields=list(FACTOR),
    )
    factors = pa.ListArray.from_arrays(pa.array(of_text, pa.int32()), values)
    stays = ~gone
    kept = [b" ".join(compress(t.split(), stays[a:b])) for t, a, b in zip(block.texts, words.first, words.first[1:])]
    removed = np.r_[0, np.cumsum(gone)]
    n_removed = removed[words.first[1:]] - removed[words.first[:-1]]
    columns = [pa.array(ids, pa.int64()), pa.array(words.counts), pa.array(n_removed), pa.array(kept, pa.binary()).cast(pa.string()), factors]
    return pa.record_batch(columns, names=["doc_id", "n_words", "n_removed", "kept_text", "factors"])

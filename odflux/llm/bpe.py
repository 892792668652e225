"""Byte-pair encoding of words by a depth-first walk over the trie of distinct words.

The state of a trie node is the last token of the encoding of its prefix. It
follows from the states above it: a token that ends the prefix is the last one
exactly when the token before it, the state at the place where it begins, does
not merge with it. Words with a common prefix share the states of that prefix,
which are computed once. The ids of a word are read off by walking back from
its last state.

The vocabulary file is a parameter; it is read by every worker, so it lies at
the same path on every machine.

Missing and empty texts have no tokens; texts of any length are encoded whole.
Repeated rows are each encoded, a missing id stays. Of pairs of equal rank (ties)
the leftmost merges. Columns other than doc_id and text do not matter; an empty
table gives an empty one.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflux.llm.words import slices

# Distinct stretches of text a worker remembers between batches; more are encoded anew in each batch.
REMEMBERED_WORDS = 400_000
REMEMBERED_PAIRS = 2_000_000
SLICE_BYTES = 3 << 20

# The contractions, letters, digits and marks that the vocabulary's pre-tokenizer takes apart.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
# The same for texts of Latin letters without superscripts, fractions and separators, where letters are plain word characters.
LATIN_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:[^\w\s]|_)+")
NOT_LATIN = re.compile("[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ]")
ANY_PIECES = regex.compile(PIECES)
WHITE_SPACE = regex.compile(r"\p{White_Space}+")
SEPARATORS = re.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, spare = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in plain else spare))
        spare += byte not in plain
    return letters


# Symbols of a word are its bytes; the last one is moved up by END.
END = 256
_END_OF = [chr(END + b) for b in range(256)]


def blank_separated(text: str) -> list[str]:
    """Normalised stretches without white space; no piece crosses their ends."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # lower-casing goes letter by letter, so there is no final form
            text = text.replace("Σ", "σ")
    text = text.lower()
    if SEPARATORS.search(text):  # str.split() takes these for white space
        return [s for s in WHITE_SPACE.split(text) if s]
    return text.split()


def pre_tokens(stretch: str) -> list[str]:
    return ANY_PIECES.findall(stretch) if NOT_LATIN.search(stretch) else LATIN_PIECES.findall(stretch)


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        ids: dict[str, int] = stored["model"]["vocab"]
        suffix: str = stored["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.text_of = [""] * (max(*ids.values(), *self.special.values()) + 1)
        for text, number in {**ids, **self.special}.items():
            self.text_of[number] = text
        letters = byte_letters()
        self.spelled: dict[int, str] = {}  # symbols of a token
        for byte, letter in enumerate(letters):
            self.spelled[ids[letter]] = chr(byte)
            self.spelled[ids[letter + suffix]] = _END_OF[byte]
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(stored["model"]["merges"]):
            pair = ids[left], ids[right]
            whole = ids[left + right]
            self.merge.setdefault(pair, (rank, whole))
            self.spelled.setdefault(whole, self.spelled[pair[0]] + self.spelled[pair[1]])
        self.length = [len(self.spelled.get(i, "")) for i in range(len(self.text_of))]
        self.symbol = {s: i for i, s in self.spelled.items() if len(s) == 1}
        # Tokens that their own letters encode to; only these can end an encoding.
        self.token = {s: i for i, s in self.spelled.items() if len(s) == 1 or self.merged(s) == [i]}
        self._suffixes()
        self.apart: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}

    def _suffixes(self) -> None:
        """An automaton over the symbols whose state tells the longest token that ends a prefix.

        ``next_state`` is filled in as words need it; ``fail`` leads to the next
        shorter suffix that begins a token, ``shorter`` from a token to the next
        shorter token that ends it.
        """
        self.next_state: dict[int, int] = {}
        self.fail, ends, depth = [0], [-1], [0]
        self._child: dict[tuple[int, str], int] = {}
        for spelled, number in self.token.items():
            at = 0
            for symbol in spelled:
                to = self._child.get((at, symbol))
                if to is None:
                    to = self._child[at, symbol] = len(ends)
                    ends.append(-1)
                    depth.append(depth[at] + 1)
                    self.fail.append(0)
                at = to
            ends[at] = number
        self.ends, self.shorter = ends, [-1] * len(self.text_of)
        for (at, symbol), to in sorted(self._child.items(), key=lambda edge: depth[edge[1]]):
            if at:
                self.fail[to] = self._go(self.fail[at], symbol)
            rest = ends[self.fail[to]]
            if ends[to] < 0:
                ends[to] = rest
            else:
                self.shorter[ends[to]] = rest

    def _go(self, at: int, symbol: str) -> int:
        while True:
            to = self._child.get((at, symbol))
            if to is not None:
                return to
            if not at:
                return 0
            at = self.fail[at]

    def merged(self, spelled: str) -> list[int]:
        """Encoding by merging the pair of lowest rank until none is left."""
        parts = [self.symbol[s] for s in spelled]
        while len(parts) > 1:
            ranks = [self.merge.get(pair, (1 << 60, 0))[0] for pair in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 60:
                break
            k = ranks.index(best)
            parts[k : k + 2] = [self.merge[parts[k], parts[k + 1]][1]]
        return parts

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether the letters of both tokens together encode to just these two."""
        return self.merged(self.spelled[left] + self.spelled[right]) == [left, right]

    def walk(self, words: Iterable[str]) -> Iterator[list[int]]:
        """Ids of words given in sorted order of their symbols.

        A stack holds the states on the way from the root: the last token, and
        the place in the automaton.
        """
        last_of, place_of = [-1], [0]
        before = ""
        apart, length, ends, shorter, go = self.apart, self.length, self.ends, self.shorter, self.next_state
        for word in words:
            shared = len(commonprefix((before, word)))
            del last_of[shared + 1 :], place_of[shared + 1 :]
            place, n = place_of[shared], shared
            for symbol in word[shared:]:
                n += 1
                key = place << 9 | ord(symbol)
                to = go.get(key)
                if to is None:
                    to = go[key] = self._go(place, symbol)
                place = to
                last = ends[place]
                while True:
                    left = last_of[n - length[last]]
                    if left < 0:
                        break
                    pair = left << 20 | last
                    fits = apart.get(pair)
                    if fits is None:
                        fits = self.stay_apart(left, last)
                        if len(apart) < REMEMBERED_PAIRS:
                            apart[pair] = fits
                    if fits:
                        break
                    last = shorter[last]
                last_of.append(last)
                place_of.append(place)
            before = word
            ids = []
            while n:
                last = last_of[n]
                ids.append(last)
                n -= length[last]
            ids.reverse()
            yield ids

    def encode_words(self, words: set[str]) -> dict[str, bytes]:
        """Ids of distinct pieces, as little-endian unsigned 32-bit numbers."""
        symbols = {}
        for word in words:
            raw = word.encode()
            symbols[raw[:-1].decode("latin-1") + _END_OF[raw[-1]]] = word
        order = sorted(symbols)
        packed = struct.Struct("<I").pack
        number = [packed(i) for i in range(len(self.text_of))].__getitem__
        return {symbols[s]: b"".join(map(number, ids)) for s, ids in zip(order, self.walk(order))}

    def learn(self, stretches: set[str]) -> dict[str, bytes]:
        """Ids of distinct stretches that are not remembered."""
        pieces = {s: pre_tokens(s) for s in stretches}
        ids = self.encode_words({p for found in pieces.values() for p in found})
        return {s: b"".join(map(ids.__getitem__, found)) for s, found in pieces.items()}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        parts = []
        new: set[str] = set()
        special: dict[str, bytes] = {}
        for text in texts:
            if self.split_special and self.split_special.search(text):
                stretches = []
                for k, part in enumerate(self.split_special.split(text)):
                    if k % 2:  # a blank tells it from all stretches
                        special[" " + part] = struct.pack("<I", self.special[part])
                    stretches += [" " + part] if k % 2 else blank_separated(part)
            else:
                stretches = blank_separated(text)
            parts.append(stretches)
            new.update(stretches)
        known = self.known
        ids = {s: known[s] for s in new if s in known} | special
        found = self.learn(new.difference(ids))
        if len(known) + len(found) <= REMEMBERED_WORDS:
            known.update(found)
        ids |= found
        return [b"".join(map(ids.__getitem__, stretches)) for stretches in parts]

    def decode(self, ids: bytes) -> str:
        """Tokens joined by blanks, special ones too."""
        return " ".join(map(self.text_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit numbers) of every text; a missing text has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for batch in slices(batches, most=SLICE_BYTES):
            ids = known.encode([t or "" for t in batch.column("text").to_pylist()])
            yield pa.record_batch([batch.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and the text that the ids decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for batch in slices(batches, "ids", SLICE_BYTES):
            yield _decoded(known, batch.column("doc_id"), batch.column("ids").to_pylist())

    return encoded.select("doc_id", "ids").mapInArrow(run, DECODED)


DECODED = "doc_id long, ids binary, text string"


def _decoded(known: Vocabulary, doc_ids: pa.Array, ids: list[bytes]) -> pa.RecordBatch:
    texts = pa.array(map(known.decode, ids), pa.string())
    return pa.record_batch([doc_ids, pa.array(ids, pa.binary()), texts], names=["doc_id", "ids", "text"])


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``decode(encode(docs))`` by one worker a task instead of two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for batch in slices(batches, most=SLICE_BYTES):
            ids = known.encode([t or "" for t in batch.column("text").to_pylist()])
            yield _decoded(known, batch.column("doc_id"), ids)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, DECODED)


def digests(decoded: DataFrame) -> DataFrame:
    """Number of tokens and hashes of the ids and of the decoded text."""
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )

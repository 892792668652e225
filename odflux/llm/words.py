"""Words of many texts at once, as positions in one buffer and as 64-bit hashes.

A word is a maximal run of bytes other than space, tab, line feed, vertical
tab, form feed and carriage return.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True

# A hash of bytes joins two polynomials modulo primes below 2^31, given by prime and base. Modulo a power of two,
# whole families of different strings would meet in any base.
BASE_A = ((2147483647, 1103515249), (2147483629, 893714567))
BASE_B = ((2147483587, 1722304123), (2147483579, 671088643))
# Odd multipliers of hashes of words; any odd numbers serve.
ROLL_A, ROLL_B = 0x2545F4914F6CDD1D, 0xD1342543DE82EF95
MIXER = U(0xD6E8FEB86659FD93)

# Text handled at a time within a task.
SLICE_BYTES = 1 << 20
# Bytes whose sums run without reduction.
STRIP_BITS = 16
STRIP = 1 << STRIP_BITS


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits."""
    h = h ^ (h >> U(32))
    h = h * MIXER
    h = h ^ (h >> U(32))
    h = h * MIXER
    return h ^ (h >> U(32))


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``most`` bytes of text, and never less than a row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(sizes.astype(np.int64)) // most
        cuts = [0, *(np.flatnonzero(piece[1:] != piece[:-1]) + 1), batch.num_rows]
        for start, end in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(start, end - start)


def as_bytes(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; a missing text is empty."""
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


@lru_cache
def _powers(prime: int, base: int, n: int) -> np.ndarray:
    """Powers of a base from 0 to n - 1, by doubling."""
    powers = np.ones(1, U)
    while len(powers) < n:
        powers = np.concatenate([powers, powers * U(pow(base, len(powers), prime)) % U(prime)])
    return powers[:n]


class Polynomial:
    """Polynomial hashes of spans of a buffer, modulo a prime.

    Sums of bytes times powers run within strips, so they need no reduction; what
    lies before a strip is added when a span is asked for.
    """

    def __init__(self, buffer: np.ndarray, prime: int, base: int):
        n = len(buffer)
        self.prime, self.base = U(prime), base
        self.n_strips = n // STRIP + 1
        self.scale = _powers(prime, pow(base, STRIP, prime), self.n_strips)
        self.sums = np.zeros(n + 1, U)
        self.before = np.zeros(self.n_strips, U)
        powers = _powers(prime, base, STRIP)
        for k in range(self.n_strips):
            strip = buffer[k * STRIP : (k + 1) * STRIP].astype(U) + U(1)
            strip *= powers[: len(strip)]
            np.cumsum(strip, out=strip)
            end = min(len(strip), STRIP - 1)
            self.sums[k * STRIP + 1 : k * STRIP + 1 + end] = strip[:end]
            if k + 1 < self.n_strips:
                self.before[k + 1] = (self.before[k] + strip[-1] % self.prime * self.scale[k]) % self.prime

    def upto(self, places: np.ndarray) -> np.ndarray:
        strip = places >> STRIP_BITS
        return (self.before[strip] + self.sums[places] % self.prime * self.scale[strip]) % self.prime

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        inverse = pow(self.base, -1, int(self.prime))
        within = _powers(int(self.prime), inverse, STRIP)[start & (STRIP - 1)]
        scale = _powers(int(self.prime), pow(inverse, STRIP, int(self.prime)), self.n_strips)[start >> STRIP_BITS]
        value = (self.upto(end) + self.prime - self.upto(start)) % self.prime
        return value * within % self.prime * scale % self.prime


class Words:
    """``first[d]`` is the number of the first word of text d; words are numbered through all texts."""

    def __init__(self, texts: list[bytes]):
        self.n_texts = len(texts)
        self.buffer = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        self.text_start = np.r_[0, ends]
        blank = np.ones(len(self.buffer) + 2, bool)
        blank[1:-1] = BLANK[self.buffer]
        edges = np.flatnonzero(blank[1:] != blank[:-1])
        self.start, self.end = edges[0::2], edges[1::2]
        self.first = np.searchsorted(self.start, self.text_start)
        self.text_of = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, base: tuple = BASE_A) -> np.ndarray:
        """Hash of every word."""
        return self.span_hashes(self.start, self.end, base)

    def span_hashes(self, start: np.ndarray, end: np.ndarray, base: tuple = BASE_A) -> np.ndarray:
        """Hash of the bytes of each span, mixed with its length."""
        one, two = (Polynomial(self.buffer, *each).of(start, end) for each in base)
        return mix((one | two << U(31)) ^ ((end - start).astype(U) * U(ROLL_B)))

    def count(self, marked: np.ndarray) -> np.ndarray:
        """Running number of bytes whose value is marked in a table of 256."""
        sums = np.zeros(len(self.buffer) + 1, np.int64)
        np.cumsum(marked[self.buffer], out=sums[1:])
        return sums

    def windows(self, hashes: np.ndarray, k: int, roll: int = ROLL_A) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of k words within one text, and the windows' hashes."""
        n = len(hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U)
        value = np.zeros(n, U)
        for j in range(k):
            value = value * U(roll) + hashes[j : j + n]
        starts = np.flatnonzero(self.text_of[:n] == self.text_of[k - 1 :])
        return starts, mix(value[starts])


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n words lie in a window of ``width`` words that begins at one of ``starts``."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + width, n), -1)
    return np.cumsum(change[:-1]) > 0


def seen_before(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether the same value came earlier in the same group."""
    order = np.lexsort((value, group))
    again = np.zeros(len(value), bool)
    g, v = group[order], value[order]
    again[order[1:]] = (g[1:] == g[:-1]) & (v[1:] == v[:-1])
    return again


def per_text(words_or_lines: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Sum by text number, as whole numbers."""
    return np.bincount(words_or_lines, weights, minlength=n).astype(np.int64)

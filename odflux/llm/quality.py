"""Quality rules: a linear-chain conditional random field over the lines of a text.

Every line that holds a word is labelled content or boilerplate by Viterbi
decoding; a text is kept when the content lines hold enough of its characters.
The field is trained here on a bounded sample of texts labelled good or bad. The
lines of a bad text are boilerplate; those of a good one are content but for lines
that stand in many places: between ``MIN_PLACES`` different lines before and after
them, counted over all texts, so copies of a text count once. So the field sees
texts that mix both. Its bias is then raised until it keeps ``KEEP_GOOD`` of the
good texts of the sample. Without good and bad labels ``DEFAULT_FIELD`` is used.

Missing and empty texts have no words, and fail. Texts of any length are judged
whole. Repeated rows are judged each on its own. Of equally likely labels (ties) a
line takes content. Columns other than the ones read are left alone. An empty
table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflux.llm.words import Words, as_bytes, covered, per_text, seen_before, slices


def _table(characters: bytes) -> np.ndarray:
    marked = np.zeros(256, bool)
    marked[list(characters)] = True
    return marked


SYMBOLS = _table(b"#*$%&|<>")
UPPER = _table(bytes(range(65, 91)))
LETTERS = _table(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
DIGITS = _table(bytes(range(48, 58)))
PLAIN = LETTERS | DIGITS | _table(b".,;:'\"()-")
FIRST_BYTES = (np.arange(256) & 0xC0) != 0x80

FEATURES = (
    "bias", "few_words", "not_letters", "upper", "digits", "odd_marks", "repeated_words", "same_as_previous",
    "line_seen", "many_words",
)

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_CONTENT = 0.5
# Texts the field is fitted on, and the most lines of one of them: of more, a stretch at a place by hash.
SAMPLE_TEXTS, SAMPLE_LINES = 3000, 60
# Different lines before and after a line, and its words, from which on it is no content.
MIN_PLACES, MIN_LINE_WORDS = 5, 5
# Part of the good texts of the sample, of those long enough, that the fitted field has to keep.
KEEP_GOOD = 0.999

BASE_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, n_content_lines long, content_share double"
)


@dataclass(frozen=True)
class Field:
    """Weights of a line being content, and of each pair of labels (boilerplate 0, content 1) in a row."""

    emit: np.ndarray
    step: np.ndarray


DEFAULT_FIELD = Field(
    emit=np.array([4.0, -0.5, -2.0, -6.0, -4.0, -10.0, -4.0, -10.0, -2.0, 1.0]),
    step=np.array([[1.0, -1.0], [-1.0, 1.0]]),
)


@dataclass
class Lines:
    """Lines that hold a word, of all texts of a batch in order."""

    text: np.ndarray
    chars: np.ndarray
    seen: np.ndarray
    hashes: np.ndarray
    n_words: np.ndarray
    features: np.ndarray


def lines_of(words: Words, hashes: np.ndarray) -> Lines:
    breaks = np.flatnonzero(words.buffer == 10)
    line = np.searchsorted(breaks, words.start)
    first = np.flatnonzero(np.r_[True, line[1:] != line[:-1]]) if len(line) else np.zeros(0, np.int64)
    number = line[first]
    begin, end = np.r_[0, breaks[:-1] + 1][number], breaks[number]
    text = words.text_of[first]
    line_hashes = words.span_hashes(begin, end)
    seen = seen_before(text, line_hashes)
    n_words = np.diff(np.r_[first, len(line)])

    def inside(marked: np.ndarray) -> np.ndarray:
        sums = words.count(marked)
        return sums[end] - sums[begin]

    def of_words(flags: np.ndarray) -> np.ndarray:
        sums = np.r_[0, np.cumsum(flags)]
        return sums[np.r_[first[1:], len(line)]] - sums[first]

    sums = words.count(FIRST_BYTES)
    chars = of_words(sums[words.end] - sums[words.start])
    size = np.maximum(of_words(words.end - words.start), 1)
    again = seen_before(line, hashes)
    previous = np.zeros(len(line), bool)
    previous[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    letters = inside(LETTERS)
    columns = (
        np.ones(len(first)),
        n_words <= 3,
        1 - letters / size,
        inside(UPPER) / np.maximum(letters, 1),
        inside(DIGITS) / size,
        (size - inside(PLAIN)) / size,
        of_words(again) / n_words,
        of_words(previous) / n_words,
        seen,
        np.minimum(np.log1p(n_words) / np.log(100), 2),
    )
    return Lines(text, chars, seen, line_hashes, n_words, np.stack([np.asarray(c, float) for c in columns], 1).reshape(len(first), len(FEATURES)))


def _by_length(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequences from long to short, and how many have a t-th element."""
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    longest = int(length.max(initial=0))
    return order, np.searchsorted(-length[order], -np.arange(longest), side="left")


def viterbi(emit: np.ndarray, first: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Best label of every line; sequence s holds lines first[s] to first[s + 1]. Ties go to content."""
    order, alive = _by_length(first)
    start, labels = first[:-1][order], np.zeros(len(emit), np.int64)
    came = np.zeros((len(emit), 2), np.int8)
    best = np.zeros((len(order), 2))
    for t, n in enumerate(alive):
        at = start[:n] + t
        if t == 0:
            best[:n, 1] = emit[at]
            continue
        options = best[:n, :, None] + step[None]
        came[at] = options[:, 1] >= options[:, 0]
        best[:n] = options.max(1)
        best[:n, 1] += emit[at]
    state = (best[:, 1] >= best[:, 0]).astype(np.int64)
    for t in range(len(alive) - 1, -1, -1):
        n = alive[t]
        at = start[:n] + t
        ends = first[1:][order][:n] - 1 == at
        state[:n] = np.where(ends, state[:n], labels[np.minimum(at + 1, len(emit) - 1)])
        state[:n] = np.where(ends, state[:n], came[np.minimum(at + 1, len(emit) - 1), state[:n]])
        labels[at] = state[:n]
    return labels


def fit_field(features: np.ndarray, first: np.ndarray, good: np.ndarray, content: np.ndarray | None = None, rounds: int = 150) -> Field:
    """Maximise the likelihood of the lines' labels, good texts and bad ones weighing alike.

    ``content`` has a label for each line; without it, lines take that of their text.
    """
    n_good = int(good.sum())
    if n_good in (0, len(good)):
        return DEFAULT_FIELD
    label = np.repeat(good, np.diff(first)).astype(np.int64) if content is None else content.astype(np.int64)
    order, alive = _by_length(first)
    start, good = first[:-1][order], good[order].astype(np.int64)
    weight = np.where(good == 1, 0.5 / n_good, 0.5 / (len(good) - n_good))
    emit, step = np.zeros(features.shape[1]), np.zeros((2, 2))
    moments = [np.zeros_like(emit), np.zeros_like(emit), np.zeros_like(step), np.zeros_like(step)]
    length = np.diff(first)[order]
    for i in range(1, rounds + 1):
        score = features @ emit
        forward = np.zeros((len(features), 2))
        for t, n in enumerate(alive):
            at = start[:n] + t
            if t:
                forward[at] = np.logaddexp(forward[at - 1, :1] + step[0], forward[at - 1, 1:] + step[1])
            forward[at, 1] += score[at]
        total = np.logaddexp.reduce(forward[first[1:][order] - 1], axis=1)
        backward, miss, turns = np.zeros((len(features), 2)), np.zeros(len(features)), np.zeros((2, 2))
        for t in range(len(alive) - 1, -1, -1):
            n = alive[t]
            at = start[:n] + t
            onward = np.flatnonzero(length[:n] > t + 1)
            if len(onward):
                here, ahead = at[onward], at[onward] + 1
                ahead_score = backward[ahead].copy()
                ahead_score[:, 1] += score[ahead]
                joint = forward[here][:, :, None] + step[None] + ahead_score[:, None, :]
                turns -= (weight[onward, None, None] * np.exp(joint - total[onward, None, None])).sum(0)
                np.add.at(turns, (label[here], label[ahead]), weight[onward])
                backward[here] = np.logaddexp(step[:, 0] + ahead_score[:, :1], step[:, 1] + ahead_score[:, 1:])
            likely = np.exp(forward[at, 1] + backward[at, 1] - total[:n])
            miss[at] = weight[:n] * (label[at] - likely)
        slopes = [features.T @ miss - 1e-4 * emit, turns - 1e-4 * step]
        for k, (value, slope) in enumerate(zip((emit, step), slopes)):
            mean, square = moments[2 * k], moments[2 * k + 1]
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope**2 - square)
            value += 0.15 * (mean / (1 - 0.9**i)) / (np.sqrt(square / (1 - 0.99**i)) + 1e-9)
    return Field(emit, step)


def _stretch(n: int, lines: int, name: int) -> slice:
    """All of n lines, or ``lines`` of them from a place that the name decides."""
    start = name % (n - lines + 1) if n > lines else 0
    return slice(start, start + min(n, lines))


def lines_in_many_places(docs: DataFrame, wanted: np.ndarray, places: int = MIN_PLACES) -> np.ndarray:
    """Those of the ``wanted`` line hashes (sorted) that stand between so many different lines, over all texts."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = Words(as_bytes(batch.column("text")))
            found = lines_of(words, words.hashes())
            inner = found.text[1:] == found.text[:-1]
            before, after = np.zeros(len(found.text), np.uint64), np.zeros(len(found.text), np.uint64)
            before[1:][inner], after[:-1][inner] = found.hashes[:-1][inner], found.hashes[1:][inner]
            asked = np.searchsorted(wanted, found.hashes)
            mine = wanted[np.minimum(asked, len(wanted) - 1)] == found.hashes
            rows = np.unique(np.stack([found.hashes[mine], before[mine], after[mine]], 1), axis=0).view(np.int64)
            yield pa.record_batch([pa.array(c.copy()) for c in rows.T], names=["line", "before", "after"])

    if not len(wanted):
        return wanted
    met = docs.select("text").mapInArrow(meet, "line long, before long, after long")
    counts = met.groupBy("line").agg(F.count_distinct("before").alias("before"), F.count_distinct("after").alias("after"))
    rows = counts.where(F.least("before", "after") >= places).select("line").collect()  # at most the wanted ones
    return np.sort(np.array([r["line"] for r in rows], np.int64).view(np.uint64))


def train_field(docs: DataFrame, labels: DataFrame, texts: int = SAMPLE_TEXTS, lines: int = SAMPLE_LINES) -> Field:
    """Fit on the ``texts`` labelled texts of smallest hash, on a stretch of ``lines`` lines of longer ones.

    ``labels`` has doc_id and quality (1 good, 0 bad); rows without either do
    not count, and of several labels of a text the lowest holds.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(texts)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", F.col("quality").cast("int").alias("good"))
    schema = "good int, n int, n_words long, features binary, hashes binary, chars binary"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = Words(as_bytes(batch.column("text")))
            found = lines_of(words, words.hashes())
            first = np.searchsorted(found.text, np.arange(batch.num_rows + 1))
            # Short lines come again by chance.
            named = np.where(found.n_words >= MIN_LINE_WORDS, found.hashes, np.uint64(0))
            rows = []
            for good, begin, end in zip(batch.column("good").to_pylist(), first[:-1].tolist(), first[1:].tolist()):
                if begin < end:
                    some = _stretch(end - begin, lines, int(found.hashes[begin]))
                    own, n_words = found.features[begin:end][some], int(found.n_words[begin:end].sum())
                    rows.append((good, len(own), n_words, own.tobytes(), named[begin:end][some].tobytes(), found.chars[begin:end][some].tobytes()))
            columns = list(zip(*rows)) or [()] * 6
            types = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=["good", "n", "n_words", "features", "hashes", "chars"])

    rows = sample.mapInArrow(measure, schema).collect()
    rows = sorted(rows, key=lambda r: (r["good"], r["n"], bytes(r["features"]), bytes(r["hashes"])))
    if len({r["good"] > 0 for r in rows}) < 2:
        return DEFAULT_FIELD
    features = np.concatenate([np.frombuffer(r["features"]) for r in rows]).reshape(-1, len(FEATURES))
    hashes = np.concatenate([np.frombuffer(r["hashes"], np.uint64) for r in rows])
    n, good = np.array([r["n"] for r in rows]), np.array([r["good"] > 0 for r in rows])
    content = np.repeat(good, n)
    common = lines_in_many_places(docs, np.unique(hashes[content & (hashes != 0)]))
    content &= ~np.isin(hashes, common)
    first, chars = np.r_[0, np.cumsum(n)], np.concatenate([np.frombuffer(r["chars"], np.int64) for r in rows])
    judged = good & (np.array([r["n_words"] for r in rows]) >= MIN_WORDS)
    return raised(fit_field(features, first, good, content), features, first, chars, judged)


def raised(field: Field, features: np.ndarray, first: np.ndarray, chars: np.ndarray, good: np.ndarray, step: float = 0.25, most: float = 20.0) -> Field:
    """The field with the least added bias at which it keeps enough of the good texts; one that keeps enough stays."""
    all_chars = np.maximum(np.add.reduceat(chars, first[:-1]), 1)
    for shift in np.arange(0, most, step):
        emit = field.emit + shift * (np.arange(len(field.emit)) == 0)
        labels = viterbi(features @ emit, first, field.step)
        share = np.add.reduceat(chars * labels, first[:-1]) / all_chars
        if not good.any() or (share[good] >= MIN_CONTENT).mean() >= KEEP_GOOD:
            break
    return Field(emit, field.step)


@dataclass
class Judged:
    """Measures of each text of a batch."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    base_failed: np.ndarray
    kept: np.ndarray
    n_lines: np.ndarray
    n_content_lines: np.ndarray
    content_share: np.ndarray


def judge(texts: list[bytes], field: Field, min_content: float = MIN_CONTENT) -> Judged:
    n = len(texts)
    words = Words(texts)
    hashes = words.hashes()
    lines = lines_of(words, hashes)
    n_words = words.counts
    sums = words.count(FIRST_BYTES)
    word_chars = per_text(words.text_of, n, sums[words.end] - sums[words.start])
    symbols = words.count(SYMBOLS)
    n_symbols = symbols[words.text_start[1:]] - symbols[words.text_start[:-1]]
    starts, triples = words.windows(hashes, 3)
    texts_of = words.text_of[starts]
    order = np.lexsort((triples, texts_of))
    same = (triples[order][1:] == triples[order][:-1]) & (texts_of[order][1:] == texts_of[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    n_repeat = per_text(words.text_of[covered(starts[twice], 3, len(words))], n)
    labels = viterbi(lines.features @ field.emit, np.searchsorted(lines.text, np.arange(n + 1)), field.step)
    content = per_text(lines.text, n, lines.chars * labels)
    share = content / np.maximum(word_chars, 1)
    failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
    return Judged(
        n_words, word_chars, n_symbols, per_text(lines.text, n, lines.seen), n_repeat, failed,
        ~failed & (share >= min_content), per_text(lines.text, n), per_text(lines.text, n, labels), share,
    )


def quality(docs: DataFrame, field: Field, min_content: float = MIN_CONTENT) -> DataFrame:
    """One row of measures and the verdict for each text; ``doc_id`` may be missing."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = judge(as_bytes(batch.column("text")), field, min_content)
            columns = [batch.column("doc_id"), *(pa.array(v) for v in vars(found).values())]
            yield pa.record_batch(columns, names=["doc_id", *vars(found)])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, BASE_SCHEMA)


def keep_good(docs: DataFrame, field: Field, min_content: float = MIN_CONTENT) -> DataFrame:
    """The documents that pass, with all their columns."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(judge(as_bytes(batch.column("text")), field, min_content).kept))

    return docs.mapInArrow(keep, docs.schema)

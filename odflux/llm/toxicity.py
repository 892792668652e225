"""Toxicity by weak supervision.

1. Lexicon: words and beginnings of words that labelled training texts of the
   toxic class use far more often, dealt over ``LEXICON_VOTERS`` voters.
   Near-copies among the sample count once.
2. Votes: each lexicon voter and each pattern voter fires on a text or does not.
   Vote patterns are counted over all training texts, labelled or not.
3. Label model: voters depend on the hidden class and, along a tree of the
   strongest correlations, on one other voter. Expectation maximisation over
   the pattern counts estimates accuracies and correlations.
4. A logistic regression on lexicon and pattern features is trained on the
   posterior labels of the sample and scores every text.

The sample is the only bounded part: ``SAMPLE_TEXTS`` labelled training texts of
smallest hash. Rows whose ``held_out`` is true teach nothing.

A missing text is empty; empty texts get the score of a text without any
feature. Texts of any length are read whole. Rows of one id take the label of that
id, of several labels the highest; repeated rows each get the same score, and a
missing id counts as empty text in the hash. Of equally telling entries (ties)
the first by letters is taken, ``LEXICON_SIZE`` of them at most. Columns other than
doc_id, text and toxic do not matter; an empty table gives an empty one. Without a toxic or without a clean label the lexicon is empty and all
scores are the share of toxic labels.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflux.llm.place import stored
from odflux.llm.words import Words, as_bytes, mix, slices

SAMPLE_TEXTS = 8000
LEXICON_SIZE = 400
LEXICON_VOTERS = 8
# An entry is used in so many toxic texts at least, its log odds are so high, and so is its log likelihood ratio
# against use that follows the class shares (13: about one in half a million by chance).
MIN_TEXTS, MIN_LOG_ODDS, MIN_EVIDENCE = 5, 3.0, 13.0
BEGINNINGS = (4, 5)
NEAR_COPY_WORDS = 4
# Texts that agree in one of these hashes count once.
COPY_HASHES = ("copy_0", "copy_1", "copy_2")

WORD = re.compile(r"[^\W\d_]+")
UPPER = bytes(range(65, 91))
HIDDEN_LETTERS = re.compile(r"[^\W\d_][*@#$]{1,4}[^\W\d_]")
STRETCHED = re.compile(r"([^\W\d_])\1{3}")
PATTERNS = ("shouting", "exclaiming", "hidden_letters", "stretched", "questioning")
N_VOTERS = LEXICON_VOTERS + 1 + len(PATTERNS)


def held_out(doc_id: str | Column = "doc_id", folds: int = 5) -> Column:
    """Whether a row is kept from training, by its id alone; a missing id is hashed as empty."""
    text = F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == 0


def entries_of(text: str) -> set[str]:
    """Words of a text, and their beginnings marked by a star."""
    words = set(WORD.findall(text.lower()))
    return words | {w[:n] + "*" for n in BEGINNINGS for w in words if len(w) > n}


def patterns_of(text: str) -> list[float]:
    """Measures behind the pattern voters, each between 0 and 1."""
    raw = text.encode()
    upper = len(raw) - len(raw.translate(None, UPPER))
    words = max(1, text.count(" ") + text.count("\n"))
    return [
        upper / max(1, len(raw)),
        min(1.0, text.count("!") / words),
        float(bool(HIDDEN_LETTERS.search(text))),
        float(bool(STRETCHED.search(text))),
        min(1.0, text.count("?") / words),
    ]


PATTERN_LIMITS = (0.3, 0.1, 0.5, 0.5, 0.1)


class Lexicon:
    """Finds entries at the beginnings of words by one automaton."""

    def __init__(self, entries: list[str]):
        self.entries = entries
        self.automaton = ahocorasick.Automaton()
        for number, entry in enumerate(entries):
            stem = entry.rstrip("*")
            known = self.automaton.get(stem, [])
            self.automaton.add_word(stem, [*known, (number, len(stem), entry.endswith("*"))])
        if entries:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[int]:
        """Numbers of the entries in a text, once for every place."""
        if not self.entries:
            return []
        lower = text.lower()
        found = []
        for last, hits in self.automaton.iter(lower):
            for number, length, open_end in hits:
                before, after = last - length, last + 1
                if (before < 0 or not lower[before].isalpha()) and (after == len(lower) or lower[after].isalpha() == open_end):
                    if after < len(lower) or not open_end:
                        found.append(number)
        return found

    def features(self, text: str) -> tuple[np.ndarray, list[int]]:
        """Features of a text, and the voters that fire on it."""
        hits = self.find(text)
        distinct = set(hits)
        patterns = patterns_of(text)
        row = np.zeros(len(self.entries) + 2 + len(patterns), np.float32)
        row[list(distinct)] = 1
        row[len(self.entries)] = np.log1p(len(distinct))
        row[len(self.entries) + 1] = np.log1p(len(hits))
        row[len(self.entries) + 2 :] = patterns
        votes = {number % LEXICON_VOTERS for number in distinct}
        if len(hits) > 1:
            votes.add(LEXICON_VOTERS)
        votes |= {LEXICON_VOTERS + 1 + k for k, (value, limit) in enumerate(zip(patterns, PATTERN_LIMITS)) if value > limit}
        return row, sorted(votes)


@dataclass
class LabelModel:
    """P(voter | class, parent) and P(class); ``parent`` -1 stands for none."""

    prior: float
    parent: np.ndarray
    table: np.ndarray  # voter, class, vote of the parent: chance to fire

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Chance of the toxic class for rows of 0/1 votes."""
        log = np.tile(np.log([1 - self.prior, self.prior]), (len(votes), 1))
        for j, parent in enumerate(self.parent):
            above = votes[:, parent] if parent >= 0 else np.zeros(len(votes), np.int64)
            fires = self.table[j][:, above].T
            log += np.log(np.where(votes[:, [j]] == 1, fires, 1 - fires))
        return 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -700, 700)))


def _tables(votes: np.ndarray, weight: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Chances to fire from weighted rows; ``weight`` has a column for each class."""
    table = np.zeros((votes.shape[1], 2, 2))
    for j, above in enumerate(parent):
        up = votes[:, above] if above >= 0 else np.zeros(len(votes), np.int64)
        for state in (0, 1):
            rows = weight[up == state]
            table[j, :, state] = (votes[up == state, j] @ rows + 0.1) / (rows.sum(0) + 0.2)
    return table


def _strongest_tree(votes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Parents along the spanning tree of highest correlation (mutual information) given the class."""
    n = votes.shape[1]
    strength = np.zeros((n, n))
    for c in (0, 1):
        w = weight[:, c] / max(weight.sum(), 1e-9)
        total = max(w.sum(), 1e-12)
        for a in (0, 1):
            for b in (0, 1):
                left, right = (votes == a).astype(float), (votes == b).astype(float)
                joint = (left * w[:, None]).T @ right
                alone = np.outer(w @ left, w @ right) / total
                strength += np.where(joint > 1e-12, joint * np.log(np.maximum(joint, 1e-12) / np.maximum(alone, 1e-12)), 0)
    parent, reached = np.full(n, -1), [0]
    while len(reached) < n:
        rest = [j for j in range(n) if j not in reached]
        i, j = max(((i, j) for i in reached for j in rest), key=lambda e: (strength[e], -e[0], -e[1]))
        parent[j] = i
        reached.append(j)
    return parent


def fit_label_model(votes: np.ndarray, counts: np.ndarray, prior: float, rounds: int = 15) -> LabelModel:
    """Expectation maximisation over distinct rows of votes, first without and then with correlations."""
    n_lexicon = LEXICON_VOTERS + 1
    fired = votes[:, :n_lexicon].sum(1)
    posterior = 1 / (1 + np.exp(-3.0 * (fired - 1.5)))
    parent = np.full(votes.shape[1], -1)
    model = LabelModel(prior, parent, np.zeros(0))
    for correlated in (False, True):
        if correlated:
            parent = _strongest_tree(votes, np.stack([counts * (1 - posterior), counts * posterior], 1))
        for _ in range(rounds):
            weight = np.stack([counts * (1 - posterior), counts * posterior], 1)
            share = float((weight[:, 1].sum() + 1) / (counts.sum() + 2))
            model = LabelModel(share, parent, _tables(votes, weight, parent))
            posterior = model.posterior(votes)
    return model


def fit_linear(x: np.ndarray, target: np.ndarray, rounds: int = 300, penalty: float = 1e-3) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, both classes weighing alike, by accelerated gradient steps."""
    mass = max(target.sum(), 1e-9), max((1 - target).sum(), 1e-9)
    gain = target * 0.5 / mass[0] + (1 - target) * 0.5 / mass[1]
    step = 4 / ((x**2).sum(1).max(initial=1) + 1)
    weights, bias = np.zeros(x.shape[1]), 0.0
    ahead, ahead_bias, t = weights, bias, 1.0
    for _ in range(rounds):
        miss = gain * (1 / (1 + np.exp(-(x @ ahead + ahead_bias))) - target)
        new, new_bias = ahead - step * (x.T @ miss + penalty * ahead), ahead_bias - step * miss.sum()
        grown = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, ahead_bias = new + (t - 1) / grown * (new - weights), new_bias + (t - 1) / grown * (new_bias - bias)
        weights, bias, t = new, new_bias, grown
    return weights, float(bias)


@dataclass
class Scorer:
    entries: list[str]
    weights: np.ndarray
    bias: float

    def score(self, lexicon: Lexicon, text: str) -> float:
        value = float(lexicon.features(text)[0] @ self.weights) + self.bias
        return 1 / (1 + np.exp(-np.clip(value, -700, 700)))


def _marked(sample: DataFrame) -> DataFrame:
    """The sample with least hashes of its word windows, mostly alike for near-copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = Words(as_bytes(batch.column("text")))
            starts, hashes = words.windows(words.hashes(), NEAR_COPY_WORDS)
            columns = list(batch.columns)
            for k in range(len(COPY_HASHES)):
                least = np.full(batch.num_rows, np.iinfo(np.uint64).max, np.uint64)
                np.minimum.at(least, words.text_of[starts], mix(hashes + np.uint64(k)))
                columns.append(pa.array(least.view(np.int64)))
            yield pa.record_batch(columns, names=["doc_id", "text", "toxic", *COPY_HASHES])

    schema = "doc_id long, text string, toxic int, " + ", ".join(f"{h} long" for h in COPY_HASHES)
    return sample.select("doc_id", "text", "toxic").mapInArrow(run, schema)


def _without_copies(sample: DataFrame) -> DataFrame:
    for least_hash in COPY_HASHES:
        sample = sample.groupBy(least_hash).agg(F.min_by(F.struct(*sample.columns), "doc_id").alias("s")).select("s.*")
    return sample


def mine_lexicon(sample: DataFrame, n_toxic: int, n_clean: int, size: int = LEXICON_SIZE) -> list[str]:
    """Entries of the toxic class, the surest first. ``sample`` has text and toxic."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            seen = (Counter(), Counter())
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                seen[toxic].update(entries_of(text or ""))
            entries = list({**seen[0], **seen[1]})
            columns = [pa.array(entries, pa.string()), *(pa.array([c[e] for e in entries], pa.int64()) for c in seen)]
            yield pa.record_batch(columns, names=["entry", "clean", "toxic"])

    counts = sample.select("text", "toxic").mapInArrow(count, "entry string, clean long, toxic long")
    counts = counts.groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(F.col("toxic") >= MIN_TEXTS)
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic - F.col("toxic") + 0.5)) - F.log((F.col("clean") + 0.5) / (n_clean - F.col("clean") + 0.5))
    share = n_toxic / (n_toxic + n_clean)
    n = F.col("toxic") + F.col("clean")
    sure = F.col("toxic") * F.log(F.col("toxic") / (n * share)) + F.col("clean") * F.log(F.greatest("clean", F.lit(0.5)) / (n * (1 - share)))
    found = counts.select("entry", sure.alias("sure")).where((odds >= MIN_LOG_ODDS) & (sure >= MIN_EVIDENCE))
    return [r["entry"] for r in found.orderBy(F.desc("sure"), "entry").limit(size).collect()]


def train(docs: DataFrame, labels: DataFrame, texts: int = SAMPLE_TEXTS) -> Scorer:
    """Fit on training rows of ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic; the highest of several holds)."""
    training = docs.select(F.col("doc_id").cast("long"), "text").where(~held_out())
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg((F.max("toxic") > 0).cast("int").alias("toxic")).where(~held_out())
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(texts)
    sample = stored(_marked(training.join(F.broadcast(chosen), "doc_id")), "sample")
    first = stored(_without_copies(sample), "first")
    classes = {r["toxic"]: r["n"] for r in first.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = classes.get(1, 0), classes.get(0, 0)
    prior = (n_toxic + 1) / (n_toxic + n_clean + 2)
    entries = mine_lexicon(first, n_toxic, n_clean) if n_toxic and n_clean else []
    if not entries:
        return Scorer([], np.zeros(2 + len(PATTERNS)), float(np.log(prior / (1 - prior))))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(entries)
        for batch in slices(batches):
            seen = Counter(",".join(map(str, lexicon.features(t or "")[1])) for t in batch.column("text").to_pylist())
            yield pa.record_batch([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["votes", "n"])

    # At most as many rows as there are sets of voters.
    counted = training.select("text").mapInArrow(vote, "votes string, n long").groupBy("votes").agg(F.sum("n").alias("n")).collect()
    counted = sorted((r["votes"], r["n"]) for r in counted)
    model = fit_label_model(np.stack([vote_row(v) for v, _ in counted]), np.array([n for _, n in counted], float), prior)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(entries)
        for batch in slices(batches):
            rows = [lexicon.features(t or "") for t in batch.column("text").to_pylist()]
            columns = [pa.array([",".join(map(str, v)) for _, v in rows], pa.string()), pa.array([x.tobytes() for x, _ in rows], pa.binary())]
            yield pa.record_batch(columns, names=["votes", "x"])

    measured = sample.select("text").mapInArrow(measure, "votes string, x binary").groupBy("votes", "x").agg(F.count(F.lit(1)).alias("n")).collect()
    measured = sorted((r["votes"], bytes(r["x"]), r["n"]) for r in measured)
    x = np.stack([np.frombuffer(x, np.float32) for _, x, _ in measured]).astype(float)
    target = model.posterior(np.stack([vote_row(v) for v, _, _ in measured]))
    weights, bias = fit_linear(x, target)
    return Scorer(entries, weights, bias)


def vote_row(votes: str) -> np.ndarray:
    row = np.zeros(N_VOTERS, np.int64)
    if votes:
        row[list(map(int, votes.split(",")))] = 1
    return row


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """doc_id, held_out, score and predicted of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(scorer.entries)
        for batch in slices(batches):
            scores = [scorer.score(lexicon, t or "") for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

"""Secrets by fixed rules and by a character network over every candidate.

1. Findings: three rules (``assign``, ``access``, ``hex``) give the base spans.
2. Candidates: what a rule found, runs of 16 and more key characters, and runs of
   6 and more behind an assignment mark. Each is read with the characters around
   it, in windows that together hold all of it.
3. A convolutional network over characters and their classes is trained on
   candidates labelled by the rules: found or not. Copies of the findings whose
   letters are drawn anew, or whose surroundings are blanked, teach it to know
   a secret from either alone. Its highest window scores a candidate.
4. A fifth of the labelled candidates, chosen by the hash of their value, is kept
   from training. On all of it scores are calibrated (a logistic curve) for
   candidates behind an assignment mark and for bare ones, each with the highest
   threshold that still finds ``RECALL`` of the held-out findings.
5. Candidates outside the base spans that reach their threshold become spans of
   kind ``learned``; base spans stay, and those that the network doubts are
   listed.

Every distinct value trains, with all its windows, or is held out, and every
candidate of every text is scored. Training goes in lanes of about
``LANE_WINDOWS`` windows dealt by hash: in each of ``ROUNDS`` rounds every lane
takes its own steps from the common network, and the mean of the lanes is the
next one. Lanes depend on the values alone, not on the partitions.

A missing or empty text has no candidates. Texts and runs of any length are read
whole. Equal values count once in training, ties in their hash go by value;
repeated rows and ids are each done. Without findings, or without other
candidates, nothing is learned and no span is added. Columns other than doc_id
and text do not matter; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odflux.llm.place import stored
from odflux.llm.words import slices

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "learned")

# Windows of a lane of training, about, and the most of one row dealt to it.
LANE_WINDOWS, PART_WINDOWS = 4096, 16
ROUNDS = 6
# Values of one label whose order by hash decides the fold, about.
FOLD_VALUES = 1000
HELD_OUT_OF = 5
RECALL = 0.95

# The base rules. Letters of cue words are ASCII letters in either case.
ASSIGN = re.compile(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
# Parts of the cue words that every one of them has, to pass over texts without one.
CUES = ("passw", "secret", "token", "api")

RUN = re.compile(r"[A-Za-z0-9+/_.-]{16,}={0,2}")
VALUE = re.compile(r"[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]{6,})")
MARK = re.compile(r"[:=]\x20*[\"']?\Z")

Span = tuple[int, int, int]  # start, number of the kind, end


def base_spans(text: str, runs: list[tuple[int, int]] | None = None) -> list[tuple[Span, tuple[int, int]]]:
    """Base spans with the span of their value. Access keys and hex strings lie in runs of key characters."""
    found = []
    lower = text.lower() if ":" in text or "=" in text else ""
    if any(cue in lower for cue in CUES):
        for match in ASSIGN.finditer(text):
            if match.end(1) - match.start(1) >= MIN_ASSIGN:
                found.append(((match.start(), 0, match.end()), match.span(1)))
    for start, end in [m.span() for m in RUN.finditer(text)] if runs is None else runs:
        for kind, (rule, least) in enumerate(((ACCESS, MIN_ACCESS), (HEX, MIN_HEX)), 1):
            for match in rule.finditer(text, start, end):
                if match.end() - match.start() >= least:
                    found.append(((match.start(), kind, match.end()), match.span()))
    return sorted(found)


@dataclass(frozen=True)
class Candidate:
    start: int
    end: int
    kind: int  # of the base span it is the value of; -1: of none
    cued: bool  # behind an assignment mark


def candidates(text: str) -> tuple[list[Span], list[Candidate]]:
    """Base spans of a text, and all its candidates."""
    runs = [m.span() for m in RUN.finditer(text)]
    base = base_spans(text, runs)
    found = {value: kind for (_, kind, _), value in reversed(base)}
    other = {m.span(1) for m in VALUE.finditer(text)} if ":" in text or "=" in text else set()
    taken = 0
    spans = sorted({*runs, *other}, key=lambda s: (s[0], -s[1]))
    covered = iter([(s, e) for (s, _, e), _ in base])
    blocked: list[tuple[int, int]] = []
    rest = next(covered, None)
    for start, end in spans:
        while rest and rest[0] < end:
            blocked.append(rest)
            rest = next(covered, None)
        blocked = [b for b in blocked if b[1] > start]
        if start >= taken and not any(b[0] < end for b in blocked):
            found[start, end] = -1
            taken = end
    marked = (MARK.search(text, max(0, start - 16), start) is not None for start, _ in sorted(found))
    return [s for s, _ in base], [Candidate(*span, found[span], cued) for span, cued in zip(sorted(found), marked)]


# A window: the characters before, a stretch of the candidate, the characters after.
AROUND, CORE = 16, 48
WINDOW = CORE + 2 * AROUND
# Codes of characters: 0 outside the text, 1 controls, 2 to 96 printable ASCII, 97 all others; INSIDE is added within the candidate.
INSIDE = 98
N_CODES = 2 * INSIDE
CLASSES = ("outside", "control", "blank", "mark", "digit", "upper", "lower", "other")


def _class_of(code: int) -> int:
    if code < 2:
        return code
    if code == INSIDE - 1:
        return 7
    letter = chr(code + 30)
    return 2 if letter == " " else 4 if letter.isdigit() else 5 if letter.isupper() else 6 if letter.islower() else 3


CLASS_OF = np.array([_class_of(c % INSIDE) + len(CLASSES) * (c // INSIDE) for c in range(N_CODES)])


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    return np.where(points < 32, 1, np.where(points < 127, points - 30, INSIDE - 1)).astype(np.uint8)


def windows(text: str, start: int, end: int) -> np.ndarray:
    """Rows of codes that together hold a candidate and what surrounds it."""
    n = -(-(end - start) // CORE)
    first, last = start - AROUND, start + n * CORE + AROUND
    row = np.zeros(last - first, np.uint8)
    known = codes(text[max(0, first) : last])
    row[max(0, -first) : max(0, -first) + len(known)] = known
    row[AROUND : AROUND + end - start] += INSIDE
    return np.lib.stride_tricks.sliding_window_view(row, WINDOW)[::CORE]


WIDTH, FILTERS = 6, 24


@dataclass
class Network:
    """Filters over characters and their classes, their highest and mean responses, and a linear score."""

    letters: np.ndarray  # place in the filter, code, filter
    classes: np.ndarray  # place in the filter, class, filter
    shift: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Network:
        draw = lambda *shape: rng.normal(0, 0.15, shape).astype(np.float32)
        n_classes = 2 * len(CLASSES)
        return cls(
            draw(WIDTH, N_CODES, FILTERS) * 0.3, draw(WIDTH, n_classes, FILTERS), np.zeros(FILTERS, np.float32),
            draw(2 * FILTERS), np.zeros(1, np.float32),
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([w.reshape(-1) for w in (self.letters, self.classes, self.shift, self.out, self.bias)])

    @classmethod
    def of(cls, flat: np.ndarray) -> Network:
        """The network whose fields are views of a flat array."""
        shapes = ((WIDTH, N_CODES, FILTERS), (WIDTH, 2 * len(CLASSES), FILTERS), (FILTERS,), (2 * FILTERS,), (1,))
        cuts = np.cumsum([0, *(np.prod(shape) for shape in shapes)])
        return cls(*(flat[start:end].reshape(shape) for start, end, shape in zip(cuts, cuts[1:], shapes)))

    def respond(self, rows: np.ndarray) -> np.ndarray:
        table = self.letters + self.classes[:, CLASS_OF]
        places = rows.shape[1] - WIDTH + 1
        total = table[0][rows[:, :places]]
        for j in range(1, WIDTH):
            total += table[j][rows[:, j : j + places]]
        return np.maximum(total + self.shift, 0)

    def score(self, rows: np.ndarray, at_once: int = 256) -> np.ndarray:
        """Score of every window."""
        parts = [np.zeros(0, np.float32)]
        for at in range(0, len(rows), at_once):
            found = self.respond(rows[at : at + at_once])
            parts.append(np.concatenate([found.max(1), found.mean(1)], 1) @ self.out + self.bias[0])
        return np.concatenate(parts)

    def gradient(self, rows: np.ndarray, target: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Of the weighted logistic loss, in the order of the fields."""
        found = self.respond(rows)
        n, places, _ = found.shape
        peak = found.argmax(1)
        pooled = np.concatenate([np.take_along_axis(found, peak[:, None], 1)[:, 0], found.mean(1)], 1)
        miss = (weight * (1 / (1 + np.exp(-(pooled @ self.out + self.bias[0]))) - target)).astype(np.float32)
        back = np.repeat(miss[:, None, None] * self.out[FILTERS:] / places, places, 1)
        np.put_along_axis(back, peak[:, None], np.take_along_axis(back, peak[:, None], 1) + (miss[:, None] * self.out[:FILTERS])[:, None], 1)
        back *= found > 0
        letters, classes = np.zeros_like(self.letters), np.zeros_like(self.classes)
        flat = back.reshape(-1, FILTERS)
        for j in range(WIDTH):
            code = rows[:, j : j + places].reshape(-1)
            order = np.argsort(code, kind="stable")
            there, first = np.unique(code[order], return_index=True)
            letters[j, there] = np.add.reduceat(flat[order], first)
            np.add.at(classes[j], CLASS_OF[there], letters[j, there])
        return [letters, classes, flat.sum(0), pooled.T @ miss, miss.sum(keepdims=True)]


@dataclass
class Adam:
    """A network in training: its weights, the running means of their slopes and squares, and the steps taken."""

    weights: np.ndarray
    mean: np.ndarray
    square: np.ndarray
    step: float = 0.0

    @classmethod
    def fresh(cls) -> Adam:
        weights = Network.fresh(np.random.default_rng(7)).flat()
        return cls(weights, np.zeros_like(weights), np.zeros_like(weights))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.weights, self.mean, self.square, np.array([self.step], np.float32)])

    @classmethod
    def of(cls, flat: np.ndarray) -> Adam:
        weights, mean, square = (w.astype(np.float32) for w in np.split(flat[:-1], 3))
        return cls(weights, mean, square, float(flat[-1]))

    def go(self, rows: np.ndarray, target: np.ndarray, gain: np.ndarray, rng: np.random.Generator, rate: float, batch: int, decay: float = 1e-2) -> None:
        """Steps over all rows once, in shuffled batches."""
        net = Network.of(self.weights)
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            self.step += 1
            some = order[at : at + batch]
            slope = np.concatenate([g.reshape(-1) for g in net.gradient(rows[some], target[some], gain[some] / len(some))])
            slope = slope.astype(np.float32) + np.float32(decay) * self.weights
            self.mean += 0.1 * (slope - self.mean)
            self.square += 0.001 * (slope**2 - self.square)
            self.weights -= rate * (self.mean / (1 - 0.9**self.step)) / (np.sqrt(self.square / (1 - 0.999**self.step)) + 1e-8)


@dataclass
class Curve:
    """Chance of a secret by score, and the threshold on it."""

    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0  # over 1: never reached

    def chance(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * score + self.shift, -700, 700)))


Sums = tuple[float, np.ndarray, np.ndarray]  # of the loss, its slope and its second slopes


def fit_line(sums: Callable[[np.ndarray], Sums]) -> Curve:
    """Logistic curve by Newton steps, given the sums over all scores at a slope and shift."""

    def penalised(at: np.ndarray) -> Sums:
        loss, slope, curve = sums(at)
        return loss + 0.5e-3 * float(at @ at), slope + 1e-3 * at, curve + 1e-3 * np.eye(2)

    at = np.array([1.0, 0.0])
    loss, slope, curve = penalised(at)
    for _ in range(50):
        move, size = np.linalg.solve(curve, slope), 1.0
        if np.abs(move).max() < 1e-6:
            break
        there = penalised(at - size * move)
        while size > 1e-6 and there[0] > loss:
            size /= 2
            there = penalised(at - size * move)
        at = at - size * move
        loss, slope, curve = there
    return Curve(max(float(at[0]), 1e-6), float(at[1]))


def smoothed(hits: int, rest: int) -> tuple[float, float]:
    """Targets of findings and of others."""
    return (hits + 1) / (hits + 2), 1 / (rest + 2)


def fit_curve(score: np.ndarray, target: np.ndarray, recall: float = RECALL) -> Curve:
    """Logistic curve on smoothed targets, and the highest threshold of the recall asked for."""
    hits, rest = int(target.sum()), int((1 - target).sum())
    if not hits:
        return Curve()
    soft = np.where(target > 0, *smoothed(hits, rest))
    x = np.stack([score, np.ones(len(score))], 1).astype(float)

    def sums(at: np.ndarray) -> Sums:
        z = x @ at
        chance = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
        return float((np.logaddexp(0, z) - soft * z).sum()), x.T @ (chance - soft), (x * (chance * (1 - chance))[:, None]).T @ x

    fitted = fit_line(sums)
    found = np.sort(fitted.chance(score[target > 0]))[::-1]
    fitted.threshold = float(found[int(np.ceil(recall * hits)) - 1])
    return fitted


def kth_highest(scores: DataFrame, k: int) -> float:
    """The k-th highest score of a table, by counts in ever finer bins."""
    low, high = scores.agg(F.min("score"), F.max("score")).first()
    while low < high:
        number = F.floor((F.col("score") - low) / ((high - low) / 1000)).alias("bin")
        within = scores.where(F.col("score").between(low, high)).groupBy(number)
        for row in within.agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"), F.max("score").alias("high")).orderBy(F.desc("bin")).collect():
            low, high = row["low"], row["high"]
            if k <= row["n"]:
                break
            k -= row["n"]
    return low


def fit_curve_of(scores: DataFrame, recall: float = RECALL) -> Curve:
    """As ``fit_curve``, of a table of score (double) and hit."""
    hits, n = scores.agg(F.count_if("hit"), F.count(F.lit(1))).first()
    if not hits:
        return Curve()
    soft = F.when(F.col("hit"), F.lit(smoothed(hits, n - hits)[0])).otherwise(F.lit(smoothed(hits, n - hits)[1]))

    def sums(at: np.ndarray) -> Sums:
        z = F.col("score") * F.lit(float(at[0])) + F.lit(float(at[1]))
        rows = scores.select("score", z.alias("z"), soft.alias("soft"))
        chance = 1 / (1 + F.exp(F.greatest(F.least(-F.col("z"), F.lit(700.0)), F.lit(-700.0))))
        loss = F.greatest("z", F.lit(0.0)) + F.log1p(F.exp(-F.abs("z"))) - F.col("soft") * F.col("z")
        rows = rows.select("score", loss.alias("loss"), (chance - F.col("soft")).alias("miss"), (chance * (1 - chance)).alias("bend"))
        of = [F.col("loss"), F.col("miss") * F.col("score"), F.col("miss"), F.col("bend") * F.col("score") ** 2, F.col("bend") * F.col("score"), F.col("bend")]
        total = rows.agg(*(F.sum(each) for each in of)).first()
        return total[0], np.array(total[1:3]), np.array([[total[3], total[4]], [total[4], total[5]]])

    fitted = fit_line(sums)
    fitted.threshold = float(fitted.chance(kth_highest(scores.where("hit"), int(np.ceil(recall * hits)))))
    return fitted


@dataclass
class Detector:
    """A network with a curve for bare candidates and one for those behind an assignment mark."""

    network: Network | None = None
    curves: list[Curve] = field(default_factory=lambda: [Curve(), Curve()])

    def judge(self, rows: list[np.ndarray], cued: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        """Chance of each candidate, given its windows, and whether it reaches its threshold."""
        if self.network is None or not rows:
            return np.zeros(len(rows)), np.zeros(len(rows), bool)
        cuts = np.cumsum([0, *map(len, rows)])[:-1]
        # In doubles, as thresholds are: a flat curve tells scores apart by less than a single holds.
        score = np.maximum.reduceat(self.network.score(np.concatenate(rows)), cuts).astype(float)
        chances = np.stack([curve.chance(score) for curve in self.curves])
        own = np.array(cued, int)
        chance = chances[own, np.arange(len(rows))]
        return chance, chance >= np.array([curve.threshold for curve in self.curves])[own]


FOUND = (
    "doc_id long, base array<struct<start: int, kind: int, stop: int>>, "
    "candidates array<struct<start: int, stop: int, kind: int, cued: boolean, value: long, windows: binary>>"
)


def _value_hash(value: str) -> int:
    """Eight bytes of a digest, so equal values meet wherever they stand."""
    return int.from_bytes(hashlib.blake2b(value.encode("utf-8"), digest_size=8).digest(), "little", signed=True)


def find_candidates(docs: DataFrame) -> DataFrame:
    """doc_id, base spans and candidates of every text."""
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32())])
    one = pa.struct(
        [("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.int32()), ("cued", pa.bool_()), ("value", pa.int64()), ("windows", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bases, others = [], []
            for text in batch.column("text").to_pylist():
                base, found = candidates(text or "")
                bases.append([{"start": s, "kind": k, "stop": e} for s, k, e in base])
                others.append(
                    [
                        {
                            "start": c.start, "stop": c.end, "kind": c.kind, "cued": c.cued,
                            "value": _value_hash(text[c.start : c.end]), "windows": windows(text, c.start, c.end).tobytes(),
                        }
                        for c in found
                    ]
                )
            columns = [batch.column("doc_id"), pa.array(bases, pa.list_(span)), pa.array(others, pa.list_(one))]
            yield pa.record_batch(columns, names=["doc_id", "base", "candidates"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, FOUND)


def _rows(stored_windows: bytes) -> np.ndarray:
    return np.frombuffer(stored_windows, np.uint8).reshape(-1, WINDOW)


def vary(rows: np.ndarray, rng: np.random.Generator) -> list[np.ndarray]:
    """A finding's windows with its letters drawn anew, with its surroundings blanked, and with both."""
    inside = rows >= INSIDE
    alphabet = [codes("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"), codes("0123456789ABCDEF"), codes("0123456789abcdef")]
    drawn = rng.choice(alphabet[rng.integers(len(alphabet))], rows.shape) + INSIDE
    redrawn = np.where(inside, drawn, rows)
    blank = codes(" ")[0]
    return [redrawn, np.where(inside, rows, blank), np.where(inside, redrawn, blank)]


def labelled(found: DataFrame) -> DataFrame:
    """A row for each distinct value: whether it is a finding and held out, whether it is behind a mark, and its windows."""
    each = found.select(F.explode("candidates").alias("c")).select("c.*").withColumn("hit", F.col("kind") >= 0)
    # Of the occurrences of a value, a finding before others, then the least window.
    distinct = each.groupBy("value").agg(F.max_by(F.struct("hit", "cued", "windows"), F.struct("hit", "windows")).alias("c")).select("value", "c.*")
    distinct = stored(distinct, "values")
    n_values = {r["hit"]: r["n"] for r in distinct.groupBy("hit").agg(F.count(F.lit(1)).alias("n")).collect()}
    # The order by hash decides the fold, so that few findings are dealt out evenly too.
    groups = F.when(F.col("hit"), F.lit(1 + n_values.get(True, 0) // FOLD_VALUES)).otherwise(F.lit(1 + n_values.get(False, 0) // FOLD_VALUES))
    rank = F.row_number().over(Window.partitionBy("hit", F.pmod(F.xxhash64("value"), groups)).orderBy(F.xxhash64("value"), "value"))
    return distinct.withColumn("held", rank % HELD_OUT_OF == 0)


def window_parts(values: DataFrame, lanes: int) -> DataFrame:
    """All windows of the values, some of one value a row, dealt to lanes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = PART_WINDOWS * WINDOW
        for batch in slices(batches, "windows"):
            cut = [
                (value, hit, at // size, rows[at : at + size])
                for value, hit, rows in zip(*(batch.column(c).to_pylist() for c in ("value", "hit", "windows")))
                for at in range(0, len(rows), size)
            ]
            types = (pa.int64(), pa.bool_(), pa.int64(), pa.binary())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*cut), types)], names=["value", "hit", "part", "windows"])

    parts = values.select("value", "hit", "windows").mapInArrow(run, "value long, hit boolean, part long, windows binary")
    return parts.withColumn("lane", F.pmod(F.xxhash64("value", "part"), F.lit(lanes)))


def lane_rows(table: pa.Table, lane: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows that a lane trains on, with copies of them, and their targets."""
    rng = np.random.default_rng([11, lane])
    rows, target = [], []
    table = table.sort_by([("value", "ascending"), ("part", "ascending")])
    for stored_windows, hit in zip(table.column("windows").to_pylist(), table.column("hit").to_pylist()):
        own = _rows(stored_windows)
        some = [own, *vary(own, rng)] if hit else [own, np.where(own >= INSIDE, own, codes(" ")[0])]
        rows += some
        target += [float(hit)] * sum(map(len, some))
    return np.concatenate(rows), np.array(target)


def train_lanes(parts: DataFrame, lanes: int, state: Adam, gains: tuple[float, float], turn: int, passes: int, batch: int, rate: float) -> Adam:
    """Steps of every lane from a common state, and the mean of where they end."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        lane = key[0].as_py()
        rows, target = lane_rows(table, lane)
        own, rng = Adam.of(state.flat()), np.random.default_rng([7, lane, turn])
        for _ in range(passes):
            own.go(rows, target, np.where(target > 0, *gains), rng, rate, batch)
        return pa.table({"state": pa.array([own.flat().tobytes()], pa.binary())})

    ends = parts.repartition(lanes, "lane").groupBy("lane").applyInArrow(run, "state binary")
    states = ends.rdd.map(lambda r: (np.frombuffer(r["state"], np.float32).astype(float), 1))
    total, n = states.treeReduce(lambda a, b: (a[0] + b[0], a[1] + b[1]))
    return Adam.of(total / n)


def fit_network(values: DataFrame, n_hit: int, n_rest: int, steps: int = 300, batch: int = 128, rate: float = 0.01) -> Network:
    """Adam steps over the ``n_hit`` and ``n_rest`` windows of the values, ``steps`` a lane at least; both classes weigh alike."""
    lanes = 1 + (n_hit + n_rest) // LANE_WINDOWS
    parts = stored(window_parts(values, lanes), "parts")
    # Rows with the copies of ``lane_rows``.
    hits, rest = 4 * n_hit, 2 * n_rest
    gains = (0.5 * (hits + rest) / max(1, hits), 0.5 * (hits + rest) / max(1, rest))
    passes = -(-steps * batch * lanes // (ROUNDS * (hits + rest)))
    state = Adam.fresh()
    for turn in range(ROUNDS):
        state = train_lanes(parts, lanes, state, gains, turn, passes, batch, rate / (1 + 4 * turn / ROUNDS))
    return Network.of(state.weights)


def scored(values: DataFrame, network: Network) -> DataFrame:
    """Scores of labelled values; a finding without its surroundings is a bare one too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for stored_windows, hit, cued in zip(*(batch.column(c).to_pylist() for c in ("windows", "hit", "cued"))):
                own = _rows(stored_windows)
                rows.append((hit, cued, float(network.score(own).max())))
                if hit:
                    rows.append((True, False, float(network.score(np.where(own >= INSIDE, own, codes(" ")[0])).max())))
            columns = list(zip(*rows)) or [()] * 3
            types = (pa.bool_(), pa.bool_(), pa.float64())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=["hit", "cued", "score"])

    return values.select("windows", "hit", "cued").mapInArrow(run, "hit boolean, cued boolean, score double")


def train(found: DataFrame) -> Detector:
    """Fit on all the candidates that ``find_candidates`` gave."""
    values = stored(labelled(found), "labelled")
    counts = values.groupBy("hit", "held").agg(F.sum(F.length("windows") / WINDOW).cast("long").alias("n")).collect()
    n = {(r["hit"], r["held"]): r["n"] for r in counts}
    if len({hit for hit, _ in n}) < 2:
        return Detector()
    network = fit_network(values.where("not held"), n.get((True, False), 0), n.get((False, False), 0))
    detector = Detector(network)
    judged = values.where("held") if any(held for _, held in n) else values
    scores = stored(scored(judged, network), "scores")
    detector.curves = [fit_curve_of(scores.where(F.col("cued") == cued)) for cued in (False, True)]
    return detector


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


COUNTS = tuple(f"n_{kind}" for kind in KINDS)
SCANNED = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base string, spans string, doubted string"


def judge(found: DataFrame, detector: Detector) -> DataFrame:
    """doc_id, spans of each kind, base spans, all spans, and base spans below their threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases, others = batch.column("base").to_pylist(), batch.column("candidates").to_pylist()
            flat = [c for own in others for c in own]
            _, sure = detector.judge([_rows(c["windows"]) for c in flat], [c["cued"] for c in flat])
            at, rows = 0, []
            for base, own in zip(bases, others):
                spans = [(s["start"], s["kind"], s["stop"]) for s in base]
                passed = sure[at : at + len(own)].tolist()
                at += len(own)
                added = [(c["start"], len(BASE_KINDS), c["stop"]) for c, yes in zip(own, passed) if yes and c["kind"] < 0]
                low = [(c["start"], c["kind"], c["stop"]) for c, yes in zip(own, passed) if not yes and c["kind"] >= 0]
                every = sorted(spans + added)
                counts = [sum(kind == k for _, kind, _ in every) for k in range(len(KINDS))]
                rows.append((*counts, written(spans), written(every), written(low)))
            columns = list(zip(*rows)) or [()] * (len(COUNTS) + 3)
            types = [pa.int64()] * len(COUNTS) + [pa.string()] * 3
            arrays = [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types))]
            yield pa.record_batch(arrays, names=["doc_id", *COUNTS, "base", "spans", "doubted"])

    return found.mapInArrow(run, SCANNED)


def scan(docs: DataFrame) -> DataFrame:
    """Find, train and judge: each text is read once, its candidates are written to the shared folder."""
    found = stored(find_candidates(docs), "candidates")
    return judge(found, train(found))

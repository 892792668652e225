"""URL rules by a sort-merge range join.

A host is turned around, ``www.example.com`` to ``com.example.www.``, so a rule's
host and all its subdomains are one interval of the sorted keys, and the
intervals of any two rules are nested or apart. Pages and rules are dealt to
ranges of keys, a rule to every range its interval meets, and sorted; one sweep
over a range keeps the hosts whose interval is open on a stack. The rules of a
host come sorted by path, and a second stack links each path to the path it is
nested in, so the rules that a page's path begins with are one chain. Of all
open rules that fit, the longest wins, and of equally long ones that of the
longer host.

Ranges are cut at (key, hash of the row and its place in the input), so the pages
of one host, and copies of one page, spread over as many ranges as their number
asks for. Only a sample of fixed size comes to the driver, to cut them.

A missing url, or one without ``://``, has an empty host and path; urls of any
length are read whole. Hosts are lower-cased from A to Z only, in rules too.
Rules without a host, path or verdict are left out; of equal rules ``block``
holds. Repeated pages are each judged. Other columns do not matter. No pages
give no rows, and without rules all pages get the verdict ``otherwise``.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflux.llm.place import shuffles

ADDRESS = re.compile(r"(?s).*?://([^/?#]*)([^?#]*)")
SAMPLES_PER_RANGE = 20
RANGES_PER_PARTITION = 4

Bound = tuple[bytes, int]
# Any hash of a row lies between these.
LEAST, MOST = -(1 << 63), 1 << 63


def host_and_path(url: str | None) -> tuple[str, str]:
    found = ADDRESS.match(url or "")
    # Only A-Z are lower-cased, as bytes.lower() does.
    return (found[1].encode().lower().decode(), found[2]) if found else ("", "")


def key_of(host: str) -> bytes:
    return ".".join(reversed(host.split("."))).encode() + b"." if host else b""


def with_tie(pages: DataFrame) -> DataFrame:
    """Pages with a hash that parts equal rows too, by their place in the input."""
    return pages.withColumn("tie", F.xxhash64("page_id", "url", F.monotonically_increasing_id()))


def range_bounds(points: DataFrame, ranges: int) -> list[Bound]:
    """Keys that cut the pages into ``ranges`` parts of like size, from a sample of fixed size; ``points`` has url and tie."""
    every = max(1, points.count() // (ranges * SAMPLES_PER_RANGE))
    sample = points.where(F.pmod(F.xxhash64("tie"), F.lit(every)) == 0).select("url", "tie").collect()
    places = sorted((key_of(host_and_path(r["url"])[0]), r["tie"]) for r in sample)
    return sorted({places[len(places) * k // ranges] for k in range(1, ranges)}) if places else []


class HostRules:
    """Rules of a host by path. A path is nested in the longest other path that it starts with."""

    def __init__(self, host: str) -> None:
        self.host = host
        self.paths: list[str] = []
        self.verdicts: list[str] = []
        self.within: list[int] = []
        self._open: list[int] = []

    def add(self, path: str, verdict: str) -> None:
        """Paths come in order."""
        while self._open and not path.startswith(self.paths[self._open[-1]]):
            self._open.pop()
        self.within.append(self._open[-1] if self._open else -1)
        self._open.append(len(self.paths))
        self.paths.append(path)
        self.verdicts.append(verdict)

    def longest(self, path: str) -> int:
        """Number of the longest path that ``path`` starts with, or -1: all such paths hold the last one before it."""
        at = bisect_right(self.paths, path) - 1
        while at >= 0 and not path.startswith(self.paths[at]):
            at = self.within[at]
        return at


class OpenRules:
    """The hosts whose interval holds the key of the sweep, the widest first."""

    def __init__(self) -> None:
        self.stack: list[tuple[bytes, HostRules]] = []

    def move(self, key: bytes) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def add(self, key: bytes, host: str, path: str, verdict: str) -> None:
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, HostRules(host)))
        self.stack[-1][1].add(path, verdict)

    def longest(self, path: str) -> tuple[str, str, str] | None:
        fits = ((rules, rules.longest(path)) for _, rules in self.stack)
        named = ((rules.host, rules.paths[at], rules.verdicts[at]) for rules, at in fits if at >= 0)
        return max(named, key=lambda rule: (len(rule[0]) + len(rule[1]), len(rule[0])), default=None)


SORTED = "range int, key binary, page boolean, tie long, page_id long, host string, path string, verdict string"
NAMES = ["range", "key", "page", "tie", "page_id", "host", "path", "verdict"]


def judge_urls(pages: DataFrame, rules: DataFrame, otherwise: str = "allow") -> DataFrame:
    """page_id, host, path, the rule that holds (host and path; missing if none does) and the verdict."""
    pages = pages.select(F.col("page_id").cast("long"), "url")
    partitions = shuffles(pages)
    points = with_tie(pages)
    bounds = range_bounds(points, partitions * RANGES_PER_PARTITION)

    def place_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parsed = [host_and_path(u) for u in batch.column("url").to_pylist()]
            keys = [key_of(host) for host, _ in parsed]
            at = [bisect_right(bounds, point) for point in zip(keys, batch.column("tie").to_pylist())]
            n = batch.num_rows
            yield pa.record_batch(
                [
                    pa.array(at, pa.int32()), pa.array(keys, pa.binary()), pa.array([True] * n, pa.bool_()),
                    batch.column("tie"), batch.column("page_id"), pa.array([p[0] for p in parsed], pa.string()),
                    pa.array([p[1] for p in parsed], pa.string()), pa.nulls(n, pa.string()),
                ],
                names=NAMES,
            )

    def place_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rule in batch.to_pylist():
                key = key_of(rule["host"])
                low, high = bisect_right(bounds, (key, LEAST)), bisect_right(bounds, (key + b"\xff", MOST))
                n = high - low + 1
                yield pa.record_batch(
                    [
                        pa.array(range(low, high + 1), pa.int32()), pa.array([key] * n, pa.binary()),
                        pa.array([False] * n, pa.bool_()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
                        pa.array([rule["host"]] * n, pa.string()), pa.array([rule["path"]] * n, pa.string()),
                        pa.array([rule["verdict"]] * n, pa.string()),
                    ],
                    names=NAMES,
                )

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, rules_open = None, OpenRules()
        for batch in batches:
            ids, hosts, paths, names, verdicts = [], [], [], [], []
            for r in batch.to_pylist():
                if r["range"] != here:
                    here, rules_open = r["range"], OpenRules()
                rules_open.move(r["key"])
                if not r["page"]:
                    rules_open.add(r["key"], r["host"], r["path"], r["verdict"])
                    continue
                rule = rules_open.longest(r["path"])
                ids.append(r["page_id"])
                hosts.append(r["host"])
                paths.append(r["path"])
                names.append(rule and rule[0] + rule[1])
                verdicts.append(rule[2] if rule else otherwise)
            columns = [pa.array(ids, pa.int64()), *(pa.array(c, pa.string()) for c in (hosts, paths, names, verdicts))]
            yield pa.record_batch(columns, names=["page_id", "host", "path", "rule", "verdict"])

    known = rules.where("host is not null and path is not null and verdict is not null")
    # Only A-Z are lower-cased, as in pages.
    known = known.groupBy(F.translate("host", ascii_uppercase, ascii_lowercase).alias("host"), "path").agg(
        F.when(F.max(F.col("verdict") == "block"), "block").otherwise(F.min("verdict")).alias("verdict")
    )
    both = points.mapInArrow(place_pages, SORTED).union(known.mapInArrow(place_rules, SORTED))
    ordered = both.repartition(partitions, "range").sortWithinPartitions("range", "key", "page", "path", "tie")
    return ordered.mapInArrow(sweep, "page_id long, host string, path string, rule string, verdict string")

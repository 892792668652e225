"""Joins of a large flow table with a lookup whose size is measured first.

A lookup that is proven small is broadcast, so the flow table is not
shuffled. A lookup beyond the bound is joined by a plain shuffle: adaptive
execution splits the flow rows of a common code over several tasks, and filters
on the result still reach the scan.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from odflux.sources.workdir import keep

BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD_BYTES = 64


@dataclass(frozen=True)
class LookupSize:
    rows: int
    bytes: int


class Lookup:
    """A lookup table, its key columns, and the largest size to broadcast."""

    def __init__(self, frame: DataFrame, keys: str | Sequence[str], max_bytes: int = BROADCAST_BYTES) -> None:
        self.frame = frame
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        self.max_bytes = max_bytes
        missing = [k for k in self.keys if k not in frame.columns]
        if missing:
            raise ValueError(f"lookup has no column {missing}")

    @classmethod
    def kept(cls, frame: DataFrame, keys: str | Sequence[str], max_bytes: int = BROADCAST_BYTES) -> Lookup:
        """A lookup evaluated once into the shared folder, and measured by that same job."""
        lookup, seen = cls(frame, keys, max_bytes), Observation()
        lookup.frame = keep(frame.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(lookup._row_bytes()).alias("b")))
        lookup.size = LookupSize(rows=seen.get["n"], bytes=seen.get["b"] or 0)
        return lookup

    def _row_bytes(self) -> Column:
        widths = (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in self.frame.columns)
        return sum(widths, F.lit(ROW_OVERHEAD_BYTES))

    @cached_property
    def size(self) -> LookupSize:
        """Rows and text bytes, by one small distributed job."""
        row = self.frame.agg(F.count(F.lit(1)).alias("n"), F.sum(self._row_bytes()).alias("b")).first()
        return LookupSize(rows=row["n"], bytes=row["b"] or 0)

    @property
    def fits(self) -> bool:
        return self.size.bytes <= self.max_bytes

    def warn_if_not_unique(self) -> Lookup:
        """Measure the table and its keys together; a repeated key multiplies flows."""
        per_key = self.frame.groupBy(*self.keys).agg(
            F.count(F.lit(1)).alias("n"), F.sum(self._row_bytes()).alias("b")
        )
        row = per_key.agg(F.sum("n").alias("n"), F.sum("b").alias("b"), F.count(F.lit(1)).alias("keys")).first()
        self.size = LookupSize(rows=row["n"] or 0, bytes=row["b"] or 0)
        if self.size.rows > row["keys"]:
            warnings.warn(
                f"lookup key {self.keys} is not unique: {self.size.rows} rows for {row['keys']} keys; "
                "matching flows are multiplied",
                stacklevel=3,
            )
        return self

    def keyed_by(self, *keys: str) -> Lookup:
        """The same table under other key columns, without measuring it again."""
        other = Lookup(self.frame, keys, self.max_bytes)
        other.size = self.size
        return other

    def attach(
        self, df: DataFrame, columns: str | Sequence[str], values: Mapping[str, str], how: str = "inner"
    ) -> DataFrame:
        """Add lookup columns (old name to new name) to the rows of ``df``."""
        side = self.frame.select(
            *[F.col(k).alias(f"__key_{i}") for i, k in enumerate(self.keys)],
            *[F.col(old).alias(new) for old, new in values.items()],
        )
        return self._join(df, columns, side, how).select(*df.columns, *values.values())

    def restrict(self, df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
        """Rows of ``df`` whose code occurs in the lookup."""
        side = self.frame.select(*[F.col(k).alias(f"__key_{i}") for i, k in enumerate(self.keys)]).distinct()
        return self._join(df, columns, side, "left_semi").select(*df.columns)

    def _join(self, df: DataFrame, columns: str | Sequence[str], side: DataFrame, how: str) -> DataFrame:
        columns = [columns] if isinstance(columns, str) else list(columns)
        return df.join(F.broadcast(side) if self.fits else side.hint("merge"), _equal(columns), how)


def _equal(columns: Sequence[str]) -> Column:
    pairs = (F.col(c) == F.col(f"__key_{i}") for i, c in enumerate(columns))
    return reduce(lambda left, right: left & right, pairs)


def map_both_ends(
    flows: DataFrame,
    lookup: Lookup | DataFrame,
    target: str,
    key: str = "lad_code",
    into: tuple[str, str] = ("area_in", "area_out"),
) -> DataFrame:
    """Map gss_in and gss_out through one lookup; flows with an unmapped end drop.

    A plain table is measured and its key checked; a ``Lookup`` is used as it is.
    """
    if not isinstance(lookup, Lookup):
        lookup = Lookup(lookup, key).warn_if_not_unique()
    area_in, area_out = into
    mapped = lookup.attach(flows, "gss_in", {target: area_in})
    return lookup.attach(mapped, "gss_out", {target: area_out})

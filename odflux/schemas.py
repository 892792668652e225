"""Explicit schemas of the flow tables.

Codes are strings, years and ages integers, measures doubles. ``year`` stays
an integer so that partition folders read ``year=2012``.
"""

from __future__ import annotations

from pyspark.sql import types as T

FLOW_KEYS = ("gss_out", "gss_in", "sex", "year", "age")

FLOWS_LONG = T.StructType(
    [
        T.StructField("gss_out", T.StringType()),
        T.StructField("gss_in", T.StringType()),
        T.StructField("sex", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("value", T.DoubleType()),
    ]
)

CODE_CHANGES = T.StructType(
    [
        T.StructField("changed_from_code", T.StringType()),
        T.StructField("changed_from_name", T.StringType()),
        T.StructField("changed_to_code", T.StringType()),
        T.StructField("changed_to_name", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("split", T.BooleanType()),
        T.StructField("merge", T.BooleanType()),
    ]
)


def sheet_field(name: str) -> T.StructField:
    """Type of one column of a yearly sheet, decided by its lower-case name."""
    if name == "year":
        return T.StructField(name, T.IntegerType())
    if name.startswith("age_"):
        return T.StructField(name, T.DoubleType())
    return T.StructField(name, T.StringType())


def sheet_schema(header: list[str]) -> T.StructType:
    return T.StructType([sheet_field(name.lower()) for name in header])


def flows_wide(last_age: int, first_age: int = 0) -> T.StructType:
    ages = [f"age_{age}" for age in range(first_age, last_age + 1)]
    return sheet_schema(["outla", "inla", "sex", "year", *ages])

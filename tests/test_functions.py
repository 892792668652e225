from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from odflux.functions import nulls
from odflux.functions.codes import is_local_authority, labelled
from odflux.functions.numbers import round_half_even
from odflux.functions.text import basename, first_year, output_name
from odflux.settings import settings_for


def test_missing_differs_from_everything(spark, rows):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "b"), (None, None)], "l string, r string")
    kept = df.where(nulls.differs(F.col("l"), F.col("r")))
    assert rows(kept) == [("a", "b"), (None, "b"), (None, None)]


@pytest.mark.parametrize("code, hit", [("E06000001", True), ("XE07", True), ("W06000003", True), ("S12000004", False), (None, False)])
def test_pattern_is_unanchored_and_false_on_missing(spark, code, hit):
    df = spark.createDataFrame([(code,)], "c string")
    assert df.select(is_local_authority(F.col("c"))).first()[0] is hit


def test_sum_of_missing_values_is_zero(spark, rows):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3.0), (2, None)], "k int, v double")
    assert rows(df.groupBy("k").agg(nulls.sum_or_zero("v"))) == [(1, 0.0), (2, 3.0)]


def test_missing_keys_are_no_group(spark, rows):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", None)], "c string, n int")
    assert rows(nulls.with_keys(df, ["c", "n"])) == [("a", 1)]


def test_ties_round_to_even(spark):
    values = [0.05, 0.25, 0.35, 1.15, 2.5, -0.25]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(round_half_even(F.col("v"))).collect()]
    assert got == [0.0, 0.2, 0.4, 1.2, 2.5, -0.2]


def test_nan_becomes_missing(spark, rows):
    df = spark.createDataFrame([(1.0, "x"), (float("nan"), "y")], "v double, c string")
    assert rows(nulls.nan_to_null(df)) == [(1.0, "x"), (None, "y")]


def test_label_without_entry_is_missing(spark, rows):
    df = spark.createDataFrame([("F",), ("M",), ("X",), (None,)], "c string")
    labels = {"F": "female", "M": "male"}
    assert rows(df.select("c", labelled(F.col("c"), labels))) == [("F", "female"), ("M", "male"), ("X", None), (None, None)]


def test_paths_years_and_names(spark):
    df = spark.createDataFrame([("https://h/a/detail2012on2021and2023las.xlsx",), ("plain",), ("x/y.xls",)], "u string")
    got = df.select(basename(F.col("u")), first_year(F.col("u")), output_name(basename(F.col("u")))).collect()
    assert [tuple(r) for r in got] == [
        ("detail2012on2021and2023las.xlsx", 2012, "detail2012on2023las.csv"),
        ("plain", None, "plain"),
        ("y.xls", None, "y.csv"),
    ]


@pytest.mark.parametrize(
    "input_bytes, cores, partitions", [(0, 8, 8), (10 * 2**30, 8, 40), (10**14, 8000, 372_530), (0, 3, 3)]
)
def test_shuffle_partitions_grow_with_the_input(input_bytes, cores, partitions):
    assert settings_for(input_bytes, cores)["spark.sql.shuffle.partitions"] == str(partitions)


def test_a_pattern_of_words_equals_the_regex(spark):
    df = spark.createDataFrame([("E06",), ("XW0",), ("S12E",), ("e06",), (None,)], "c string")
    words = [r[0] for r in df.select(nulls.holds(F.col("c"), "E0|W0")).collect()]
    regex = [r[0] for r in df.select(nulls.holds(F.col("c"), "(E0|W0)")).collect()]
    assert words == regex == [True, True, False, False, False]

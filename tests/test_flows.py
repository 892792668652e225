from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from odflux.operators import flows as ops
from odflux.operators.lookups import Lookup, map_both_ends

OD = "gss_in string, gss_out string, year int, value double"


def by_hand(df):
    """Sums per area and year in plain Python."""
    found = defaultdict(lambda: [0.0, 0.0])
    for row in df.collect():
        for side, end in enumerate(("gss_in", "gss_out")):
            if row[end] is not None and row["year"] is not None:
                found[row[end], row["year"]][side] += row["value"] or 0.0
    return {key: tuple(v) for key, v in found.items()}


@pytest.mark.parametrize("seed", range(2))
def test_gross_flows_against_brute_force(random_flows, seed):
    df = random_flows(seed)
    got = {(r["gss_code"], r["year"]): (r["inflow"], r["outflow"]) for r in ops.gross_flows(df).collect()}
    assert got == by_hand(df)


def test_single_pass_equals_outer_join_of_sums(random_flows, rows):
    df = random_flows(5)
    joined = ops.outer_fill(ops.inflow_by_area(df), ops.outflow_by_area(df))
    assert rows(ops.gross_flows(df)) == rows(joined)


def test_one_sided_areas_and_missing_keys(spark, rows):
    df = spark.createDataFrame([("a", "b", 2012, 1.25), ("a", None, 2012, 2.0), (None, "c", 2013, 1.0), ("d", "d", None, 9.0)], OD)
    assert rows(ops.gross_flows(df)) == [("a", 2012, 3.2, 0.0), ("b", 2012, 0.0, 1.2), ("c", 2013, 0.0, 1.0)]


def test_what_flows_in_flows_out(random_flows):
    df = random_flows(6).where("gss_in IS NOT NULL AND gss_out IS NOT NULL")
    for row in ops.gross_flows(df).groupBy("year").agg(F.sum("inflow").alias("i"), F.sum("outflow").alias("o")).collect():
        assert row["i"] == row["o"]


def test_gross_flows_shuffle_once_over_partial_sums(random_flows, plan):
    text = plan(ops.gross_flows(random_flows(0)))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in text and "Python" not in text


def test_repeated_lookup_key_multiplies_and_warns(spark, rows):
    df = spark.createDataFrame([("a", "b", 2012, 1.0)], OD)
    lookup = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "lad_code string, region string")
    with pytest.warns(UserWarning, match="not unique"):
        got = ops.aggregate_areas(df, lookup, "region")
    assert rows(got) == [("x", "z", 2012, 1.0), ("y", "z", 2012, 1.0)]


def test_unmapped_ends_drop_and_moves_inside_stay(spark, rows):
    df = spark.createDataFrame([("a", "b", 2012, 1.0), ("a", "q", 2012, 5.0), ("q", "a", 2012, 5.0)], OD)
    lookup = spark.createDataFrame([("a", "x"), ("b", "x")], "lad_code string, region string")
    assert rows(ops.aggregate_areas(df, lookup, "region")) == [("x", "x", 2012, 1.0)]
    assert rows(ops.aggregate_areas(df, lookup, "region", drop_self=True)) == []


def test_large_lookup_gives_the_same_areas(random_flows, areas, rows, plan):
    df = random_flows(7)
    region = areas[1]
    large = Lookup(region.lookup, "lad_code", max_bytes=0)
    by_shuffle = map_both_ends(df, large, region.target)
    assert "SortMergeJoin" in plan(by_shuffle)
    assert rows(by_shuffle) == rows(map_both_ends(df, region.lookup, region.target))
    assert "BroadcastHashJoin" in plan(map_both_ends(df, region.lookup, region.target))


def test_final_gross_flows_equal_the_separate_ones(random_flows, areas, rows):
    df = random_flows(8)
    country, region, london = (ops.gross_flows(ops.aggregate_areas(df, g.lookup, g.target)) for g in areas)
    parts = country.where("gss_code = 'E92000001'").unionByName(region).unionByName(london.where("gss_code != 'other'"))
    assert rows(ops.final_gross_flows(df, areas)) == rows(parts)
    od = ops.od_by_geography(df, areas)
    assert rows(ops.gross_by_geography(od, areas)) == rows(parts)
    for g in areas:
        assert rows(od.where(F.col("geography") == g.name).drop("geography")) == rows(
            ops.aggregate_areas(df, g.lookup, g.target)
        )


def test_net_flows_are_antisymmetric_and_equal_the_join(random_flows, rows):
    df = ops.sum_value(random_flows(9), "gss_in", "gss_out", "age", "year")
    net = ops.net_flows(df)
    found = {(r["gss_in"], r["gss_out"], r["age"], r["year"]): r["netflow"] for r in net.collect()}
    assert all(found[o, i, a, y] == -value for (i, o, a, y), value in found.items())
    keys = ["gss_in", "gss_out", "age", "year", "inflow", "outflow"]
    assert rows(net, *keys) == rows(ops.flows_outer_swapped(df), *keys)


def test_net_flows_add_up_repeated_keys(spark, rows):
    df = spark.createDataFrame([("a", "b", 1, 2012, 1.0), ("a", "b", 1, 2012, 2.0)], "gss_in string, gss_out string, age int, year int, value double")
    assert rows(ops.net_flows(df)) == [("a", "b", 1, 2012, 3.0, 0.0, 3.0), ("b", "a", 1, 2012, 0.0, 3.0, -3.0)]


def test_geographies_beyond_the_bound_give_the_same_pairs(random_flows, areas, rows, monkeypatch):
    df = random_flows(10)
    small = rows(ops.od_by_geography(df, areas))
    build = ops.stack_lookups

    def tiny(geographies):
        stacked = build(geographies)
        stacked.max_bytes = 0
        return stacked

    monkeypatch.setattr(ops, "stack_lookups", tiny)
    large = ops.od_by_geography(df, areas)
    assert rows(large) == small and small


def test_repeated_keys_multiply_in_every_geography(spark, rows):
    df = spark.createDataFrame([("a", "b", 2012, 1.0), ("c", "b", 2012, 2.0)], OD)
    first = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z"), ("c", "x"), ("c", "y")], "lad_code string, t string")
    second = spark.createDataFrame([("a", "k"), ("b", "k")], "lad_code string, t string")
    parts = [ops.Geography("one", first, "t"), ops.Geography("two", second, "t")]
    with pytest.warns(UserWarning, match="not unique"):
        od = ops.od_by_geography(df, parts)
        for g in parts:
            separate = ops.aggregate_areas(df, g.lookup, g.target)
            assert rows(od.where(F.col("geography") == g.name).drop("geography")) == rows(separate)


def test_repeated_keys_meet_their_reverse_once(spark, rows):
    data = [("a", "b", 1, 2012, 1.0), ("a", "b", 1, 2012, 2.0), ("b", "a", 1, 2012, 5.0), ("b", "a", 1, 2012, 1.0), ("a", "c", 1, 2012, None)]
    flows = spark.createDataFrame(data, "gss_in string, gss_out string, age int, year int, value double")
    found = rows(ops.flows_outer_swapped(flows), "gss_in", "gss_out", "inflow", "outflow")
    assert found == [("a", "b", 3.0, 6.0), ("a", "c", 0.0, 0.0), ("b", "a", 6.0, 3.0), ("c", "a", 0.0, 0.0)]

from __future__ import annotations

from functools import reduce

import pytest
from pyspark.sql import DataFrame

from odflux.operators import children as ops
from odflux.operators.flows import Geography, net_flows


def separate(df, region, london):
    pairs = ops.region_flows(df, region.lookup, region.target)
    return [
        pairs,
        ops.inner_outer_flows(df, london.lookup, london.target),
        ops.london_rollup(df),
        ops.total_inflow(pairs),
        ops.total_outflow(pairs),
    ]


@pytest.mark.parametrize("seed", range(2))
def test_one_scan_equals_the_separate_tables(random_flows, areas, rows, seed):
    df = random_flows(seed)
    _, region, london = areas
    parts = separate(df, region, london)
    assert all(part.count() for part in parts)
    assert rows(ops.all_od_flows(df, region, london)) == rows(reduce(DataFrame.unionByName, parts))


def test_grouping_sets_equal_the_union(random_flows, areas, rows):
    pairs, _, _, total_in, total_out = separate(random_flows(3), areas[1], areas[2])
    assert rows(ops.pair_and_totals(pairs)) == rows(pairs.unionByName(total_in).unionByName(total_out))


def test_totals_add_up(random_flows, areas):
    pairs = ops.region_flows(random_flows(4), areas[1].lookup, areas[1].target)
    whole = pairs.agg({"value": "sum"}).first()[0]
    assert ops.total_inflow(pairs).agg({"value": "sum"}).first()[0] == whole
    assert ops.total_outflow(pairs).agg({"value": "sum"}).first()[0] == whole


def test_only_children_count(spark, areas, rows):
    df = spark.createDataFrame(
        [("E06000001", "E07000002", 15, 2012, 1.0), ("E06000001", "E07000002", 16, 2012, 9.0), ("E06000001", "E07000002", None, 2012, 9.0)],
        "gss_in string, gss_out string, age int, year int, value double",
    )
    assert rows(ops.region_flows(df, areas[1].lookup, areas[1].target)) == [("E12000001", "E12000001", 15, 2012, 1.0)]


def test_london_keeps_local_origins(spark, rows):
    df = spark.createDataFrame(
        [("E09000001", "S12000004", 1, 2012, 1.0), ("E09000002", "S12000004", 1, 2012, 2.0), ("E06000001", "S12000004", 1, 2012, 4.0)],
        "gss_in string, gss_out string, age int, year int, value double",
    )
    assert rows(ops.london_rollup(df)) == [("E12000007", "S12000004", 1, 2012, 3.0)]


def test_flow_table_is_scanned_once(spark, areas, plan, tmp_path, random_flows):
    random_flows(0).write.parquet(str(tmp_path / "flows"))
    df = spark.read.parquet(str(tmp_path / "flows"))
    text = plan(ops.children_net(df, areas[1], areas[2]))
    initial = text.split("Initial Plan")[-1]
    assert initial.count("FileScan parquet") == 1
    assert "BroadcastHashJoin" in initial and "SortMergeJoin" not in initial and "Python" not in initial
    assert "LessThanOrEqual(age,15)" in initial


def test_wide_table(random_flows, areas, rows):
    od = ops.all_od_flows(random_flows(5), areas[1], areas[2])
    net = net_flows(od)
    wide = ops.children_net_wide(net, range(16))
    assert wide.columns == ["gss_code", "origin_destination_code", "direction", "year", *map(str, range(16))]
    ids = ["gss_code", "origin_destination_code", "direction", "year"]
    back = wide.unpivot(ids, [str(a) for a in range(16)], "age", "value").selectExpr(*ids, "int(age) age", "value")
    named = net.withColumnsRenamed({"gss_in": "gss_code", "gss_out": "origin_destination_code"})
    long = named.unpivot(["gss_code", "origin_destination_code", "age", "year"], ["inflow", "outflow", "netflow"], "direction", "value")
    assert rows(back.where("value != 0"), *ids, "age", "value") == rows(long.where("value != 0"), *ids, "age", "value")


def test_a_geography_cannot_be_named_like_the_london_branch(random_flows, areas):
    with pytest.raises(ValueError, match="london"):
        ops.all_od_flows(random_flows(0), Geography("london", areas[1].lookup, "region_code"), areas[2])

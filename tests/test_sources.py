from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from odflux.operators.flows import Geography, final_gross_flows, gross_flows
from odflux.plans.areas import write_area_flows
from odflux.plans.children import write_children_flows
from odflux.plans.series import build_series, write_series
from odflux.schemas import FLOWS_LONG, flows_wide
from odflux.sources import readers, sinks
from odflux.sources.releases import clean_sheets, combine_cleaned, files_read, header_of, read_lookup
from odflux.sources.workdir import fresh_path, work_root


@pytest.fixture
def root(tmp_path) -> str:
    return str(tmp_path)


def text_file(spark, path: str, *lines: str) -> None:
    with open(path, "w") as out:
        out.write("\n".join(lines) + "\n")


def test_csv_round_trip(spark, random_flows, rows, root):
    df = random_flows(1)
    sinks.write_csv(df, f"{root}/csv")
    assert rows(readers.read_csv(spark, f"{root}/csv", FLOWS_LONG)) == rows(df)
    assert readers.sample_csv(spark, f"{root}/csv", FLOWS_LONG, 7).count() == 7


def test_parquet_round_trip(spark, random_flows, rows, root):
    df = random_flows(1)
    sinks.write_parquet(df, f"{root}/p")
    assert rows(readers.read_parquet(spark, f"{root}/p")) == rows(df)


def test_second_write_replaces_only_its_years(spark, random_flows, rows, root):
    df = random_flows(2)
    kept = df.where("year IS NOT NULL")
    summary = write_series(df, root)
    assert (summary.rows, summary.partitions) == (kept.count(), 3)
    sinks.write_partitioned(df.where("year = 2011"), root)
    sinks.write_partitioned(df.where("year = 2012").withColumn("value", F.lit(1.0)), root)
    back = readers.read_partitioned(spark, root)
    assert dict(back.dtypes)["year"] == "int"
    expected = kept.withColumn("value", F.when(F.col("year") == 2012, 1.0).otherwise(F.col("value")))
    assert rows(back, *FLOWS_LONG.names) == rows(expected, *FLOWS_LONG.names)
    assert rows(sinks.write_summary(back)) == [(kept.count(), 3)]


def test_a_large_year_is_cut_into_files(spark, root):
    df = spark.range(0, 400_000, 1, 16).selectExpr(
        "uuid() AS gss_in", "uuid() AS gss_out", "IF(id % 10 = 0, 2011, 2012) AS year", "double(id) AS value"
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        sinks.write_partitioned(df, root)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    back = readers.read_partitioned(spark, root)
    assert back.count() == 400_000
    files = back.where("year = 2012").select(F.input_file_name().alias("f")).distinct().count()
    assert files > 4


def test_year_filter_reads_only_its_folder(spark, random_flows, root, plan):
    sinks.write_partitioned(random_flows(3), root)
    text = plan(readers.read_partitioned(spark, root).where("year = 2011").select("gss_in"))
    assert "PartitionFilters: [isnotnull(year" in text and "ReadSchema: struct<gss_in:string>" in text


def test_files_are_listed_by_suffix(spark, root):
    for name in ("a.xlsx", "b.xls", "c.csv"):
        text_file(spark, f"{root}/{name}", "x")
    names = [r["path"].rsplit("/", 1)[-1] for r in readers.list_files(spark, root, ".xlsx", ".xls").collect()]
    assert sorted(names) == ["a.xlsx", "b.xls"]
    assert readers.list_files(spark, root, ".parquet").count() == 0


def test_unreadable_files_fail_or_are_skipped(spark, random_flows, rows, root):
    df = random_flows(4)
    sinks.write_parquet(df, root)
    text_file(spark, f"{root}/broken.parquet", "this is not parquet")
    assert rows(readers.read_parquet(spark, root, FLOWS_LONG, skip_unreadable=True)) == rows(df)
    with pytest.raises(Exception, match="broken|Parquet|parquet"):
        readers.read_parquet(spark, root, FLOWS_LONG).collect()


def test_malformed_lines_fail_or_are_dropped(spark, rows, root):
    text_file(spark, f"{root}/a.csv", "outla,inla,sex,year,age_0", "a,b,F,2012,1.5", "a,b,F,soon,1.5", "a,b,M,2013,")
    schema = flows_wide(0)
    with pytest.raises(Exception, match="MALFORMED"):
        readers.read_csv(spark, root, schema).collect()
    lenient = readers.read_csv(spark, root, schema, mode="DROPMALFORMED")
    assert rows(lenient) == [("a", "b", "F", 2012, 1.5), ("a", "b", "M", 2013, None)]


def test_sheets_with_different_headers_combine(spark, rows, root):
    text_file(spark, f"{root}/2012.csv", "outla,inla,Year,Sex,Age_0,Age_1", "a,b,2012,F,1,2")
    text_file(spark, f"{root}/2013.csv", "outla,inla,Year,Sex,Age_0,Age_1", "a,c,2013,M,3,NaN")
    text_file(spark, f"{root}/2014.csv", 'outla,inla,sex,year,age_0,"note"', 'b,a,F,2014,5,"x, y"')
    text_file(spark, f"{root}/empty.csv")
    text_file(spark, f"{root}/ignored.txt", "a,b")
    df = combine_cleaned(spark, root)
    assert rows(df, "outla", "inla", "sex", "year", "age_0", "age_1", "note") == [
        ("a", "b", "F", 2012, 1.0, 2.0, None),
        ("a", "c", "M", 2013, 3.0, None, None),
        ("b", "a", "F", 2014, 5.0, None, "x, y"),
    ]
    assert header_of(spark, f"{root}/2014.csv") == ("outla", "inla", "sex", "year", "age_0", "note")


def test_no_sheets_and_colliding_headers(spark, root):
    assert combine_cleaned(spark, root) is None
    text_file(spark, f"{root}/a.csv", "Year,year", "1,2")
    with pytest.raises(ValueError, match="year"):
        combine_cleaned(spark, root)


def test_written_tables_go_to_the_shared_folder(spark):
    assert work_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x").startswith(work_root(spark)) and fresh_path(spark, "x") != fresh_path(spark, "x")


def test_area_suite_is_written(spark, random_flows, areas, rows, root):
    df = random_flows(5)
    write_area_flows(df, areas, root)
    read = lambda name: spark.read.parquet(f"{root}/{name}")
    assert rows(read("lad_gross_flows")) == rows(gross_flows(df))
    assert rows(read("final_gross_flows")) == rows(final_gross_flows(df, areas))
    assert read("region_od_series").columns == ["gss_in", "gss_out", "year", "value"]


def test_children_suite_is_written(spark, random_flows, areas, root):
    region, london = areas[1], Geography("inner_outer", areas[2].lookup, "io_london")
    write_children_flows(random_flows(6), region, london, root, ages=[0, 5])
    wide = spark.read.option("header", True).csv(f"{root}/net_flows_wide")
    assert wide.columns == ["gss_code", "origin_destination_code", "direction", "year", "0", "5"]
    assert wide.count() == 3 * spark.read.parquet(f"{root}/net_flows").select("gss_in", "gss_out", "year").distinct().count()


def test_sheets_are_cleaned_one_by_one(spark, rows, root):
    raw, clean = f"{root}/raw", f"{root}/clean"
    Path(raw).mkdir()
    text_file(spark, f"{raw}/detail2012on2021and2023las.csv", "outla,inla,Year,Sex,Age_0", "a,b,2012,F,1", "a,b,2012,,2", ",,,,")
    text_file(spark, f"{raw}/detail2013on2021and2023las.csv", "outla,inla,Year,Sex,Age_0,Age_1", "a,c,2013,M,3,4", "a,c,2013,M,3,")
    for _ in range(2):
        assert clean_sheets(spark, raw, clean).sheets == 2
    assert sorted(p.name for p in Path(clean).glob("source=*")) == [
        "source=detail2012on2023las.csv", "source=detail2013on2023las.csv",
    ]
    assert rows(combine_cleaned(spark, clean), "outla", "inla", "year", "sex", "age_0", "age_1") == [
        ("a", "b", 2012, "F", 1.0, None), ("a", "c", 2013, "M", 3.0, 4.0),
    ]
    assert rows(files_read(combine_cleaned(spark, clean))) == [(2,)]


def test_sheets_of_one_name_stay_apart(spark, rows, root):
    raw, clean = f"{root}/raw dir", f"{root}/clean"
    for year in ("2012", "2013"):
        Path(f"{raw}/{year}").mkdir(parents=True)
    text_file(spark, f"{raw}/2012/flows.csv", "outla,inla,Year,Sex,Age_0", "a,b,2012,F,1")
    text_file(spark, f"{raw}/2013/flows.csv", "outla,inla,Year,Sex,Age_0,Age_1", "a,c,2013,M,3,4")
    assert clean_sheets(spark, raw, clean).sheets == 2
    assert rows(combine_cleaned(spark, clean), "outla", "inla", "year", "age_1") == [("a", "b", 2012, None), ("a", "c", 2013, 4.0)]
    text_file(spark, f"{raw}/2012/flows.csv", "outla,inla,Year,Sex,Age_0", "a,b,2012,F,")
    assert clean_sheets(spark, raw, clean).sheets == 2
    assert rows(combine_cleaned(spark, clean), "inla", "year") == [("c", 2013)]
    text_file(spark, f"{raw}/a2023.csv", "outla,inla", "a,b")
    text_file(spark, f"{raw}/a2021and2023.csv", "outla,inla", "a,b")
    with pytest.raises(ValueError, match="a2023.csv"):
        clean_sheets(spark, raw, clean)


def test_unreadable_sheets_are_left_out_whole(spark, rows, root):
    raw, clean = f"{root}/raw", f"{root}/clean"
    Path(raw).mkdir()
    text_file(spark, f"{raw}/good.csv", "outla,inla,Year,Sex,Age_0", "a,b,2012,F,1")
    text_file(spark, f"{raw}/torn.csv", "outla,inla,Year,Sex,Age_0", "a,c,2012,F,1", "a,d,2012")
    text_file(spark, f"{raw}/noise.csv", "<html>", "a,b")
    with pytest.raises(Exception, match="(?i)malformed"):
        clean_sheets(spark, raw, clean)
    done = clean_sheets(spark, raw, clean, skip_unreadable=True, needs=("outla", "inla"))
    assert done.sheets == 1
    assert sorted(r["path"].rsplit("/", 1)[-1] for r in done.skipped.collect()) == ["noise.csv", "torn.csv"]
    assert rows(combine_cleaned(spark, clean), "outla", "inla") == [("a", "b")]
    assert rows(combine_cleaned(spark, raw, skip_unreadable=True, needs=("outla",)), "outla", "inla") == [("a", "b")]


def test_jobs_do_not_grow_with_the_number_of_sheets(spark, root):
    def jobs(name: str, n: int) -> int:
        Path(f"{root}/{name}").mkdir()
        for k in range(n):
            text_file(spark, f"{root}/{name}/{k}.csv", "outla,inla,year,sex,age_0", f"a{k},b,2012,F,1")
        spark.sparkContext.setJobGroup(name, name)
        assert combine_cleaned(spark, f"{root}/{name}").count() == n
        spark.sparkContext.setJobGroup("rest", "rest")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    assert jobs("many", 60) <= jobs("few", 3) + 2


def test_lookup_codes_stay_text(spark, rows, root):
    text_file(spark, f"{root}/lookup.csv", "name,lad_code,region_code", "x,0012,E1", "y,E06,E2")
    assert rows(read_lookup(spark, f"{root}/lookup.csv", "lad_code", "region_code")) == [("0012", "E1"), ("E06", "E2")]


def test_series_from_sheets_to_dataset(spark, changes, rows, root):
    Path(f"{root}/sheets").mkdir()
    text_file(spark, f"{root}/sheets/2012.csv", "outla,inla,Year,Sex,Age_0,Age_1", "a,b,2012,F,1,0", "a,a,2012,F,7,7")
    old = spark.createDataFrame([("E07000002", "E06000001", "male", 2011, 1, 2.0)], FLOWS_LONG)
    summary = build_series(spark, f"{root}/sheets", old, changes, f"{root}/series")
    assert (summary.rows, summary.partitions) == (2, 2)
    assert rows(readers.read_partitioned(spark, f"{root}/series"), *FLOWS_LONG.names) == [
        ("E06000301", "E06000201", "male", 2011, 1, 2.0), ("a", "b", "female", 2012, 0, 1.0),
    ]
    Path(f"{root}/empty").mkdir()
    with pytest.raises(FileNotFoundError):
        build_series(spark, f"{root}/empty", old, changes, f"{root}/series")


def test_a_write_without_rebalance(spark, random_flows, rows, root):
    df = random_flows(7).where("year IS NOT NULL")
    sinks.write_partitioned(df, root, rebalance=False)
    assert rows(readers.read_partitioned(spark, root), *FLOWS_LONG.names) == rows(df, *FLOWS_LONG.names)

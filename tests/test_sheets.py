"""Sheets of any header: records over lines, one scan, a staged write and a report."""

from __future__ import annotations

import csv
import io
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from odflux.schemas import FLOWS_LONG
from odflux.sources import readers, releases, sinks
from odflux.sources.releases import clean_sheets, combine_cleaned, stitch
from odflux.sources.workdir import keep, replace_folder


@pytest.fixture
def root(tmp_path) -> str:
    return str(tmp_path)


def sheet(path: str, *lines: str, end: str = "\n") -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_bytes((end.join(lines) + end).encode())


def test_a_data_line_like_the_header_stays(spark, rows, root):
    sheet(f"{root}/a.csv", "", "outla,inla", "a,b", "outla,inla", "c,d")
    assert rows(combine_cleaned(spark, root), "outla", "inla") == [("a", "b"), ("c", "d"), ("outla", "inla")]
    assert clean_sheets(spark, root, f"{root}-clean").report.first()["n_written"] == 3


def test_quoted_fields_over_lines_round_trip(spark, rows, root):
    sheet(f"{root}/raw/a.csv", 'outla,"no\nte",year', 'a,"x, y\n\nz ""q"" \n",2012', "b,plain,2013", 'c,"",2014', end="\r\n")
    sheet(f"{root}/raw/b.csv", "outla,inla,year", "d,e,2015")
    wanted = [("a", None, 'x, y\n\nz "q" \n', 2012), ("b", None, "plain", 2013), ("c", None, None, 2014), ("d", "e", None, 2015)]
    found = combine_cleaned(spark, f"{root}/raw")
    assert found.columns == ["outla", "no\nte", "year", "inla"]
    assert rows(found.withColumnRenamed("no\nte", "note"), "outla", "inla", "note", "year") == wanted
    assert clean_sheets(spark, f"{root}/raw", f"{root}/clean").sheets == 2
    back = combine_cleaned(spark, f"{root}/clean").withColumnRenamed("no\nte", "note")
    assert rows(back, "outla", "inla", "note", "year") == [wanted[0], wanted[1], wanted[3]]


@pytest.mark.parametrize("split_bytes", [40, 300, 1 << 20])
def test_records_equal_a_csv_reader_whatever_the_splits(spark, root, split_bytes):
    rng = random.Random(split_bytes)
    texts = {}
    for name in ("a", "b", "c"):
        lines = [["k", "v", "w"]]
        for k in range(60):
            cells = ["".join(rng.choice(['"', "\n", ",", "x", "long word ", "é"]) for _ in range(rng.randint(1, 12))) for _ in range(2)]
            lines.append([f"{name}{k}", *cells])
        out = io.StringIO()
        csv.writer(out, lineterminator="\n").writerows(lines)
        texts[name] = lines
        Path(f"{root}/{name}.csv").write_text(out.getvalue())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        found = combine_cleaned(spark, root).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    wanted = sorted(tuple(line) for lines in texts.values() for line in lines[1:])
    assert sorted(map(tuple, found)) == wanted


def test_an_open_quote_and_a_very_long_record_are_malformed(spark, rows, root, monkeypatch):
    monkeypatch.setattr(releases, "MAX_RECORD_LINES", 5)
    sheet(f"{root}/raw/open.csv", "outla,inla", 'a,"b', "c,d")
    sheet(f"{root}/raw/long.csv", "outla,inla", 'a,"' + "\n" * 9 + '"', "c,d")
    sheet(f"{root}/raw/good.csv", "outla,inla", 'a,"b\nc"')
    done = clean_sheets(spark, f"{root}/raw", f"{root}/clean", skip_unreadable=True)
    assert {r["path"].rsplit("/", 1)[1]: r["reason"] for r in done.report.collect()} == {
        "open.csv": "malformed record", "long.csv": "malformed record", "good.csv": None,
    }
    assert rows(combine_cleaned(spark, f"{root}/clean"), "outla", "inla") == [("a", "b\nc")]
    with pytest.raises(Exception, match="malformed record in .*(open|long)"):
        combine_cleaned(spark, f"{root}/raw").collect()
    kept = combine_cleaned(spark, f"{root}/raw", mode="DROPMALFORMED")
    assert rows(kept, "outla", "inla") == [("a", "b\nc"), ("c", "d")]


def scans(df) -> int:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("FileScan text")


def test_scans_do_not_grow_with_headers(spark, root):
    for n in (1, 5):
        for k in range(n):
            names = ["outla", "Inla" if k % 2 else "inla", "Year", *[f"Age_{a}" for a in range(k + 1)]]
            sheet(f"{root}/{n}/{k}.csv", ",".join(names), ",".join(["a", "b", "2012", *["1"] * (k + 1)]))
    assert scans(combine_cleaned(spark, f"{root}/1")) == scans(combine_cleaned(spark, f"{root}/5")) == 1
    found = combine_cleaned(spark, f"{root}/5")
    assert found.columns == ["outla", "inla", "year", *[f"age_{a}" for a in range(5)]] and found.count() == 5


def test_a_failed_run_leaves_the_old_output_whole(spark, rows, root, monkeypatch):
    raw, clean = f"{root}/raw", f"{root}/clean"
    sheet(f"{raw}/a.csv", "outla,inla", "a,b")
    assert clean_sheets(spark, raw, clean).status == "done"
    sheet(f"{raw}/a.csv", "outla,inla", "new,row")
    sheet(f"{raw}/b.csv", "outla,inla,year", "x,y,2012")
    whole, written = releases._write_header, []

    def fails_later(*arguments):
        if written:
            raise RuntimeError("lost")
        written.append(whole(*arguments))

    monkeypatch.setattr(releases, "_write_header", fails_later)
    with pytest.raises(RuntimeError, match="lost"):
        clean_sheets(spark, raw, clean)
    assert rows(combine_cleaned(spark, clean), "outla", "inla") == [("a", "b")]
    monkeypatch.setattr(releases, "_write_header", whole)
    clean_sheets(spark, raw, clean)
    assert rows(combine_cleaned(spark, clean), "outla", "inla", "year") == [("new", "row", None), ("x", "y", 2012)]
    assert [p.name for p in Path(root).iterdir() if "replaced" in p.name] == []


def test_a_folder_is_put_back_when_it_cannot_be_replaced(spark, root):
    sheet(f"{root}/out/a.csv", "x")
    with pytest.raises(OSError, match="cannot move"):
        replace_folder(spark, f"{root}/nowhere", f"{root}/out")
    assert Path(f"{root}/out/a.csv").exists()


def test_the_report_has_a_row_for_each_sheet(spark, root):
    raw = f"{root}/raw"
    sheet(f"{raw}/1/a.csv", "outla,inla,year", "a,b,2012", "a,,2012", ",,", "c,d,2013")
    sheet(f"{raw}/2/b.csv", "outla,inla", "a,b", "a,b,c", "c")
    sheet(f"{raw}/2/c.csv", "other", "1", "2")
    sheet(f"{raw}/2/only_header.csv", "outla,inla")
    sheet(f"{raw}/empty.csv", "")
    done = clean_sheets(spark, raw, f"{root}/clean", skip_unreadable=True, needs=("outla",))
    columns = ["n_read", "n_gaps", "n_malformed", "n_written", "status", "reason"]
    assert {r["source"]: tuple(r[c] for c in columns) for r in done.report.collect()} == {
        "1/a.csv": (4, 2, 0, 2, "written", None),
        "2/b.csv": (3, 0, 2, 0, "skipped", "malformed record"),
        "2/c.csv": (2, 0, 0, 0, "skipped", "lacks columns"),
        "2/only_header.csv": (0, 0, 0, 0, "written", None),
    }
    assert (done.sheets, done.status, done.skipped.count()) == (2, "done", 2)
    dropped = clean_sheets(spark, f"{raw}/2", f"{root}/clean", mode="DROPMALFORMED").report
    assert {r["source"]: (r["n_malformed"], r["n_written"]) for r in dropped.collect()} == {"b.csv": (2, 1), "c.csv": (0, 2), "only_header.csv": (0, 0)}


def test_no_sheets_is_a_status(spark, root):
    Path(f"{root}/raw").mkdir()
    sheet(f"{root}/out/source=old.csv/part.csv", "a", "b")
    done = clean_sheets(spark, f"{root}/raw", f"{root}/out")
    assert (done.status, done.sheets, done.report.count()) == ("no files", 0, 0)
    assert Path(f"{root}/out/source=old.csv/part.csv").exists()


def test_stitching_keeps_every_line(spark, root):
    sheet(f"{root}/a.csv", 'a,"b', 'c"', "", 'd,e,"', '"')
    lines = releases._lines(spark, root)
    found = stitch(lines).orderBy("place").collect()
    assert [r["record"] for r in found] == ['a,"b\nc"', "", 'd,e,"\n"']
    assert lines.where(F.length("record") == 0).count() == 1


def test_torn_and_foreign_parquet_files_are_reported_and_left_out(spark, random_flows, rows, root):
    df = random_flows(8)
    sinks.write_parquet(df.coalesce(1), f"{root}/in/a b")
    sinks.write_parquet(random_flows(9).coalesce(1), f"{root}/in/c")
    torn = next(Path(f"{root}/in/c").glob("part-*"))
    raw = bytearray(torn.read_bytes())
    raw[60:400] = bytes(340)  # pages are lost, the footer stands
    torn.write_bytes(bytes(raw))
    next(Path(f"{root}/in/c").glob(".part-*.crc")).unlink()
    Path(f"{root}/in/noise.parquet").write_text("not parquet")
    report = keep(readers.parquet_report(spark, f"{root}/in", FLOWS_LONG, ".parquet"))
    found = {r["path"].rsplit("/", 2)[1]: r["status"] for r in report.where("path NOT LIKE '%noise%'").collect()}
    assert found["a b"] == "read" and found["c"] in ("torn", "unreadable")
    assert [r["status"] for r in report.where("path LIKE '%noise%'").collect()] == ["unreadable"]
    assert rows(readers.read_whole_files(spark, f"{root}/in", FLOWS_LONG, report)) == rows(df)

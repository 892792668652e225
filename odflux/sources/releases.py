"""Cleaning and combining yearly sheets, whatever their headers.

Sheets are CSV files. One job finds the header of every sheet, and the files in
which a quoted field goes on over several lines; only the distinct headers come
to the driver. The records of all sheets are then scanned once: each is taken
apart into values by position, and the positions of the columns in its sheet's
header, attached as a small lookup, tell which value is which. So neither scans
nor plans grow with the number of headers or files.

Quote marks open and close fields, and are doubled within them.
"""

from __future__ import annotations

import csv
import io
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odflux.functions.nulls import nan_to_null
from odflux.functions.text import basename, output_name
from odflux.operators.lookups import Lookup
from odflux.schemas import sheet_schema
from odflux.sources.readers import RFC_QUOTES, read_csv
from odflux.sources.workdir import fresh_folder, fresh_path, keep, relative_path, replace_folder

Header = tuple[str, ...]

MODES = ("FAILFAST", "DROPMALFORMED")

# Lines of a record within one split of its file; a record of more is malformed.
MAX_RECORD_LINES = 1000
QUOTED = '"[^"]*"'


def parse_header(record: str) -> Header:
    return tuple(next(csv.reader(io.StringIO(record))))


def header_of(spark: SparkSession, path: str) -> Header:
    """Column names on the first line of a file; only its first block is touched."""
    line = spark.read.text(path).first()
    return parse_header(line["value"]) if line else ()


def _lines(spark: SparkSession, root: str) -> DataFrame:
    """path, place (begin of the split, order in it) and value of every line of all CSV files under ``root``."""
    text = spark.read.format("text").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(root)
    place = F.struct(F.col("_metadata.file_block_start").alias("begin"), F.monotonically_increasing_id().alias("at"))
    return text.select(F.col("_metadata.file_path").alias("path"), place.alias("place"), F.col("value").alias("record"))


def _is_blank(record: Column) -> Column:
    return F.trim(record) == ""


def _odd_quotes(record: Column) -> Column:
    return (F.length(record) - F.length(F.replace(record, F.lit('"'), F.lit("")))) % 2


def stitch(lines: DataFrame) -> DataFrame:
    """path, place, record and whether it is too long, of files whose quoted fields go on over lines.

    A line begins a record when an even number of quote marks comes before it in
    its file. Marks are summed by split first, so no task orders more than the
    lines of one split; a record over the end of a split is joined to its begin.
    """
    begin = F.col("place.begin")
    in_split = Window.partitionBy("path", "begin").orderBy("place")
    earlier = Window.partitionBy("path").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumns({"begin": begin, "odd": _odd_quotes(F.col("record"))})
    splits = lines.groupBy("path", "begin").agg(F.sum("odd").alias("odd"))
    splits = splits.select("path", "begin", F.coalesce(F.sum("odd").over(earlier), F.lit(0)).alias("before"))
    so_far = F.coalesce(F.sum("odd").over(in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    marked = lines.join(splits, ["path", "begin"]).withColumns({"starts": (F.col("before") + so_far) % 2 == 0, "number": F.row_number().over(in_split)})
    upto = in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = marked.withColumn("own", F.last(F.when(F.col("starts"), F.struct("place", "number")), ignorenulls=True).over(upto))
    last = marked.groupBy("path", "begin").agg(F.max("own.place").alias("last"))
    carried = last.select("path", "begin", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    placed = marked.join(carried, ["path", "begin"])
    fits = F.col("number") - F.coalesce("own.number", F.lit(0)) < MAX_RECORD_LINES
    part = F.when(fits, F.struct("place", "record"))
    records = placed.groupBy("path", F.coalesce("own.place", "carried", "place").alias("start")).agg(
        F.array_sort(F.collect_list(part)).alias("parts"), F.bool_or(~fits).alias("too_long")
    )
    return records.select("path", F.col("start").alias("place"), F.array_join("parts.record", "\n").alias("record"), "too_long")


@dataclass
class Sheets:
    """Sheets under a folder: ``files`` (path, place and text of the header, whether records go on over lines)."""

    spark: SparkSession
    root: str
    files: DataFrame
    stitched: DataFrame | None
    headers: dict[str, Header]

    @classmethod
    def under(cls, spark: SparkSession, root: str) -> Sheets:
        """Files without a line are left out."""
        lines = _lines(spark, root).where(~_is_blank(F.col("record")))
        first = lambda df: df.groupBy("path").agg(F.min_by("record", "place").alias("header"), F.min("place").alias("place"))
        torn = F.bool_or(_odd_quotes(F.col("record")) == 1)
        files = lines.groupBy("path").agg(F.min_by("record", "place").alias("header"), F.min("place").alias("place"), torn.alias("torn"))
        files, stitched = keep(files), None
        if files.where("torn").limit(1).count():
            over = Lookup(files.where("torn"), "path").restrict(_lines(spark, root), "path")
            path = fresh_path(spark, "records")
            stitch(over).write.parquet(path)
            stitched = spark.read.parquet(path)
            again = first(stitched.where(~_is_blank(F.col("record")))).withColumn("torn", F.lit(True))
            files = keep(files.where("NOT torn").unionByName(again))
        headers = {row["header"]: parse_header(row["header"]) for row in files.select("header").distinct().orderBy("header").collect()}
        return cls(spark, root, files, stitched, headers)

    @property
    def width(self) -> int:
        return max(map(len, self.headers.values()), default=0)

    def numbered(self) -> DataFrame:
        """``files`` with the number and the width of their header."""
        rows = [(text, n, len(names)) for n, (text, names) in enumerate(self.headers.items())]
        return self.files.join(F.broadcast(self.spark.createDataFrame(rows, "header string, h int, width int")), "header")

    def rows(self) -> DataFrame:
        """path, number of the header, values by position and whether the record does not fit, of every record below a header."""
        about = Lookup(keep(self.numbered().select("path", "place", "h", "width", "torn")), "path")
        names = {"place": "first", "h": "h", "width": "width", "torn": "torn"}
        records = about.attach(_lines(self.spark, self.root), "path", names).where("NOT torn").withColumn("too_long", F.lit(False))
        if self.stitched is not None:
            records = records.unionByName(about.attach(self.stitched, "path", names))
        body = (F.col("place") != F.col("first")) & ~_is_blank(F.col("record"))
        schema = ", ".join(f"c{k} string" for k in range(self.width))
        # Parsed only below the header, so a filter on the result never parses before the join.
        parsed = records.where(body).withColumn("r", F.when(body, F.from_csv("record", schema, {"mode": "PERMISSIVE", **RFC_QUOTES})))
        values = F.array(*(F.nullif(F.col("r")[f"c{k}"], F.lit("")) for k in range(self.width)))
        bare = F.regexp_replace("record", QUOTED, "")
        misfit = F.col("too_long") | bare.contains('"') | (F.regexp_count(bare, F.lit(",")) + 1 != F.col("width"))
        return parsed.select("path", "h", "width", values.alias("v"), misfit.alias("bad"))


def _checked(mode: str, skip_unreadable: bool) -> bool:
    """Whether a record that does not fit is an error."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    return mode == "FAILFAST" and not skip_unreadable


def _malformed() -> Column:
    return F.raise_error(F.concat(F.lit("malformed record in "), "path"))


def _staged(rows: DataFrame, strict: bool, gap: Column) -> DataFrame:
    """Records once more from the shared folder, by header, with their state; the only scan of the sheets."""
    state = F.when(F.col("bad"), _malformed() if strict else F.lit("malformed")).when(gap, "gap").otherwise("kept")
    path = fresh_path(rows.sparkSession, "sheets")
    rows.select("path", "h", "v", state.alias("state")).write.partitionBy("h").parquet(path)
    schema = T.StructType([*rows.select("path", "v").schema.fields, T.StructField("state", T.StringType()), T.StructField("h", T.IntegerType())])
    return rows.sparkSession.read.schema(schema).parquet(path)


def _run_report(sheets: Sheets, staged: DataFrame, needs: Header, skip_unreadable: bool) -> DataFrame:
    """One row for each sheet: records read, left out and written, whether it was written, and why not."""
    n = lambda state: F.count_if(F.col("state") == state)
    counts = staged.groupBy("path").agg(F.count(F.lit(1)).alias("n_read"), n("gap").alias("n_gaps"), n("malformed").alias("n_malformed"))
    wanted = {name.lower() for name in needs}
    lacking = [k for k, names in enumerate(sheets.headers.values()) if not wanted <= {name.lower() for name in names}]
    files = sheets.numbered().select("path", "h").join(counts, "path", "left").fillna(0)
    reason = F.lit(None).cast("string")
    if skip_unreadable:
        reason = F.when(F.col("h").isin(lacking), "lacks columns").when(F.col("n_malformed") > 0, "malformed record")
    report = files.withColumn("reason", reason)
    written = F.when(F.col("reason").isNull(), F.col("n_read") - F.col("n_gaps") - F.col("n_malformed")).otherwise(0)
    status = F.when(F.col("reason").isNull(), "written").otherwise("skipped")
    return keep(report.select("path", "h", "n_read", "n_gaps", "n_malformed", written.alias("n_written"), status.alias("status"), "reason"))


def _cleaned_name(spark: SparkSession, root: str, prefix: str) -> Column:
    """Output name of a sheet: its relative folder, and its file name rewritten."""
    relative = F.url_decode(F.replace(relative_path(spark, root), F.lit("+"), F.lit("%2B")))
    name = basename(relative)
    folder = F.substr(relative, F.lit(1), F.length(relative) - F.length(name))
    return F.concat(folder, output_name(name, prefix))


@dataclass
class Cleaned:
    """How many sheets were processed, the paths of those left out, and a row on each sheet."""

    sheets: int
    skipped: DataFrame
    report: DataFrame

    @property
    def status(self) -> str:
        return "done" if self.sheets else "no files"


def _write_header(rows: DataFrame, names: Header, folder: str) -> None:
    """Append the sheets of one header."""
    columns = [F.get("v", F.lit(k)).alias(name) for k, name in enumerate(names)]
    rows.select("source", *columns).write.mode("append").options(header=True, **RFC_QUOTES).partitionBy("source").csv(folder)


def clean_sheets(
    spark: SparkSession, root: str, out: str, prefix: str = "", skip_unreadable: bool = False, mode: str = "FAILFAST", needs: Header = ()
) -> Cleaned:
    """Write every sheet without its records that lack a value.

    A sheet becomes the folder ``source=<relative path, its name cleaned>`` of
    CSV files. All are written beside ``out``, which is replaced when the last one
    is complete: it then holds the sheets of this run and no others, and a run
    that fails leaves it as it was. Two sheets with one output name are an error.
    With ``skip_unreadable``, sheets without the columns in ``needs`` or with a
    record that does not fit its header are left out whole.
    """
    strict = _checked(mode, skip_unreadable)
    sheets = Sheets.under(spark, root)
    named = sheets.files.select("path", _cleaned_name(spark, root, prefix).alias("source"))
    clash = named.groupBy("source").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("source").first()
    if clash:
        raise ValueError(f"several sheets would be written as {clash['source']}")
    if not sheets.headers:
        report = _empty_report(spark)
        return Cleaned(0, report.select("path"), report)
    gap = F.exists(F.slice("v", 1, F.col("width")), lambda value: value.isNull())
    staged = _staged(sheets.rows(), strict, gap)
    report = keep(_run_report(sheets, staged, needs, skip_unreadable).join(named, "path"))
    written = Lookup(report.where("status = 'written'"), "path")
    folder = fresh_folder(spark, out)
    present = {row["h"] for row in report.where("status = 'written'").select("h").distinct().collect()}
    for h, names in enumerate(sheets.headers.values()):
        if h in present:
            kept = staged.where((F.col("h") == h) & (F.col("state") == "kept"))
            _write_header(written.attach(kept, "path", {"source": "source"}), names, folder)
    replace_folder(spark, folder, out)
    skipped = report.where("status = 'skipped'").select("path")
    return Cleaned(report.where("status = 'written'").count(), skipped, report.drop("h"))


def _empty_report(spark: SparkSession) -> DataFrame:
    counts = ", ".join(f"{c} long" for c in ("n_read", "n_gaps", "n_malformed", "n_written"))
    return spark.createDataFrame([], f"path string, {counts}, status string, reason string, source string")


def combined_schema(headers: list[Header]) -> T.StructType:
    """Columns of all headers in lower case, in the order they are first seen."""
    names: dict[str, None] = {}
    for header in headers:
        lowered = [name.lower() for name in header]
        clashes = [n for n, k in Counter(lowered).items() if k > 1]
        if clashes:
            raise ValueError(f"columns of sheets with header {header} differ only by case: {clashes}")
        names |= dict.fromkeys(lowered)
    return sheet_schema(list(names))


def combine_cleaned(
    spark: SparkSession, root: str, skip_unreadable: bool = False, mode: str = "FAILFAST", needs: Header = ()
) -> DataFrame | None:
    """All sheets under ``root`` as one table with lower-case headers.

    Columns a sheet lacks are missing in its rows. None when there is no sheet.
    ``skip_unreadable`` as in ``clean_sheets``; it writes the records to the shared
    folder once, to know which sheets to leave out.
    """
    strict = _checked(mode, skip_unreadable)
    sheets = Sheets.under(spark, root)
    wanted = {name.lower() for name in needs} if skip_unreadable else set()
    chosen = {h: names for h, names in enumerate(sheets.headers.values()) if wanted <= {n.lower() for n in names}}
    if not chosen:
        return None
    schema = combined_schema(list(chosen.values()))
    # For each header, where the combined columns stand in it; -1 where it lacks one.
    order = {h: [n.lower() for n in names] for h, names in chosen.items()}
    places = [(h, [order[h].index(c) if c in order[h] else -1 for c in schema.names]) for h in chosen]
    positions = F.broadcast(spark.createDataFrame(places, "h int, position array<int>"))
    rows = sheets.rows().join(positions, "h")
    picked = [F.get("v", F.get("position", F.lit(k))) for k in range(len(schema))]
    typed = [p if f.dataType == T.StringType() else p.try_cast(f.dataType) for p, f in zip(picked, schema)]
    fits = [p.isNull() | t.isNotNull() for p, t, f in zip(picked, typed, schema) if f.dataType != T.StringType()]
    bad = F.col("bad") | ~F.forall(F.array(*fits), lambda fit: fit) if fits else F.col("bad")
    if skip_unreadable:
        staged = _staged(rows.withColumn("bad", bad), False, F.lit(False))
        malformed = Lookup(keep(staged.where("state = 'malformed'").select("path").distinct().withColumn("out", F.lit(True))), "path")
        left = malformed.attach(staged, "path", {"out": "out"}, "left").where("out IS NULL")
        rows = left.join(positions, "h")
    elif strict:
        # Not droppable by the optimiser: a record that does not fit gives an error wherever its columns are used.
        typed = [F.when(bad, _malformed().cast(f.dataType)).otherwise(t) for t, f in zip(typed, schema)]
    else:
        rows = rows.where(~bad)
    return nan_to_null(rows.select(*(t.alias(f.name) for t, f in zip(typed, schema))))


def files_read(df: DataFrame) -> DataFrame:
    """Number of files a scan took its rows from."""
    return df.select(F.input_file_name().alias("f")).agg(F.count_distinct("f").alias("n_files"))


def text_schema(header: Header) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in header])


def read_lookup(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Columns of a CSV lookup as text, so no code is taken for a number."""
    return read_csv(spark, path, text_schema(header_of(spark, path))).select(*columns)

"""Scans. Schemas are given, so no pass over the data infers them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from odflux.functions.nulls import nan_to_null
from odflux.operators.lookups import Lookup

SHEET_SUFFIXES = (".xlsx", ".xls")
# A quote mark within a quoted field is doubled, and blanks around a value are part of it.
RFC_QUOTES = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _tolerance(reader: DataFrameReader, skip_unreadable: bool) -> DataFrameReader:
    """Leave out files that cannot be read, or fail on the first one."""
    return reader.option("ignoreCorruptFiles", skip_unreadable)


def read_csv(
    spark: SparkSession, path: str | list[str], schema: StructType, skip_unreadable: bool = False, mode: str = "FAILFAST"
) -> DataFrame:
    """CSV with a header line. ``mode`` DROPMALFORMED leaves out lines that do not fit the schema."""
    reader = _tolerance(spark.read.schema(schema), skip_unreadable)
    return nan_to_null(reader.options(header=True, mode=mode, **RFC_QUOTES).csv(path))


def sample_csv(spark: SparkSession, path: str, schema: StructType, n: int, order: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows; of a stated order when one is given."""
    df = read_csv(spark, path, schema)
    return (df.orderBy(*order) if order else df).limit(n)


def read_parquet(
    spark: SparkSession, path: str, schema: StructType | str | None = None, skip_unreadable: bool = False
) -> DataFrame:
    reader = _tolerance(spark.read, skip_unreadable)
    return (reader.schema(schema) if schema else reader).parquet(path)


def read_partitioned(spark: SparkSession, root: str) -> DataFrame:
    """A dataset of ``year=`` folders; a filter on year reads only its folders."""
    return spark.read.parquet(root)


def _glob(suffixes: tuple[str, ...]) -> str:
    return "*{" + ",".join(suffixes) + "}" if suffixes else "*"


def list_files(spark: SparkSession, root: str, *suffixes: str) -> DataFrame:
    """Files under ``root`` with one of the suffixes; no file is opened."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=_glob(suffixes))
    return files.load(root).select("path", F.col("length").alias("n_bytes"))


def read_files(spark: SparkSession, root: str, schema: StructType, *suffixes: str, mode: str = "FAILFAST") -> DataFrame:
    """CSV files with one of the suffixes, wherever below ``root``; none is named on the driver."""
    reader = spark.read.schema(schema).options(recursiveFileLookup=True, pathGlobFilter=_glob(suffixes))
    return nan_to_null(reader.options(header=True, mode=mode, **RFC_QUOTES).csv(root))


def _rows_by_file(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """Rows of each file, of which ``columns`` are read whole: the count is made to need them."""
    touched = F.sum(F.xxhash64(*columns).bitwiseAND(F.lit(0)) + 1) if columns else F.count(F.lit(1))
    return df.groupBy(F.col("_metadata.file_path").alias("path")).agg(touched.alias(name))


def parquet_report(spark: SparkSession, root: str, schema: StructType, *suffixes: str) -> DataFrame:
    """path, n_bytes, n_rows its footer tells, n_read rows that could be read, and status of every file under ``root``.

    ``read``: whole. ``torn``: it breaks off in the middle. ``unreadable``: no row could
    be read. Files without a byte are not listed. One scan reads all columns, one
    only footers.
    """
    files = list_files(spark, root, *suffixes)
    reader = spark.read.schema(schema).options(recursiveFileLookup=True, pathGlobFilter=_glob(suffixes), ignoreCorruptFiles=True)
    told = _rows_by_file(reader.parquet(root), "n_rows", [])
    read = _rows_by_file(reader.parquet(root), "n_read", schema.names)
    report = files.withColumn("path", _plain("path")).join(told.withColumn("path", _plain("path")), "path", "left")
    report = report.join(read.withColumn("path", _plain("path")), "path", "left").fillna(0, ["n_rows", "n_read"])
    whole = F.when(F.col("n_read") < F.col("n_rows"), F.when(F.col("n_read") > 0, "torn").otherwise("unreadable")).otherwise("read")
    return report.withColumn("status", F.when(F.col("n_rows") == 0, "unreadable").otherwise(whole))


def _plain(path: str) -> Column:
    """A file's path without its scheme, decoded: listings and scans spell them differently."""
    bare = F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:/*", "/")
    return F.try_url_decode(F.replace(bare, F.lit("+"), F.lit("%2B")))


def read_whole_files(spark: SparkSession, root: str, schema: StructType, report: DataFrame) -> DataFrame:
    """Rows of the files that ``report`` (of ``parquet_report``, kept) calls read; of others, none."""
    bad = Lookup(report.where("status != 'read'").select("path").withColumn("bad", F.lit(True)), "path")
    reader = spark.read.schema(schema).options(recursiveFileLookup=True, ignoreCorruptFiles=True)
    rows = reader.parquet(root).withColumn("path", _plain("_metadata.file_path"))
    return bad.attach(rows, "path", {"bad": "bad"}, "left").where("bad IS NULL").select(*schema.names)

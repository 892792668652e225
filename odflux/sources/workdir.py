"""Where jobs may put written tables: the shared folder the session names."""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odflux.functions.text import basename

CHECKPOINT_DIR = "spark.checkpoint.dir"


def work_root(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only on a local master."""
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    return tempfile.gettempdir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the work root that no other run uses."""
    return f"{work_root(spark)}/odflux-{uuid.uuid4().hex}/{name}"


def keep(df: DataFrame) -> DataFrame:
    """Evaluate a small table once, into the shared folder, for all its later uses."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(work_root(spark))
    return df.checkpoint()


def relative_path(spark: SparkSession, root: str, path: str = "path") -> Column:
    """Path of a file below ``root``; its own name where ``root`` is the file."""
    base = quote(spark._jvm.org.apache.hadoop.fs.Path(root).toUri().getPath().rstrip("/"))
    plain = F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return F.when(plain.startswith(base + "/"), F.substr(plain, F.lit(len(base) + 2))).otherwise(basename(plain))


def fresh_folder(spark: SparkSession, out: str) -> str:
    """An empty folder beside ``out``, on the same file system."""
    folder = f"{out.rstrip('/')}.staged-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return folder


def _renamed(files, old, new) -> bool:
    try:
        return files.rename(old, new)
    except Py4JJavaError:  # some file systems say no, others fail
        return False


def replace_folder(spark: SparkSession, staged: str, out: str) -> None:
    """Put a complete folder in the place of ``out`` by renaming; what was there goes last.

    Where the move fails, the old folder is put back.
    """
    new, old = spark._jvm.org.apache.hadoop.fs.Path(staged), spark._jvm.org.apache.hadoop.fs.Path(out.rstrip("/"))
    files = new.getFileSystem(spark._jsc.hadoopConfiguration())
    aside = old.suffix(f".replaced-{uuid.uuid4().hex}")
    had = files.exists(old)
    if had and not _renamed(files, old, aside):
        raise OSError(f"cannot move {out}")
    if not _renamed(files, new, old):
        if had:
            files.rename(aside, old)
        raise OSError(f"cannot move {staged} to {out}")
    if had:
        files.delete(aside, True)

"""Headers, renames and the two directions of reshaping."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflux.functions.codes import labelled
from odflux.functions.nulls import differs, with_keys

# Column names and labels of the yearly sheets.
SHEET_NAMES = {"outla": "gss_out", "inla": "gss_in", "Sex": "sex", "Year": "year"}
SEX_LABELS = {"F": "female", "M": "male"}
FLOW_IDS = ("gss_out", "gss_in", "sex", "year")
AGE_COLUMN = re.compile(r"age_\d+", re.IGNORECASE)
DIRECTIONS = ("inflow", "outflow", "netflow")


def lowercase_headers(df: DataFrame) -> DataFrame:
    lowered = [c.lower() for c in df.columns]
    clashes = [name for name, n in Counter(lowered).items() if n > 1]
    if clashes:
        raise ValueError(f"columns differ only by case: {clashes}")
    return df.toDF(*lowered)


def rename_keys(df: DataFrame, names: Mapping[str, str] = SHEET_NAMES) -> DataFrame:
    """Rename the columns that exist, by exact name."""
    return df.toDF(*[names.get(c, c) for c in df.columns])


def parse_age(label: Column) -> Column:
    return F.regexp_replace(label, "(?i)^age_", "").cast("int")


def map_sex(code: Column) -> Column:
    """Label of a sex code; any other code is missing."""
    return labelled(code, SEX_LABELS)


def cast_year(year: Column) -> Column:
    return year.cast("int")


def unpivot_age(df: DataFrame, keep_missing: bool = True) -> DataFrame:
    """One row per age column of a yearly sheet, zero flows left out."""
    df = rename_keys(df)
    ages = [c for c in df.columns if AGE_COLUMN.fullmatch(c)]
    extra = [c for c in df.columns if c not in ages and c not in FLOW_IDS]
    if extra or not ages:
        raise ValueError(f"expected {FLOW_IDS} and age columns, found also {extra}")
    sheet = df.select(
        "gss_out",
        "gss_in",
        map_sex(F.col("sex")).alias("sex"),
        cast_year(F.col("year")).alias("year"),
        *[F.col(c).cast("double").alias(c) for c in ages],
    )
    long = sheet.unpivot(list(FLOW_IDS), ages, "age", "value").withColumn("age", parse_age(F.col("age")))
    wanted = differs(F.col("value"), F.lit(0)) if keep_missing else F.col("value") != 0
    return long.where(wanted)


def unpivot_direction(
    net: DataFrame,
    ids: Sequence[str] = ("gss_code", "origin_destination_code", "age", "year"),
    directions: Sequence[str] = DIRECTIONS,
) -> DataFrame:
    return net.unpivot(list(ids), list(directions), "direction", "value")


def pivot_age_wide(
    df: DataFrame,
    ages: Sequence[int] | None = None,
    index: Sequence[str] = ("gss_code", "origin_destination_code", "direction", "year"),
) -> DataFrame:
    """One column per age holding the mean value, 0 where there is none.

    Conditional means keep it to one shuffle of partial aggregates. Give
    ``ages`` to save the job that looks them up; rows of another age are then an
    error, found by the same aggregate.
    """
    if ages is None:
        ages = [r["age"] for r in df.where("age IS NOT NULL").select("age").distinct().orderBy("age").collect()]
    cells = [
        F.coalesce(F.avg(F.when(F.col("age") == age, F.col("value"))), F.lit(0.0)).alias(str(age)) for age in ages
    ]
    other = F.max(F.when(~F.col("age").isin(*ages), F.col("age"))) if ages else F.max("age")
    wide = with_keys(df, [*index, "age"]).groupBy(*index).agg(*cells, other.alias("__other"))
    unlisted = F.raise_error(F.concat(F.lit("age outside the list: "), F.col("__other").cast("string"))).cast("boolean")
    return wide.where(F.when(F.col("__other").isNotNull(), unlisted).otherwise(True)).drop("__other")


def swap_endpoints(flows: DataFrame, measure: str = "outflow") -> DataFrame:
    """Exchange the two ends and carry the value as ``measure``."""
    others = [c for c in flows.columns if c not in ("gss_in", "gss_out", "value")]
    return flows.select(
        F.col("gss_out").alias("gss_in"), F.col("gss_in").alias("gss_out"), *others, F.col("value").alias(measure)
    )


def constant_column(df: DataFrame, name: str, value: object) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def restore_column_order(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*like.columns)


def with_netflow(df: DataFrame) -> DataFrame:
    return df.withColumn("netflow", F.col("inflow") - F.col("outflow"))


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)

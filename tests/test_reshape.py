from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from odflux.operators import reshape
from odflux.operators.sets import union_by_name

SHEET = "outla string, inla string, Year int, Sex string, Age_0 double, Age_1 double, Age_2 double"


def sheet(spark):
    return spark.createDataFrame(
        [("a", "b", 2012, "F", 1.0, 0.0, None), ("b", "a", 2013, "M", 2.0, 3.5, -0.0), ("c", "a", 2013, "X", 0.0, 0.0, 4.0)],
        SHEET,
    )


LONG = [
    ("a", "b", "female", 2012, 0, 1.0),
    ("a", "b", "female", 2012, 2, None),
    ("b", "a", "male", 2013, 0, 2.0),
    ("b", "a", "male", 2013, 1, 3.5),
    ("c", "a", None, 2013, 2, 4.0),
]


@pytest.mark.parametrize("lower", [False, True])
def test_unpivot_takes_either_header_style(spark, rows, lower):
    df = reshape.lowercase_headers(sheet(spark)) if lower else sheet(spark)
    long = reshape.unpivot_age(df)
    assert long.columns == ["gss_out", "gss_in", "sex", "year", "age", "value"]
    assert [f.dataType.simpleString() for f in long.schema] == ["string", "string", "string", "int", "int", "double"]
    assert rows(long) == LONG


def test_unpivot_can_leave_out_missing_values(spark, rows):
    assert rows(reshape.unpivot_age(sheet(spark), keep_missing=False)) == [r for r in LONG if r[-1] is not None]


def test_unpivot_rejects_other_columns(spark):
    with pytest.raises(ValueError, match="note"):
        reshape.unpivot_age(sheet(spark).withColumn("note", F.lit("x")))
    with pytest.raises(ValueError):
        reshape.unpivot_age(sheet(spark).select("outla", "inla", "Sex", "Year"))


def test_headers_that_collide_are_an_error(spark):
    df = spark.range(1).select(F.lit(1).alias("Year"), F.lit(2).alias("sex"))
    assert reshape.lowercase_headers(df).columns == ["year", "sex"]
    with pytest.raises(ValueError, match="year"):
        reshape.lowercase_headers(df.toDF("Year", "year"))


def test_rename_ignores_absent_names(spark):
    df = spark.range(1).select(F.lit("a").alias("outla"), F.lit(1).alias("other"))
    assert reshape.rename_keys(df).columns == ["gss_out", "other"]


NET = "gss_code string, origin_destination_code string, direction string, year int, age int, value double"


def test_pivot_averages_repeated_keys_and_fills_gaps(spark, rows):
    df = spark.createDataFrame(
        [
            ("a", "b", "inflow", 2012, 0, 1.0),
            ("a", "b", "inflow", 2012, 0, 4.0),
            ("a", "b", "inflow", 2012, 2, None),
            ("a", "b", "outflow", 2012, 1, 5.0),
            (None, "b", "outflow", 2012, 1, 5.0),
        ],
        NET,
    )
    wide = reshape.pivot_age_wide(df, [0, 1, 2])
    assert wide.columns[-3:] == ["0", "1", "2"]
    assert rows(wide) == [("a", "b", "inflow", 2012, 2.5, 0.0, 0.0), ("a", "b", "outflow", 2012, 0.0, 5.0, 0.0)]
    assert rows(reshape.pivot_age_wide(df)) == rows(wide)


def test_pivot_agrees_with_the_builtin_pivot(spark, rows):
    data = [(f"a{i % 5}", f"b{i % 3}", "inflow", 2012 + i % 2, i % 7, float(i)) for i in range(200)]
    df = spark.createDataFrame(data, NET)
    keys = ["gss_code", "origin_destination_code", "direction", "year"]
    builtin = df.groupBy(*keys).pivot("age", list(range(7))).agg(F.avg("value")).fillna(0.0)
    assert rows(reshape.pivot_age_wide(df, range(7))) == rows(builtin)


def test_unpivot_undoes_pivot_on_unique_keys(spark, rows):
    data = [(f"a{i % 5}", f"b{i // 5}", "inflow", 2012, i % 4, float(i + 1)) for i in range(20)]
    df = spark.createDataFrame(data, NET)
    wide = reshape.pivot_age_wide(df, range(4))
    keys = ["gss_code", "origin_destination_code", "direction", "year"]
    back = wide.unpivot(keys, ["0", "1", "2", "3"], "age", "value").withColumn("age", reshape.parse_age(F.col("age")))
    assert rows(back.where("value != 0")) == rows(df)


def test_directions_become_rows(spark, rows):
    df = spark.createDataFrame([("a", "b", 1, 2012, 5.0, 2.0)], "gss_code string, origin_destination_code string, age int, year int, inflow double, outflow double")
    long = reshape.unpivot_direction(reshape.with_netflow(df))
    assert rows(long, "direction", "value") == [("inflow", 5.0), ("netflow", 3.0), ("outflow", 2.0)]


def test_union_fills_and_widens(spark, rows):
    left = spark.createDataFrame([("a", 1)], "c string, v int")
    right = spark.createDataFrame([("b", 2.5, "x")], "c string, v double, extra string")
    both = union_by_name([left, right])
    assert dict(both.dtypes) == {"c": "string", "v": "double", "extra": "string"}
    assert rows(both) == [("a", 1.0, None), ("b", 2.5, "x")]


def test_ages_outside_the_list_are_an_error(spark, rows):
    df = spark.createDataFrame([("a", "b", "inflow", 2012, 0, 1.0), ("a", "b", "inflow", 2012, 7, 2.0)], "gss_code string, origin_destination_code string, direction string, year int, age int, value double")
    assert rows(reshape.pivot_age_wide(df, [0, 7])) == [("a", "b", "inflow", 2012, 1.0, 2.0)]
    with pytest.raises(Exception, match="age outside the list: 7"):
        reshape.pivot_age_wide(df, [0, 1]).collect()
    with pytest.raises(Exception, match="age outside the list"):
        reshape.pivot_age_wide(df, [0, 1]).select("year").collect()
    assert rows(reshape.pivot_age_wide(df.where("age = 0"), [0])) == [("a", "b", "inflow", 2012, 1.0)]

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .appName("flow-series-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows as a sorted list of tuples, missing values last."""

    def of(df: DataFrame, *columns: str) -> list[tuple]:
        found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(found, key=lambda row: [(v is None, str(type(v)), v if v is not None else 0) for v in row])

    return of


@pytest.fixture(scope="session")
def plan():
    """Executed plan as text."""

    def of(df: DataFrame) -> str:
        return df._jdf.queryExecution().executedPlan().toString()

    return of


FLOW_DDL = "gss_out string, gss_in string, sex string, year int, age int, value double"


@pytest.fixture(scope="session")
def random_flows(spark):
    """Seeded flows with missing keys and values, repeated keys, and a hot pair."""
    import random

    def make(seed: int, n: int = 1500) -> DataFrame:
        rng = random.Random(seed)
        codes = ["E06000001", "E06000101", "E07000002", "E07000007", "E06000006", "E09000001", "S12000004", "XE07", None]
        data = []
        for _ in range(n):
            hot = rng.random() < 0.33
            data.append(
                (
                    "E07000002" if hot else rng.choice(codes),
                    "E07000007" if hot else rng.choice(codes),
                    rng.choice(["female", "male", "male", None]),
                    rng.choice([2010, 2011, 2012, None]),
                    rng.choice([0, 5, 16]),
                    rng.choice([0.0, 1.0, 2.0, 7.0, None]),
                )
            )
        return spark.createDataFrame(data, FLOW_DDL)

    return make


@pytest.fixture(scope="session")
def changes(spark) -> DataFrame:
    from workload.standin import code_changes

    return code_changes(spark)


@pytest.fixture(scope="session")
def areas(spark):
    """Three lookups over the codes of ``random_flows``; S12 and XE07 have no region."""
    from odflux.operators.flows import reporting_geographies

    country = [("E06000001", "E92000001"), ("E07000002", "E92000001"), ("E07000007", "E92000001"),
               ("E09000001", "E92000001"), ("S12000004", "S92000003")]
    region = [("E06000001", "E12000001"), ("E07000002", "E12000001"), ("E07000007", "E12000002"),
              ("E09000001", "E12000007")]
    london = [("E06000001", "other"), ("E07000002", "E13000001"), ("E07000007", "E13000002"),
              ("E09000001", "E13000001")]
    frames = [
        spark.createDataFrame(data, f"lad_code string, {target} string")
        for data, target in ((country, "country_code"), (region, "region_code"), (london, "io_london"))
    ]
    return reporting_geographies(*frames)

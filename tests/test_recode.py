from __future__ import annotations

import random
import warnings

import pytest
from pyspark.sql import functions as F

from odflux.operators import audit, recode
from odflux.operators.filters import code_present
from odflux.operators.lookups import Lookup
from odflux.plans.series import combine_series

CHANGE = "changed_from_code string, changed_to_code string, year int"


def lookup_of(spark, edges, first, last):
    return {r[0]: r[1] for r in recode.recode_lookup(spark.createDataFrame(edges, CHANGE), first, last).collect()}


def codes(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "code string")


def test_forward_lookup(spark, changes):
    present = codes(spark, "E06000001", "E06000006", "E07000002", "E07000007", "W06000003", "E06000011", "E06000016")
    found = code_present(recode.recode_lookup(changes, 2021, 2023), "changed_from_code", present, "code")
    assert {r[0]: r[1] for r in found.collect()} == {
        "E06000001": "E06000201",
        "E06000006": "E06000401, E06000402",
        "E07000002": "E06000301",
        "E07000007": "E06000301",
    }


def test_reverse_lookup(spark, changes):
    assert {r[0]: r[1] for r in recode.recode_lookup(changes, 2023, 2021).collect()} == {
        "E06000201": "E06000101",
        "E06000301": "E07000002, E07000007",
        "E06000401": "E06000006",
        "E06000402": "E06000006",
        "E06000601": "E06000016",
    }


def test_reverse_swaps_flags_and_names(changes):
    row = recode.reverse_changes(changes).where("changed_to_code = 'E06000006' AND changed_from_code = 'E06000401'").first()
    assert (row["changed_from_name"], row["changed_to_name"], row["year"], row["split"], row["merge"]) == (
        "Nation 401", "Nation 6", 2021, False, True,
    )


def test_targets_move_on_once_a_year(spark):
    edges = [("A", "B", 2021), ("B", "C", 2021), ("C", "D", 2021)]
    assert lookup_of(spark, edges, 2021, 2021) == {"A": "C", "B": "D", "C": "D"}


def test_long_chain_ends_at_the_last_code(spark):
    edges = [("A", "B", 2010), ("B", "C", 2012), ("C", "D", 2024)]
    assert lookup_of(spark, edges, 2008, 2024) == {"A": "D", "B": "D", "C": "D"}


def test_split_then_chain_and_late_second_change(spark):
    edges = [("A", "B", 2021), ("A", "C", 2021), ("B", "B2", 2022), ("A", "Z", 2023), ("K", "K", 2022)]
    assert lookup_of(spark, edges, 2021, 2023) == {"A": "B2, C, Z", "B": "B2"}


def test_code_that_returns_is_unchanged(spark):
    assert lookup_of(spark, [("A", "B", 2021), ("B", "A", 2022)], 2021, 2022) == {"B": "A"}


@pytest.mark.parametrize("seed", range(4))
def test_walk_against_single_codes_followed_by_hand(spark, seed):
    """Each start is followed on its own, as sets of codes per year."""
    rng = random.Random(seed)
    edges = [(rng.choice("ABCDEFGH"), rng.choice("ABCDEFGHIJ"), rng.randrange(2019, 2025)) for _ in range(14)]
    first, last = 2020, 2023
    backward = [(b, a, year - 1) for a, b, year in edges]
    for used, years, ends in ((edges, range(first, last + 1), (first, last)), (backward, range(last, first - 1, -1), (last, first))):
        expected = {}
        for start in {a for a, _, _ in used}:
            reached = set()
            for year in years:
                moves = {(a, b) for a, b, y in used if y == year}
                reached |= {b for a, b in moves if a == start}
                reached = {b for code in reached for b in ({b for a, b in moves if a == code} or {code})}
            if reached - {start}:
                expected[start] = ", ".join(sorted(reached - {start}))
        assert lookup_of(spark, edges, *ends) == expected


def test_closed_lookup_is_kept_in_the_shared_folder(spark, changes, plan):
    lookup = recode.as_recode_lookup(changes, 2021, 2023)
    assert "Join" not in plan(lookup.frame)
    assert spark.sparkContext.getCheckpointDir().startswith("file:" + spark.conf.get("spark.checkpoint.dir"))


def brute_force(df, lookup, column):
    """Relabel and sum by hand."""
    sums = {}
    for row in df.collect():
        record = row.asDict()
        record[column] = lookup.get(record[column], record[column])
        value = record.pop("value")
        if None in record.values():
            continue
        key = tuple(record.items())
        sums.setdefault(key, []).append(value)
    return sums


def test_sum_and_mean_against_brute_force(spark, changes, random_flows):
    df = random_flows(1)
    lookup = {r[0]: r[1] for r in recode.recode_lookup(changes, 2021, 2023).collect()}
    groups = brute_force(df, lookup, "gss_in")
    for fun in ("sum", "mean"):
        got = recode.recode_gss(df, "gss_in", "value", fun, 2021, 2023, lad_code_changes=changes)
        assert got.columns == df.columns
        found = {tuple((c, r[c]) for c in df.columns if c != "value"): r["value"] for r in got.collect()}
        assert found.keys() == groups.keys()
        for key, values in groups.items():
            present = [v for v in values if v is not None]
            if fun == "sum":
                assert found[key] == sum(present)
            else:
                assert found[key] == (pytest.approx(sum(present) / len(present)) if present else None)


def test_sum_keeps_the_total_and_relabel_keeps_rows(spark, changes, random_flows):
    df = random_flows(2).dropna()
    recoded = recode.recode_gss(df, "gss_in", "value", "sum", 2021, 2023, lad_code_changes=changes)
    total = F.sum("value")
    assert recoded.agg(total).first()[0] == df.agg(total).first()[0]
    plain = recode.recode_gss(df, "gss_in", "value", "sum", 2021, 2023, False, changes)
    assert plain.count() == df.count()


def test_several_measures(spark, changes, rows):
    df = spark.createDataFrame([("E07000002", 1.0, 2), ("E07000007", 3.0, 4)], "code string, v double, n int")
    got = recode.recode_gss(df, "code", ["v", "n"], "sum", 2021, 2023, lad_code_changes=changes)
    assert rows(got) == [("E06000301", 4.0, 6)]


@pytest.mark.parametrize("seed", range(3))
def test_one_pass_over_both_ends_equals_two_steps(spark, changes, rows, random_flows, seed):
    df = random_flows(seed)
    lookup = recode.as_recode_lookup(changes, 2021, 2023)
    two_steps = recode.recode_end(recode.recode_end(df, "gss_in", lookup), "gss_out", lookup)
    assert rows(recode.recode_both_ends(df, lookup)) == rows(two_steps)


@pytest.mark.parametrize("seed", range(3))
def test_unique_keys_need_no_shuffle_of_untouched_codes(spark, changes, rows, random_flows, seed):
    df = recode.aggregate_measures(random_flows(seed), ["value"]).unionByName(
        spark.createDataFrame([("S12000004", None, "male", 2010, 3, 1.0), ("E06000001", None, "male", 2010, 3, 1.0)],
                              random_flows(seed).schema)
    )
    lookup = recode.as_recode_lookup(changes, 2021, 2023)
    whole = recode.recode_both_ends(df, lookup)
    assert rows(recode.recode_both_ends(df, lookup, unique_keys=True)) == rows(whole)


def test_one_pass_shuffles_once(changes, random_flows, plan):
    lookup = recode.as_recode_lookup(changes, 2021, 2023)
    text = plan(recode.recode_both_ends(random_flows(0), lookup))
    assert text.count("Exchange hashpartitioning(gss") == 1


def test_lookup_beyond_the_bound_gives_the_same_rows(spark, changes, rows, plan, random_flows):
    df = random_flows(4)
    small = recode.as_recode_lookup(changes, 2021, 2023)
    large = Lookup(small.frame, small.keys, max_bytes=0)
    assert small.fits and not large.fits
    assert rows(recode.relabel(df, "gss_in", large)) == rows(recode.relabel(df, "gss_in", small))
    assert rows(large.restrict(df, "gss_in")) == rows(small.restrict(df, "gss_in"))
    assert "SortMergeJoin" in plan(recode.relabel(df, "gss_in", large))


@pytest.mark.parametrize(
    "options, error",
    [
        ({"fun": "max"}, ValueError),
        ({"recode_from_year": 2007}, ValueError),
        ({"recode_to_year": 2025}, ValueError),
        ({"recode_to_year": "2023"}, TypeError),
        ({"col_data": "missing"}, ValueError),
        ({"col_data": "sex"}, ValueError),
        ({"col_data": 3}, TypeError),
        ({"col_code": "missing"}, ValueError),
        ({"col_code": ["gss_in"]}, TypeError),
    ],
)
def test_bad_arguments(random_flows, changes, options, error):
    arguments = {"col_code": "gss_in", "recode_from_year": 2021, "recode_to_year": 2023, "lad_code_changes": changes}
    with pytest.raises(error):
        recode.recode_gss(random_flows(0), **(arguments | options))


def test_changes_and_frame_are_needed(random_flows, changes):
    with pytest.raises(ValueError, match="code changes"):
        recode.recode_gss(random_flows(0), "gss_in", recode_from_year=2021, recode_to_year=2023)
    with pytest.raises(TypeError):
        recode.check_recode([], "gss_in", "value", 2021, 2023)


def test_area_names_are_warned_of(spark, changes):
    df = spark.createDataFrame([("E06000001", "Camden", "x", 1.0)], "code string, name string, other string, value double")
    register = spark.createDataFrame([("Camden",), ("Barnet",)], "gss_name string")
    def warned(frame):
        with warnings.catch_warnings(record=True) as caught:
            warnings.simplefilter("always")
            recode.recode_gss(frame, "code", "value", "sum", 2021, 2023, True, changes, register)
        return [str(w.message) for w in caught if "area names" in str(w.message)]

    assert warned(df) == ["column 'name' holds area names; consider leaving it out"]
    assert warned(df.drop("name")) == []


def test_code_audits(spark, rows):
    before = codes(spark, "a", "b", "b", None)
    after = codes(spark, "b", "c", None)
    assert rows(audit.changed_codes(before, after, "code")) == [("a", "left_only"), ("c", "right_only")]
    assert rows(audit.code_difference(before, after, "code")) == [("a",)]
    assert rows(audit.added_removed_codes(before, after, "code")) == [
        ("added", "c"), ("n_after", "3"), ("n_before", "3"), ("removed", "a"),
    ]
    assert rows(audit.added_removed_codes(before.limit(0), after.limit(0), "code")) == [("n_after", "0"), ("n_before", "0")]
    joined = before.distinct().alias("l").join(after.distinct().alias("r"), F.expr("l.code <=> r.code"), "full_outer")
    one_sided = joined.where("l.code IS NULL AND r.code IS NOT NULL OR r.code IS NULL AND l.code IS NOT NULL")
    assert one_sided.count() == audit.changed_codes(before, after, "code").count()


def test_combined_series(spark, changes, rows):
    old = spark.createDataFrame(
        [
            ("E07000002", "E06000001", "male", 2011, 1, 2.0),
            ("E07000007", "E06000001", "male", 2011, 1, 3.0),
            ("E07000002", "E07000007", "male", 2011, 1, 9.0),
            ("S12000004", "S12000005", None, 2011, 1, 1.0),
            ("E06000001", "E07000002", "male", 2012, 1, 8.0),
            (None, "S12000005", "male", 2011, 1, 4.0),
        ],
        "gss_out string, gss_in string, sex string, year int, age int, value double",
    )
    new = spark.createDataFrame(
        [("a", "b", "F", 2012, 0.0, 5.0), ("a", "a", "F", 2012, 1.0, 1.0)],
        "outla string, inla string, sex string, year int, age_0 double, age_1 double",
    )
    assert rows(combine_series(old, new, changes)) == [
        ("E06000301", "E06000201", "male", 2011, 1, 5.0),
        ("S12000004", "S12000005", None, 2011, 1, 1.0),
        ("a", "b", "female", 2012, 1, 5.0),
        (None, "S12000005", "male", 2011, 1, 4.0),
    ]


def test_a_watch_counts_area_names_without_a_job(spark, changes):
    df = spark.createDataFrame(
        [("E06000001", "Camden", "x", 1.0), ("E06000001", None, "Barnet", 1.0), ("E07000002", "Barnet", "y", 2.0)],
        "code string, name string, other string, value double",
    )
    names = audit.AreaNames(spark.createDataFrame([("Camden",), ("Barnet",), (None,)], "gss_name string"))
    assert names.listed and names.few
    lookup = recode.as_recode_lookup(changes, 2021, 2023)
    assert lookup.fits
    watch = audit.AreaNameWatch(names)
    spark.sparkContext.setJobGroup("watched", "watched")
    recoded = recode.recode_gss(df, "code", "value", "sum", 2021, 2023, True, lookup, watch)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("watched")
    recoded.collect()
    spark.sparkContext.setJobGroup("rest", "rest")
    assert watch.columns == {"name": 2, "other": 1}
    with pytest.warns(UserWarning, match="column 'name' holds area names"):
        watch.warn()


def test_many_area_names_are_joined(spark, rows):
    df = spark.createDataFrame([("Camden", "x"), ("Barnet", "Camden"), (None, "Camden")], "name string, other string")
    register = spark.createDataFrame([("Camden",), ("Barnet",)], "gss_name string")
    few, many = audit.AreaNames(register), audit.AreaNames(register, max_bytes=0)
    expected = [("name", 2), ("other", 2)]
    assert rows(audit.columns_with_area_names(df, few)) == rows(audit.columns_with_area_names(df, many)) == expected
    with pytest.raises(ValueError, match="too many"):
        audit.AreaNameWatch(many).on(df)


@pytest.mark.parametrize("seed", range(3))
def test_sides_from_the_codes_equal_sides_from_the_rows(random_flows, changes, rows, seed):
    flows, lookup = random_flows(seed), recode.as_recode_lookup(changes, 2021, 2023)
    after = recode.aggregate_measures(recode.relabel(flows, "gss_in", lookup), ["value"])
    sides = audit.recode_sides(flows, "gss_in", lookup, recode.TO)
    assert rows(sides) == rows(audit.code_sides(flows, after, "gss_in"))
    assert rows(audit.only_changed(sides)) == rows(audit.changed_codes(flows, after, "gss_in"))
    assert rows(audit.added_and_removed(sides)) == rows(audit.added_removed_codes(flows, after, "gss_in"))


def exchanges(df) -> list[str]:
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "Exchange hashpartitioning" in line]


def test_audits_shuffle_codes_only(spark, random_flows, changes, tmp_path):
    random_flows(1).write.parquet(f"{tmp_path}/flows")
    flows = spark.read.parquet(f"{tmp_path}/flows")
    lookup = recode.as_recode_lookup(changes, 2021, 2023)
    for df in (audit.only_changed(audit.recode_sides(flows, "gss_in", lookup, recode.TO)),):
        for line in exchanges(df):
            assert line.count("#") == 1 and ("code" in line or "gss_in" in line), line


def scans(df) -> int:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("FileScan parquet")


def test_recodes_scan_their_input_once(spark, random_flows, changes, tmp_path):
    random_flows(2).write.parquet(f"{tmp_path}/historical")
    flows = spark.read.parquet(f"{tmp_path}/historical")
    lookup = recode.as_recode_lookup(changes, 2021, 2023)
    assert scans(recode.recode_end(flows, "gss_in", lookup)) == 1
    assert scans(recode.recode_end(recode.recode_end(flows, "gss_in", lookup), "gss_out", lookup)) == 1
    assert scans(recode.recode_both_ends(flows, lookup)) == 1
    wide = spark.createDataFrame([("a", "b", "F", 2013, 1.0, 0.0)], "outla string, inla string, sex string, year int, age_0 double, age_1 double")
    assert scans(combine_series(flows, wide, lookup, 2012)) == 1


def test_passing_rows_stay_as_they_are(spark, rows):
    data = [("E07000002", "x", 1.0), ("E07000002", "x", 2.0), ("S1", "x", 1.0), ("S1", "x", 1.0), ("S1", None, None), (None, "y", 3.0), ("E07000007", None, 5.0), ("E07000007", "z", None)]
    df = spark.createDataFrame(data, "gss_in string, k string, value double")
    found = recode.sum_or_pass(df, "value", ~F.coalesce(F.col("gss_in").startswith("E0"), F.lit(False)))
    assert rows(found) == rows(spark.createDataFrame([("E07000002", "x", 3.0), *data[2:6], ("E07000007", "z", 0.0)], df.schema))


def test_a_lookup_is_measured_by_the_job_that_keeps_it(spark, changes):
    spark.sparkContext.setJobGroup("kept", "kept")
    lookup = recode.as_recode_lookup(changes, 2021, 2023)
    size, jobs = lookup.size, len(spark.sparkContext.statusTracker().getJobIdsForGroup("kept"))
    assert lookup.fits and len(spark.sparkContext.statusTracker().getJobIdsForGroup("kept")) == jobs
    spark.sparkContext.setJobGroup("rest", "rest")
    assert size == Lookup(lookup.frame, recode.FROM).size and size.rows > 0
    assert Lookup.kept(lookup.frame.limit(0), recode.FROM).size == Lookup(lookup.frame.limit(0), recode.FROM).size

"""Every kind of check with a seeded violation and a clean frame; statuses, storage, profiles."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from conftest import SMALL

from dailymart.plans.mart import FACT
from dailymart.quality import CATALOG, Check, QualityError, failing_rows, key_presence, profiles, require_passed, row_measures, run_checks, store_failures
from dailymart.quality.catalog import EXPRESSIONS, FUTURE_DATES, RATING_RANGE, TEMPERATURE_RANGE
from dailymart.quality.checks import _counted_keys
from dailymart.quality.presence import key_domains, key_type
from dailymart.schemas import RAW
from dailymart.sinks.lake import Lake
from dailymart.workspace import STORED, Workspace

T0 = datetime(2024, 1, 1)


def test_catalog_is_complete():
    kinds = Counter(c.kind for c in CATALOG)
    assert len(CATALOG) == 77 == len({c.name for c in CATALOG})
    assert kinds == {
        "not_null": 45,
        "unique": 12,
        "relationships": 8,
        "accepted_values": 7,
        "expression": 2,
        "range": 2,
        "no_future_dates": 1,
    }


GENERIC = [
    (Check("m", "not_null", ("x",)), "x int", [(None,), (1,)], [(1,)], 1),
    (Check("m", "not_null", ("x",), where="p"), "x int, p boolean", [(None, True)], [(None, False), (None, None)], 1),
    (Check("m", "unique", ("x",)), "x int", [(1,), (1,), (1,), (2,), (2,)], [(1,), (None,), (None,)], 2),
    (
        Check("m", "unique", ("x", "y")),
        "x int, y int",
        [(1, 1), (1, 1)],
        [(1, 1), (1, 2), (None, 1), (None, 1)],
        1,
    ),
    (Check("m", "accepted_values", ("x",), values=("a",)), "x string", [("b",), ("b",), ("c",)], [("a",), (None,)], 2),
    (Check("m", "relationships", ("x",), parent=("p", "k")), "x int", [(7,), (7,), (1,)], [(1,), (None,)], 2),
    (Check("m", "expression", expression="x <= y", label="e"), "x int, y int", [(2, 1)], [(1, 1), (None, 1)], 1),
    (RATING_RANGE, "avg_rating decimal(4,2)", [(D("5.01"),), (D("-0.01"),)], [(D("5.00"),), (None,)], 2),
    (
        TEMPERATURE_RANGE,
        "avg_temperature double, min_temperature double, max_temperature double",
        [(61.0, 0.0, 0.0), (0.0, -51.0, 0.0), (0.0, 0.0, 61.0)],
        [(0.0, -50.0, 60.0), (None, -99.0, 99.0), (1.0, None, None)],
        3,
    ),
    (FUTURE_DATES, "date date", [(date(2024, 1, 2),), (date(2024, 1, 2),)], [(date(2024, 1, 1),), (None,)], 1),
    (EXPRESSIONS[0], "completed_orders int, daily_orders int", [(2, 1)], [(1, 1)], 1),
    (EXPRESSIONS[1], "data_quality_flag string", [("large_discrepancy",)], [("match",)], 1),
]


@pytest.mark.parametrize(("check", "schema", "bad", "clean", "expected"), GENERIC)
def test_check_finds_seeded_violation(spark, check, schema, bad, clean, expected):
    parent = spark.createDataFrame([(1,), (1,)], "k int")

    def result(rows):
        models = {check.model: spark.createDataFrame(rows, schema), "p": parent}
        return run_checks(models, [check], as_of=date(2024, 1, 1)).first(), failing_rows(check, models, date(2024, 1, 1))

    failed, rows = result(bad + clean)
    assert failed.n_failures == expected
    assert failed.status == ("warn" if check is EXPRESSIONS[1] else "error")
    assert rows.count() > 0
    passed, rows = result(clean)
    assert (passed.n_failures, passed.status) == (0, "pass")
    assert rows.count() == 0


def test_severity_thresholds(spark):
    bad = spark.createDataFrame([(None,)] * 101, "x int")

    def status(rows, **limits):
        return run_checks({"m": rows}, [Check("m", "not_null", ("x",), **limits)]).first().status

    assert status(bad) == "error"
    assert status(bad, error_above=None) == "warn"
    assert status(bad, error_above=100) == "error"
    assert status(bad.limit(100), error_above=100) == "warn"


def test_all_checks_on_test_tables(small):
    results = run_checks(small.checked, CATALOG, as_of=date(2024, 2, 1))
    found = {r.check_name: r.status for r in results.collect()}
    assert len(found) == 77
    assert set(found.values()) <= {"pass", "warn"}
    assert [n for n, s in found.items() if s == "warn"] == ["expression_no_large_discrepancy"]
    require_passed(results)


def test_failure_raises_and_is_stored(spark, tmp_path):
    models = {"m": spark.createDataFrame([(None,), (1,)], "x int")}
    check = Check("m", "not_null", ("x",))
    with pytest.raises(QualityError, match="not_null_m_x: 1"):
        require_passed(run_checks(models, [check]))
    lake = Lake(spark, str(tmp_path))
    assert store_failures(lake, models, [check]) == {"not_null_m_x": 1}
    assert lake.read("test_results", "not_null_m_x").count() == 1


def weather(spark, rows):
    return spark.createDataFrame([(*r, T0) for r in rows], RAW["weather"])


def test_weather_profiles(spark):
    good = [(1, T0, D("10"), 50, D("3"))]
    outlet = spark.createDataFrame([(1, 1, "o", D(1), D(2), T0, T0)], RAW["outlet"])
    clean = weather(spark, good)
    assert profiles.null_profile(clean).first().status == "pass"
    assert profiles.range_profile(clean).first().status == "pass"
    assert profiles.orphan_profile(clean, outlet).first().passed
    assert profiles.source_rows(outlet).first().passed
    assert profiles.row_count_reconciliation(clean, clean).first().passed
    coverage = profiles.coverage_profile(clean).first()
    assert (coverage.min_datetime, coverage.unique_outlets) == ("2024-01-01 00:00:00", 1)

    optional = weather(spark, [*good, (1, T0, D("10"), None, D("3"))])
    assert profiles.null_profile(optional).first().status == "warn"
    required = weather(spark, [*good, (1, T0, None, 50, D("3"))])
    assert profiles.null_profile(required).first().status == "error"
    for row in [(1, T0, D("61"), 50, D("3")), (1, T0, D("1"), 101, D("3")), (1, T0, D("1"), 50, D("-1"))]:
        assert profiles.range_profile(weather(spark, [*good, row])).first().status == "error"
    lost = weather(spark, [*good, (9, T0, D("1"), 1, D("1")), (None, T0, D("1"), 1, D("1"))])
    assert profiles.orphan_profile(lost, outlet).first().orphan_count == 2
    assert not profiles.row_count_reconciliation(clean, lost).first().passed
    assert not profiles.row_count_reconciliation(clean.limit(0), clean.limit(0)).first().passed
    origin = spark.createDataFrame([(1, 1, "o", D(0), D(0), T0, T0)], RAW["outlet"])
    assert not profiles.source_rows(origin).first().passed
    assert not profiles.source_rows(outlet.limit(0)).first().passed


def test_fact_checks_share_one_scan(small, plan_of):
    fact_checks = [c for c in CATALOG if c.model == FACT and c.kind in ("not_null", "range", "expression")]
    assert len(fact_checks) == 10
    assert plan_of(run_checks(small.checked, fact_checks)).count("Scan parquet") <= 2


def test_row_checks_of_stored_models_read_nothing(small, plan_of):
    """Their failing rows were counted by the write; accepted values, too, as long as none fails."""
    stored = {c.model for c in CATALOG if c.model in STORED}
    kinds = ("not_null", "range", "expression", "accepted_values")
    checks = [c for c in CATALOG if c.model in stored and c.kind in kinds]
    assert len(checks) > 40
    results = small.check(checks, date(2024, 2, 1))
    assert "Scan parquet" not in plan_of(results)
    scanned = run_checks(small.checked, checks, date(2024, 2, 1))
    assert sorted(results.collect()) == sorted(scanned.collect())


def test_checks_build_the_fact_from_stored_models(spark):
    """What the checks store is read by the fact, not computed from the raw tables once more."""
    space = Workspace(spark, f"{SMALL}/")  # a folder of its own, beside that of ``small``
    try:
        checks = [c for c in CATALOG if c.kind == "unique" and len(c.columns) > 1]
        assert {r.status for r in space.check(checks, date(2024, 2, 1)).collect()} == {"pass"}
        assert not space.lazy._built
        assert {r.model for r in space.check(CATALOG, date(2024, 2, 1)).collect()} == {c.model for c in CATALOG}
        assert not space.lazy._built
        stored = space.fact.drop("month")
        plain = space.lazy.fact.select(*stored.columns)
        assert stored.exceptAll(plain).isEmpty() and plain.exceptAll(stored).isEmpty()
    finally:
        space.close()


def test_measures_of_a_write(spark, tmp_path, plan_of):
    lake = Lake(spark, str(tmp_path))
    checks = [
        Check("m", "not_null", ("x",)),
        Check("m", "expression", expression="x <= y", where="y > 0", label="e"),
        Check("m", "accepted_values", ("z",), values=("a",)),
        Check("m", "accepted_values", ("w",), values=("it's",)),
    ]
    rows = [(None, 1, "a", "it's"), (3, 2, "b", None), (3, 0, "b", "it's"), (None, None, "c", "it's")]
    df = spark.createDataFrame(rows, "x int, y int, z string, w string")
    measures = row_measures(checks, "m")
    assert row_measures(checks, "other") == {}
    assert lake.replace(df.repartition(3), "mart", "m", measures) == 4
    assert sorted(lake.measured("mart", "m").values()) == [0, 1, 2, 3]

    models = {"m": lake.read("mart", "m")}
    results = run_checks(models, checks, measured=lambda m: lake.measured("mart", m))
    assert plan_of(results).count("Scan parquet") == 2  # in the tree and below: the values that are not accepted
    assert {r.check_name: r.n_failures for r in results.collect()} == {"not_null_m_x": 2, "e": 1, "accepted_values_m_z": 2, "accepted_values_m_w": 0}
    assert sorted(results.collect()) == sorted(run_checks(models, checks).collect())

    lake.append(df, "mart", "m")  # a load that was not measured
    assert lake.measured("mart", "m") == {}
    assert lake.replace(df.where("false"), "mart", "m", measures) == 0
    assert set(lake.measured("mart", "m").values()) == {0}
    assert lake.measured("mart", "none") == {}


def test_measures_of_a_parted_table_count_until_a_part_is_replaced(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    df = spark.createDataFrame([(date(2024, 1, 1), 1, None), (date(2024, 2, 1), 1, 5)], "date date, listing_id int, x int")
    bad = row_measures([Check("m", "not_null", ("x",))], "m")
    lake.build_fact(df, "mart", "f", bad)
    assert list(lake.measured("mart", "f").values()) == [1]
    lake.refresh_fact(df.fillna(1), "mart", "f", date(2024, 1, 1), date(2024, 1, 31))
    assert lake.measured("mart", "f") == {}


def test_single_keys_are_counted_in_one_aggregate(spark, plan_of):
    """References along a chain and to itself, several children of a parent, nulls and repeated parents."""
    models = {
        "a": spark.createDataFrame([(1, 2), (2, None), (2, 9), (None, 1)], "k int, up int"),
        "b": spark.createDataFrame([(1, 2), (7, 2), (7, 3), (None, None)], "k long, c int"),
        "c": spark.createDataFrame([("x", 2), ("x", 4), (None, 4)], "s string, c short"),
    }
    checks = [
        Check("a", "unique", ("k",)),
        Check("a", "relationships", ("up",), parent=("a", "k")),
        Check("a", "relationships", ("k",), parent=("a", "k"), label="itself"),
        Check("b", "relationships", ("k",), parent=("a", "k")),
        Check("b", "relationships", ("c",), parent=("c", "c")),
        Check("c", "unique", ("s",)),
        Check("c", "unique", ("c",)),
        Check("b", "unique", ("k", "c")),
        Check("c", "relationships", ("s",), parent=("b", "c"), label="text to number"),
    ]
    found = {r.check_name: r.n_failures for r in run_checks(models, [c for c in checks if c.label != "text to number"]).collect()}
    assert found == {
        "unique_a_k": 1,
        "relationships_a_up": 1,
        "itself": 0,
        "relationships_b_k": 2,
        "relationships_b_c": 1,
        "unique_c_s": 1,
        "unique_c_c": 1,
        "unique_b_k_c": 0,
    }
    for check in checks[:-2]:
        rows = failing_rows(check, models)
        listed = sum(r.n_rows for r in rows.collect()) if check.kind == "relationships" else rows.count()
        assert listed == found[check.name], check.name
    # Keys of different types have no common aggregate.
    assert key_domains([[("a", "k"), ("b", "k")], [("c", "c")], [("b", "k"), ("d", "k")]]) == [
        [("c", "c")],
        [("a", "k"), ("b", "k"), ("d", "k")],
    ]
    assert key_type(models, [("c", "s"), ("b", "c")]) is None
    with pytest.raises(TypeError, match="different types"):
        key_presence(models, {"s": ("c", "s"), "k": ("a", "k")})
    empty = {m: df.limit(0) for m, df in models.items()}
    assert {r.n_failures for r in run_checks(empty, checks[:-1]).collect()} == {0}


def test_keys_of_the_catalog_take_one_shuffle(small):
    single = [c for c in CATALOG if c.kind == "relationships" or (c.kind == "unique" and len(c.columns) == 1)]
    assert len(single) == 14
    counted, rest = _counted_keys(small.checked, single)
    assert len(counted) == 1 and rest == []
    plan = counted[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_presence_counts_rows_by_source(spark):
    models = {"a": spark.createDataFrame([(1,), (1,), (None,)], "k int"), "b": spark.createDataFrame([(1,), (5,)], "k long")}
    found = key_presence(models, {"left": ("a", "k"), "right": ("b", "k")})
    assert sorted(map(tuple, found.collect())) == [(1, 2, 1), (5, 0, 1)]

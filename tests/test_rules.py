"""Business rules and column builders on literal rows."""

from __future__ import annotations

from decimal import ROUND_HALF_UP
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from dailymart.functions import (
    avg_where,
    clamp,
    count_where,
    domain_order,
    exact_avg,
    pct,
    rules,
    safe_corr,
    text_key,
    weekday_label,
)


def evaluate(spark, schema, rows, column):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_data_quality_flag(spark):
    rows = [(None, 3), (-1, 3), (0, 7), (6, None), (3, None), (4, 2), (5, 5)]
    flags = evaluate(spark, "od int, total bigint", rows, rules.data_quality_flag(F.col("od"), F.col("total")))
    assert flags == [
        "snapshot_missing",
        "snapshot_negative",
        "large_discrepancy",
        "large_discrepancy",
        "match",
        "minor_discrepancy",
        "match",
    ]


def test_snapshot_diff_treats_missing_as_zero(spark):
    rows = [(None, 3), (4, None), (None, None), (2, 5)]
    diff = rules.snapshot_vs_actual_diff(F.col("od"), F.col("total"))
    assert evaluate(spark, "od int, total bigint", rows, diff) == [3, -4, 0, 3]


@pytest.mark.parametrize(
    ("rule", "values", "expected"),
    [
        (
            rules.rating_category,
            ["5.00", "4.50", "4.49", "4.00", "3.00", "2.99", "0.01", "0.00", None],
            ["Excellent", "Excellent", "Good", "Good", "Average", "Poor", "Poor", "No Ratings", "No Ratings"],
        ),
        (
            rules.temperature_category,
            ["9.99", "10.00", "19.99", "20.00", "29.99", "30.00", "-5.00", None],
            ["Cold", "Mild", "Mild", "Warm", "Warm", "Hot", "Cold", "Unknown"],
        ),
        (
            rules.availability_category,
            ["100.0", "99.9", "75.0", "74.9", "25.0", "24.9", "0.1", "0.0", None],
            [
                "Always Online",
                "Mostly Online",
                "Mostly Online",
                "Partially Online",
                "Partially Online",
                "Mostly Offline",
                "Mostly Offline",
                "Always Offline",
                "Always Offline",
            ],
        ),
    ],
)
def test_categories(spark, rule, values, expected):
    rows = [(None if v is None else D(v),) for v in values]
    assert evaluate(spark, "x decimal(6,2)", rows, rule(F.col("x"))) == expected


def test_offline_flags(spark):
    rows = [(1, None, None), (0, 0, None), (None, 2, D("0.0")), (None, 2, D("10.0")), (None, None, None)]
    anomaly = rules.is_offline_order_anomaly(F.col("od"), F.col("total"), F.col("up"))
    assert evaluate(spark, "od int, total bigint, up decimal(5,1)", rows, anomaly) == [True, False, True, False, False]
    rows = [(D("49.9"), D("30.1")), (D("50.0"), D("90.0")), (D("0.0"), D("90.0")), (D("10.0"), D("30.0")), (None, None)]
    high = rules.is_high_failure_when_offline(F.col("up"), F.col("rate"))
    assert evaluate(spark, "up decimal(5,1), rate decimal(5,1)", rows, high) == [True, False, False, False, False]


def test_coordinates(spark):
    rows = [(D(0), D(0)), (None, D(1)), (D(1), None), (D(0), D(1)), (D(0), None), (None, None)]
    valid = rules.has_valid_coordinates(F.col("a"), F.col("b"))
    assert evaluate(spark, "a decimal(10,7), b decimal(10,7)", rows, valid) == [False, False, False, True, False, False]


def test_clamp_keeps_null(spark):
    assert evaluate(spark, "x int", [(-3,), (0,), (7,), (None,)], clamp("x", lo=0)) == [0, 0, 7, None]
    assert evaluate(spark, "x int", [(-3,), (3,), (7,), (None,)], clamp("x", 0, 5)) == [0, 3, 5, None]


def test_pct_rounds_half_up_once(spark):
    rows = [(1, 16), (1, 3), (2, 3), (0, 5), (5, 5), (1, 0), (1, 2000), (None, 4)]
    values = evaluate(spark, "a bigint, b bigint", rows, pct(F.col("a"), F.col("b"), 1))
    expected = [D("6.3"), D("33.3"), D("66.7"), D("0.0"), D("100.0"), None, D("0.1"), None]
    assert values == expected


def test_pct_and_average_against_brute_force(spark):
    pairs = [(a, b) for b in range(1, 41) for a in range(b + 1)]
    found = evaluate(spark, "a bigint, b bigint", pairs, pct(F.col("a"), F.col("b"), 1))
    assert found == [(D(100 * a) / D(b)).quantize(D("0.1"), ROUND_HALF_UP) for a, b in pairs]

    groups = [(g, D(g * k * k % 997) / 100) for g in range(60) for k in range(1, g % 7 + 2)]
    df = spark.createDataFrame(groups, "g int, x decimal(10,2)")
    found = {r.g: r.v for r in df.groupBy("g").agg(exact_avg("x", 1).alias("v")).collect()}
    for g in range(60):
        values = [x for h, x in groups if h == g]
        assert found[g] == (sum(values) / len(values)).quantize(D("0.1"), ROUND_HALF_UP)


def test_exact_average_does_not_round_twice(spark):
    # 0.004999999 would become 0.005 after a first rounding to six digits, and 0.01 after a second one.
    df = spark.createDataFrame([(D("0.00"),)] * 999 + [(D("4.99"),)], "x decimal(10,2)")
    assert df.agg(exact_avg("x", 2).alias("v")).first().v == D("0.00")
    df = spark.createDataFrame([(D("1.00"),), (D("1.01"),)], "x decimal(10,2)")
    assert df.agg(exact_avg("x", 2).alias("v")).first().v == D("1.01")
    assert df.where("x > 5").agg(exact_avg("x", 2).alias("v")).first().v is None


def test_conditional_aggregates(spark):
    df = spark.createDataFrame([(1, True), (2, None), (3, False), (4, True)], "x int, p boolean")
    row = df.agg(count_where(F.col("p")).alias("n"), avg_where("x", F.col("p"), 1).alias("a")).first()
    assert (row.n, row.a) == (2, D("2.5"))


def test_safe_corr(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 4.0, 3.0), (3.0, None, 3.0)], "x double, y double, c double")
    row = df.agg(safe_corr("x", "y").alias("xy"), safe_corr("x", "c").alias("xc")).first()
    assert (row.xy, row.xc) == (D("1.000"), None)
    assert df.limit(1).agg(safe_corr("x", "y").alias("v")).first().v is None


def test_domain_order_puts_unknown_last(spark):
    df = spark.createDataFrame([("b",), ("?",), ("a",)], "x string")
    assert [r.x for r in df.orderBy(domain_order("x", ["a", "b"])).collect()] == ["a", "b", "?"]


def test_text_functions(spark):
    df = spark.sql("select date'2024-01-03' d, 7 k, cast(null as int) n")
    row = df.select(text_key("d", "k").alias("key"), text_key("d", "n").alias("gone"), weekday_label("d").alias("w"))
    assert tuple(row.first()) == ("2024-01-03-7", None, "Wednesday")
    assert spark.sql("select date'2024-01-01' d").select(weekday_label("d").alias("w")).first().w == "Monday   "

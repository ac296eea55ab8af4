"""Business rules as reusable columns, each independent of where its inputs come from."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from dailymart.functions.exprs import pct

# Labels and lower or upper bounds of the published categories.
RATING_LEVELS = [("4.5", "Excellent"), ("4.0", "Good"), ("3.0", "Average")]
RATING_CATEGORIES = ["Excellent", "Good", "Average", "Poor", "No Ratings"]
TEMPERATURE_LIMITS = [("10", "Cold"), ("20", "Mild"), ("30", "Warm")]
TEMPERATURE_CATEGORIES = ["Cold", "Mild", "Warm", "Hot", "Unknown"]
UPTIME_LEVELS = [("75", "Mostly Online"), ("25", "Partially Online")]
AVAILABILITY_CATEGORIES = [
    "Always Online",
    "Mostly Online",
    "Partially Online",
    "Mostly Offline",
    "Always Offline",
    "No Data",
]
QUALITY_FLAGS = ["match", "minor_discrepancy", "large_discrepancy", "snapshot_negative", "snapshot_missing"]
RATING_TRENDS = ["improving", "declining", "stable", "new"]
ORDER_STATUSES = ["completed", "pending", "refunded", "cancelled"]
PLATFORM_GROUPS = ["Delivery", "Aggregator"]
LARGE_DISCREPANCY = 5
LOW_UPTIME = 50
HIGH_FAILURE_RATE = 30
HOURS_PER_DAY = 24


def bucket(branches: Sequence[tuple[Column, str]], default: str) -> Column:
    """First true branch wins, a NULL condition is not taken, ``default`` otherwise."""
    (condition, label), *rest = branches
    out = F.when(condition, F.lit(label))
    for condition, label in rest:
        out = out.when(condition, F.lit(label))
    return out.otherwise(F.lit(default))


def data_quality_flag(snapshot: Column, actual: Column) -> Column:
    """How the daily snapshot compares with the counted orders.

    ``actual`` is NULL when no order was counted. The last comparison keeps that NULL on purpose: a
    snapshot of 0 to 5 without any counted order is a ``match``. Staging clamps negatives to 0, so
    ``snapshot_negative`` never shows up in the mart; the branch serves unclamped input.
    """
    gap = F.abs(snapshot - F.coalesce(actual, F.lit(0)))
    return bucket(
        [
            (snapshot.isNull(), "snapshot_missing"),
            (snapshot < 0, "snapshot_negative"),
            (gap > LARGE_DISCREPANCY, "large_discrepancy"),
            (snapshot != actual, "minor_discrepancy"),
        ],
        "match",
    )


def snapshot_vs_actual_diff(snapshot: Column, actual: Column) -> Column:
    return F.coalesce(actual, F.lit(0)) - F.coalesce(snapshot, F.lit(0))


def order_failure_rate(failed: Column, total: Column) -> Column:
    return pct(failed, total, 1).cast("decimal(5,1)")


def uptime_percentage(online: Column, readings: Column) -> Column:
    """Share of online readings among all readings, unknown ones included."""
    return pct(online, readings, 1).cast("decimal(5,1)")


def rating_category(rating: Column) -> Column:
    levels = [(rating >= F.lit(Decimal(bound)), label) for bound, label in RATING_LEVELS]
    return bucket([*levels, (rating > 0, "Poor")], "No Ratings")


def temperature_category(temperature: Column) -> Column:
    limits = [(temperature < F.lit(Decimal(bound)), label) for bound, label in TEMPERATURE_LIMITS]
    return bucket([*limits, (temperature.isNotNull(), "Hot")], "Unknown")


def availability_category(uptime: Column) -> Column:
    levels = [(uptime >= F.lit(Decimal(bound)), label) for bound, label in UPTIME_LEVELS]
    return bucket([(uptime == 100, "Always Online"), *levels, (uptime > 0, "Mostly Offline")], "Always Offline")


def rank_volatility(best: Column, worst: Column) -> Column:
    return F.round(worst - best, 2).cast("decimal(10,2)")


def daily_new_ratings(cumulative: Column, previous: Column) -> Column:
    """Growth since the previous record; the first record counts in full. May be negative."""
    return cumulative - F.coalesce(previous, F.lit(0))


def rating_delta(rating: Column, previous: Column) -> Column:
    return F.coalesce(F.round(rating - previous, 2), F.lit(Decimal("0.00"))).cast("decimal(4,2)")


def rating_trend(has_previous: Column, delta: Column) -> Column:
    """Trend from the sign of the rating change; ``delta`` is 0 or NULL when nothing is known."""
    return bucket(
        [(~has_previous, "new"), (delta > 0, "improving"), (delta < 0, "declining")],
        "stable",
    )


def is_offline_order_anomaly(snapshot: Column, actual: Column, uptime: Column) -> Column:
    """Orders on a day without known uptime; days without any reading qualify too."""
    sold = (F.coalesce(snapshot, F.lit(0)) > 0) | (F.coalesce(actual, F.lit(0)) > 0)
    return sold & (F.coalesce(uptime, F.lit(0)) == 0)


def is_high_failure_when_offline(uptime: Column, failure_rate: Column) -> Column:
    known = F.coalesce(uptime, F.lit(0))
    return (known > 0) & (known < LOW_UPTIME) & (F.coalesce(failure_rate, F.lit(0)) > HIGH_FAILURE_RATE)


def is_complete_day(hourly_records: Column) -> Column:
    return hourly_records == HOURS_PER_DAY


def has_valid_coordinates(latitude: Column, longitude: Column) -> Column:
    known = latitude.isNotNull() & longitude.isNotNull()
    return known & ~((latitude == 0) & (longitude == 0))

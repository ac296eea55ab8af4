"""Rollups give the reports of the fact, and a refreshed month is that of a rebuild."""

from __future__ import annotations

from datetime import date
from functools import partial

import pytest
from pyspark.sql import functions as F

from dailymart.plans import reports, rollup
from dailymart.plans.rollup import Rollup
from dailymart.sinks.lake import Lake


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def stored(small, tmp_path_factory):
    rollups = Rollup(Lake(small.spark, str(tmp_path_factory.mktemp("rollups"))), small.fact.schema)
    rollups.build(small.fact)
    return rollups


REPORTS = ["top_listings", "platform_comparison", "top_organizations", "monthly_trend", "top_outlets", "platform_outlets"]


@pytest.mark.parametrize("name", REPORTS)
def test_reports_equal_those_of_the_fact(small, stored, name):
    over_fact, over_months = getattr(reports, name)(small.fact), getattr(rollup, name)(stored.listing_months)
    assert over_months.dtypes == over_fact.dtypes
    assert rows(over_months) == rows(over_fact)


def test_days_without_orders_are_left_out_of_the_worst(small, stored):
    for limit in (0, 20, 100):
        found = partial(rollup.worst_listings, failed_above=limit)(stored.listing_months)
        assert rows(found) == rows(reports.worst_listings(small.fact, failed_above=limit))


def test_days_are_merged_from_bitmaps(small, stored, plan_of):
    merged = reports.merged_days(stored.day_parts)
    assert rows(merged) == rows(reports.daily_summary(small.fact))
    assert "rollup/day_parts" in plan_of(merged)


def test_bitmaps_count_every_id(spark):
    """Also ids below 0, at the borders of ranges, and the largest."""
    ids = [*range(-70_000, 70_001, 7), -32_769, -32_768, -1, 0, 1, 32_768, 32_769, 2**62, -(2**62)]
    wanted = len(set(ids))
    day = F.lit(date(2024, 1, 1)).alias("date")
    nothing = [F.lit(1).alias("daily_orders"), *[F.lit(None).cast("decimal(4,2)").alias(c) for c in reports.DAY_MEANS]]
    fact = spark.createDataFrame([(i,) for i in [*ids, *ids]], "listing_id long").select(day, "listing_id", *nothing)
    found = reports.daily_summary(fact).first()
    assert (found.active_listings, found.total_orders, found.avg_rating) == (wanted, 2 * len(ids), None)


def test_refresh_reads_and_writes_the_months_alone(small, tmp_path, plan_of):
    rollups = Rollup(Lake(small.spark, str(tmp_path)), small.fact.schema)
    first = date(2024, 1, 1)
    rollups.build(small.fact.where(F.col("month") != first))
    before = {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")}
    assert rollups.refresh(small.fact, [date(2024, 1, 9), date(2024, 1, 30)]) == [first]
    key = ["month", "listing_id"]
    assert rows(rollups.listing_months.select(*sorted(rollups.listing_months.columns)).orderBy(*key)) == rows(
        rollup.listing_months(small.fact).select(*sorted(rollups.listing_months.columns)).orderBy(*key)
    )
    assert all(f.stat().st_mtime_ns == t for f, t in before.items())
    assert "PartitionFilters: [" in plan_of(rollup.listing_months(small.fact.where(F.col("month").isin(first))))
    # All rows of a month withdrawn.
    assert rollups.refresh(small.fact.where("false"), [date(2024, 1, 9)]) == [first]
    assert rollups.listing_months.where(F.col("month") == first).count() == 0
    assert rollups.refresh(small.fact, []) == []


def test_an_empty_fact(small, spark, tmp_path):
    nothing = rollup.listing_months(small.fact.limit(0))
    assert rows(rollup.top_listings(nothing)) == rows(rollup.monthly_trend(nothing)) == []


def test_unrated_share(spark):
    fact = spark.createDataFrame([(3, "No Ratings"), (1, None), (12, "Good"), (None, "Poor")], "daily_orders int, rating_category string")
    found = reports.unrated_share(fact).first()
    assert (found.unrated_orders, found.total_orders, float(found.unrated_pct)) == (4, 16, 25.0)
    assert reports.unrated_share(fact.limit(0)).first().unrated_pct is None

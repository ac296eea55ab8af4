"""Staging, intermediate and mart models on literal rows, and invariants on the test tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal as D

import pytest

from dailymart.plans import intermediate, mart, staging
from dailymart.plans.models import LAYERS, Models
from dailymart.schemas import RAW

T0 = datetime(2024, 1, 1)


def raw(spark, table, rows):
    return spark.createDataFrame([(*r, T0) for r in rows], RAW[table])


def test_orders_are_normalised_and_deduplicated(spark):
    df = raw(
        spark,
        "orders",
        [(1, 10, datetime(2024, 1, 1, 23, 59), "  Completed "), (1, 10, datetime(2024, 1, 1), "pending"), (2, 11, None, None)],
    )
    found = {r.order_id: (r.order_date, r.status) for r in staging.stg_orders(df).collect()}
    assert found == {10: (date(2024, 1, 1), "completed"), 11: (None, None)}


def test_snapshot_clamp(spark):
    day = date(2024, 1, 1)
    df = raw(spark, "orders_daily", [(day, 1, -4, T0), (day, 2, None, T0), (day, 3, 6, T0), (day, 3, 9, None)])
    assert {r.listing_id: r.daily_orders for r in staging.stg_orders_daily(df).collect()} == {1: 0, 2: None, 3: 9}


def test_latest_rating_without_count_removes_the_day(spark):
    day = date(2024, 1, 1)
    rows = [(day, 1, 5, D("4.0"), T0), (day, 1, 0, D("3.0"), datetime(2024, 1, 2)), (day, 2, 3, D("-1.0"), T0)]
    rows += [(day, 3, 3, D("7.5"), T0), (day, 4, None, D("1.0"), T0), (day, 5, 2, None, T0)]
    df = spark.createDataFrame(rows, RAW["ratings_agg"])
    found = {r.listing_id: r.avg_rating for r in staging.stg_ratings_agg(df).collect()}
    assert found == {2: D("0.00"), 3: D("5.00"), 5: None}


def test_platform_and_rank_keep_duplicates(spark):
    platforms = raw(spark, "platform", [(1, "Delivery", "p", "US")] * 2)
    assert staging.stg_platform(platforms).count() == 2
    readings = raw(spark, "rank", [(1, date(2024, 1, 1), T0, False, None)] * 2)
    assert staging.stg_rank(readings).count() == 2


@pytest.mark.parametrize(("hours", "missing", "complete"), [(24, 0, True), (23, 0, False), (48, 0, False), (24, 1, False)])
def test_complete_weather_day(spark, hours, missing, complete):
    rows = [
        (1, T0 + timedelta(hours=h % 24), None if h < missing else D("10.00") + h, 50, D("1.00")) for h in range(hours)
    ]
    weather = raw(spark, "weather", rows)
    row = staging.stg_weather(weather).first()
    assert (row.is_complete_day, row.hourly_records_count) == (complete, hours - missing)
    deduped = staging.stg_weather(staging.dedupe_hours(weather)).first()
    assert deduped.hourly_records_count == min(hours, 24) - missing


def readings(spark, states):
    rows = [(1, date(2024, 1, 1), T0, s, D(i + 1) if s else None) for i, s in enumerate(states)]
    return intermediate.int_rank_daily_avg(staging.stg_rank(raw(spark, "rank", rows))).first()


def test_rank_days(spark):
    online = readings(spark, [True] * 4)
    assert (online.avg_rank, online.best_rank, online.worst_rank, online.rank_volatility) == (
        D("2.50"),
        D("1.00"),
        D("4.00"),
        D("3.00"),
    )
    assert (online.uptime_percentage, online.availability_category) == (D("100.0"), "Always Online")
    offline = readings(spark, [False] * 3)
    assert (offline.avg_rank, offline.was_ever_online, offline.availability_category) == (
        D("0.00"),
        False,
        "Always Offline",
    )
    unknown = readings(spark, [None, True])
    assert (unknown.total_readings, unknown.online_readings, unknown.offline_readings) == (2, 1, 0)
    assert unknown.uptime_percentage == D("50.0")
    assert readings(spark, [None]).was_ever_online is None
    assert readings(spark, [True] + [False] * 15).uptime_percentage == D("6.3")


def test_rating_changes(spark):
    days = [date(2024, 1, d) for d in (1, 5, 6, 7, 8)]
    counts, ratings = [10, 14, 12, 12, 13], ["3.00", "4.25", "4.25", "1.50", None]
    rows = [(d, 1, c, None if r is None else D(r)) for d, c, r in zip(days, counts, ratings, strict=True)]
    staged = staging.stg_ratings_agg(raw(spark, "ratings_agg", rows))
    found = [
        (r.daily_new_ratings, r.rating_delta, r.rating_trend)
        for r in intermediate.int_ratings_metrics(staged).orderBy("date").collect()
    ]
    assert found == [
        (10, D("0.00"), "new"),
        (4, D("1.25"), "improving"),
        (-2, D("0.00"), "stable"),
        (0, D("-2.75"), "declining"),
        (1, D("0.00"), "stable"),
    ]


def tiny(spark):
    day, later = date(2024, 1, 1), date(2024, 1, 2)
    tables = {
        "listing": [(1, 5, 7, T0), (2, 6, 8, T0), (3, 5, 7, T0)],
        "outlet": [(5, 9, "five", D("1.0"), D("2.0"), T0)],
        "org": [(9, " nine ", T0)],
        "platform": [(7, "Delivery", "p7", "US")],
        "orders": [(1, 100, datetime(2024, 1, 1, 5), "completed"), (99, 101, datetime(2024, 1, 1, 5), "completed")]
        + [(1, 102, datetime(2024, 1, 9, 5), "pending"), (3, 103, datetime(2024, 1, 2), "Refunded")],
        "orders_daily": [(day, 1, 1, T0), (later, 2, None, T0)],
        "rank": [(2, day, T0, False, None)],
        "ratings_agg": [(later, 1, 4, D("4.50"))],
        "weather": [(5, T0 + timedelta(hours=h), D("12.00"), 40, D("3.00")) for h in range(24)],
    }
    return Models({name: raw(spark, name, rows) for name, rows in tables.items()})


def test_fact_rows(spark):
    fact = {(r.listing_id, r.date.day): r for r in tiny(spark).fact.collect()}
    # No row for the unknown listing 99, for the 9th (no snapshot that day) or for an empty snapshot alone.
    assert sorted(fact) == [(1, 1), (1, 2), (2, 1), (3, 2)]
    first = fact[1, 1]
    assert (first.data_quality_flag, first.daily_orders, first.org_name, first.weather_data_complete) == (
        "match",
        1,
        "nine",
        True,
    )
    assert (first.temperature_category, first.rating_category, first.availability_category) == (
        "Mild",
        "No Ratings",
        "No Data",
    )
    assert (first.is_offline_order_anomaly, first.avg_rank, first.rating_trend) == (True, None, "No Ratings")
    rated = fact[1, 2]
    assert (rated.rating_category, rated.rating_trend, rated.daily_new_ratings) == ("Excellent", "new", 4)
    assert (rated.temperature_category, rated.data_quality_flag) == ("Unknown", "snapshot_missing")
    offline = fact[2, 1]
    assert (offline.avg_rank, offline.availability_category, offline.outlet_name, offline.platform_name) == (
        D("0.00"),
        "Always Offline",
        None,
        None,
    )
    failed = fact[3, 2]
    assert (failed.refunded_orders, failed.failed_orders, failed.order_failure_rate) == (1, 1, D("100.0"))


def test_duplicate_platform_doubles_the_fact(spark):
    models = tiny(spark)
    before = models.fact.count()
    doubled = Models({**models.raw, "platform": models.raw["platform"].union(models.raw["platform"])})
    assert doubled.fact.where("platform_id = 7").count() == 2 * models.fact.where("platform_id = 7").count()
    assert doubled.fact.where("platform_id = 8").count() == before - models.fact.where("platform_id = 7").count()


def test_enriched_orders_drop_incomplete_profiles(spark):
    assert [r.order_id for r in tiny(spark)["int_orders_enriched"].orderBy("order_id").collect()] == [100, 102, 103]


def test_fact_invariants(small):
    fact = small.fact
    assert fact.count() == fact.select("date", "listing_id").distinct().count()
    assert fact.count() == small.lazy.date_listing_spine().count()
    broken = "completed_orders + pending_orders + cancelled_orders + refunded_orders <> total_orders"
    assert fact.where(broken).count() == 0
    assert fact.where("successful_orders + failed_orders <> total_orders").count() == 0
    assert fact.where("data_quality_flag = 'snapshot_negative'").count() == 0


def test_fact_has_published_columns(small):
    assert small.lazy.fact.columns == mart.FACT_COLUMNS
    assert len(mart.FACT_COLUMNS) == 51 == len(set(mart.FACT_COLUMNS))


def test_layers():
    assert LAYERS["stg_orders"] == "staging" and LAYERS[mart.FACT] == "mart"


def test_without_shared_folder_nothing_is_stored(spark, monkeypatch):
    from conftest import SMALL

    from dailymart import workspace as module

    monkeypatch.setattr(module, "shared_folder", lambda _: None)
    space = module.Workspace(spark, SMALL)
    assert space.lake is None
    assert space.fact.columns == mart.FACT_COLUMNS
    assert space.checked["stg_org"].count() == 25
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        space.folder("files")


def test_stored_copies_follow_the_input_and_can_be_deleted(spark, tmp_path):
    from pathlib import Path
    from shutil import copyfile

    import pandas as pd
    from conftest import SMALL

    from dailymart.workspace import Workspace

    (tmp_path / "in").mkdir()
    for file in Path(SMALL).glob("*.parquet"):  # not copytree: it copies a read-only folder's mode
        copyfile(file, tmp_path / "in" / file.name)
    source = tmp_path / "in"
    space = Workspace(spark, str(source))
    before = space.fact.count()
    events = pd.read_parquet(f"{SMALL}/events.parquet")
    late = events.head(1).assign(event_id=events.event_id.max() // 11 * 11 + 12, user_id=events.user_id.max() + 1)
    pd.concat([events, late]).to_parquet(f"{source}/events.parquet", coerce_timestamps="us", allow_truncated_timestamps=True)
    assert space.fact.count() == before
    space.refresh()
    assert space.fact.count() == before + 1
    assert Path(space.results.root).exists()
    space.close()
    assert not Path(space.results.root).exists()
    assert space.fact.count() == before + 1
    space.close()


def test_a_shared_folder_leaves_the_session_alone(spark):
    from dailymart.session import shared_folder

    before = spark.sparkContext.getCheckpointDir()
    assert shared_folder(spark) == shared_folder(spark)
    assert spark.sparkContext.getCheckpointDir() == before

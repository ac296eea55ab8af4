"""The mart after some loads equals the mart computed from all rows, and a load leaves other periods alone."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dailymart.plans.models import Models
from dailymart.schemas import RAW
from dailymart.sinks.incremental import IncrementalMart
from dailymart.sinks.lake import Lake

T0 = datetime(2024, 6, 1)


def frame(spark, table, rows):
    return spark.createDataFrame(rows, RAW[table])


def dimensions(spark):
    rows = {
        "listing": [(i, 1 + i % 2, 1, T0, T0) for i in range(1, 6)],
        "outlet": [(1, 1, "one", None, None, T0, T0), (2, 1, "two", None, None, T0, T0)],
        "org": [(1, "org", T0, T0)],
        "platform": [(1, "Delivery", "p", "US", T0)],
    }
    return {t: frame(spark, t, r) for t, r in rows.items()}


def some_rows(rng, stamp):
    """Rows of all dated tables over four months; keys come again in later loads."""
    day = lambda: date(2024, 1, 1) + timedelta(days=rng.randrange(120))
    at = lambda: rng.choice([None, *[datetime.combine(day(), datetime.min.time())] * 9])
    status = ["completed", "pending", "cancelled"]
    return {
        "orders": [(rng.randrange(1, 6), rng.randrange(60), at(), rng.choice(status), stamp) for _ in range(20)],
        "orders_daily": [(day(), rng.randrange(1, 6), rng.randrange(5), stamp, stamp) for _ in range(25)],
        "rank": [(rng.randrange(1, 6), day(), stamp, True, None, stamp) for _ in range(6)],
        "ratings_agg": [(day(), rng.randrange(1, 6), rng.randrange(0, 4) * 5, None, stamp) for _ in range(12)],
        "weather": [(rng.randrange(1, 3), at(), None, 50, None, stamp) for _ in range(5)],
    }


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_loads_add_up_to_a_rebuild(spark, tmp_path):
    rng = random.Random(1)
    mart = IncrementalMart(Lake(spark, str(tmp_path)), dimensions(spark))
    every = {t: [] for t in ("orders", "orders_daily", "rank", "ratings_agg", "weather")}
    for number in range(3):
        new = some_rows(rng, T0 + timedelta(hours=number))
        chosen = list(every) if number == 0 else rng.sample(list(every), 2)
        mart.load(f"load{number}", {t: frame(spark, t, new[t]) for t in chosen})
        for t in chosen:
            every[t] += new[t]
        whole = Models({**mart.dimensions, **{t: frame(spark, t, r) for t, r in every.items()}}).fact
        assert rows(mart.fact.select(*whole.columns)) == rows(whole), number
    before = rows(mart.fact)
    mart.load(f"load{number}", {t: frame(spark, t, new[t]) for t in chosen})  # again, under the same id
    assert rows(mart.fact) == before
    mart.rebuild()
    assert rows(mart.fact) == before


@pytest.fixture
def months(spark, tmp_path):
    """Ratings of listing 1 in January, February and April, of listing 2 in March; orders in each month."""
    mart = IncrementalMart(Lake(spark, str(tmp_path)), dimensions(spark))
    days = [date(2024, m, 10) for m in (1, 2, 3, 4, 5)]
    rated = [(1, 1), (2, 1), (3, 2), (4, 1)]
    mart.load(
        "all",
        {
            "orders": frame(spark, "orders", [(1, m, datetime(2024, m, 10), "completed", T0) for m in range(1, 6)]),
            "orders_daily": frame(spark, "orders_daily", [(d, i, 1, T0, T0) for d in days for i in (1, 2)]),
            "ratings_agg": frame(spark, "ratings_agg", [(date(2024, m, 10), i, m * 10, None, T0) for m, i in rated]),
        },
    )
    return mart, tmp_path


def files(folder):
    return {f: f.stat().st_mtime_ns for f in folder.rglob("period=*/*.parquet")}


def first_days(*numbers):
    return [date(2024, m, 1) for m in numbers]


def test_a_late_rating_reaches_the_next_one_only(spark, months):
    mart, folder = months
    before = files(folder)
    later = T0 + timedelta(days=1)
    # The last of January changes: the next rating of listing 1 is in February, none is in between.
    assert mart.load("late", {"ratings_agg": frame(spark, "ratings_agg", [(date(2024, 1, 12), 1, 15, None, later)])}) == first_days(1, 2)
    fact = {(r.date.month, r.date.day): r for r in mart.fact.where("listing_id = 1").collect()}
    assert fact[1, 10].daily_new_ratings == 10 and (1, 12) not in fact  # no snapshot on the 12th
    assert fact[2, 10].daily_new_ratings == 5 and fact[4, 10].daily_new_ratings == 20
    added = {f for f in files(folder) if f not in before}
    assert {f.parent.name for f in added if "mart" in f.parts} == {"period=2024-01-01", "period=2024-02-01"}
    assert all(f.stat().st_mtime_ns == t for f, t in before.items() if f.exists())
    # Listing 2's next: none. A rating before the last of its month changes nothing later.
    assert mart.load("two", {"ratings_agg": frame(spark, "ratings_agg", [(date(2024, 3, 5), 2, 1, None, later)])}) == first_days(3)
    # Withdrawn: April's now follows January's.
    assert mart.load("gone", {"ratings_agg": frame(spark, "ratings_agg", [(date(2024, 2, 10), 1, 0, None, later)])}) == first_days(2, 4)
    assert mart.fact.where("listing_id = 1 and date = date'2024-04-10'").first().daily_new_ratings == 25


def test_a_later_version_moves_an_order(spark, months, plan_of):
    mart, folder = months
    before = files(folder)
    moved = frame(spark, "orders", [(1, 2, datetime(2024, 5, 10), "cancelled", T0 + timedelta(days=1))])
    assert mart.load("moved", {"orders": moved}) == first_days(2, 5)
    orders = {r.date.month: r.daily_orders for r in mart.fact.where("listing_id = 1").collect()}
    assert orders == {1: 1, 2: 0, 3: 1, 4: 1, 5: 2}
    assert {f.parent.name for f in files(folder) if f not in before and "orders" in f.parts} == {"period=2024-05-01"}
    # What a merge reads: stored orders of the periods, and slots of the index, nothing else.
    plan = plan_of(mart.stored("orders").where(F.col("period").isin(*first_days(2, 5))))
    assert "PartitionFilters: [period" in plan
    plan = plan_of(mart._known(moved))
    (filters,) = (line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "slot#" in filters and "incremental/orders/" not in plan


def test_an_order_without_a_date_waits_for_one(spark, months):
    mart, _ = months
    undated = frame(spark, "orders", [(1, 3, None, "pending", T0 + timedelta(days=1))])
    assert mart.load("undated", {"orders": undated}) == first_days(3)  # times that are missing win
    assert mart.fact.where("listing_id = 1 and date = date'2024-03-10'").first().daily_orders == 0


def test_a_big_period_is_dealt_to_several_tasks(spark, tmp_path):
    mart = IncrementalMart(Lake(spark, str(tmp_path)), dimensions(spark))
    at = lambda i: datetime(2024, 1, 1) + timedelta(minutes=i)
    many = {
        "orders": [(1, i, at(i), "completed", T0) for i in range(200)],
        "orders_daily": [(date(2024, 1, 1 + i % 20), i, 1, T0, T0) for i in range(200)],
        "rank": [(1, date(2024, 1, 1 + i % 20), at(i), True, None, T0) for i in range(200)],
        "ratings_agg": [(date(2024, 1, 1 + i % 20), i, 1, None, T0) for i in range(200)],
        "weather": [(1, at(60 * i), None, 50, None, T0) for i in range(200)],
    }
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mart.load("all", {t: frame(spark, t, r) for t, r in many.items()})
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    for table, every in many.items():
        (period,) = (tmp_path / "incremental" / table).rglob("period=2024-01-01")
        assert len(list(period.glob("*.parquet"))) > 1, table
        assert rows(mart.stored(table).select(*RAW[table].names)) == rows(frame(spark, table, every))


def test_of_several_versions_in_one_load_the_latest_counts_and_leaves_other_periods_alone(spark, months):
    mart, _ = months
    versions = [(1, 9, datetime(2024, m, 10), "completed", T0) for m in (3, 4, 5)]
    assert mart.load("versions", {"orders": frame(spark, "orders", versions)}) == first_days(5)
    assert mart.stored("orders").where("order_id = 9").count() == 1
    known = mart._known(frame(spark, "orders", versions)).collect()
    assert [(r.order_id, r.period) for r in known] == [(9, date(2024, 5, 1))]


def test_mistakes(spark, tmp_path):
    with pytest.raises(ValueError, match="calendar"):
        IncrementalMart(Lake(spark, str(tmp_path)), {}, period="fortnight")

"""The daily fact: one row per listing and date with any source present.

The published definition crosses all snapshot dates with all listings, joins every source and drops the
empty rows. Here the rows come from the sources themselves, so work follows the data instead of
days x listings: each source is reduced to one narrow row per (listing, date) behind its own shuffle on
that key, the four results are stacked and folded without another shuffle (a union keeps a
partitioning its inputs share), and the fold is restricted to known listings and snapshot dates.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailymart.functions import rules
from dailymart.operators import Hot, salted_join
from dailymart.plans.intermediate import DAY_KEYS

FACT = "fct_daily_business_performance"


def daily_measures(
    snapshots: DataFrame, outcomes: DataFrame, ratings: DataFrame, ranks: DataFrame
) -> DataFrame:
    """All measures per listing and date, NULL where a source has no row.

    Arguments are stg_orders_daily, orders_by_status, int_ratings_metrics and int_rank_daily_avg, each
    with at most one row per key, so ``max`` only picks the value. Text columns are left out and derived
    again afterwards: fixed-width buffers keep this a hash aggregation. Ratings come clustered by
    listing alone and are brought to the common partitioning first.
    """
    sources = [
        outcomes,
        ranks.drop("availability_category"),
        snapshots.select(*DAY_KEYS, F.col("daily_orders").alias("snapshot_orders")),
        ratings.withColumn("had_rating_before", F.col("rating_trend") != "new")
        .drop("rating_trend")
        .repartition(*DAY_KEYS),
    ]
    first, *rest = sources
    stacked = first
    for source in rest:
        stacked = stacked.unionByName(source, allowMissingColumns=True)
    measures = [c for source in sources for c in source.columns if c not in DAY_KEYS]
    folded = stacked.groupBy(*DAY_KEYS).agg(*[F.max(c).alias(c) for c in measures])
    present = ["snapshot_orders", "total_orders", "cumulative_rating_count", "total_readings"]
    return folded.where(F.coalesce(*[F.col(c).cast("bigint") for c in present]).isNotNull())


def on_spine(measures: DataFrame, snapshot_dates: DataFrame) -> DataFrame:
    """Keep dates that have any snapshot row.

    Distinct dates are bounded by the calendar (years 1 to 9999 are 3.65 million days, some 30 MB),
    whatever the size of the data, so this side may always be broadcast.
    """
    dates = snapshot_dates.select("date").where(F.col("date").isNotNull()).distinct()
    return measures.join(F.broadcast(dates), "date", "left_semi")


def date_listing_spine(
    snapshots: DataFrame,
    outcomes: DataFrame,
    ratings: DataFrame,
    ranks: DataFrame,
    listing: DataFrame,
    snapshot_dates: DataFrame | None = None,
) -> DataFrame:
    """Keys of the fact: (date, listing) pairs of the spine with at least one source present."""
    dates = snapshots if snapshot_dates is None else snapshot_dates
    keys = on_spine(daily_measures(snapshots, outcomes, ratings, ranks), dates).select("date", "listing_id")
    return keys.join(listing.select("listing_id").distinct(), "listing_id", "left_semi").select("date", "listing_id")


def fct_daily(
    snapshots: DataFrame,
    outcomes: DataFrame,
    ratings: DataFrame,
    ranks: DataFrame,
    profile: DataFrame,
    weather: DataFrame,
    snapshot_dates: DataFrame | None = None,
    listing: DataFrame | Hot | None = None,
) -> DataFrame:
    """The 51-column fact from the staged sources.

    ``profile`` is the left :func:`listing_profile`, ``weather`` is stg_weather. ``snapshot_dates`` may
    be the raw snapshot table: deduplication never removes a date.

    A listing has at most one folded row per date, so the profile join cannot be skewed. The weather
    join can: one outlet may own many listings, which share its daily weather row. Hot outlets are given, or found
    by their listings in ``listing``, by default in the days themselves.

    Weather by day grows with outlets x dates, but Spark takes rows that come out of an ``explode`` for as many as went in
    and would broadcast it: it is asked to merge instead.
    """
    dates = snapshots if snapshot_dates is None else snapshot_dates
    days = day_columns(on_spine(daily_measures(snapshots, outcomes, ratings, ranks), dates))
    described = days.join(profile, "listing_id", "inner")
    daily_weather = weather.select(
        "outlet_id",
        "date",
        *WEATHER_COLUMNS,
        F.col("is_complete_day").alias("weather_data_complete"),
        rules.temperature_category(F.col("avg_temperature")).alias("temperature_category"),
    )
    joined = salted_join(
        described,
        daily_weather,
        ["outlet_id", "date"],
        "left",
        spread=["listing_id"],
        hot_from=listing,
        hint="merge",
    )
    return joined.withColumns(
        {
            "weather_data_complete": F.coalesce("weather_data_complete", F.lit(False)),
            "temperature_category": F.coalesce("temperature_category", F.lit("Unknown")),
        }
    ).select(*FACT_COLUMNS)


def day_columns(measures: DataFrame) -> DataFrame:
    """Published columns that need no dimension and no weather.

    Computed right after the fold and carried through the joins, so that the code Spark generates for
    the join stages only moves columns and stays small enough for the JIT compiler.
    """
    snapshot, actual = F.col("snapshot_orders"), F.col("total_orders")
    uptime, failure_rate = F.col("uptime_percentage"), F.col("order_failure_rate")
    rating = _or_zero("avg_rating", "decimal(3,2)")
    trend = rules.rating_trend(F.col("had_rating_before"), F.col("rating_delta"))
    counts = [f"{outcome}_orders" for outcome in (*rules.ORDER_STATUSES, "successful", "failed", "total")]
    columns = {name: _or_zero(name) for name in counts} | {
        "daily_orders_from_snapshot": _or_zero("snapshot_orders"),
        "daily_orders": _or_zero("total_orders"),
        "data_quality_flag": rules.data_quality_flag(snapshot, actual),
        "snapshot_vs_actual_diff": rules.snapshot_vs_actual_diff(snapshot, actual),
        "order_failure_rate": _or_zero("order_failure_rate", "decimal(5,1)"),
        "daily_new_ratings": _or_zero("daily_new_ratings"),
        "cumulative_rating_count": _or_zero("cumulative_rating_count"),
        "avg_rating": rating,
        "rating_delta": _or_zero("rating_delta", "decimal(4,2)"),
        "rating_trend": F.when(F.col("cumulative_rating_count").isNotNull(), trend).otherwise(F.lit("No Ratings")),
        "avg_rank": F.col("avg_rank"),
        "daily_best_rank": F.col("best_rank"),
        "daily_worst_rank": F.col("worst_rank"),
        "rank_volatility": F.col("rank_volatility"),
        "rank_total_readings": _or_zero("total_readings"),
        "rank_online_readings": _or_zero("online_readings"),
        "rank_offline_readings": _or_zero("offline_readings"),
        "uptime_percentage": _or_zero("uptime_percentage", "decimal(5,1)"),
        "was_ever_online": F.coalesce(F.col("was_ever_online"), F.lit(False)),
        "availability_category": F.when(uptime.isNull(), F.lit("No Data")).otherwise(
            rules.availability_category(uptime)
        ),
        "rating_category": rules.rating_category(rating),
        "is_offline_order_anomaly": rules.is_offline_order_anomaly(snapshot, actual, uptime),
        "is_high_failure_when_offline": rules.is_high_failure_when_offline(uptime, failure_rate),
    }
    return measures.select(*DAY_KEYS, *[c.alias(name) for name, c in columns.items()])


def _or_zero(name: str, kind: str = "bigint") -> Column:
    zero = F.lit(0) if kind == "bigint" else F.lit(Decimal(0))
    return F.coalesce(F.col(name).cast(kind), zero.cast(kind))


WEATHER_COLUMNS = ["avg_temperature", "avg_humidity", "avg_wind_speed", "min_temperature", "max_temperature"]

# The 51 published columns in published order.
FACT_COLUMNS = """
date listing_id listing_timestamp
outlet_id outlet_name latitude longitude has_valid_coordinates
org_id org_name
platform_id platform_name platform_group platform_country
daily_orders_from_snapshot daily_orders total_orders
data_quality_flag snapshot_vs_actual_diff
completed_orders pending_orders cancelled_orders refunded_orders
successful_orders failed_orders order_failure_rate
daily_new_ratings cumulative_rating_count avg_rating rating_delta rating_trend
avg_rank daily_best_rank daily_worst_rank rank_volatility
rank_total_readings rank_online_readings rank_offline_readings
uptime_percentage was_ever_online availability_category
avg_temperature avg_humidity avg_wind_speed min_temperature max_temperature weather_data_complete
rating_category temperature_category
is_offline_order_anomaly is_high_failure_when_offline
""".split()

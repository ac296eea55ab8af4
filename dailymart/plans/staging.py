"""Staging models: raw tables deduplicated, renamed and cleaned."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailymart.functions import clamp, exact_avg, rules
from dailymart.operators import latest_per_key
from dailymart.schemas import LOADED_AT


def stg_listing(raw: DataFrame) -> DataFrame:
    """One row per listing, the latest."""
    latest = latest_per_key(raw, ["id"], ["timestamp", LOADED_AT])
    return latest.select(
        F.col("id").alias("listing_id"),
        "outlet_id",
        "platform_id",
        F.col("timestamp").alias("listing_timestamp"),
        LOADED_AT,
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    """One row per order, the latest, with its date and a normalised status."""
    latest = latest_per_key(raw, ["order_id"], ["placed_at", LOADED_AT])
    return latest.select(
        "order_id",
        "listing_id",
        "placed_at",
        F.to_date("placed_at").alias("order_date"),
        F.lower(F.trim("status")).alias("status"),
        LOADED_AT,
    )


def stg_orders_daily(raw: DataFrame) -> DataFrame:
    """One row per date and listing, the latest; negative counts become 0."""
    latest = latest_per_key(raw, ["listing_id", "date"], ["timestamp", LOADED_AT])
    return latest.select("date", "listing_id", clamp("orders", lo=0).alias("daily_orders"), "timestamp", LOADED_AT)


def stg_org(raw: DataFrame) -> DataFrame:
    """One row per organization, the latest, with a trimmed name."""
    latest = latest_per_key(raw, ["id"], ["timestamp", LOADED_AT])
    return latest.select(
        F.col("id").alias("org_id"),
        F.trim("name").alias("org_name"),
        F.col("timestamp").alias("org_timestamp"),
        LOADED_AT,
    )


def stg_outlet(raw: DataFrame) -> DataFrame:
    """One row per outlet, the latest, with a coordinate flag."""
    latest = latest_per_key(raw, ["id"], ["timestamp", LOADED_AT])
    return latest.select(
        F.col("id").alias("outlet_id"),
        "org_id",
        F.col("name").alias("outlet_name"),
        "latitude",
        "longitude",
        rules.has_valid_coordinates(F.col("latitude"), F.col("longitude")).alias("has_valid_coordinates"),
        F.col("timestamp").alias("outlet_timestamp"),
        LOADED_AT,
    )


def stg_platform(raw: DataFrame) -> DataFrame:
    """Renamed only; duplicates stay."""
    return raw.select(
        F.col("id").alias("platform_id"),
        F.col("group").alias("platform_group"),
        F.col("name").alias("platform_name"),
        F.col("country").alias("platform_country"),
        LOADED_AT,
    )


def stg_rank(raw: DataFrame) -> DataFrame:
    """Renamed only; offline readings and duplicates stay."""
    return raw.select(
        "listing_id",
        "date",
        F.col("timestamp").alias("rank_timestamp"),
        "is_online",
        "rank",
        LOADED_AT,
    )


def stg_ratings_agg(raw: DataFrame) -> DataFrame:
    """One row per date and listing, the last loaded, ratings limited to 0..5.

    The count filter runs after the choice: a latest row without ratings removes the key, an older row
    does not replace it.
    """
    latest = latest_per_key(raw, ["listing_id", "date"], [LOADED_AT])
    rating = clamp("avg_rating", Decimal("0.00"), Decimal("5.00")).cast("decimal(3,2)")
    return latest.where(F.col("cnt_ratings") > 0).select(
        "date",
        "listing_id",
        F.col("cnt_ratings").alias("rating_count"),
        rating.alias("avg_rating"),
        LOADED_AT,
    )


def stg_weather(raw: DataFrame) -> DataFrame:
    """Hourly rows with a temperature, aggregated per outlet and date."""
    hourly = raw.where(F.col("temperature_2m").isNotNull()).withColumn("date", F.to_date("datetime"))
    daily = hourly.groupBy("outlet_id", "date").agg(
        exact_avg("temperature_2m", 2).alias("avg_temperature"),
        exact_avg("relative_humidity_2m", 2).alias("avg_humidity"),
        exact_avg("wind_speed_10m", 2).alias("avg_wind_speed"),
        F.min("temperature_2m").alias("min_temperature"),
        F.max("temperature_2m").alias("max_temperature"),
        F.count("*").alias("hourly_records_count"),
    )
    return daily.withColumn("is_complete_day", rules.is_complete_day(F.col("hourly_records_count")))


def dedupe_hours(raw_weather: DataFrame) -> DataFrame:
    """Optional step before :func:`stg_weather`: one row per outlet and hour, the last loaded.

    Off by default, because loading an outlet twice makes its days incomplete by definition.
    """
    return latest_per_key(raw_weather, ["outlet_id", "datetime"], [LOADED_AT])


STAGING = {
    "stg_listing": (stg_listing, "listing"),
    "stg_orders": (stg_orders, "orders"),
    "stg_orders_daily": (stg_orders_daily, "orders_daily"),
    "stg_org": (stg_org, "org"),
    "stg_outlet": (stg_outlet, "outlet"),
    "stg_platform": (stg_platform, "platform"),
    "stg_rank": (stg_rank, "rank"),
    "stg_ratings_agg": (stg_ratings_agg, "ratings_agg"),
    "stg_weather": (stg_weather, "weather"),
}

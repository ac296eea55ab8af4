"""Intermediate models: enriched orders, daily ranks, rating changes, daily order outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailymart.functions import avg_where, count_where, rules
from dailymart.operators import Hot, prev_by, salted_join

DAY_KEYS = ["listing_id", "date"]


def listing_profile(
    listing: DataFrame,
    outlet: DataFrame,
    org: DataFrame,
    platform: DataFrame,
    how: str,
    hot_outlets: Hot | None = None,
    hot_platforms: Hot | None = None,
) -> DataFrame:
    """Listing with its outlet, organization and platform attributes (``how``: inner or left).

    Built once at listing grain, so the day- and order-grain tables carry out one dimension join
    instead of four. Every platform has very many listings, so that join is salted, and so is the one by outlet if
    an outlet has many; the hot keys are those of the listings. Outlets by organization are few: adaptive execution
    splits what is skewed there. Platforms are not unique: a doubled platform doubles its listings.
    """
    owned = outlet.select(
        "outlet_id", "org_id", "outlet_name", "latitude", "longitude", "has_valid_coordinates"
    ).join(org.select("org_id", "org_name"), "org_id", how)
    placed = salted_join(
        listing.select("listing_id", "listing_timestamp", "outlet_id", "platform_id"),
        owned,
        ["outlet_id"],
        how,
        spread=["listing_id"],
        hot_from=hot_outlets,
    )
    return salted_join(
        placed,
        platform.select("platform_id", "platform_name", "platform_group", "platform_country"),
        ["platform_id"],
        how,
        spread=["listing_id"],
        hot_from=listing if hot_platforms is None else hot_platforms,
    )


def int_orders_enriched(orders: DataFrame, profile: DataFrame, counted: DataFrame | Hot | None = None) -> DataFrame:
    """Orders with all attributes of their listing; orders without a full profile are dropped.

    ``profile`` is the inner :func:`listing_profile`. ``counted`` are rows to find hot listings in (the raw
    orders, a superset, save deduplicating twice), or the hot listings.
    """
    joined = salted_join(
        orders.select("order_id", "order_date", "placed_at", "status", "listing_id"),
        profile,
        ["listing_id"],
        "inner",
        spread=["order_id"],
        hot_from=counted,
    )
    return joined.select(
        "order_id",
        "order_date",
        "placed_at",
        "status",
        "listing_id",
        "listing_timestamp",
        "outlet_id",
        "outlet_name",
        "latitude",
        "longitude",
        "has_valid_coordinates",
        "org_id",
        "org_name",
        "platform_id",
        "platform_name",
        "platform_group",
        "platform_country",
    )


def int_rank_daily_avg(ranks: DataFrame) -> DataFrame:
    """Rank statistics over online readings (0 when there are none), uptime and availability per day."""
    online = F.col("is_online")
    zero = F.lit(0).cast("decimal(10,2)")
    daily = ranks.groupBy(*DAY_KEYS).agg(
        F.coalesce(avg_where("rank", online, 2), zero).cast("decimal(10,2)").alias("avg_rank"),
        F.coalesce(F.min(F.when(online, F.col("rank"))), zero).alias("best_rank"),
        F.coalesce(F.max(F.when(online, F.col("rank"))), zero).alias("worst_rank"),
        F.count("*").alias("total_readings"),
        count_where(online).alias("online_readings"),
        count_where(~online).alias("offline_readings"),
        F.bool_or("is_online").alias("was_ever_online"),
    )
    uptime = rules.uptime_percentage(F.col("online_readings"), F.col("total_readings"))
    return (
        daily.withColumn("rank_volatility", rules.rank_volatility(F.col("best_rank"), F.col("worst_rank")))
        .withColumn("uptime_percentage", uptime)
        .withColumn("availability_category", rules.availability_category(F.col("uptime_percentage")))
        .select(
            *DAY_KEYS,
            "avg_rank",
            "best_rank",
            "worst_rank",
            "rank_volatility",
            "total_readings",
            "online_readings",
            "offline_readings",
            "uptime_percentage",
            "was_ever_online",
            "availability_category",
        )
    )


def int_ratings_metrics(ratings: DataFrame) -> DataFrame:
    """New ratings, rating change and trend against the previous record of the listing."""
    with_previous = prev_by(
        ratings, ["listing_id"], "date", {"previous_count": "rating_count", "previous_rating": "avg_rating"}
    )
    zero = F.lit(0).cast("decimal(3,2)")
    delta = rules.rating_delta(F.col("avg_rating"), F.col("previous_rating"))
    return with_previous.select(
        "date",
        "listing_id",
        rules.daily_new_ratings(F.col("rating_count"), F.col("previous_count")).alias("daily_new_ratings"),
        F.col("rating_count").alias("cumulative_rating_count"),
        F.coalesce(F.col("avg_rating"), zero).alias("avg_rating"),
        delta.alias("rating_delta"),
        rules.rating_trend(F.col("previous_rating").isNotNull(), delta).alias("rating_trend"),
    )


def orders_by_status(orders: DataFrame) -> DataFrame:
    """Orders per listing and day by outcome; an unknown status counts in the total only."""
    status = F.col("status")
    daily = orders.groupBy("listing_id", F.col("order_date").alias("date")).agg(
        F.count("*").alias("total_orders"),
        *[count_where(status == s).alias(f"{s}_orders") for s in rules.ORDER_STATUSES],
    )
    failed = F.col("cancelled_orders") + F.col("refunded_orders")
    return daily.select(
        "date",
        "listing_id",
        "total_orders",
        "completed_orders",
        "pending_orders",
        "cancelled_orders",
        "refunded_orders",
        (F.col("completed_orders") + F.col("pending_orders")).alias("successful_orders"),
        failed.alias("failed_orders"),
        rules.order_failure_rate(failed, F.col("total_orders")).alias("order_failure_rate"),
    )

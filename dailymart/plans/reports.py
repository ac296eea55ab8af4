"""Analyst reports over the daily fact. Each takes the fact and returns a small DataFrame."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailymart.functions import (
    avg_where,
    count_where,
    domain_order,
    exact_avg,
    mean,
    mean_ratio,
    month_of,
    pct,
    rules,
    safe_corr,
    weekday_label,
)
from dailymart.operators import share_of_total, top_k

LISTING = ["listing_id", "outlet_name", "org_name", "platform_name"]


def _orders(name: str = "total_orders") -> Column:
    return F.sum("daily_orders").alias(name)


def _avg(column: str, digits: int, name: str) -> Column:
    return exact_avg(column, digits).alias(name)


def _avg_rated(name: str) -> Column:
    """Average rating over rated days only."""
    return avg_where("avg_rating", F.col("avg_rating") > 0, 2).alias(name)


def _since(fact: DataFrame, first: Column | date) -> DataFrame:
    """Rows from ``first`` on. A stored fact also names the month, which prunes its folders."""
    first = F.lit(first) if isinstance(first, date) else first
    rows = fact.where(F.col("date") >= first)
    return rows.where(F.col("month") >= month_of(first)) if "month" in fact.columns else rows


_FAILURE = ("order_failure_rate", 1, "avg_failure_rate")
_UPTIME = ("uptime_percentage", 1, "avg_uptime")


def overall_summary(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.countDistinct("date").alias("total_days"),
        F.countDistinct("listing_id").alias("total_listings"),
        _orders(),
        _avg("daily_orders", 2, "avg_daily_orders_per_listing"),
        F.sum("successful_orders").alias("total_successful_orders"),
        F.sum("failed_orders").alias("total_failed_orders"),
        _avg("order_failure_rate", 2, "avg_failure_rate"),
        _avg("avg_rating", 2, "overall_avg_rating"),
        _avg("uptime_percentage", 1, "avg_uptime_percentage"),
    )


def top_listings(fact: DataFrame, k: int = 10) -> DataFrame:
    totals = fact.groupBy(*LISTING).agg(
        _orders(), _avg("avg_rating", 2, "avg_rating"), _avg(*_UPTIME), _avg(*_FAILURE)
    )
    return top_k(totals, [F.col("total_orders").desc_nulls_first()], k, LISTING)


def platform_comparison(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("platform_name")
        .agg(
            F.countDistinct("listing_id").alias("num_listings"),
            _orders(),
            _avg("daily_orders", 2, "avg_orders_per_day"),
            _avg(*_FAILURE),
            _avg_rated("avg_rating_when_rated"),
            _avg(*_UPTIME),
        )
        .orderBy(F.col("total_orders").desc_nulls_first(), "platform_name")
    )


def rating_impact(fact: DataFrame) -> DataFrame:
    """By rating category; ``total_orders`` also gives the unrated share of orders."""
    return (
        fact.groupBy("rating_category")
        .agg(
            F.count("*").alias("num_days"),
            _orders(),
            _avg("daily_orders", 2, "avg_daily_orders"),
            _avg(*_FAILURE),
            _avg("avg_rating", 2, "avg_rating_score"),
            _avg(*_UPTIME),
        )
        .orderBy(domain_order("rating_category", rules.RATING_CATEGORIES))
    )


def unrated_share(fact: DataFrame) -> DataFrame:
    """Orders on days without a rating and their share of all orders."""
    unrated = F.coalesce(F.col("rating_category") == "No Ratings", F.lit(True))
    once = fact.agg(F.sum(F.when(unrated, F.col("daily_orders")).otherwise(0)).alias("unrated_orders"), _orders())
    return once.withColumn("unrated_pct", pct(F.col("unrated_orders"), F.col("total_orders"), 1))


def weather_impact(fact: DataFrame) -> DataFrame:
    return (
        fact.where(F.col("temperature_category") != "Unknown")
        .groupBy("temperature_category")
        .agg(
            F.count("*").alias("num_days"),
            _avg("daily_orders", 2, "avg_daily_orders"),
            _avg("avg_temperature", 1, "avg_temp"),
            _avg(*_FAILURE),
        )
        .orderBy(domain_order("temperature_category", rules.TEMPERATURE_CATEGORIES))
    )


def availability_impact(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("availability_category")
        .agg(
            F.count("*").alias("num_days"),
            _avg("daily_orders", 2, "avg_daily_orders"),
            _avg(*_UPTIME),
            _avg(*_FAILURE),
            count_where(F.col("is_offline_order_anomaly")).alias("offline_order_anomalies"),
        )
        .orderBy(domain_order("availability_category", rules.AVAILABILITY_CATEGORIES))
    )


def top_organizations(fact: DataFrame, k: int = 10) -> DataFrame:
    totals = fact.groupBy("org_name").agg(
        F.countDistinct("listing_id").alias("num_listings"),
        _orders(),
        _avg("daily_orders", 2, "avg_orders_per_listing_day"),
        _avg(*_FAILURE),
        _avg_rated("avg_rating_score"),
        _avg(*_UPTIME),
    )
    return top_k(totals, [F.col("total_orders").desc_nulls_first()], k, ["org_name"])


def monthly_trend(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy(month_of("date").alias("month"))
        .agg(
            _orders(),
            _avg("daily_orders", 2, "avg_daily_orders"),
            _avg(*_FAILURE),
            _avg_rated("avg_rating"),
            _avg(*_UPTIME),
        )
        .orderBy("month")
    )


def issue_summary(fact: DataFrame) -> DataFrame:
    """Four issue counts and their share of all rows, counted in one pass and turned into rows."""
    # Published issue names.
    issues = {
        "Offline Order Anomalies": F.col("is_offline_order_anomaly"),
        "High Failure When Offline": F.col("is_high_failure_when_offline"),
        "Days Without Weather Data": F.col("avg_temperature").isNull(),
        "Days Without Rank Data": F.col("avg_rank").isNull(),
    }
    counted = [count_where(condition).alias(f"issue_{i}") for i, condition in enumerate(issues.values())]
    once = fact.agg(F.count("*").alias("total"), *counted)
    rows = [
        F.struct(
            F.lit(name).alias("issue_type"),
            F.col(f"issue_{i}").alias("occurrences"),
            pct(F.col(f"issue_{i}"), F.col("total"), 2).alias("pct_of_total"),
        )
        for i, name in enumerate(issues)
    ]
    return once.select(F.inline(F.array(*rows)))


def worst_listings(fact: DataFrame, failed_above: int = 100, k: int = 10) -> DataFrame:
    totals = (
        fact.where(F.col("daily_orders") > 0)
        .groupBy(*LISTING)
        .agg(
            _orders(),
            F.sum("failed_orders").alias("total_failed"),
            _avg(*_FAILURE),
            _avg(*_UPTIME),
            _avg_rated("avg_rating"),
        )
        .where(F.col("total_failed") > failed_above)
    )
    return top_k(totals, [F.col("avg_failure_rate").desc_nulls_first()], k, LISTING)


def quality_flag_distribution(fact: DataFrame) -> DataFrame:
    shares = share_of_total(fact, "data_quality_flag", 2, "records", "percentage")
    return shares.orderBy(F.col("records").desc(), "data_quality_flag")


def day_of_week(fact: DataFrame) -> DataFrame:
    day_number = (F.weekday("date") + 1).cast("bigint")
    return (
        fact.groupBy(weekday_label("date").alias("day_of_week"), day_number.alias("day_number"))
        .agg(
            F.count("*").alias("num_days"),
            _avg("daily_orders", 2, "avg_orders"),
            _avg(*_FAILURE),
            _orders(),
        )
        .orderBy("day_number")
    )


def problem_records(fact: DataFrame, k: int = 20) -> DataFrame:
    """Largest snapshot differences; listing and date settle ties."""
    suspicious = fact.where(~F.col("data_quality_flag").isin("match", "snapshot_missing")).select(
        "date",
        "listing_id",
        "daily_orders_from_snapshot",
        "daily_orders",
        "snapshot_vs_actual_diff",
        "data_quality_flag",
        "completed_orders",
        "pending_orders",
        "cancelled_orders",
    )
    return top_k(suspicious, [F.abs("snapshot_vs_actual_diff").desc_nulls_first()], k, ["date", "listing_id"])


def listing_history(fact: DataFrame, listing_id: int, since: date = date(2023, 1, 1)) -> DataFrame:
    """One listing over time; both conditions reach the Parquet scan."""
    return (
        _since(fact, since)
        .where(F.col("listing_id") == listing_id)
        .select(
            "date",
            "daily_orders",
            "order_failure_rate",
            "avg_rating",
            "rating_trend",
            "uptime_percentage",
            "availability_category",
            "avg_temperature",
            "temperature_category",
        )
        .orderBy("date")
    )


def correlation_matrix(fact: DataFrame) -> DataFrame:
    # Published names of the six pairs.
    pairs = {
        "orders_rating_corr": ("daily_orders", "avg_rating"),
        "orders_uptime_corr": ("daily_orders", "uptime_percentage"),
        "orders_temp_corr": ("daily_orders", "avg_temperature"),
        "orders_rank_corr": ("daily_orders", "avg_rank"),
        "failure_uptime_corr": ("order_failure_rate", "uptime_percentage"),
        "rating_failure_corr": ("avg_rating", "order_failure_rate"),
    }
    usable = fact.where(
        (F.col("daily_orders") > 0) & (F.col("avg_rating") > 0) & F.col("avg_temperature").isNotNull()
    )
    return usable.agg(*[safe_corr(x, y, 3).alias(name) for name, (x, y) in pairs.items()])


#: Means of the daily summary, by column of the fact.
DAY_MEANS = {"avg_rating": "avg_rating", "avg_temperature": "avg_temp"}


def day_parts(fact: DataFrame) -> DataFrame:
    """Per date and range of listing ids: the listings as one bitmap, sums and counts. Parts of a date can be merged.

    Rows of a date and a range are merged into one bitmap by every map task, so the shuffle carries short bitmaps,
    not (date, listing) pairs.
    """
    return fact.groupBy("date", F.bitmap_bucket_number("listing_id").alias("range")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("listing_id")).alias("listings"),
        _orders(),
        *[F.sum(c).alias(f"sum_{c}") for c in DAY_MEANS],
        *[F.count(c).alias(f"count_{c}") for c in DAY_MEANS],
    )


def merged_days(parts: DataFrame) -> DataFrame:
    """The daily summary from :func:`day_parts`, one part per date and range."""
    return (
        parts.groupBy("date")
        .agg(
            F.sum(F.bitmap_count("listings")).alias("active_listings"),
            F.sum("total_orders").alias("total_orders"),
            *[mean_ratio(F.sum(f"sum_{c}"), F.sum(f"count_{c}")).alias(name) for c, name in DAY_MEANS.items()],
        )
        .orderBy(F.col("date").desc())
    )


def daily_summary(fact: DataFrame, since: date | None = None) -> DataFrame:
    """Per date: active listings (counted exactly, as set bits), orders, mean rating and temperature, newest first."""
    return merged_days(day_parts(fact if since is None else _since(fact, since)))


def orders_by_date(fact: DataFrame, since: date = date(2023, 1, 1)) -> DataFrame:
    """The shorter daily overview, oldest first."""
    return daily_summary(fact, since).drop("active_listings").orderBy("date")


def _temperature_range(cold: str, mild: str, warm: str) -> Column:
    """Two limits, everything else (a missing temperature included) is ``warm``."""
    t = F.col("avg_temperature")
    return rules.bucket([(t < F.lit(Decimal(10)), cold), (t < F.lit(Decimal(20)), mild)], warm)


def temperature_buckets(fact: DataFrame) -> DataFrame:
    """Ad-hoc buckets without a guard: days without a temperature count as 'Warm'."""
    return fact.groupBy(_temperature_range("Cold", "Mild", "Warm").alias("temp_range")).agg(
        mean("daily_orders").alias("avg_orders")
    )


def temperature_buckets_known(fact: DataFrame) -> DataFrame:
    """The guarded variant: only days with a temperature."""
    # Published labels.
    label = _temperature_range("Cold (<10°C)", "Mild (10-20°C)", "Warm (>20°C)")
    return (
        fact.where(F.col("avg_temperature").isNotNull())
        .groupBy(label.alias("temperature_range"))
        .agg(F.count("*").alias("days"), mean("daily_orders").alias("avg_orders"))
        .orderBy(F.col("avg_orders").desc_nulls_first())
    )


def orders_by_temperature(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("temperature_category")
        .agg(mean("daily_orders").alias("avg_orders"))
        .orderBy(F.col("avg_orders").desc_nulls_first())
    )


def top_outlets(fact: DataFrame, k: int = 10) -> DataFrame:
    keys = ["outlet_name", "org_name"]
    totals = fact.groupBy(*keys).agg(
        _orders(), mean("avg_rating").alias("avg_rating"), mean("avg_rank").alias("avg_rank")
    )
    return top_k(totals, [F.col("total_orders").desc_nulls_first()], k, keys)


def layer_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per named table as one stacked result."""
    (name, first), *rest = tables.items()

    def counted(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")

    out = counted(name, first)
    for name, df in rest:
        out = out.unionByName(counted(name, df))
    return out


def latest_rows(fact: DataFrame, k: int = 20) -> DataFrame:
    sample = fact.select(
        "date",
        "listing_id",
        "outlet_name",
        "org_name",
        "platform_name",
        "daily_orders",
        "avg_rating",
        "avg_rank",
        "avg_temperature",
    )
    order = [F.col("date").desc_nulls_first(), F.col("daily_orders").desc_nulls_first()]
    return top_k(sample, order, k, ["listing_id"])


def recent_overview(fact: DataFrame, as_of: Column | date | None = None, days: int = 30) -> DataFrame:
    """The daily summary of the last ``days`` days before ``as_of`` (today by default)."""
    today = F.current_date() if as_of is None else (F.lit(as_of) if isinstance(as_of, date) else as_of)
    return daily_summary(_since(fact, F.date_sub(today, days))).withColumnRenamed("avg_rating", "platform_avg_rating")


def rating_distribution(fact: DataFrame) -> DataFrame:
    rated = fact.where(F.col("rating_category") != "No Ratings")
    return share_of_total(rated, "rating_category", 2, "count", "percentage").orderBy(F.col("count").desc())


def platform_outlets(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("platform_name")
        .agg(
            F.countDistinct("outlet_id").alias("outlets"),
            _orders(),
            mean("avg_rating").alias("avg_rating"),
            mean("avg_rank").alias("avg_rank"),
        )
        .orderBy(F.col("total_orders").desc_nulls_first())
    )

"""Sums, counts and bitmaps of the fact that add up: reports read them instead of the fact's days.

``listing_months`` has one row per month and listing (with the names it had), ``day_parts`` one per date and range of
listing ids. Both are stored by month. Sums and counts of exact numbers merge into those of any coarser group, so a
report over a rollup equals the one over the fact to the last digit. A month that changes is summed up again from the
fact's rows of that month alone.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dailymart.functions import exact_ratio, mean_ratio, month_of
from dailymart.operators import top_k
from dailymart.plans import reports
from dailymart.sinks.lake import Lake

KEYS = ["month", "listing_id", "outlet_id", "outlet_name", "org_name", "platform_name"]
LAYER = "rollup"


def _measures() -> dict[str, Column]:
    """What is summed and counted, by name; a NULL is neither. ``busy``: days with orders alone."""
    columns = {"failed": "failed_orders", "failure": "order_failure_rate", "uptime": "uptime_percentage"}
    plain = {"orders": F.col("daily_orders"), **{name: F.col(c) for name, c in columns.items()}}
    plain["rated"] = F.when(F.col("avg_rating") > 0, F.col("avg_rating"))
    busy = {f"busy_{name}": F.when(F.col("daily_orders") > 0, c) for name, c in plain.items()}
    return {**plain, **busy, "rating": F.col("avg_rating"), "rank": F.col("avg_rank")}


def listing_months(fact: DataFrame) -> DataFrame:
    """One row per month and listing: ``sum_<measure>`` and ``count_<measure>``."""
    measures = _measures()
    return (
        fact.withColumn("month", month_of("date"))
        .groupBy(*KEYS)
        .agg(
            *[F.sum(c).alias(f"sum_{name}") for name, c in measures.items()],
            *[F.count(c).alias(f"count_{name}") for name, c in measures.items()],
        )
    )


def _total(measure: str, name: str) -> Column:
    return F.sum(f"sum_{measure}").alias(name)


def _avg(measure: str, digits: int, name: str) -> Column:
    return exact_ratio(F.sum(f"sum_{measure}"), F.sum(f"count_{measure}"), digits).alias(name)


def _mean(measure: str, name: str) -> Column:
    return mean_ratio(F.sum(f"sum_{measure}"), F.sum(f"count_{measure}")).alias(name)


def _most_orders() -> Column:
    return F.col("total_orders").desc_nulls_first()


def top_listings(months: DataFrame, k: int = 10) -> DataFrame:
    totals = months.groupBy(*reports.LISTING).agg(
        _total("orders", "total_orders"),
        _avg("rating", 2, "avg_rating"),
        _avg("uptime", 1, "avg_uptime"),
        _avg("failure", 1, "avg_failure_rate"),
    )
    return top_k(totals, [_most_orders()], k, reports.LISTING)


def platform_comparison(months: DataFrame) -> DataFrame:
    totals = months.groupBy("platform_name").agg(
        F.countDistinct("listing_id").alias("num_listings"),
        _total("orders", "total_orders"),
        _avg("orders", 2, "avg_orders_per_day"),
        _avg("failure", 1, "avg_failure_rate"),
        _avg("rated", 2, "avg_rating_when_rated"),
        _avg("uptime", 1, "avg_uptime"),
    )
    return totals.orderBy(_most_orders(), "platform_name")


def top_organizations(months: DataFrame, k: int = 10) -> DataFrame:
    totals = months.groupBy("org_name").agg(
        F.countDistinct("listing_id").alias("num_listings"),
        _total("orders", "total_orders"),
        _avg("orders", 2, "avg_orders_per_listing_day"),
        _avg("failure", 1, "avg_failure_rate"),
        _avg("rated", 2, "avg_rating_score"),
        _avg("uptime", 1, "avg_uptime"),
    )
    return top_k(totals, [_most_orders()], k, ["org_name"])


def monthly_trend(months: DataFrame) -> DataFrame:
    totals = months.groupBy("month").agg(
        _total("orders", "total_orders"),
        _avg("orders", 2, "avg_daily_orders"),
        _avg("failure", 1, "avg_failure_rate"),
        _avg("rated", 2, "avg_rating"),
        _avg("uptime", 1, "avg_uptime"),
    )
    return totals.orderBy("month")


def worst_listings(months: DataFrame, failed_above: int = 100, k: int = 10) -> DataFrame:
    """Only days with orders count, which the rollup sums apart from the others."""
    totals = months.groupBy(*reports.LISTING).agg(
        _total("busy_orders", "total_orders"),
        _total("busy_failed", "total_failed"),
        _avg("busy_failure", 1, "avg_failure_rate"),
        _avg("busy_uptime", 1, "avg_uptime"),
        _avg("busy_rated", 2, "avg_rating"),
    )
    failing = totals.where(F.col("total_failed") > failed_above)
    return top_k(failing, [F.col("avg_failure_rate").desc_nulls_first()], k, reports.LISTING)


def top_outlets(months: DataFrame, k: int = 10) -> DataFrame:
    keys = ["outlet_name", "org_name"]
    totals = months.groupBy(*keys).agg(_total("orders", "total_orders"), _mean("rating", "avg_rating"), _mean("rank", "avg_rank"))
    return top_k(totals, [_most_orders()], k, keys)


def platform_outlets(months: DataFrame) -> DataFrame:
    totals = months.groupBy("platform_name").agg(
        F.countDistinct("outlet_id").alias("outlets"),
        _total("orders", "total_orders"),
        _mean("rating", "avg_rating"),
        _mean("rank", "avg_rank"),
    )
    return totals.orderBy(_most_orders())


class Rollup:
    """The rollups of a daily fact with the columns ``schema``, stored in ``lake`` with one folder per month."""

    def __init__(self, lake: Lake, schema: T.StructType):
        self.lake = lake
        self.schema = schema

    @staticmethod
    def _tables(fact: DataFrame) -> dict[str, tuple[DataFrame, list[str]]]:
        days = reports.day_parts(fact).withColumn("month", month_of("date"))
        return {"listing_months": (listing_months(fact), ["listing_id"]), "day_parts": (days, ["date", "range"])}

    def build(self, fact: DataFrame) -> None:
        """Sum up the whole fact."""
        for table, (rows, within) in self._tables(fact).items():
            self.lake.build_parts(rows, LAYER, table, "month", within)

    def refresh(self, fact: DataFrame, days: Iterable[date]) -> list[date]:
        """Sum up the months of ``days`` again, from the fact's rows of these months; returns the months.

        A stored fact is read in these months' folders only. A month without rows any more is empty from then on.
        """
        months = sorted({day.replace(day=1) for day in days})
        if not months:
            return []
        held = F.col("month") if "month" in fact.columns else month_of("date")
        for table, (rows, within) in self._tables(fact.where(held.isin(*months))).items():
            self.lake.replace_parts(rows, LAYER, table, "month", months, within)
        return months

    def _read(self, table: str) -> DataFrame:
        rows, _ = self._tables(self.lake.spark.createDataFrame([], self.schema))[table]
        return self.lake.read_parts(LAYER, table, "month", rows.schema)

    @property
    def listing_months(self) -> DataFrame:
        return self._read("listing_months")

    @property
    def day_parts(self) -> DataFrame:
        return self._read("day_parts")

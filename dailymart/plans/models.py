"""All models over one set of raw tables, composed lazily by name."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from threading import RLock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailymart.functions import rules
from dailymart.operators import HotKeys
from dailymart.plans import intermediate, mart
from dailymart.plans.staging import STAGING

# Layer of each model; staging and intermediate models are views, the mart is a table.
LAYERS = {
    **{name: "staging" for name in STAGING},
    "int_orders_enriched": "intermediate",
    "int_rank_daily_avg": "intermediate",
    "int_ratings_metrics": "intermediate",
    mart.FACT: "mart",
}

#: Models that the fact is built from.
FACT_SOURCES = [
    "stg_listing",
    "stg_orders",
    "stg_orders_daily",
    "stg_org",
    "stg_outlet",
    "stg_platform",
    "stg_weather",
    "int_rank_daily_avg",
    "int_ratings_metrics",
]

Store = Callable[[str, DataFrame], DataFrame]


def _as_is(name: str, df: DataFrame) -> DataFrame:
    return df


class Models:
    """Models by name: ``Models(raw)["stg_orders"]``; ``raw_<table>`` gives the raw table.

    ``store(name, df)`` may write a model and hand back the stored copy; by default every model stays a
    lazy DataFrame and Spark plans each query from the raw tables.

    The joins of all models share the hot keys of the raw tables (``hot``): the first model that joins on a key has
    them counted, in one job per table that reads the keys alone.
    """

    def __init__(self, raw: Mapping[str, DataFrame], store: Store = _as_is):
        self.raw = raw
        self._store = store
        self._built: dict[str, DataFrame] = {}
        # A lock for each model: those that do not build on each other are stored at the same time.
        self._locks = {name: RLock() for name in LAYERS}
        self.hot = HotKeys(raw, {"listing": ["outlet_id", "platform_id"], "orders": ["listing_id"]})

    def __getitem__(self, name: str) -> DataFrame:
        if name.startswith("raw_"):
            return self.raw[name.removeprefix("raw_")]
        with self._locks[name]:
            if name not in self._built:
                self._built[name] = self._store(name, self._build(name))
            return self._built[name]

    def build(self, names: Iterable[str], at_once: int = 4) -> None:
        """Build (and store) models, several at a time; those that others build on come first."""
        wanted = {*names}
        if mart.FACT in wanted:
            wanted.update(FACT_SOURCES)
        layers = list(LAYERS)
        with ThreadPoolExecutor(at_once) as pool:
            list(pool.map(self.__getitem__, sorted(wanted, key=lambda name: (layers.index(name) if name in LAYERS else -1, name))))

    def _build(self, name: str) -> DataFrame:
        if name in STAGING:
            model, source = STAGING[name]
            return model(self.raw[source])
        if name == "int_rank_daily_avg":
            return intermediate.int_rank_daily_avg(self["stg_rank"])
        if name == "int_ratings_metrics":
            return intermediate.int_ratings_metrics(self["stg_ratings_agg"])
        if name == "int_orders_enriched":
            return intermediate.int_orders_enriched(
                self["stg_orders"], self.profile("inner"), self.hot.of("orders", "listing_id")
            )
        if name == mart.FACT:
            return mart.fct_daily(
                self["stg_orders_daily"],
                self.orders_by_status(),
                self["int_ratings_metrics"],
                self["int_rank_daily_avg"],
                self.profile("left"),
                self["stg_weather"],
                snapshot_dates=self.raw["orders_daily"],
                listing=self.hot.of("listing", "outlet_id"),
            )
        raise KeyError(name)

    def profile(self, how: str) -> DataFrame:
        return intermediate.listing_profile(
            self["stg_listing"],
            self["stg_outlet"],
            self["stg_org"],
            self["stg_platform"],
            how,
            self.hot.of("listing", "outlet_id"),
            self.hot.of("listing", "platform_id"),
        )

    def orders_by_status(self) -> DataFrame:
        return intermediate.orders_by_status(self["stg_orders"])

    def date_listing_spine(self) -> DataFrame:
        return mart.date_listing_spine(
            self["stg_orders_daily"],
            self.orders_by_status(),
            self["int_ratings_metrics"],
            self["int_rank_daily_avg"],
            self["stg_listing"],
            snapshot_dates=self.raw["orders_daily"],
        )

    @property
    def fact(self) -> DataFrame:
        return self[mart.FACT]


def failure_rates_by_listing(orders_by_status: DataFrame) -> DataFrame:
    """Orders, failures and failure rate per listing over all its days."""
    totals = orders_by_status.groupBy("listing_id").agg(
        F.count("*").alias("active_days"),
        F.sum("total_orders").alias("total_orders"),
        F.sum("failed_orders").alias("failed_orders"),
    )
    rate = rules.order_failure_rate(F.col("failed_orders"), F.col("total_orders"))
    return totals.withColumn("order_failure_rate", rate)

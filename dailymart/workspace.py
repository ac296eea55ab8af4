"""Stored copies of models for one set of input tables, shared by the queries of a session."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from datetime import date
from threading import RLock
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

from dailymart.plans.mart import FACT
from dailymart.plans.models import LAYERS, Models
from dailymart.quality import CATALOG, Check, row_measures, run_checks
from dailymart.session import shared_folder
from dailymart.sinks.lake import Lake
from dailymart.sources.projection import raw_tables

# Deduplicated and joined models that several checks read; renamed ones stay views.
STORED = {
    "stg_listing",
    "stg_outlet",
    "stg_org",
    "stg_orders",
    "stg_orders_daily",
    "stg_ratings_agg",
    "stg_weather",
    "int_orders_enriched",
    "int_rank_daily_avg",
    "int_ratings_metrics",
    FACT,
}

T = TypeVar("T")

_open: dict[tuple[str, str], Workspace] = {}


class Workspace:
    """Lazy models over ``sf_dir``, and a second set (``checked``) whose big tables are written once.

    The copies live in the folder the session names for checkpoints (a fresh one per application), so
    they outlast lost executors. Without such a folder nothing is stored and every query is planned
    from the input tables.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._lock = RLock()
        folder = shared_folder(spark)
        label = hashlib.sha256(sf_dir.encode()).hexdigest()[:12]
        self.lake = Lake(spark, f"{folder}/{label}") if folder else None
        self.refresh()

    def refresh(self) -> None:
        """Look at the input tables anew: what was stored of them is made again when next asked for."""
        with self._lock:
            self.raw = raw_tables(self.spark, self.sf_dir)
            self.lazy = Models(self.raw)
            self.checked = Models(self.raw, self._keep)
            self._done: dict[str, object] = {}

    def close(self) -> None:
        """Delete everything stored here; the next query starts over."""
        if self.lake is not None:
            self.lake.drop()
        self.refresh()

    @property
    def results(self) -> Lake:
        """Where queries that store something write to."""
        if self.lake is None:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        return self.lake

    def folder(self, name: str) -> str:
        return f"{self.results.root}/{name}"

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        """Store what several checks or reports read again and is costly to plan anew."""
        if self.lake is None or name not in STORED:
            return df
        if name == FACT:  # from the stored models, which need not be computed again
            return self.once(FACT, lambda: self._build_fact(df))
        self.lake.replace(df, LAYERS[name], name, row_measures(CATALOG, name))
        return self.lake.read(LAYERS[name], name)

    def check(self, checks: Iterable[Check], as_of: date | None = None) -> DataFrame:
        """Checks of the stored models. Their failing rows were counted as they were written, which is not done again."""
        checks = list(checks)
        self.checked.build([c.model for c in checks] + [c.parent[0] for c in checks if c.parent])
        return run_checks(self.checked, checks, as_of, self._measured)

    def _measured(self, model: str) -> dict[str, int]:
        stored = self.lake is not None and model in STORED
        return self.lake.measured(LAYERS[model], model) if stored else {}

    def once(self, name: str, work: Callable[[], T]) -> T:
        """Run a job that stores something a single time; later callers get the first outcome.

        So nothing a lazy result still reads is overwritten, also when queries run in several threads.
        """
        with self._lock:
            if name not in self._done:
                self._done[name] = work()
            return self._done[name]

    @property
    def fact(self) -> DataFrame:
        """The mart table: built on first use, read from storage afterwards."""
        return self.lazy.fact if self.lake is None else self.once(FACT, lambda: self._build_fact(self.lazy.fact))

    def _build_fact(self, df: DataFrame) -> DataFrame:
        self.lake.build_fact(df, LAYERS[FACT], FACT, row_measures(CATALOG, FACT))
        return self.lake.read(LAYERS[FACT], FACT)


_opening = RLock()


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    key = (spark.sparkContext.applicationId, sf_dir)
    with _opening:
        if key not in _open:
            _open[key] = Workspace(spark, sf_dir)
        return _open[key]

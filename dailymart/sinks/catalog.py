"""The layers as databases of the session's catalog, for users who query by name.

``raw`` holds tables, ``staging`` lazy views over them, ``intermediate`` and ``mart`` stored models. Databases lie in
folders of their own under one root, so no warehouse setting is needed. A prefix keeps several sets of layers apart.

Tables that are joined by listing may be bucketed: their rows are stored as a shuffle by the bucket column would deal them,
so a join or an aggregate by that column reads them without one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailymart.functions import month_of
from dailymart.plans.mart import FACT
from dailymart.plans.models import LAYERS, Models
from dailymart.schemas import RAW
from dailymart.sinks.lake import qualified_name

LATEST_BY = ["timestamp", "loaded_at"]


def _latest(table: str, keys: Sequence[str], latest_by: Sequence[str] = LATEST_BY) -> str:
    """The latest row per key, ties broken by the remaining columns."""
    rest = [c for c in RAW[table].names if c not in keys and c not in latest_by]
    order = ", ".join(f"`{c}` DESC NULLS FIRST" for c in [*latest_by, *rest])
    columns = ", ".join(f"`{k}`" for k in keys)
    place = f"row_number() OVER (PARTITION BY {columns} ORDER BY {order})"
    return f"(SELECT * FROM (SELECT *, {place} AS _place FROM {{raw}}.{table}) WHERE _place = 1)"


def _average(column: str) -> str:
    exact = f"CAST(sum({column}) AS DECIMAL(30, 6)) / CAST(nullif(count({column}), 0) AS DECIMAL(18, 0))"
    return f"CAST(round({exact}, 2) AS DECIMAL(18, 2))"


#: The staging models once more, as text that the catalog can keep.
VIEWS = {
    "stg_listing": f"""SELECT id AS listing_id, outlet_id, platform_id, `timestamp` AS listing_timestamp, loaded_at
        FROM {_latest("listing", ["id"])}""",
    "stg_orders": f"""SELECT order_id, listing_id, placed_at, to_date(placed_at) AS order_date, lower(trim(status)) AS status, loaded_at
        FROM {_latest("orders", ["order_id"], ["placed_at", "loaded_at"])}""",
    "stg_orders_daily": f"""SELECT `date`, listing_id, CASE WHEN orders < 0 THEN 0 ELSE orders END AS daily_orders, `timestamp`, loaded_at
        FROM {_latest("orders_daily", ["listing_id", "date"])}""",
    "stg_org": f"""SELECT id AS org_id, trim(name) AS org_name, `timestamp` AS org_timestamp, loaded_at
        FROM {_latest("org", ["id"])}""",
    "stg_outlet": f"""SELECT id AS outlet_id, org_id, name AS outlet_name, latitude, longitude,
          latitude IS NOT NULL AND longitude IS NOT NULL AND NOT (latitude = 0 AND longitude = 0) AS has_valid_coordinates,
          `timestamp` AS outlet_timestamp, loaded_at
        FROM {_latest("outlet", ["id"])}""",
    "stg_platform": """SELECT id AS platform_id, `group` AS platform_group, name AS platform_name, country AS platform_country, loaded_at
        FROM {raw}.platform""",
    "stg_rank": "SELECT listing_id, `date`, `timestamp` AS rank_timestamp, is_online, rank, loaded_at FROM {raw}.rank",
    "stg_ratings_agg": f"""SELECT `date`, listing_id, cnt_ratings AS rating_count,
          CAST(CASE WHEN avg_rating > 5 THEN 5 WHEN avg_rating < 0 THEN 0 ELSE avg_rating END AS DECIMAL(3, 2)) AS avg_rating, loaded_at
        FROM {_latest("ratings_agg", ["listing_id", "date"], ["loaded_at"])} WHERE cnt_ratings > 0""",
    "stg_weather": f"""SELECT outlet_id, to_date(`datetime`) AS `date`, {_average("temperature_2m")} AS avg_temperature,
          {_average("relative_humidity_2m")} AS avg_humidity, {_average("wind_speed_10m")} AS avg_wind_speed,
          min(temperature_2m) AS min_temperature, max(temperature_2m) AS max_temperature, count(*) AS hourly_records_count,
          count(*) = 24 AS is_complete_day
        FROM {{raw}}.weather WHERE temperature_2m IS NOT NULL GROUP BY outlet_id, to_date(`datetime`)""",
}


class Catalog:
    """Databases ``<prefix>raw``, ``<prefix>staging``, ``<prefix>intermediate`` and ``<prefix>mart`` under ``root``."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix

    def database(self, layer: str) -> str:
        """Name of a layer's database, created where it does not exist yet."""
        name = f"{self.prefix}{layer}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{self.root}/{name}.db'")
        return name

    def name(self, model: str) -> str:
        """``layer.model``, for raw tables and models alike."""
        return qualified_name(model, self.database("raw" if model in RAW else LAYERS[model]))

    def save(self, df: DataFrame, model: str) -> str:
        """Store rows as the table of ``model`` and return its name."""
        name = self.name(model)
        df.write.mode("overwrite").saveAsTable(name)
        return name

    def save_bucketed(self, df: DataFrame, name: str, column: str, buckets: int, within: Sequence[str] = ()) -> str:
        """Store rows under ``name`` in ``buckets`` files by ``column``, sorted by it and ``within`` in each.

        Rows are dealt to the buckets first, so that each file is written by one task.
        """
        dealt = df.repartition(buckets, column)
        writer = dealt.write.mode("overwrite").bucketBy(buckets, column).sortBy(column, *within)
        writer.saveAsTable(name)
        return name

    def publish(self, raw: Mapping[str, DataFrame], models: Models, intermediate: Sequence[str] = (), at_once: int = 4) -> None:
        """Offer all layers: ``raw`` and the chosen models are written, staging models become views.

        No table is planned from another one written here, so several are written at a time: single ones leave executors idle.
        """
        for layer in {"raw", *LAYERS.values()}:
            self.database(layer)
        writes = {
            FACT: lambda: models.fact.withColumn("month", month_of("date")),
            **{model: partial(models.__getitem__, model) for model in intermediate},
            **{table: partial(raw.__getitem__, table) for table in raw},
        }
        with ThreadPoolExecutor(at_once) as pool:  # the fact first, which takes longest
            list(pool.map(lambda name: self.save(writes[name](), name), writes))
        self.create_views()

    def create_views(self) -> None:
        """The staging models as views over the raw tables; nothing is computed."""
        for model, text in VIEWS.items():
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(model)} AS {text.format(raw=self.database('raw'))}")

    def drop(self) -> None:
        """Take all layers out of the catalog, with their tables."""
        for layer in {"raw", *LAYERS.values()}:
            self.spark.sql(f"DROP DATABASE IF EXISTS `{self.prefix}{layer}` CASCADE")


def days_by_listing(fact: DataFrame, listing: DataFrame) -> DataFrame:
    """Active days and orders of each listing with its outlet, the fact joined by listing to the staged listings."""
    daily = fact.select("listing_id", "daily_orders").join(listing.select("listing_id", "outlet_id"), "listing_id").groupBy("listing_id")
    return daily.agg(
        F.first("outlet_id").alias("outlet_id"), F.count("*").alias("active_days"), F.sum("daily_orders").alias("total_orders")
    )

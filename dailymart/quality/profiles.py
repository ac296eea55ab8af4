"""Checks on the raw weather table after a load, each from one aggregate pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailymart.operators import orphan_keys

# Plausible ranges of raw readings.
RANGES = {"temperature_2m": (-50, 60), "relative_humidity_2m": (0, 100), "wind_speed_10m": (0, 200)}
SHORT = {"temperature_2m": "temp", "relative_humidity_2m": "humidity", "wind_speed_10m": "wind"}
# A NULL in these fails the load, a NULL in the others only warns.
REQUIRED = ["outlet_id", "datetime", "temperature_2m"]
OPTIONAL = ["relative_humidity_2m", "wind_speed_10m"]


def source_rows(raw_outlet: DataFrame) -> DataFrame:
    """Are there outlets, and at least one with coordinates other than (0, 0)?"""
    lat, lon = F.col("latitude"), F.col("longitude")
    valid = lat.isNotNull() & lon.isNotNull() & ~((lat == 0) & (lon == 0))
    counted = raw_outlet.agg(F.count("*").alias("outlets"), F.count_if(valid).alias("valid_outlets"))
    return counted.withColumn("passed", (F.col("outlets") > 0) & (F.col("valid_outlets") > 0))


def row_count_reconciliation(stored: DataFrame, fetched: DataFrame) -> DataFrame:
    """Stored rows must equal fetched rows and not be none."""
    counted = stored.agg(F.count("*").alias("stored_rows"))
    expected = fetched.agg(F.count("*").alias("n")).scalar()
    return counted.withColumn("fetched_rows", expected).withColumn(
        "passed", (F.col("stored_rows") > 0) & (F.col("stored_rows") == F.col("fetched_rows"))
    )


def null_profile(weather: DataFrame) -> DataFrame:
    columns = [*REQUIRED, *OPTIONAL]
    counted = weather.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])
    fatal = [F.col(f"null_{c}") > 0 for c in REQUIRED]
    warned = [F.col(f"null_{c}") > 0 for c in OPTIONAL]
    return counted.withColumn("status", _worst(fatal, warned))


def range_profile(weather: DataFrame) -> DataFrame:
    bad = [
        F.count_if((F.col(c) < low) | (F.col(c) > high)).alias(f"bad_{SHORT[c]}")
        for c, (low, high) in RANGES.items()
    ]
    counted = weather.agg(
        *bad, F.min("temperature_2m").alias("min_temp"), F.max("temperature_2m").alias("max_temp")
    )
    return counted.withColumn("status", _worst([F.col(f"bad_{s}") > 0 for s in SHORT.values()], []))


def _worst(errors: list[Column], warnings: list[Column]) -> Column:
    def any_of(conditions: list[Column]) -> Column:
        out = F.lit(False)
        for c in conditions:
            out = out | c
        return out

    return F.when(any_of(errors), "error").when(any_of(warnings), "warn").otherwise("pass")


def coverage_profile(weather: DataFrame) -> DataFrame:
    """First and last hour as text, distinct outlets and rows; informational."""
    return weather.agg(
        F.min("datetime").cast("string").alias("min_datetime"),
        F.max("datetime").cast("string").alias("max_datetime"),
        F.countDistinct("outlet_id").alias("unique_outlets"),
        F.count("*").alias("total_records"),
    )


def orphan_profile(weather: DataFrame, raw_outlet: DataFrame) -> DataFrame:
    """Weather rows of unknown outlets; a NULL outlet is unknown too."""
    lost = orphan_keys(weather, "outlet_id", raw_outlet, "id", null_is_orphan=True)
    counted = lost.agg(F.coalesce(F.sum("n_rows"), F.lit(0).cast("bigint")).alias("orphan_count"))
    return counted.withColumn("passed", F.col("orphan_count") == 0)

"""Hourly weather: which outlets to fetch, and turning landed payloads into rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dailymart.operators import latest_per_key
from dailymart.schemas import HOURLY_METRICS, LOADED_AT

# Default collection range.
DEFAULT_START, DEFAULT_END = date(2023, 1, 1), date(2024, 12, 31)


def weather_locations(raw_outlet: DataFrame, dedupe: bool = False) -> DataFrame:
    """Outlets with known coordinates other than (0, 0), by id.

    Reads the raw table, so an outlet stored twice is listed twice unless ``dedupe`` is set.
    """
    outlets = latest_per_key(raw_outlet, ["id"], ["timestamp", LOADED_AT]) if dedupe else raw_outlet
    lat, lon = F.col("latitude"), F.col("longitude")
    usable = outlets.where(lat.isNotNull() & lon.isNotNull() & ~((lat == 0) & (lon == 0)))
    return usable.select(F.col("id").alias("outlet_id"), "latitude", "longitude").orderBy("outlet_id")


def coordinate_problem(latitude: Column, longitude: Column) -> Column:
    """Why a coordinate pair cannot be used; NULL for a usable one."""
    return F.when(~latitude.between(-90, 90), "latitude out of range").when(
        ~longitude.between(-180, 180), "longitude out of range"
    )


def split_coordinates(locations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable, rejected with reason) locations."""
    judged = locations.withColumn("reason", coordinate_problem(F.col("latitude"), F.col("longitude")))
    return judged.where(F.col("reason").isNull()).drop("reason"), judged.where(F.col("reason").isNotNull())


def flatten_hourly(
    payloads: DataFrame, metrics: dict[str, T.DataType] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Turn payloads (outlet_id, payload JSON text) into one row per outlet and hour.

    A payload holds parallel arrays ``hourly.time[]`` and ``hourly.<metric>[]``. A metric that is absent
    counts as an empty array, one that is ``null`` gives NULL for every hour. Arrays of unequal length,
    unreadable times or values reject the payload as a whole; rejects come back as the second result
    (outlet_id, reason, payload). A payload without hours gives no rows and is no reject.
    """
    metrics = metrics or HOURLY_METRICS
    envelope = "hourly map<string,string>, _corrupt string"
    parsed = payloads.withColumn(
        "_p", F.from_json("payload", envelope, {"columnNameOfCorruptRecord": "_corrupt"})
    ).withColumn("_hourly", F.col("_p.hourly"))

    def text(name: str) -> Column:
        return F.element_at("_hourly", F.lit(name))

    times = F.coalesce(F.from_json(text("time"), "array<string>"), F.array().cast("array<string>"))
    parsed = parsed.withColumn("_time", times)
    bad_length, bad_value = F.lit(False), F.lit(False)
    for metric in metrics:
        values = F.from_json(text(metric), "array<double>")
        given = F.map_contains_key("_hourly", F.lit(metric))
        spread = F.transform("_time", lambda _: F.lit(None).cast("double"))
        absent = F.array().cast("array<double>")
        parsed = parsed.withColumn(
            f"_m_{metric}",
            F.when(text(metric).isNotNull(), values).when(given, spread).otherwise(absent),
        )
        bad_length = bad_length | (F.size(f"_m_{metric}") != F.size("_time"))
        bad_value = bad_value | (text(metric).isNotNull() & F.col(f"_m_{metric}").isNull())

    bad_time = F.exists("_time", lambda t: t.isNotNull() & t.try_cast("timestamp_ntz").isNull())
    reason = (
        F.when(F.col("_p._corrupt").isNotNull(), "malformed payload")
        .when(bad_value, "unreadable value")
        .when(bad_length, "arrays of unequal length")
        .when(bad_time, "unreadable time")
    )
    judged = parsed.withColumn("reason", reason)
    # The verdict sits inside the generators, not in a filter: Spark would push a filter below the
    # projections and repeat every JSON parse in it.
    usable = F.col("reason").isNull()
    zipped = F.arrays_zip(F.col("_time"), *[F.col(f"_m_{m}") for m in metrics])
    rows = judged.select("outlet_id", F.inline(F.when(usable, zipped)))
    stored = rows.select(
        "outlet_id",
        F.col("_time").try_cast("timestamp_ntz").alias("datetime"),
        *[_as_stored(F.col(f"_m_{m}"), kind).alias(m) for m, kind in metrics.items()],
    )
    refused = F.when(~usable, F.array(F.struct("reason", "payload")))
    return stored, judged.select("outlet_id", F.inline(refused))


def _as_stored(value: Column, kind: T.DataType) -> Column:
    rounded = F.round(value) if isinstance(kind, T.IntegralType) else value
    return rounded.try_cast(kind)


def within_dates(hourly: DataFrame, start: date = DEFAULT_START, end: date = DEFAULT_END) -> DataFrame:
    """Rows whose date lies in the collection range, both ends included."""
    return hourly.where(F.to_date("datetime").between(F.lit(start), F.lit(end)))

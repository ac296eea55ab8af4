"""The nine raw entities projected from the star-schema tables (region, nation, supplier, events).

Roles: region -> platform, nation -> org, supplier -> outlet, events.user_id -> listing, events ->
orders, snapshots, rank readings and ratings; hourly weather is laid out per usable outlet and event date.
The arithmetic is the fixture specification. Second versions of a row (stale
duplicates) come out of the same scan through an exploded array instead of a second pass.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dailymart.schemas import LOADED_AT, RAW, TS, conform

LOAD_TIME = datetime(2024, 2, 1)


def _at(text: str) -> Column:
    return F.lit(text).cast(TS)


def _versions(df: DataFrame, first: dict[str, Column], again: Column, second: dict[str, Column]) -> DataFrame:
    """One row per input row from ``first``, plus one from ``second`` where ``again`` holds."""
    def pack(columns: dict[str, Column]) -> Column:
        return F.struct(*[c.alias(n) for n, c in columns.items()])

    both = F.when(again, F.array(pack(first), pack(second))).otherwise(F.array(pack(first)))
    return df.select(F.inline(both))


def _finish(df: DataFrame, table: str) -> DataFrame:
    return conform(df.withColumn(LOADED_AT, _at(LOAD_TIME.isoformat(sep=" "))), table)


def platform(region: DataFrame) -> DataFrame:
    key = F.col("r_regionkey")
    return region.select(
        key.alias("id"),
        F.when(key < 3, "Delivery").otherwise("Aggregator").alias("group"),
        F.col("r_name").alias("name"),
        F.when(key % 2 == 0, "US").otherwise("UK").alias("country"),
    )


def org(nation: DataFrame) -> DataFrame:
    key = F.col("n_nationkey")
    padded = F.concat(F.lit("  "), F.col("n_name"), F.lit(" "))
    return _versions(
        nation,
        {"id": key, "name": padded, "timestamp": _at("2020-01-01 00:00:00")},
        key % 5 == 0,
        {"id": key, "name": F.lit("stale"), "timestamp": _at("2019-01-01 00:00:00")},
    )


def outlet(supplier: DataFrame) -> DataFrame:
    key, kind = F.col("s_suppkey"), "decimal(10,7)"
    zero = F.lit(0).cast(kind)
    at_origin = key % 17 == 3
    latitude = F.when(at_origin, F.lit(0)).when(key % 17 == 5, F.lit(None)).otherwise(key % 90).cast(kind)
    longitude = F.when(at_origin, F.lit(0)).otherwise(key % 180).cast(kind)

    def row(name: Column, lat: Column, lon: Column, at: str) -> dict[str, Column]:
        return {
            "id": key,
            "org_id": F.col("s_nationkey"),
            "name": name,
            "latitude": lat,
            "longitude": lon,
            "timestamp": _at(at),
        }

    return _versions(
        supplier,
        row(F.col("s_name"), latitude, longitude, "2020-06-01 00:00:00"),
        key % 10 == 0,
        row(F.lit("stale"), zero, zero, "2020-05-01 00:00:00"),
    )


def listing(events: DataFrame, supplier: DataFrame) -> DataFrame:
    user = F.col("user_id")
    outlets = supplier.agg(F.count("*")).scalar()
    users = events.select("user_id").distinct().withColumn("outlet", F.col("user_id") % outlets)

    def row(platform_id: Column, at: str) -> dict[str, Column]:
        return {"id": user, "outlet_id": F.col("outlet"), "platform_id": platform_id, "timestamp": _at(at)}

    return _versions(
        users,
        row(user % 5, "2021-01-02 00:00:00"),
        user % 8 == 0,
        row((user + 1) % 5, "2021-01-01 00:00:00"),
    )


def orders(events: DataFrame) -> DataFrame:
    event = F.col("event_id")
    kind = F.col("event_type")
    status = (
        F.when(kind == "purchase", "completed")
        .when(kind == "view", "  Completed ")
        .when(kind == "signup", "pending")
        .when(kind == "error", "CANCELLED")
        .otherwise("refunded")
    )

    def row(at: Column, state: Column) -> dict[str, Column]:
        return {"listing_id": F.col("user_id"), "order_id": event, "placed_at": at, "status": state}

    return _versions(
        events.where(event % 11 != 0),
        row(F.col("ts"), status),
        event % 50 == 0,
        row(F.col("ts") - F.expr("interval 1 hour"), F.lit("pending")),
    )


def orders_daily(events: DataFrame) -> DataFrame:
    user = F.col("user_id")
    noise = F.when(user % 13 == 0, 7).otherwise(0) - F.when(user % 19 == 1, 20).otherwise(0)
    counted = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    current = {
        "date": F.col("day"),
        "listing_id": user,
        "orders": F.col("n") + noise,
        "timestamp": _at("2024-02-01 00:00:00"),
    }
    earlier = current | {"orders": F.lit(99).cast("bigint"), "timestamp": _at("2024-01-31 00:00:00")}
    # Two conditions decide which versions exist: the current one and the earlier one.
    rows = F.array(
        F.when(user % 6 != 0, F.struct(*[c.alias(n) for n, c in current.items()])),
        F.when(user % 9 == 1, F.struct(*[c.alias(n) for n, c in earlier.items()])),
    )
    return counted.select(F.inline(F.array_compact(rows)))


def rank(events: DataFrame) -> DataFrame:
    online = ~F.col("event_type").isin("error", "click")
    return events.where(F.col("user_id") % 3 != 0).select(
        F.col("user_id").alias("listing_id"),
        F.to_date("ts").alias("date"),
        F.col("ts").alias("timestamp"),
        online.alias("is_online"),
        F.when(online, F.col("value").cast("decimal(10,2)")).alias("rank"),
    )


def ratings_agg(events: DataFrame) -> DataFrame:
    user, day = F.col("user_id"), F.dayofmonth("day")
    tenths = ((user * 7 + day * 3) % 56 - 2).cast("decimal(5,0)")
    keys = events.where(user % 4 != 1).select("user_id", F.to_date("ts").alias("day")).distinct()
    return keys.select(
        F.col("day").alias("date"),
        user.alias("listing_id"),
        (day * (user % 5)).alias("cnt_ratings"),
        (tenths * F.lit(0.1).cast("decimal(1,1)")).cast("decimal(3,2)").alias("avg_rating"),
    )


def weather(raw_outlet: DataFrame, events: DataFrame) -> DataFrame:
    """24 hours per usable outlet and event date, with some hours and values left out.

    The event dates are one small array (bounded by the calendar) read through a scalar subquery.
    """
    at_origin = (F.col("latitude") == 0) & (F.col("longitude") == 0)
    usable = raw_outlet.where(F.col("latitude").isNotNull() & ~at_origin).select("id").distinct()
    dates = events.select(F.to_date("ts").alias("day")).distinct().agg(F.collect_set("day")).scalar()
    days = usable.select("id", F.explode(dates).alias("day"))
    # Each row becomes 24, which size-based partition merging cannot foresee: fix the partition count.
    partitions = int(days.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    days = days.repartition(partitions, "id", "day")
    hourly = days.select("id", "day", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))

    place, hour, day = F.col("id"), F.col("hour"), F.dayofmonth("day")
    tenth = F.lit(0.1).cast("decimal(2,1)")
    celsius = ((place * 7 + day * 13 + hour * 5) % 551).cast("decimal(5,0)") * tenth - F.lit(12)
    wind = ((place + hour * 3) % 400).cast("decimal(5,0)") * tenth
    return hourly.where(~((hour == 23) & ((place + day) % 5 == 0))).select(
        place.alias("outlet_id"),
        (F.col("day").cast(TS) + F.make_dt_interval(F.lit(0), hour)).alias("datetime"),
        F.when((place + hour) % 97 != 96, celsius.cast("decimal(5,2)")).alias("temperature_2m"),
        ((place + hour) % 101).alias("relative_humidity_2m"),
        wind.cast("decimal(5,2)").alias("wind_speed_10m"),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All raw entities as lazy DataFrames over the parquet files in ``sf_dir``."""
    region, nation, supplier, events = (
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        for name in ("region", "nation", "supplier", "events")
    )
    raw_outlet = _finish(outlet(supplier), "outlet")
    built = {
        "listing": listing(events, supplier),
        "orders": orders(events),
        "orders_daily": orders_daily(events),
        "org": org(nation),
        "platform": platform(region),
        "rank": rank(events),
        "ratings_agg": ratings_agg(events),
        "weather": weather(raw_outlet, events),
    }
    tables = {name: _finish(df, name) for name, df in built.items()} | {"outlet": raw_outlet}
    return {name: tables[name] for name in RAW}

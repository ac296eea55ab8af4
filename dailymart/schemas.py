"""Fixed schemas of the raw layer and of the hourly weather payload.

Ids are BIGINT so that the same code holds at any data size. Schemas are never inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

ID = T.LongType()
TS = T.TimestampNTZType()
TEXT = T.StringType()

LOADED_AT = "loaded_at"


def _table(**columns: T.DataType) -> T.StructType:
    fields = [T.StructField(name, kind) for name, kind in columns.items()]
    return T.StructType([*fields, T.StructField(LOADED_AT, TS)])


# Column names and types of the nine raw tables.
RAW: dict[str, T.StructType] = {
    "listing": _table(id=ID, outlet_id=ID, platform_id=ID, timestamp=TS),
    "orders": _table(listing_id=ID, order_id=ID, placed_at=TS, status=TEXT),
    "orders_daily": _table(date=T.DateType(), listing_id=ID, orders=T.IntegerType(), timestamp=TS),
    "org": _table(id=ID, name=TEXT, timestamp=TS),
    "outlet": _table(
        id=ID,
        org_id=ID,
        name=TEXT,
        latitude=T.DecimalType(10, 7),
        longitude=T.DecimalType(10, 7),
        timestamp=TS,
    ),
    "platform": _table(id=ID, group=TEXT, name=TEXT, country=TEXT),
    "rank": _table(
        listing_id=ID,
        date=T.DateType(),
        timestamp=TS,
        is_online=T.BooleanType(),
        rank=T.DecimalType(10, 2),
    ),
    "ratings_agg": _table(
        date=T.DateType(),
        listing_id=ID,
        cnt_ratings=T.IntegerType(),
        avg_rating=T.DecimalType(3, 2),
    ),
    "weather": _table(
        outlet_id=ID,
        datetime=TS,
        temperature_2m=T.DecimalType(5, 2),
        relative_humidity_2m=T.IntegerType(),
        wind_speed_10m=T.DecimalType(5, 2),
    ),
}

# The hourly metrics a weather payload carries, with the types they are stored as.
HOURLY_METRICS: dict[str, T.DataType] = {
    "temperature_2m": T.DecimalType(5, 2),
    "relative_humidity_2m": T.IntegerType(),
    "wind_speed_10m": T.DecimalType(5, 2),
}


def conform(df, table: str):
    """Select the columns of ``RAW[table]`` in order, cast to their declared types."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in RAW[table].fields])

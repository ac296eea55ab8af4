"""Typed CSV scans and the file manifest of the raw layer."""

from __future__ import annotations

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dailymart.schemas import LOADED_AT, RAW

# File name -> raw table.
MANIFEST = {
    "listing.csv": "listing",
    "orders.csv": "orders",
    "orders_daily.csv": "orders_daily",
    "org.csv": "org",
    "outlet.csv": "outlet",
    "platform.csv": "platform",
    "rank.csv": "rank",
    "ratings_agg.csv": "ratings_agg",
}

# Texts read as missing, the usual list of dataframe CSV readers.
MISSING_TEXTS = [
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]


def file_columns(table: str) -> list[T.StructField]:
    """Columns a file of ``table`` carries: all but the load stamp."""
    return [f for f in RAW[table].fields if f.name != LOADED_AT]


def _coerce(field: T.StructField) -> Column:
    """Times and dates that cannot be read become NULL; any other bad value fails the file."""
    raw = F.col(f"`{field.name}`")
    text = F.when(~raw.isin("", *MISSING_TEXTS), raw)
    if isinstance(field.dataType, T.TimestampNTZType):
        return text.try_cast("timestamp_ntz")
    if isinstance(field.dataType, T.DateType):
        return text.try_cast("timestamp_ntz").cast("date")
    if isinstance(field.dataType, T.IntegralType):
        text = F.regexp_replace(text, r"\.0+$", "")
    return text.cast(field.dataType)


def _headers(spark: SparkSession, path: str, multi_line: bool | None) -> dict[tuple[tuple[str, ...], bool], list[str]]:
    """The files under ``path`` by the column names in their first line, and whether quotes in them hold line breaks.

    Files without a line are left out. A line with an odd number of quotes begins or ends inside a quoted part; whether a
    file has any is counted in one pass over the lines, unless the caller knows. Without that pass only the first
    block of each file is looked at. One row per file reaches the driver, which lists them anyway.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    if multi_line is not None:
        lines = lines.where("start = 0")
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"')))) % 2
    numbered = lines.withColumns({"at": F.when(F.col("start") == 0, F.monotonically_increasing_id()), "odd": odd})
    seen = numbered.groupBy("file").agg(F.min_by("value", "at").alias("line"), F.max("odd").alias("odd"))
    found: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for row in seen.collect():
        names = tuple(name.strip() for name in next(csv.reader([row.line.lstrip("\ufeff")]), []))
        broken = bool(row.odd) if multi_line is None else multi_line
        found.setdefault((names, broken), []).append(unquote(row.file))
    return found


_BROKEN = "_broken_line"


def _scan(spark: SparkSession, path: str, table: str, multi_line: bool | None) -> list[tuple[DataFrame, list[T.StructField], Column]]:
    """For each order of columns found: all fields as text, the table's fields, and whether a line has too many."""
    fields = file_columns(table)
    known = {f.name for f in fields}
    scans = []
    by_header = _headers(spark, path, multi_line)
    for (names, broken), files in sorted(by_header.items()):
        unknown = sorted(set(names) - known)
        if unknown or len(set(names)) < len(names):
            raise ValueError(f"{table}: unexpected columns {unknown or sorted(names)} in {sorted(files)[0]}")
        schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, _BROKEN)])
        reader = spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", broken)
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BROKEN)
        # Quoted parts may hold commas; what is left of them after that separates fields.
        bare = F.regexp_replace(F.col(_BROKEN), '"[^"]*"', "")
        surplus = F.coalesce(F.length(bare) - F.length(F.replace(bare, F.lit(","))) >= len(names), F.lit(False))
        # Always true, but reads all columns: Spark counts the fields of a line only then.
        surplus &= F.length(F.concat_ws("", *[F.col(f"`{n}`") for n in names])) >= 0
        scans.append((reader.csv(path if len(by_header) == 1 else files), fields, surplus))
    return scans


def _typed(text: DataFrame, fields: list[T.StructField]) -> DataFrame:
    return text.select(
        *[(_coerce(f) if f.name in text.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in fields]
    )


def _nothing(spark: SparkSession, fields: list[T.StructField]) -> DataFrame:
    return spark.createDataFrame([], T.StructType(fields))


def scan_csv(spark: SparkSession, path: str, table: str, multi_line: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """The readable rows of :func:`read_typed_csv`, and ``(line, reason)`` of lines with more fields than columns."""
    scans = _scan(spark, path, table, multi_line)
    rows = [_typed(text.where(~surplus), fields) for text, fields, surplus in scans]
    rejects = [
        text.where(surplus).select(F.col(_BROKEN).alias("line"), F.lit("more fields than columns").alias("reason"))
        for text, _, surplus in scans
    ]
    nothing = spark.createDataFrame([], "line string, reason string")
    return reduce(DataFrame.unionByName, rows, _nothing(spark, file_columns(table))), reduce(DataFrame.union, rejects, nothing)


def read_typed_csv(spark: SparkSession, path: str, table: str, multi_line: bool | None = None) -> DataFrame:
    """Read one CSV file, or a folder of part files, with the declared types of ``table``.

    Columns are matched by the header names of each file, so parts may order them differently; a column the
    file lacks is NULL, a column the table lacks is an error. A line with fewer fields ends in NULLs, one with
    more fails the read (see :func:`scan_csv` to set such lines aside). Types are never inferred. Files with
    line breaks inside quotes are read whole, each in one task; ``multi_line`` tells for all files whether they have any,
    which saves the pass that looks for them.
    """
    problem = F.concat(F.lit(f"{table}: more fields than columns: "), F.col(_BROKEN))
    rows = [
        _typed(text.where(F.when(surplus, F.raise_error(problem).cast("boolean")).otherwise(True)), fields)
        for text, fields, surplus in _scan(spark, path, table, multi_line)
    ]
    return reduce(DataFrame.unionByName, rows) if rows else _nothing(spark, file_columns(table))

"""Loading the raw layer from files, with an audit of what happened to each table."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailymart.sinks.lake import Lake
from dailymart.sources.files import MANIFEST, read_typed_csv

AUDIT = "table_name string, rows_loaded bigint, total_rows bigint, status string, reason string"


def _reason(problem: Exception) -> str:
    """Spark's names for what went wrong, the innermost last, or the message."""
    names = re.findall(r"\[([A-Z][A-Z_.]+)\]", str(problem))
    return names[-1] if names else str(problem).splitlines()[0]


def load_manifest(
    spark: SparkSession,
    folder: str,
    lake: Lake,
    loaded_at: datetime,
    replace: bool = False,
    manifest: dict[str, str] | None = None,
) -> DataFrame:
    """Load every file of the manifest into ``raw``; one file's failure does not stop the rest.

    Rows are added to what is stored unless ``replace`` is set, so loading a file twice doubles its rows. A
    missing file and a failed one load 0 rows and leave the stored ones as they are, also when replacing; an
    empty file loads 0 rows. Only problems with the data or its storage are recorded; programming
    errors are raised. Files are loaded side by side. Returns one audit row per table.
    """

    def load(entry: tuple[str, str]) -> tuple[str, int, int, str, str | None]:
        file, table = entry
        loaded, status, reason = 0, "failed", None
        try:
            loaded = lake.load_raw(read_typed_csv(spark, f"{folder}/{file}", table), table, loaded_at, replace)
            status = "loaded" if loaded else "empty"
        except AnalysisException as problem:
            reason = _reason(problem)
            status = "missing" if "PATH_NOT_FOUND" in str(problem) else "failed"
        except (PySparkException, Py4JError, ValueError) as problem:
            reason = _reason(problem)
        return table, loaded, lake.count("raw", table), status, reason

    with ThreadPoolExecutor(4) as pool:
        audit = list(pool.map(load, (manifest or MANIFEST).items()))
    return spark.createDataFrame(audit, AUDIT)


def audit_summary(audit: DataFrame) -> DataFrame:
    """The audit rows plus a TOTAL row; its status counts the tables that went well."""
    good = F.count_if(F.col("status").isin("loaded", "empty"))
    total = audit.agg(
        F.lit("TOTAL").alias("table_name"),
        F.sum("rows_loaded").alias("rows_loaded"),
        F.sum("total_rows").alias("total_rows"),
        F.concat(good.cast("string"), F.lit("/"), F.count("*").cast("string")).alias("status"),
        F.lit(None).cast("string").alias("reason"),
    )
    return audit.unionByName(total)


def load_succeeded(audit: DataFrame) -> DataFrame:
    """One row: no table may have rows stored but none loaded."""
    return audit.agg(F.bool_and((F.col("rows_loaded") > 0) | (F.col("total_rows") == 0)).alias("succeeded"))

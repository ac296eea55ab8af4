"""Session settings for local runs (tests, bench). A cluster brings its own session."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "dailymart") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_temporary: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str | None:
    """A folder of this application that every executor can reach, inside ``spark.checkpoint.dir``.

    Nothing is set in the caller's session. Only a single-machine session without the setting gets a fresh
    temporary folder; a cluster session without it gets ``None`` and the callers stay fully lazy.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is not None:
        return f"{named.rstrip('/')}/dailymart-{context.applicationId}"
    if not context.master.startswith("local"):
        return None
    return _temporary.setdefault(context.applicationId, tempfile.mkdtemp(prefix="dailymart-"))

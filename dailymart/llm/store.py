"""Intermediate tables in the shared folder, which cut lineage and outlast lost executors."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most rows of a key column that is sent to every executor (16 MB); larger ones are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a single-machine session without it gets a temporary folder."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this library to the workers, once per application, for executors that do not have it installed."""
    context = spark.sparkContext
    package = Path(__file__).resolve().parents[1]
    if context.applicationId in _shipped or not package.is_dir():
        return
    archive = f"{tempfile.mkdtemp(prefix='llm-')}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


_stored: dict[str, list[str]] = {}


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a new folder of the shared one and read it back; :func:`clear` deletes it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    _stored.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> int:
    """Delete all tables this application has stored so far and return how many.

    For callers that have written their results: a result not yet written reads these tables.
    """
    paths = _stored.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return len(paths)


def matching(big: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``big`` whose ``on`` columns are among ``keys`` (distinct, stored).

    Few keys are counted and broadcast, so that ``big`` is not shuffled; more are joined by a shuffle.
    """
    few = keys.count() <= BROADCAST_ROWS
    return big.join(F.broadcast(keys) if few else keys, on, "left_semi")


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out."""
    return F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 5

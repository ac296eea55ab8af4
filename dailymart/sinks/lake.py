"""Layered Parquet tables under one folder, with append, replace, counts and views."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Collection, Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dailymart.functions import month_of
from dailymart.schemas import LOADED_AT, RAW, TS, conform

DEFAULT_LAYER = "public"
#: Marks a load as complete; Spark does not read files that begin so.
COMMITTED = "_COMMITTED"
#: What was counted while a load was written, beside its rows.
MEASURED = "_MEASURED"


def qualified_name(model: str, layer: str | None = None) -> str:
    """``layer.model``: a layer is used verbatim, models without one go to the default."""
    return f"{(layer or DEFAULT_LAYER).strip()}.{model}"


def stamped(df: DataFrame, loaded_at: datetime) -> DataFrame:
    """One literal load time for the whole load, independent of any time zone setting."""
    return df.withColumn(LOADED_AT, F.lit(loaded_at.isoformat(sep=" ")).cast(TS))


class Lake:
    """Tables at ``root/<layer>/<table>/v<number>-<unique>``. ``root`` must be reachable from every executor.

    The rows of a table are those of its highest complete version, and of a version those of its complete loads:
    every write goes to a folder of its own, ``load=<id>``, that counts once it is marked as committed, after
    Spark's job. A write that dies leaves nothing a reader sees, and loading the same id again starts over.

    Replacing writes the next version. The version before is kept for readers that have already listed its files;
    older ones are deleted. Parted tables (one folder per month, say) are refreshed part by part: a load says which
    parts it replaces, and of each part the latest load counts. Two
    writers at a time never write to one folder; of their versions or parts the one with the later name counts.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _files(self, path: str):
        """Hadoop's file system and path object of ``path``."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _names(self, path: str) -> list[str]:
        files, base = self._files(path)
        return sorted(s.getPath().getName() for s in files.listStatus(base)) if files.exists(base) else []

    def _filled(self, path: str) -> bool:
        return any(not n.startswith(("_", ".")) for n in self._names(path))

    def _exists(self, path: str) -> bool:
        files, where = self._files(path)
        return files.exists(where)

    def _delete(self, path: str) -> None:
        files, where = self._files(path)
        files.delete(where, True)

    def _numbered(self, folder: str, prefix: str) -> list[str]:
        """Names in ``folder`` that :meth:`_next` gave, in order."""
        found = [m for n in self._names(folder) if (m := re.fullmatch(rf"{prefix}(\d+)-(\w+)", n))]
        return [m[0] for m in sorted(found, key=lambda m: (int(m[1]), m[2]))]

    def _next(self, folder: str, prefix: str) -> str:
        """A name behind all others. Two writers may draw the same number, but never the same name."""
        last = self._numbered(folder, prefix)[-1:]
        number = int(last[0].removeprefix(prefix).partition("-")[0]) + 1 if last else 1
        return f"{prefix}{number}-{uuid.uuid4().hex[:12]}"

    def versions(self, layer: str, table: str) -> list[str]:
        """Complete versions, oldest first."""
        base = self.path(layer, table)
        return [v for v in self._numbered(base, "v") if self._committed(f"{base}/{v}")]

    def current(self, layer: str, table: str) -> str:
        """Folder of the version readers see (of an empty first one where there is none yet)."""
        return f"{self.path(layer, table)}/{(self.versions(layer, table) or ['v0-appended'])[-1]}"

    def _committed(self, folder: str) -> list[str]:
        return [n for n in self._names(folder) if n.startswith("load=") and self._exists(f"{folder}/{n}/{COMMITTED}")]

    def loads(self, layer: str, table: str) -> list[str]:
        """Ids of the committed loads that make up a table."""
        return [n.removeprefix("load=") for n in self._committed(self.current(layer, table))]

    def append(self, df: DataFrame, layer: str, table: str, load_id: str | None = None) -> int:
        """Add rows and return how many; the count rides along with the write.

        With a ``load_id`` a load that is already stored is refused (``ValueError``) and one that died is written anew.
        """
        folder = self.current(layer, table)
        if load_id is None:
            load_id = f"{uuid.uuid4().hex}"
        elif not re.fullmatch(r"[\w.-]+", load_id):
            raise ValueError(f"a load id is made of letters, digits, dots, dashes and underscores: {load_id!r}")
        elif load_id in self.loads(layer, table):
            raise ValueError(f"{layer}.{table}: load {load_id} is already stored")
        return self._load(df, f"{folder}/load={load_id}")

    def replace(self, df: DataFrame, layer: str, table: str, measures: Mapping[str, Column] | None = None) -> int:
        """Put ``df`` in place of all rows once it is stored completely.

        ``measures``: sums and counts that ride along with the write, for :meth:`measured`.
        """
        return self._replaced(layer, table, lambda version: self._load(df, f"{version}/load=all", measures))

    def _replaced(self, layer: str, table: str, write: Callable[[str], int]) -> int:
        base = self.path(layer, table)
        versions = self.versions(layer, table)
        rows = write(f"{base}/{self._next(base, 'v')}")
        for old in versions[:-1]:
            self._delete(f"{base}/{old}")
        return rows

    def measured(self, layer: str, table: str) -> dict[str, int]:
        """What was counted while the current rows were written, summed over loads that all counted it.

        Empty for a parted table that was written to since: rows that were counted may have been replaced.
        """
        folder = self.current(layer, table)
        loads = self._committed(folder)
        found = [self._read_measures(f"{folder}/{load}") for load in loads]
        parted = len(loads) > 1 and any("=" in n for n in self._names(f"{folder}/{loads[0]}"))
        if parted or not found:
            return {}
        return {name: sum(f[name] for f in found) for name in found[0] if all(name in f for f in found)}

    def _load(self, df: DataFrame, path: str, measures: Mapping[str, Column] | None = None) -> int:
        names = list(measures or {})
        seen = Observation()
        counts = [(measures or {})[name].alias(f"m{i}") for i, name in enumerate(names)]
        df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).write.mode("overwrite").parquet(path)
        return self._finish(path, seen, names)

    def _finish(self, path: str, seen: Observation, names: Sequence[str]) -> int:
        """Store what was counted, then mark the load as complete."""
        got = seen.get
        if names:
            self._write_measures(path, {name: int(got.get(f"m{i}") or 0) for i, name in enumerate(names)})
        files, mark = self._files(f"{path}/{COMMITTED}")
        files.createNewFile(mark)
        return int(got.get("rows", 0))

    def _write_measures(self, path: str, measures: Mapping[str, int]) -> None:
        files, where = self._files(f"{path}/{MEASURED}")
        out = files.create(where, True)
        out.write(bytearray(json.dumps(measures).encode()))
        out.close()

    def _read_measures(self, path: str) -> dict[str, int]:
        files, where = self._files(f"{path}/{MEASURED}")
        if not files.exists(where):
            return {}
        stream = files.open(where)
        text = bytes(stream.readAllBytes()).decode()
        stream.close()
        return json.loads(text)

    def build_parts(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        part: str,
        within: Sequence[str] = (),
        measures: Mapping[str, Column] | None = None,
    ) -> int:
        """Rebuild a parted table, one folder per value of the column ``part``; rows are ranged by it and ``within``."""

        def write(version: str) -> int:
            return self._load_parts(df, f"{version}/{self._next(version, 'load=')}", part, within, measures=measures)

        return self._replaced(layer, table, write)

    def replace_parts(
        self, df: DataFrame, layer: str, table: str, part: str, values: Collection[object], within: Sequence[str] = ()
    ) -> int:
        """Put ``df`` in place of the parts ``values`` alone; those without rows in ``df`` are empty from then on.

        All rows of ``df`` must be of these parts. Files of other parts stay as they are. What the replaced parts held is
        kept for readers that have listed it, until they are replaced again.
        """
        if not self.versions(layer, table):
            return self.build_parts(df, layer, table, part, within)
        folder = self.current(layer, table)
        before = self._parts(folder, part)
        path = f"{folder}/{self._next(folder, 'load=')}"
        rows = self._load_parts(df, path, part, within, values)
        for value in map(str, values):
            for old in before.get(value, [])[:-1]:
                self._delete(f"{folder}/{old}/{part}={value}")
        return rows

    def _parts(self, folder: str, part: str) -> dict[str, list[str]]:
        """The committed loads that hold each part, oldest first; the last one counts."""
        found: dict[str, list[str]] = {}
        for load in self._numbered(folder, "load="):
            names = self._names(f"{folder}/{load}")
            for name in names if COMMITTED in names else []:
                if name.startswith(f"{part}="):
                    found.setdefault(name.removeprefix(f"{part}="), []).append(load)
        return found

    def _load_parts(
        self,
        df: DataFrame,
        path: str,
        part: str,
        within: Sequence[str],
        values: Collection[object] = (),
        measures: Mapping[str, Column] | None = None,
    ) -> int:
        # Counted behind the shuffle, in the writing tasks: a map task that runs again would count twice.
        arranged = df.repartitionByRange(part, *within).sortWithinPartitions(part, *within)
        names = list(measures or {})
        seen = Observation()
        counts = [(measures or {})[name].alias(f"m{i}") for i, name in enumerate(names)]
        counted = arranged.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
        counted.write.mode("overwrite").partitionBy(part).parquet(path)
        for value in values:  # also those that are empty now
            files, where = self._files(f"{path}/{part}={value}")
            files.mkdirs(where)
        return self._finish(path, seen, names)

    def read_parts(self, layer: str, table: str, part: str, schema: T.StructType) -> DataFrame:
        """A parted table with its ``part`` as a column; ``schema`` are all its columns.

        Folders are told to Spark, which prunes them by filters on ``part`` as usual.
        """
        folder = self.current(layer, table)
        paths = [f"{folder}/{loads[-1]}/{part}={value}" for value, loads in self._parts(folder, part).items()]
        filled = [p for p in paths if self._filled(p)]
        if not filled:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("load", T.StringType())]))
        return reader.option("basePath", folder).parquet(*filled).select(*schema.names)

    def build_fact(self, df: DataFrame, layer: str, table: str, measures: Mapping[str, Column] | None = None) -> int:
        """Rebuild a dated table, one folder per month.

        Rows are ranged by month and listing, so a month is split where it is big, and its files hold
        listings apart from each other: a filter on a listing opens few of them.
        """
        monthly = df.withColumn("month", month_of("date"))
        return self.build_parts(monthly, layer, table, "month", ["listing_id", "date"], measures)

    def refresh_fact(self, df: DataFrame, layer: str, table: str, first: date, last: date) -> int:
        """Recompute only the months from ``first`` to ``last``; other months stay untouched.

        ``df`` is the full lazy model. Whole months are replaced, so late rows of a month are taken along; a
        month that has no rows any more loses its old ones.
        """
        begin = first.replace(day=1)
        months = [begin]
        while months[-1] <= last:
            months.append((months[-1] + timedelta(days=31)).replace(day=1))
        monthly = df.withColumn("month", month_of("date"))
        wanted = monthly.where(F.col("month").between(F.lit(begin), F.lit(last)))
        return self.replace_parts(wanted, layer, table, "month", months[:-1], ["listing_id", "date"])

    def read_fact(self, layer: str, table: str, schema: T.StructType) -> DataFrame:
        """A dated table with its ``month``; ``schema`` without it."""
        return self.read_parts(layer, table, "month", T.StructType([*schema.fields, T.StructField("month", T.DateType())]))

    def read(self, layer: str, table: str, schema: T.StructType | None = None) -> DataFrame:
        """All rows of a table. A parted one whose columns are known is better read by :meth:`read_parts`."""
        folder = self.current(layer, table)
        loads = self._committed(folder)
        parts = {n.partition("=")[0] for load in loads for n in self._names(f"{folder}/{load}") if "=" in n}
        if parts:
            (part,) = parts
            held = [f"{folder}/{kept[-1]}" for value, kept in self._parts(folder, part).items() if self._filled(f"{folder}/{kept[-1]}/{part}={value}")]
            return self.read_parts(layer, table, part, self.spark.read.parquet(held[0]).schema if held else schema or T.StructType())
        paths = [f"{folder}/{load}" for load in loads] or [folder]
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*paths)

    def read_raw(self, table: str) -> DataFrame:
        return self.read("raw", table, RAW[table])

    def count(self, layer: str, table: str) -> int:
        """Rows in a table; 0 where nothing has been stored. Other problems are errors."""
        if not self.versions(layer, table):
            return 0
        return self.read(layer, table, RAW.get(table) if layer == "raw" else None).count()

    def drop(self) -> None:
        """Delete all tables and files under the root."""
        self._delete(self.root)

    def load_raw(self, df: DataFrame, table: str, loaded_at: datetime, replace: bool = True, load_id: str | None = None) -> int:
        """Stamp rows, conform them to the table and store them."""
        rows = conform(stamped(df, loaded_at), table)
        return self.replace(rows, "raw", table) if replace else self.append(rows, "raw", table, load_id)


def register_views(models: dict[str, DataFrame]) -> None:
    """Offer models by name to SQL, as lazy temporary views."""
    for name, df in models.items():
        df.createOrReplaceTempView(name)

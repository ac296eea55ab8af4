"""A mart kept up to date load by load, reading only the periods a load changes.

Raw rows are stored by period (the calendar unit of ``F.trunc``: week, month, quarter) of their own date, one row per key
where the models keep the latest. A load is merged into the periods it touches:

* A later version of an order may move it to another period. ``order_periods`` holds the period of every order, by
  ``SLOTS`` slots of a hash of the id, so the old row is found without reading orders: only the slots of the load are read.
* A late, corrected or withdrawn rating changes its own record and the next one of the listing, which may lie in a later
  period. ``rating_ends`` holds, for each listing and period with a rating, its last one. Where a load changes that, the listing's next
  period is computed again too; and a period is computed with the last ratings before it, taken from there.
* Everything else depends on rows of the same date, so on the same period.

Then the fact's rows of these periods are computed from the stored rows of these periods and take the place of the old
ones. Files of other periods are neither read nor written.

Each step may be repeated: a load that died is loaded again under its id and ends in the same tables. What reaches the
driver are periods and slots, bounded by the calendar and by ``SLOTS``.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dailymart.operators import latest_per_key
from dailymart.plans.mart import FACT
from dailymart.plans.models import Models
from dailymart.plans.staging import stg_ratings_agg
from dailymart.schemas import LOADED_AT, RAW
from dailymart.sinks.lake import Lake

LAYER = "incremental"
INCOMING = "incoming"
SLOTS = 256
#: Period of rows without a date. They are kept, as a later version may have one, but no fact row comes of them.
UNDATED = date(1600, 1, 1)

#: The date each raw table goes by.
DATED = {"orders": "placed_at", "orders_daily": "date", "rank": "date", "ratings_agg": "date", "weather": "datetime"}
#: Keys of which the models keep the latest row, and what decides; the other tables keep every row.
LATEST = {
    "orders": (["order_id"], ["placed_at", LOADED_AT]),
    "orders_daily": (["listing_id", "date"], ["timestamp", LOADED_AT]),
    "ratings_agg": (["listing_id", "date"], [LOADED_AT]),
}
#: Columns by which the rows of a period are ranged, so that a period is dealt to several tasks and files where it is big.
RANGED = {
    "orders": ["listing_id", "order_id"],
    "orders_daily": ["listing_id"],
    "rank": ["listing_id", "timestamp"],
    "ratings_agg": ["listing_id"],
    "weather": ["outlet_id", "datetime"],
    "rating_ends": ["listing_id"],
}
PERIODS = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("period", T.DateType()), T.StructField("slot", T.IntegerType())])


class IncrementalMart:
    """The daily fact in ``lake`` over dimension tables ``dimensions`` (listing, outlet, org, platform).

    Other dimension rows than before are seen by periods computed from then on; :meth:`rebuild` computes all.
    """

    def __init__(self, lake: Lake, dimensions: Mapping[str, DataFrame], period: str = "month"):
        self.lake = lake
        self.dimensions = dict(dimensions)
        self.period = period
        if period not in ("week", "month", "quarter", "year"):
            raise ValueError(f"no calendar unit: {period}")

    def _of(self, column: Column | str) -> Column:
        day = F.to_date(F.col(column) if isinstance(column, str) else column)
        return F.coalesce(F.trunc(day, self.period), F.lit(UNDATED))

    def _periods(self, rows: DataFrame) -> set[date]:
        return {r.period for r in rows.select("period").distinct().collect()}

    def stored(self, table: str) -> DataFrame:
        """Stored raw rows with their period (and the load of tables that keep every row)."""
        more = [T.StructField("period", T.DateType())]
        more += [] if table in LATEST else [T.StructField("load_id", T.StringType())]
        return self.lake.read_parts(LAYER, table, "period", T.StructType([*RAW[table].fields, *more]))

    @property
    def fact(self) -> DataFrame:
        """The mart table; a filter on ``period`` prunes its folders."""
        return self.lake.read("mart", FACT)

    def load(self, load_id: str, tables: Mapping[str, DataFrame]) -> list[date]:
        """Store raw rows (schemas of the raw tables) and refresh the fact; returns the periods computed anew."""

        def merge(table: str) -> set[date]:
            if load_id not in self.lake.loads(INCOMING, table):
                self.lake.append(tables[table].select(*RAW[table].names), INCOMING, table, load_id)
            new = self.lake.spark.read.schema(RAW[table]).parquet(f"{self.lake.current(INCOMING, table)}/load={load_id}")
            return self._merge(table, new, load_id)

        with ThreadPoolExecutor(len(DATED)) as pool:  # the tables do not depend on each other
            changed = set().union(*pool.map(merge, sorted(tables)))
        self.refresh(changed)
        return sorted(changed - {UNDATED})

    def rebuild(self) -> None:
        """Compute the fact of all stored periods."""
        self.refresh(set().union(*(self._periods(self.stored(t)) for t in DATED)))

    def _merge(self, table: str, new: DataFrame, load_id: str) -> set[date]:
        """Merge rows into their periods; returns the periods whose fact rows may change."""
        new = new.withColumn("period", self._of(DATED[table]))
        if table not in LATEST:
            periods = self._periods(new)
            old = self.stored(table).where(F.col("period").isin(*periods) & (F.col("load_id") != load_id))
            self._put(table, old.unionByName(new.withColumn("load_id", F.lit(load_id))), periods)
            return periods
        keys, latest_by = LATEST[table]
        periods = self._periods(latest_per_key(new, keys, latest_by))
        # From here on versions that do not count do no harm: the latest is chosen among all, and ids are only looked up.
        if table == "orders":
            periods |= self._periods(self._known(new))
        old = self.stored(table).where(F.col("period").isin(*periods))
        self._put(table, latest_per_key(old.unionByName(new), keys, latest_by), periods)
        if table == "orders":
            self._remember(new, periods)
        if table == "ratings_agg":
            periods |= self._next_ratings(periods)
        return periods

    def _put(self, table: str, rows: DataFrame, periods: set[date]) -> None:
        self.lake.replace_parts(rows, LAYER, table, "period", sorted(periods), RANGED[table])

    # Orders: where a key is stored.

    def _slot(self) -> Column:
        return F.pmod(F.xxhash64("order_id"), F.lit(SLOTS)).cast("int")

    def _slots(self, orders: DataFrame) -> DataFrame:
        """The known periods of orders in the slots of ``orders``."""
        slots = [r.slot for r in orders.select(self._slot().alias("slot")).distinct().collect()]
        return self.lake.read_parts(LAYER, "order_periods", "slot", PERIODS).where(F.col("slot").isin(*slots))

    def _known(self, orders: DataFrame) -> DataFrame:
        return self._slots(orders).join(orders.select("order_id"), "order_id", "left_semi")

    def _remember(self, orders: DataFrame, periods: set[date]) -> None:
        """Note the period that the latest version of each order of a load is stored under now."""
        now = self.stored("orders").where(F.col("period").isin(*periods)).join(orders.select("order_id"), "order_id", "left_semi")
        now = now.select("order_id", "period", self._slot().alias("slot"))
        others = self._slots(orders).join(orders.select("order_id"), "order_id", "left_anti")
        slots = [r.slot for r in orders.select(self._slot().alias("slot")).distinct().collect()]
        self.lake.replace_parts(others.select(*PERIODS.names).unionByName(now), LAYER, "order_periods", "slot", sorted(slots), ["order_id"])

    # Ratings: what comes before and after a period.

    def _ends(self) -> DataFrame:
        last = T.StructField("last", T.StructType(RAW["ratings_agg"].fields))
        fields = [T.StructField("listing_id", T.LongType()), last, T.StructField("period", T.DateType())]
        return self.lake.read_parts(LAYER, "rating_ends", "period", T.StructType(fields))

    def _next_ratings(self, periods: set[date]) -> set[date]:
        """Bring the last ratings of ``periods`` up to date; returns the next periods of listings where they changed."""
        held = self.stored("ratings_agg").where(F.col("period").isin(*periods - {UNDATED}))
        # Ratings that the staging model drops are no records.
        live = held.join(stg_ratings_agg(held.drop("period")).select("listing_id", "date"), ["listing_id", "date"], "left_semi")
        ends = live.groupBy("listing_id", "period").agg(F.max_by(F.struct(*RAW["ratings_agg"].names), "date").alias("last"))
        ends = ends.select("listing_id", "last", "period")
        before = self._ends().where(F.col("period").isin(*periods))
        shown = [F.col("last")[c] for c in ("date", "cnt_ratings", "avg_rating")]
        one = before.select("listing_id", "period", F.struct(*shown).alias("was"))
        other = ends.select("listing_id", "period", F.struct(*shown).alias("now"))
        moved = one.join(other, ["listing_id", "period"], "full").where(~F.col("was").eqNullSafe(F.col("now")))
        moved = moved.select("listing_id", F.col("period").alias("at"))
        after = self._ends().where(F.col("period") > min(periods)).select("listing_id", "period")
        following = moved.join(after, "listing_id").where("period > at").groupBy("listing_id", "at").agg(F.min("period").alias("period"))
        found = self._periods(following)
        self._put("rating_ends", ends, periods)
        return found

    def _ratings(self, periods: set[date]) -> DataFrame:
        """Ratings of ``periods`` and, of each listing, the last one before each of them."""
        own = self.stored("ratings_agg").where(F.col("period").isin(*periods)).drop("period")
        wanted = F.array(*[F.lit(p) for p in sorted(periods)])
        target = F.array_min(F.filter(wanted, lambda p: p > F.col("period")))
        before = self._ends().where((F.col("period") < max(periods)) & ~F.col("period").isin(*periods))
        carried = before.withColumn("target", target).groupBy("listing_id", "target").agg(F.max_by("last", "period").alias("last"))
        return own.unionByName(carried.select("last.*"))

    # The fact.

    def refresh(self, periods: set[date]) -> None:
        """Compute the fact rows of ``periods`` from their stored rows and put them in place of the old ones."""
        periods = set(periods) - {UNDATED}
        if not periods:
            return
        raw = {t: self.stored(t).where(F.col("period").isin(*periods)).select(*RAW[t].names) for t in DATED if t != "ratings_agg"}
        fact = Models({**self.dimensions, **raw, "ratings_agg": self._ratings(periods)}).fact.withColumn("period", self._of("date"))
        # Ratings carried along lie in other periods.
        own = fact.where(F.col("period").isin(*periods))
        self.lake.replace_parts(own, "mart", FACT, "period", sorted(periods), ["listing_id", "date"])

"""Seven-day signals kept as counts per day, so that a moving window adds and retires days instead of counting them again.

The table has a row per day and product.  An update counts only the days whose files changed in Silver events or orders since
the versions it notes.  A window sums its whole days from the table; of the two days at its ends, which it holds in part, the events
and orders themselves are read.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import INTENT, product_signals
from ..sources.tables import VersionedTable


def day_counts(events: DataFrame, orders: DataFrame) -> DataFrame:
    """(day, product_id) with the signals of one day; orders count on the day of their first line."""
    seen = events.where(F.col("product_id").isNotNull() & F.col("event_type").isin("page_view", "add_to_cart")).select(
        F.to_date("event_ts").alias("day"), "product_id", F.lit(0).cast("long").alias("purchases_7d"),
        (F.col("event_type") == "add_to_cart").cast("long").alias("add_to_cart_7d"), (F.col("event_type") == "page_view").cast("long").alias("views_7d"))
    sold = orders.select(F.to_date("order_ts").alias("day"), F.inline("items")).where("product_id IS NOT NULL").select(
        "day", "product_id", F.coalesce(F.col("quantity").cast("long"), F.lit(0)).alias("purchases_7d"),
        F.lit(0).cast("long").alias("add_to_cart_7d"), F.lit(0).cast("long").alias("views_7d"))
    return seen.unionByName(sold).groupBy("day", "product_id").agg(*[F.sum(c).alias(c) for c in INTENT])


class RollingSignals:
    """``table`` is partitioned by day; ``events`` and ``orders`` (with items) by event_date and order_date."""

    def __init__(self, spark: SparkSession, table: VersionedTable, events: VersionedTable, orders: VersionedTable):
        if table.partition_by != ["day"]:
            raise ValueError("the table of counts is partitioned by day")
        self.spark, self.table, self.events, self.orders = spark, table, events, orders

    def update(self, keep: int = 3) -> list:
        """Counts the days that changed; those days, all of them where a noted version is no longer kept."""
        stands_for = {"events": self.events.version(), "orders": self.orders.version()}
        noted = self.table.pointer()["notes"] if self.table.exists() else {}
        if noted == stands_for:
            return []
        if any(noted.get(n) not in t._published() for n, t in (("events", self.events), ("orders", self.orders))):
            self.table.publish(day_counts(self.events.read(), self.orders.read()), keep=keep, notes=stands_for)
            return self._days(self.table.changed_partitions(None))
        days = self.events.changed_partitions(noted["events"]).select(F.col("event_date").alias("day")).union(
            self.orders.changed_partitions(noted["orders"])).distinct()
        rows = day_counts(self._of(self.events, "event_date", days), self._of(self.orders, "order_date", days))
        self.table.replace_partitions(days, rows, keep=keep, notes=stands_for)
        return self._days(days)

    @staticmethod
    def _days(days: DataFrame) -> list:
        return sorted(r[0] for r in days.collect())

    @staticmethod
    def _of(table: VersionedTable, column: str, days: DataFrame) -> DataFrame:
        return table.read_partitions(days.select(F.col("day").alias(column)))

    def signals(self, as_of: str, days: int = 7) -> DataFrame:
        """As :func:`product_signals` for the window that ends at ``as_of``."""
        now = datetime.fromisoformat(as_of)
        start = now - timedelta(days=days)
        first = start.date() if start == datetime.combine(start.date(), datetime.min.time()) else start.date() + timedelta(days=1)
        whole = [first + timedelta(days=i) for i in range((now.date() - first).days)]
        ends = sorted({start.date(), now.date()} - set(whole))
        frame = lambda ds: self.spark.createDataFrame([(d,) for d in ds], "day date")
        inner = self.table.read_partitions(frame(whole)).select("product_id", *INTENT)
        at_ends = frame(ends)
        outer = product_signals(self._of(self.events, "event_date", at_ends), self._of(self.orders, "order_date", at_ends), as_of, days)
        return inner.unionByName(outer).groupBy("product_id").agg(*[F.sum(c).alias(c) for c in INTENT])

"""End-to-end refresh: landing files to Bronze, Silver and the marts, gated by rules.

A refresh takes in what is new and passes on what changed.  New landing files are streamed to Bronze; new Bronze rows are merged into
Silver events and the dimensions.  The difference of two versions of Silver names the days whose files changed.  The
sessions of those days lead to the orders and carts that may have changed; they are built again from their sessions' rows, and
only those days of a mart are written whose rows differ.  A mart notes the version of Silver it stands for; where that version is
no longer kept, the mart is built in full.  Both ways give the same rows.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as q
from ..operators.marts import abandoned_carts, daily_sales, funnel, user_360
from ..operators.orders import fact_orders
from ..operators.sessions import silver_events
from ..schemas import EVENT, PRODUCT, PRODUCT_TRACKED, USER, USER_TRACKED, loosened, with_ingest_columns
from ..session import shuffles_dropped
from ..sources.tables import VersionedTable
from ..streaming.dimensions import Dimension
from ..streaming.incremental import SilverEvents
from ..streaming.ingest import counted, stream_events, stream_snapshot, trigger
from ..streaming.stateful import split_late

PARTITIONS = {
    "events": ["event_date"],
    "fact_orders": ["order_date"],
    "fact_daily_sales": ["sale_date"],
    "fact_funnel": ["event_date"],
    "fact_abandoned_carts": ["cart_date"],
}
# Columns the tables are clustered by after they were written.
CLUSTERED = {
    "events": ["event_ts", "user_id", "session_id_silver"],
    "fact_orders": ["order_ts", "user_id"],
    "fact_daily_sales": ["category"],
}
CLUSTERED_FILES = 64


class Refresh:
    """The tables of one warehouse and the steps that bring them up to date."""

    def __init__(
        self, spark: SparkSession, landing: str, warehouse: str, inactivity_minutes: float = 30, keep: int = 3,
        anonymous_key: str | None = None, tax_rate: float = 0.08, free_shipping_threshold: float = 75.0, flat_shipping: float = 9.99,
        quarantine_late_minutes: int | None = None, cluster: bool = False,
    ):
        self.spark, self.landing, self.warehouse, self.keep = spark, landing, warehouse, keep
        self.inactivity_minutes, self.anonymous_key, self.cluster = inactivity_minutes, anonymous_key, cluster
        self.rates = {"tax_rate": tax_rate, "free_shipping_threshold": free_shipping_threshold, "flat_shipping": flat_shipping}
        self.quarantine_late_minutes = quarantine_late_minutes
        self._work: list[str] = []
        self.bronze_counts: dict[str, list[dict]] = {}
        self.written: dict[str, list] = {}  # the partition days each mart had written

    def table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.warehouse}/{name}", PARTITIONS.get(name, []))

    # ---- Bronze
    def bronze_path(self, name: str) -> str:
        return f"{self.warehouse}/bronze/{name}_raw"

    def bronze_schema(self, name: str):
        pinned = {"events": EVENT, "users": USER, "products": PRODUCT}[name]
        return loosened(with_ingest_columns(pinned, dated=name == "events")).add("_rescued_data", "string")

    def ingest(self) -> None:
        """Take what is new under the landing folder into Bronze, with its rules counted on the way."""
        def where(name: str) -> tuple[str, str, str]:
            return f"{self.landing}/{name}", f"{self.warehouse}/_checkpoints/{name}", self.bronze_path(name)

        late = self.quarantine_late_minutes
        src, ckpt, target = where("events")
        query = stream_events(
            self.spark, src, ckpt, target, EVENT, rules=q.BRONZE_EVENTS,
            split=None if late is None else lambda rows: split_late(rows, late), quarantine=f"{self.warehouse}/_quarantine/events")
        self.bronze_counts["events"] = counted(query, q.BRONZE_EVENTS)
        for name, schema, rules in (("users", USER, q.BRONZE_USERS), ("products", PRODUCT, q.BRONZE_PRODUCTS)):
            src, ckpt, target = where(name)
            self.bronze_counts[name] = counted(stream_snapshot(self.spark, src, ckpt, schema, target, rules=rules), rules)

    def _arrived(self, name: str, take: Callable[[DataFrame, int], None]) -> None:
        """Hands on the Bronze rows that were not handed on before."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.bronze_path(name))
        if at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at):
            rows = self.spark.readStream.schema(self.bronze_schema(name)).parquet(self.bronze_path(name))
            checkpoint = f"{self.warehouse}/_checkpoints/silver_{name}"
            rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(**trigger("availableNow")).start().awaitTermination()

    def _nothing(self, name: str) -> DataFrame:
        return self.spark.createDataFrame([], self.bronze_schema(name))

    # ---- Silver
    def silver(self) -> None:
        events = SilverEvents(self.spark, self.table("events"), self.inactivity_minutes, self.anonymous_key, q.EVENTS)
        self._arrived("events", lambda batch, _: events.merge(batch, self.keep) and None)
        if not events.table.exists():
            empty = silver_events(self._nothing("events"), self.inactivity_minutes, anonymous_key=self.anonymous_key)
            events.table.publish(empty, q.EVENTS, anonymous_key=self.anonymous_key)
        for name, key, tracked, rules in (("users", "user_id", USER_TRACKED, q.DIM_USERS), ("products", "product_id", PRODUCT_TRACKED, q.DIM_PRODUCTS)):
            dimension = Dimension(self.spark, self.table(f"dim_{name}_scd2"), key, tracked, rules)
            self._arrived(name, lambda batch, number, d=dimension: d.merge(batch, number, self.keep) and None)
            if not dimension.table.exists():
                dimension.merge(self._nothing(name))

    # ---- what changed
    def _session_rows(self, events: VersionedTable, sessions: DataFrame, days: DataFrame, rows: DataFrame) -> DataFrame:
        """All rows of ``sessions``: ``rows``, theirs on ``days``, and those of the days beside, as long as a session goes on there.

        No gap within a session is longer than the limit, so a session that goes on does so within as many days.
        """
        reach = math.ceil(self.inactivity_minutes / 1440)
        parts, seen, edge = [rows], days, days
        while True:
            beside = edge.select(F.explode(F.sequence(F.date_sub("event_date", reach), F.date_add("event_date", reach))).alias("event_date"))
            beside = beside.distinct().join(seen, "event_date", "left_anti")
            more = self._staged(events.read_partitions(beside).join(sessions, "session_id_silver", "left_semi").select(*rows.columns))
            if more.isEmpty():
                break
            parts.append(more)
            edge = self._staged(more.select("event_date").distinct())
            seen = self._staged(seen.unionByName(beside))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def _staged(self, df: DataFrame) -> DataFrame:
        path = f"{self.warehouse}/_work/{uuid.uuid4().hex}"
        self._work.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _clear(self) -> None:
        for path in self._work:
            VersionedTable(self.spark, path)._delete(path)
        self._work.clear()

    def _replace_differing(self, table: VersionedTable, new: DataFrame, old: DataFrame, rest: DataFrame, rules, notes: dict) -> DataFrame | None:
        """``new`` takes the place of ``old`` where they differ; ``rest`` are the other rows of the same days.  The days written."""
        [day] = table.partition_by
        differing = old.exceptAll(new).select(day).unionByName(new.exceptAll(old).select(day)).distinct()
        differing = self._staged(differing)
        if differing.isEmpty():
            table.note(notes)
            return None
        rows = rest.unionByName(new)
        same = rows[day].eqNullSafe(differing[day])
        table.replace_partitions(differing, rows.join(differing, same, "left_semi"), rules, self.keep, notes)
        return differing

    def marts(self, as_of: str) -> None:
        events = self.table("events")
        version, stands_for = events.version(), {"events": events.version()}
        names = ("fact_orders", "fact_abandoned_carts", "fact_funnel", "fact_daily_sales")
        tables = {n: self.table(n) for n in names}
        seen = {t.pointer()["notes"].get("events") if t.exists() else None for t in tables.values()}
        [since] = seen if len(seen) == 1 else [None]
        self.written = {n: [] for n in names}
        if since is None or since not in events._published():
            whole = events.read()
            orders = tables["fact_orders"]
            orders.publish(fact_orders(whole, **self.rates), q.ORDERS, keep=self.keep, notes=stands_for)
            made = {
                "fact_daily_sales": (daily_sales(orders.read()), q.DAILY_SALES), "fact_funnel": (funnel(whole), q.FUNNEL),
                "fact_abandoned_carts": (abandoned_carts(whole), q.CARTS)}
            for name, (df, rules) in made.items():
                tables[name].publish(df, rules, keep=self.keep, notes=stands_for)
            self.written = {n: self._days(t.changed_partitions(None)) for n, t in tables.items()}
        elif since != version:
            self._changed_days(events, since, tables, stands_for)
        users, orders = self.table("dim_users_scd2").read(), tables["fact_orders"].read()
        self.table("dim_user_360").publish(user_360(users, orders, events.read(), as_of), q.USER_360, keep=self.keep)

    def _changed_days(self, events: VersionedTable, since: int, tables: dict[str, VersionedTable], notes: dict) -> None:
        days = self._staged(events.changed_partitions(since))
        after, before = self._staged(events.read_partitions(days)), events.read_partitions(days, since)
        sessions = self._staged(after.select("session_id_silver").unionByName(before.select("session_id_silver")).distinct())
        rows = self._staged(self._session_rows(events, sessions, days, after))
        touched = self._staged(rows.select("event_date").unionByName(days).distinct())
        built = {
            "fact_orders": (fact_orders(rows, **self.rates), q.ORDERS), "fact_abandoned_carts": (abandoned_carts(rows), q.CARTS)}
        replaced: dict[str, DataFrame | None] = {}
        for name, (made, rules) in built.items():
            table = tables[name]
            [day] = table.partition_by
            stored = table.read_partitions(touched.select(F.col("event_date").alias(day)))
            columns = stored.columns
            made = self._staged(made.select(*columns))
            old = stored.join(sessions, "session_id_silver", "left_semi").select(*columns)
            rest = stored.join(sessions, "session_id_silver", "left_anti").select(*columns)
            replaced[name] = self._replace_differing(table, made, old, rest, rules, notes)
        sold = replaced["fact_orders"]
        sales, orders = tables["fact_daily_sales"], tables["fact_orders"]
        if sold is None:
            sales.note(notes)
        else:
            wanted = sold.select(F.col("order_date").alias("sale_date"))
            sales.replace_partitions(wanted, daily_sales(orders.read_partitions(sold)), q.DAILY_SALES, self.keep, notes)
            replaced["fact_daily_sales"] = wanted
        steps = tables["fact_funnel"]
        stored = steps.read_partitions(days)
        made = self._staged(funnel(after).select(*stored.columns))
        replaced["fact_funnel"] = self._replace_differing(steps, made, stored, stored.limit(0), q.FUNNEL, notes)
        self.written |= {name: self._days(days) for name, days in replaced.items() if days is not None}

    @staticmethod
    def _days(partitions: DataFrame) -> list:
        return sorted((r[0] for r in partitions.collect()), key=str)

    def run(self, as_of: str) -> dict[str, VersionedTable]:
        with shuffles_dropped(self.spark):
            try:
                self.ingest()
                self.silver()
                self.marts(as_of)
            finally:
                self._clear()
            if self.cluster:
                for name, columns in CLUSTERED.items():
                    self.table(name).optimize(columns, CLUSTERED_FILES, self.keep)
        names = ("events", "dim_users_scd2", "dim_products_scd2", "fact_orders", "fact_daily_sales", "fact_funnel", "fact_abandoned_carts", "dim_user_360")
        return {n: self.table(n) for n in names}


def refresh(spark: SparkSession, landing: str, warehouse: str, as_of: str, inactivity_minutes: float = 30, keep: int = 3, **options) -> dict[str, VersionedTable]:
    """Bring a warehouse up to date.  A broken ``fail`` rule leaves the old version of that table visible
    and stops the refresh before anything that depends on it.  ``options`` are those of :class:`Refresh`."""
    return Refresh(spark, landing, warehouse, inactivity_minutes, keep, **options).run(as_of)

"""Silver events kept up to date from what arrives, without reading what is stored.

A session number depends on a visitor's history.  That history is kept as a state table beside Silver: per visitor and day the
last second and the last number.  New rows are numbered from the visitor's last day before them; of Silver only files that may
hold an arriving event id are opened (replaced copies), and the days from the first touched one on, where a visitor that
was touched has rows there.  Rows that arrive in order thus open the files of their own days.  Rows that keep their number are not
written again.

Silver is published first.  The state names the version of Silver that it stands for; if a job ended between the two, or Silver
was built otherwise, the state is made anew from Silver.  A batch that is repeated merges to the same rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import fingerprint, whole_seconds
from ..operators.events import known_events, latest_per_key
from ..operators.quality import Rule
from ..operators.sessions import sessionize, visitor_of
from ..sources.tables import VersionedTable


class SilverEvents:
    """``table`` holds Silver events, partitioned by event_date; its state lies at ``<path>_days``."""

    def __init__(self, spark: SparkSession, table: VersionedTable, inactivity_minutes: float = 30, anonymous_key: str | None = None,
                 rules: Iterable[Rule] = ()):
        self.spark, self.table, self.rules = spark, table, list(rules)
        self.inactivity_minutes, self.anonymous_key = inactivity_minutes, anonymous_key
        self.state = VersionedTable(spark, f"{table.path}_days", ["event_date"], keys=["_visitor"], stats=["event_date"])
        self._work: list[str] = []

    # rows written down once, as several steps read them; gone when the merge ends
    def _stage(self, df: DataFrame) -> DataFrame:
        path = f"{self.table.path}_work/{uuid.uuid4().hex}"
        self._work.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _clear(self) -> None:
        for path in self._work:
            self.table._delete(path)
        self._work.clear()

    def _sessionized(self, rows: DataFrame, seed: DataFrame | None = None) -> DataFrame:
        return sessionize(rows, self.inactivity_minutes, self.anonymous_key, seed=seed)

    def _as_arrived(self, silver: DataFrame) -> DataFrame:
        """Silver rows in the columns of Bronze, with their visitor and their present id."""
        plain = silver.withColumnRenamed("session_id_raw", "session_id")
        return plain.withColumn("_visitor", visitor_of(self.anonymous_key)).withColumnsRenamed({"session_id_silver": "_old", "event_date": "_day"})

    def _days_of(self, silver: DataFrame) -> DataFrame:
        """The state of Silver rows: the last second and number per visitor and day."""
        number = F.substring_index("_old", "_", -1).cast("long")
        return self._as_arrived(silver).groupBy("_visitor", F.col("_day").alias("event_date")).agg(
            F.max(whole_seconds(F.col("event_ts"))).alias("last_second"), F.max(number).alias("last_number"))

    def state_is_current(self) -> bool:
        return self.state.exists() and self.state.pointer().get("notes", {}).get("silver") == self.table.version()

    def rebuild_state(self, keep: int = 2) -> None:
        self.state.publish(self._days_of(self.table.read()), keep=keep, notes={"silver": self.table.version()})

    def merge(self, bronze: DataFrame, keep: int = 10) -> int | None:
        """Takes in Bronze rows, late and repeated ones included; the version of Silver they led to."""
        try:
            fresh = self._stage(latest_per_key(known_events(bronze), "event_id"))
            if not self.table.exists():
                self.table.keys = self.table.keys or ["event_id"]
                version = self.table.publish(self._sessionized(fresh), self.rules, keep=keep, anonymous_key=self.anonymous_key)
                self.rebuild_state()
                return version
            self.table._require(self.table.pointer()["details"], {"anonymous_key": self.anonymous_key})
            if not self.state_is_current():
                self.rebuild_state()
            return self._merge(fresh, keep)
        finally:
            self._clear()

    def _met(self, fresh: DataFrame, stored: DataFrame) -> DataFrame:
        """Stored copies of arrived events: their visitor and day, and whether the arrived copy is newer.

        Of equal copies the stored one stays.  Whole rows are read, for their hashes, only if copies came at the same time from the
        same file; none is shuffled.
        """
        kinds = fresh.unionByName(stored.select(*fresh.columns)).schema  # order and hashes depend on the type
        fresh, stored = (df.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in kinds}) for df in (fresh, stored))
        rank = F.struct(F.lit(0), *[c for c in ("_ingest_ts", "_source_file") if c in fresh.columns])  # nulls are least, so last of the newest
        held = stored.select("event_id", "_visitor", "_day", rank.alias("_held")).join(fresh.select("event_id", rank.alias("_rank")), "event_id")
        met = self._stage(held.select(
            "event_id", "_visitor", "_day", (F.col("_rank") > F.col("_held")).alias("_newer"), (F.col("_rank") == F.col("_held")).alias("_same")))
        same = met.where("_same").select("event_id")
        if same.isEmpty():
            return met.drop("_same")
        hashed = [df.select("event_id", fingerprint(df.select(*kinds.names)).alias(name)).join(same, "event_id", "left_semi")
                  for df, name in ((fresh, "_hash"), (stored, "_held_hash"))]
        later = hashed[0].join(hashed[1], "event_id").where("_hash > _held_hash").select("event_id", F.lit(True).alias("_later"))
        newer = F.col("_newer") | (F.col("_same") & F.coalesce("_later", F.lit(False)))
        return self._stage(met.join(later, "event_id", "left").select("event_id", "_visitor", "_day", newer.alias("_newer")))

    def _merge(self, fresh: DataFrame, keep: int) -> int | None:
        """Rows are numbered by their ids, visitors and times alone; whole rows meet their number once, when they are written."""
        met = self._met(fresh, self._as_arrived(self.table.read_around(fresh, ["event_id"])))
        older = met.where("NOT _newer").select("event_id")
        new = fresh if older.isEmpty() else self._stage(fresh.join(older, "event_id", "left_anti").select(*fresh.columns))
        if new.isEmpty():  # all copies are older than what is stored
            return self.table.version()
        replaced = met.where("_newer")
        touched = self._stage(
            new.select(visitor_of(self.anonymous_key).alias("_visitor"), F.to_date("event_ts").alias("day"))
            .union(replaced.select("_visitor", "_day"))
            .groupBy("_visitor").agg(F.min("day").alias("_from")))
        known = self._stage(self.state.read_matching(touched, ["_visitor"]).where("last_second IS NOT NULL").join(touched, "_visitor"))
        latest = F.max(F.struct("event_date", "last_second", "last_number")).alias("s")
        seed = known.where("event_date < _from").groupBy("_visitor").agg(latest).select(
            "_visitor", F.col("s.last_second").alias("_seed_second"), F.col("s.last_number").alias("_seed_number"))
        later = known.where("event_date >= _from")
        narrow = list(dict.fromkeys(["event_id", "event_ts", "user_id", *([self.anonymous_key] if self.anonymous_key else [])]))
        theirs = (
            self._as_arrived(self.table.read_partitions(later.select("event_date").distinct()))
            .select(*narrow, "_old", "_visitor", "_day")
            .join(touched, "_visitor").where("_day >= _from")
            .join(replaced.select("event_id"), "event_id", "left_anti")
        )
        rows = theirs.select(*narrow, "_old").unionByName(new.select(*narrow, F.lit(None).cast("string").alias("_old")))
        numbered = self._stage(self._sessionized(rows, seed))
        changed = numbered.where("NOT session_id_silver <=> _old").select("event_id", "_old", "session_id_silver", "event_date")
        version = self.table.upsert(
            self._whole(changed, new), ["event_id"], rules=self.rules, keep=keep, settled=True, asked=changed.select("event_id"),
            anonymous_key=self.anonymous_key)
        days = self._days_of(numbered.drop("_old"))
        emptied = later.join(days, ["_visitor", "event_date"], "left_anti").select(
            "_visitor", "event_date", F.lit(None).cast("long").alias("last_second"), F.lit(None).cast("long").alias("last_number"))
        self.state.upsert(self._stage(days.unionByName(emptied)), ["_visitor", "event_date"], keep=2, notes={"silver": version}, settled=True)
        return version

    def _whole(self, changed: DataFrame, new: DataFrame) -> DataFrame:
        """Silver rows of ``changed``: arrived ones, and stored ones under another number."""
        ids = ["event_id", "session_id_silver", "event_date"]
        rows = new.withColumnRenamed("session_id", "session_id_raw").join(changed.where("_old IS NULL").select(*ids), "event_id")
        columns = ["session_id_raw" if c == "session_id" else c for c in new.columns] + ids[1:]
        rows = rows.select(*columns)
        moved = changed.where("_old IS NOT NULL")
        if moved.isEmpty():
            return rows
        stored = self.table.read_partitions(moved.select("event_date").distinct()).drop("session_id_silver", "event_date")
        return rows.unionByName(stored.join(moved.select(*ids), "event_id").select(*columns))

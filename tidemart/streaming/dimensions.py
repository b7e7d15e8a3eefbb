"""Versioned dimensions kept up to date from arriving snapshots, in any order of delivery.

Snapshots that change nothing leave no trace in the versions, yet decide where a later arrival splits an interval.  So all
snapshots are kept in a table of their own, with a filter over the key in each file's entry.  An arrival reads the snapshots of its
own keys, from files that may hold one, numbers those keys again and merges their versions: an interval is closed, split or
begun earlier, wherever the arrival falls.  A snapshot more never makes versions fewer, so no version has to be taken away.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.events import keyed_rows
from ..operators.history import versions
from ..operators.quality import Rule
from ..session import shuffles_dropped
from ..sources.tables import VersionedTable

LOT_ROWS = 40_000_000  # of the snapshots whose versions are built in one go


class Dimension:
    """``table`` holds the versions; the snapshots lie at ``<path>_snapshots``."""

    def __init__(
        self, spark: SparkSession, table: VersionedTable, key: str, tracked: Sequence[str], rules: Sequence[Rule] = (), **options
    ):
        self.spark, self.table, self.key, self.tracked = spark, table, key, list(tracked)
        self.rules, self.options = rules, options
        self.snapshots = VersionedTable(spark, f"{table.path}_snapshots", keys=[key])

    def merge(self, arrived: DataFrame, batch: int | None = None, keep: int = 3) -> int | None:
        """Takes in snapshots; the version of the dimension they led to.

        ``batch`` numbers the deliveries: one that is repeated adds no snapshots again.  Versions are merged in any case, so
        a job that ended between the two is made good by the repetition.
        """
        if not self.snapshots.exists():
            self.snapshots.publish(keyed_rows(arrived, self.key), keep=2, notes={"batch": batch})
            return self._built(arrived.columns, keep)
        pointer = self.snapshots.pointer()
        if batch is None or pointer["notes"].get("batch") != batch:
            version = self.snapshots.append(keyed_rows(arrived, self.key), keep=2, notes={"batch": batch})
        else:
            version = pointer["version"]
        if not self.table.exists():
            return self._built(arrived.columns, keep)
        rows = self.snapshots.read_written(version)  # what arrived, as it was written
        if rows.isEmpty():
            return self.table.version()
        return self._number(self.snapshots.read_matching(rows, [self.key]), arrived.columns, keep, rows.select(self.key).distinct())

    def _built(self, columns: list[str], keep: int) -> int:
        """The versions of all snapshots.

        Whole rows are shuffled for them, which would take more disk than the tables themselves.  So large tables are built by lots of
        keys: each reads the snapshots again, and shuffles its own.
        """
        snapshots = self.snapshots.read().select(*columns)
        rows = self.snapshots.files().agg(F.sum("rows")).first()[0] or 0
        n = -(-rows // LOT_ROWS)
        self.table.keys = self.table.keys or [self.key]
        if n < 2:
            return self.table.publish(self._versions(snapshots), self.rules, keep=keep)
        lot = F.pmod(F.xxhash64(self.key), F.lit(n))

        def lots() -> Iterator[DataFrame]:
            for i in range(n):
                yield self._versions(snapshots.where(lot == i))

        made = lots()
        with shuffles_dropped(self.spark):
            return self.table.publish(next(made), self.rules, keep=keep, more=made)

    def _versions(self, snapshots: DataFrame) -> DataFrame:
        return versions(snapshots, self.key, self.tracked, **self.options)

    def _number(self, snapshots: DataFrame, columns: list[str], keep: int, keys: DataFrame) -> int:
        """The versions of all keys of ``snapshots``, which holds every snapshot of theirs, take the place of what these ``keys`` had."""
        return self.table.upsert(
            self._versions(snapshots.select(*columns)), [self.key], rules=self.rules, keep=keep, settled=True, asked=keys)

"""Upserts per micro-batch, watermarks, late data, live sessions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.events import latest_per_key
from ..sources.tables import VersionedTable
from .incremental import SilverEvents
from .ingest import trigger

WATERMARK_MINUTES = 60
MAX_LATE_MINUTES = 1_440


def upsert_stream(
    stream: DataFrame,
    table: VersionedTable,
    keys: list[str],
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    when: str = "availableNow",
    keep: int = 10,
    **details,
) -> StreamingQuery:
    """Merge every micro-batch into a versioned table.

    A batch repeated after a failure merges to the same rows.  Without ``prepare`` the latest
    copy of each key in the batch is merged.
    """
    def merge(batch: DataFrame, _: int) -> None:
        rows = prepare(batch) if prepare else latest_per_key(batch, keys)
        table.upsert(rows, keys, keep=keep, **details)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(**trigger(when)).start()


def silver_stream(
    bronze: DataFrame, table: VersionedTable, checkpoint: str, inactivity_minutes: float = 30, when: str = "availableNow",
    anonymous_key: str | None = None, keep: int = 10,
) -> StreamingQuery:
    """Keep Silver events up to date: only what each batch touches is numbered again (see :mod:`incremental`).

    The table records its ``anonymous_key``; one that was built under another rule is refused.
    """
    silver = SilverEvents(table.spark, table, inactivity_minutes, anonymous_key)
    writer = bronze.writeStream.foreachBatch(lambda batch, _: silver.merge(batch, keep) and None)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger(when)).start()


def deduplicated(stream: DataFrame, minutes: int = WATERMARK_MINUTES) -> DataFrame:
    """First arrival of each event id; ids are remembered for the watermark's length."""
    return stream.withWatermark("event_ts", f"{minutes} minutes").dropDuplicatesWithinWatermark(["event_id"])


def split_late(events: DataFrame, max_late_minutes: int = MAX_LATE_MINUTES) -> tuple[DataFrame, DataFrame]:
    """On-time rows, and rows for quarantine with the reason; works on batches and streams."""
    late = F.unix_micros("_ingest_ts") - F.unix_micros("event_ts") > max_late_minutes * 60_000_000
    drifted = F.col("_rescued_data").isNotNull() if "_rescued_data" in events.columns else F.lit(False)
    reason = F.when(drifted, "drifted").when(F.coalesce(late, F.lit(False)), "late")
    judged = events.withColumn("quarantine_reason", reason)
    return judged.where("quarantine_reason IS NULL").drop("quarantine_reason"), judged.where("quarantine_reason IS NOT NULL")


def live_sessions(stream: DataFrame, inactivity_minutes: int = 30, watermark_minutes: int = WATERMARK_MINUTES) -> DataFrame:
    """Sessions per visitor by event-time gaps, emitted once the watermark has passed them.

    Unlike the batch rule this one looks at fractions of a second, and numbers nothing.
    """
    return (
        stream.withWatermark("event_ts", f"{watermark_minutes} minutes")
        .groupBy(F.session_window("event_ts", f"{inactivity_minutes} minutes").alias("w"), "user_id")
        .agg(F.count(F.lit(1)).alias("events"), F.min("event_ts").alias("first_ts"), F.max("event_ts").alias("last_ts"))
        .drop("w")
    )

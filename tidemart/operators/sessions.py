"""Gap sessions that stay balanced when one visitor owns a large part of the events.

A session starts where the whole-second gap to the visitor's previous event exceeds the
limit.  Cut time into slots as wide as the limit: two events in one slot are closer than the
limit, so only the first event of a slot can start a session and the session number is
constant within it.  The window therefore runs over (visitor, slot) summaries, which are
combined before the shuffle: at 30 minutes a visitor has at most 48 a day, however many
events lie behind them.  The events take their number back through a join on
(visitor, slot), whose skewed partitions AQE may split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import whole_seconds
from .events import known_events, latest_per_key


def visitor_of(anonymous_key: str | None) -> Column:
    """Whose event it is: the user, else the one anonymous visitor or, by ``anonymous_key``, one of several."""
    nobody = F.lit("a") if anonymous_key is None else F.concat(F.lit("a"), F.coalesce(F.col(anonymous_key), F.lit("")))
    return F.coalesce(F.concat(F.lit("u"), F.col("user_id")), nobody)


def _session_label(anonymous_key: str | None) -> Column:
    if anonymous_key is None:
        owner = F.coalesce(F.col("user_id"), F.lit("anon"))
    else:
        owner = F.coalesce(F.col("user_id"), F.concat_ws("_", F.lit("anon"), F.col(anonymous_key)))
    return F.concat_ws("_", owner, F.col("_number").cast("string"))


def session_numbers(marked: DataFrame, limit: int, seed: DataFrame | None = None) -> DataFrame:
    """(_visitor, _slot) -> session number, from rows that carry _visitor, _slot and _second.

    ``seed`` has the second and number of each visitor's last earlier event, if any.
    """
    slots = marked.groupBy("_visitor", "_slot").agg(
        F.min("_second").alias("_first"), F.max("_second").alias("_last")
    )
    if seed is None:
        slots = slots.withColumns({"_seed_second": F.lit(None).cast("long"), "_seed_number": F.lit(0)})
    else:
        slots = slots.join(seed, "_visitor", "left")
    in_time = Window.partitionBy("_visitor").orderBy("_slot")
    idle = F.col("_first") - F.coalesce(F.lag("_last").over(in_time), F.col("_seed_second"))
    starts = slots.withColumn("_start", F.when(idle <= limit, 0).otherwise(1))
    so_far = in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    number = F.coalesce(F.col("_seed_number"), F.lit(0)) + F.sum("_start").over(so_far)
    return starts.select("_visitor", "_slot", number.alias("_number"))


def sessionize(
    events: DataFrame,
    inactivity_minutes: float = 30,
    anonymous_key: str | None = None,
    method: str = "slots",
    seed: DataFrame | None = None,
) -> DataFrame:
    """Add session_id_silver and event_date; session_id becomes session_id_raw.

    All events without a user form one visitor unless ``anonymous_key`` names a column that
    tells them apart.  ``method='window'`` is the plain one-window plan with the same ids.
    """
    limit = int(inactivity_minutes * 60)
    marked = events.withColumns({
        "_visitor": visitor_of(anonymous_key),
        "_second": whole_seconds(F.col("event_ts")),
    })
    if method == "slots":
        marked = marked.withColumn("_slot", F.floor(F.col("_second") / F.lit(max(limit, 1))))
        numbered = marked.join(session_numbers(marked, limit, seed), ["_visitor", "_slot"])
    elif method == "window" and seed is None:
        in_time = Window.partitionBy("_visitor").orderBy("event_ts")
        idle = F.col("_second") - F.lag("_second").over(in_time)
        marked = marked.withColumn("_start", F.when(idle <= limit, 0).otherwise(1))
        # The default frame is RANGE: events at the same instant share one number.
        numbered = marked.withColumn("_number", F.sum("_start").over(in_time))
    else:
        raise ValueError(f"method {method!r} is unknown or takes no seed")
    renamed = [
        F.col(c).alias("session_id_raw" if c == "session_id" else c) for c in events.columns
    ]
    return numbered.select(
        *renamed,
        _session_label(anonymous_key).alias("session_id_silver"),
        F.to_date("event_ts").alias("event_date"),
    )


def silver_events(bronze: DataFrame, inactivity_minutes: float = 30, **options) -> DataFrame:
    """Bronze rows to Silver events: domain filter, latest copy, session ids."""
    return sessionize(latest_per_key(known_events(bronze), "event_id"), inactivity_minutes, **options)


def renumbered(
    silver: DataFrame, arrived: DataFrame, inactivity_minutes: float = 30, anonymous_key: str | None = None
) -> DataFrame:
    """Silver rows to upsert after more Bronze rows arrived, late or repeated ones included.

    Session numbers depend on a visitor's history, so numbering the arrivals on their own
    would clash with stored ids.  For each visitor they touch (by a new row, or by the stored
    row it replaces) everything from the first touched instant on is numbered again, starting
    from the visitor's last earlier event; what lies before keeps its number.  ``anonymous_key`` must be the one that
    ``silver`` was numbered with.
    """
    fresh = known_events(arrived)
    stored = silver.withColumnRenamed("session_id_raw", "session_id").withColumn("_visitor", visitor_of(anonymous_key))
    replaced = stored.join(fresh.select("event_id").distinct(), "event_id", "left_semi")
    touched = (
        fresh.select(visitor_of(anonymous_key).alias("_visitor"), "event_ts")
        .union(replaced.select("_visitor", "event_ts"))
        .groupBy("_visitor")
        .agg(F.min("event_ts").alias("_from"))
    )
    theirs = stored.join(touched, "_visitor")
    number = F.substring_index("session_id_silver", "_", -1).cast("long")
    seed = theirs.where("event_ts < _from").groupBy("_visitor").agg(
        F.max(whole_seconds(F.col("event_ts"))).alias("_seed_second"), F.max(number).alias("_seed_number")
    )
    later = theirs.where("event_ts >= _from").drop("session_id_silver", "event_date", "_visitor", "_from")
    merged = latest_per_key(later.unionByName(fresh.select(*later.columns)), "event_id")
    return sessionize(merged, inactivity_minutes, anonymous_key, seed=seed)


def ingested_between(bronze: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Bronze rows of a span of ingest days, both included."""
    return bronze.where(F.col("_ingest_date").between(F.to_date(F.lit(first_day)), F.to_date(F.lit(last_day))))


def backfill(
    silver: DataFrame, bronze: DataFrame, first_day: str, last_day: str, inactivity_minutes: float = 30,
    anonymous_key: str | None = None,
) -> DataFrame:
    """Rows to upsert after replaying the Bronze rows ingested in a span of days (inclusive)."""
    return renumbered(silver, ingested_between(bronze, first_day, last_day), inactivity_minutes, anonymous_key)

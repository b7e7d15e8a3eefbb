"""Keys that hold a large share of the rows, divided by measured counts.

Nothing here has a cap: every key above the wanted rows per task is divided.  The tables of such keys are written down before they
are joined.  Where no key is large, there is no join at all.  Otherwise their size is known when the join is planned: small ones are
broadcast, so the facts need no shuffle by the large key, and for large ones both sides of the join have an exchange of their own, so
Spark may split a large key.  Both tables have at most one row per ``rows_per_task`` rows of input (slices: and per minute
of a divided key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import fingerprint, time_slice
from ..session import stage

ROWS_PER_TASK = 1_000_000
MINUTE = 60


def large_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(_key, _lanes) of the keys above ``rows_per_task`` rows; counts combine before the shuffle."""
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > rows_per_task).select(
        "_key", F.ceil(F.col("_n") / F.lit(rows_per_task)).cast("int").alias("_lanes"))


def settled_large_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame | None:
    """:func:`large_keys`, written down; None where no key is large."""
    found = stage(large_keys(df, key, rows_per_task), "large-keys")
    return None if found.isEmpty() else found


def with_slices(df: DataFrame, key: str, at: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Add _heavy and _slice: time slices of about ``rows_per_task`` rows for large keys, 0 for all others.

    Borders lie between minutes and follow the running count of a key's rows; rows without a time come first, as one minute.
    """
    minute = time_slice(F.col(at), MINUTE)
    large = settled_large_keys(df, key, rows_per_task)
    if large is None:
        return df.withColumns({"_heavy": F.lit(False), "_slice": F.lit(0).cast("long")})
    counts = (
        df.select(F.col(key).alias("_key"), minute.alias("_minute")).join(large.select("_key"), "_key", "left_semi")
        .groupBy("_key", "_minute").agg(F.count(F.lit(1)).alias("_n"))
    )
    earlier = Window.partitionBy("_key").orderBy("_minute").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    slices = stage(counts.select(
        F.col("_key").alias("_large_key"), "_minute", F.floor(before / F.lit(rows_per_task)).alias("_cut")), "slices")
    joined = df.withColumn("_at_minute", minute).join(
        slices, (F.col(key) == F.col("_large_key")) & F.col("_at_minute").eqNullSafe(F.col("_minute")), "left")
    return joined.withColumns({
        "_heavy": F.col("_large_key").isNotNull(), "_slice": F.coalesce(F.col("_cut"), F.lit(0)),
    }).drop("_large_key", "_minute", "_at_minute", "_cut")


def with_lanes(df: DataFrame, key: str, lanes: DataFrame | None) -> DataFrame:
    """Add _lane: rows of large keys are spread by their hash over the key's lanes, others are in lane 0."""
    if lanes is None:
        return df.withColumn("_lane", F.lit(0))
    named = lanes.withColumnRenamed("_key", "_large_key")
    joined = df.withColumn("_spread", fingerprint(df)).join(named, F.col(key) == F.col("_large_key"), "left")
    own = F.coalesce(F.pmod("_spread", "_lanes"), F.lit(0)).cast("int")
    return joined.withColumn("_lane", own).drop("_spread", "_large_key", "_lanes")


def in_every_lane(df: DataFrame, key: str, lanes: DataFrame | None) -> DataFrame:
    """Rows once for each lane of their key, with _lane."""
    if lanes is None:
        return df.withColumn("_lane", F.lit(0))
    named = lanes.withColumnRenamed("_key", "_large_key")
    joined = df.join(named, F.col(key) == F.col("_large_key"), "left")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("_lanes", F.lit(1)) - 1))
    return joined.withColumn("_lane", every).drop("_large_key", "_lanes")

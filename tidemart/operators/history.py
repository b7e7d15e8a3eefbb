"""Versioned dimensions (SCD2) and point-in-time lookups.

A plain window per key would put a key with a third of all rows into one task.  For versions, the rows of such large
keys are ordered within (key, time slice), with slice borders from measured counts, and what crosses a border is carried
through per-slice summaries.  For lookups, a large key's facts are spread over lanes and its versions copied into
each lane.  All other keys have a single slice or lane.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import fingerprint
from .events import keyed_rows
from .heavy import ROWS_PER_TASK, in_every_lane, settled_large_keys, with_lanes, with_slices


def _joined_hash(tracked: Sequence[str]) -> Column:
    """The older rule: a hash of the joined non-null values, which misses a value moving to a neighbouring null column."""
    return F.sha2(F.concat_ws("||", *[F.col(c).cast("string") for c in tracked]), 256)


def _slice_borders(steps: DataFrame, key: str, at: str, inner: Column, state: Sequence[str]) -> DataFrame:
    """Per slice of a heavy key: does its first row open a version, how many versions lie
    before it, and when does the next version after it begin."""
    whole = F.struct(*[F.col(c) for c in state])  # compares null-safely
    slices = steps.where("_heavy").groupBy(key, "_slice").agg(
        F.min_by(whole, "_pos").alias("_head"),
        F.max_by(whole, "_pos").alias("_tail"),
        F.min(at).alias("_head_at"),
        F.min(F.when(inner, F.col(at))).alias("_inner_at"),
        F.count_if(inner).alias("_inner_n"),
    )
    by_time = Window.partitionBy(key).orderBy("_slice")
    earlier = by_time.rowsBetween(Window.unboundedPreceding, -1)
    # Read backwards in time, the next change of a later slice is the last one seen.
    later = Window.partitionBy(key).orderBy(F.col("_slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    first = F.lag("_slice").over(by_time).isNull()
    slices = slices.withColumn("_opens", first | ~F.lag("_tail").over(by_time).eqNullSafe(F.col("_head")))
    slices = slices.withColumn("_entry", F.when(F.col("_opens"), F.col("_head_at")).otherwise(F.col("_inner_at")))
    return slices.select(
        key,
        "_slice",
        "_opens",
        F.sum(F.col("_inner_n") + F.col("_opens").cast("int")).over(earlier).alias("_before"),
        F.last("_entry", ignorenulls=True).over(later).alias("_next"),
    )


def versions(
    snapshots: DataFrame,
    key: str,
    tracked: Sequence[str],
    at: str = "updated_ts",
    compat_hash: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Snapshots to versions: a row where the tracked state differs from the one before.

    Adds valid_from (inclusive), valid_to (exclusive, null while current), is_current and
    version (from 1).  Equal times are ordered by ingest time, then by row hash.
    """
    rows = keyed_rows(snapshots, key)
    order = [F.col(at).asc_nulls_first()]
    if "_ingest_ts" in rows.columns:
        order.append(F.col("_ingest_ts").asc_nulls_first())
    order.append(F.col("_hash"))
    rows = rows.withColumn("_hash", fingerprint(rows))
    if compat_hash:
        rows = rows.withColumn("_state", _joined_hash(tracked))
    state = ["_state"] if compat_hash else list(tracked)
    rows = with_slices(rows, key, at, rows_per_task)

    in_slice = Window.partitionBy(key, "_slice").orderBy(*order)
    steps = rows.withColumns({
        "_pos": F.row_number().over(in_slice),
        # Column by column: a struct of them would travel and be sorted beside the columns themselves.
        "_moved": ~reduce(and_, [F.lag(c).over(in_slice).eqNullSafe(F.col(c)) for c in state], F.lit(True)),
    })
    inner = (F.col("_pos") > 1) & F.col("_moved")
    carried = steps.join(_slice_borders(steps, key, at, inner, state), [key, "_slice"], "left")
    opens = (F.col("_pos") == 1) & F.coalesce(F.col("_opens"), F.lit(True))
    numbered = carried.where(opens | inner).withColumns({
        "valid_from": F.col(at),
        "valid_to": F.when(F.lead(F.lit(True)).over(in_slice), F.lead(at).over(in_slice)).otherwise(F.col("_next")),
        "version": (F.coalesce(F.col("_before"), F.lit(0)) + F.row_number().over(in_slice)).cast("int"),
    }).withColumn("is_current", F.col("valid_to").isNull())
    return numbered.select(*snapshots.columns, "valid_from", "valid_to", "is_current", "version")


def current(dimension: DataFrame, active_only: bool = False) -> DataFrame:
    rows = dimension.where("is_current")
    return rows.where("active") if active_only else rows


def as_of_versions(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    at: str,
    columns: Sequence[str],
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Each fact with ``columns`` of the version valid at its time (half-open interval).

    No pair of facts and versions is ever formed: the facts and versions of a key (and lane, for large keys) are laid in one
    time order and the last version seen is the answer.
    """
    if how == "inner":
        facts = facts.where(F.col(key).isNotNull() & F.col(at).isNotNull())
    elif how != "left":
        raise ValueError(f"unknown join type {how!r}")
    dimension = dimension.where(F.col(key).isNotNull() & F.col("valid_from").isNotNull())
    lanes = settled_large_keys(facts, key, rows_per_task)

    facts_only = [c for c in facts.columns if c not in (key, at)]
    f = facts.select(F.col(key).alias("_key"), F.col(at).alias("_at"), *[F.col(c).alias(f"_f_{c}") for c in facts_only])
    v = dimension.select(
        F.col(key).alias("_key"), F.col("valid_from").alias("_at"), F.col("version").alias("_nth"),
        F.struct("valid_to", *columns).alias("_version"),
    )
    f = with_lanes(f, "_key", lanes)
    if how == "left":
        # Facts without a key match nothing; their hash spreads them over many groups.
        spread = F.pmod(fingerprint(f), F.lit(1024)).cast("int")
        f = f.withColumn("_lane", F.when(F.col("_key").isNull(), spread).otherwise(F.col("_lane")))
    v = in_every_lane(v, "_key", lanes)

    # At one instant the version comes before the fact: valid_from is inclusive.
    lane = v.withColumn("_kind", F.lit(1)).unionByName(f.withColumn("_kind", F.lit(2)), allowMissingColumns=True)
    so_far = (
        Window.partitionBy("_key", "_lane").orderBy("_at", "_kind", "_nth")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    met = lane.withColumn("_version", F.last("_version", ignorenulls=True).over(so_far)).where("_kind = 2")
    valid = F.col("_version").isNotNull() & (
        F.col("_version.valid_to").isNull() | (F.col("_at") < F.col("_version.valid_to"))
    )
    met = met.where(valid) if how == "inner" else met.withColumn("_version", F.when(valid, F.col("_version")))
    names = {key: "_key", at: "_at", **{c: f"_f_{c}" for c in facts_only}}
    return met.select(
        *[F.col(names[c]).alias(c) for c in facts.columns], *[F.col(f"_version.{c}").alias(c) for c in columns]
    )


def lines_at_sale_price(lines: DataFrame, products: DataFrame, columns: Sequence[str], **options) -> DataFrame:
    """Order lines (with the order_ts of their order) and the product version valid at the sale."""
    sold = lines.select("order_id", "order_ts", "product_id", "quantity", "unit_price")
    return as_of_versions(sold, products, "product_id", "order_ts", columns, **options)

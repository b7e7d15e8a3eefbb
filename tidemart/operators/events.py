"""Event cleaning, deduplication and enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import fingerprint
from ..schemas import EVENT_TYPES


def known_events(events: DataFrame) -> DataFrame:
    """Rows with an id, a time and one of the contract's event types."""
    return events.where(
        F.col("event_type").isin(*EVENT_TYPES) & F.col("event_id").isNotNull() & F.col("event_ts").isNotNull()
    )


def keyed_rows(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull())


def latest_per_key(df: DataFrame, keys: str | list[str], newest_first: list[Column] | None = None) -> DataFrame:
    """One row per key: the last ingested, then by source file, then by row hash.

    ``rank = 1`` over a window lets Spark keep one row per key in every map task before
    the shuffle, so a key that holds many copies sends one row per task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if newest_first is None:
        newest_first = [F.col(c).desc_nulls_last() for c in ("_ingest_ts", "_source_file") if c in df.columns]
    newest = Window.partitionBy(*keys).orderBy(*newest_first, fingerprint(df).desc())
    return df.withColumn("_nth", F.row_number().over(newest)).where("_nth = 1").drop("_nth")


def clean_events(bronze: DataFrame) -> DataFrame:
    return latest_per_key(known_events(bronze), "event_id")


def fill_from_product(events: DataFrame, products: DataFrame, source: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Split events into those of a known product, filled from it, and the rest.

    ``products`` has one row per product_id, active or not.  The events may be a stream.
    """
    attrs = products.select(
        "product_id", F.col("category").alias("_category"), F.col("price").alias("_price"), F.col("name").alias("_name"),
        F.lit(True).alias("_known"),
    )
    extra = {"name": F.col("_name")}
    if source:
        extra["source"] = F.lit(source)
    tags = F.map_from_arrays(F.array(*map(F.lit, extra)), F.array(*extra.values()))
    named = F.map_filter(tags, lambda _, v: v.isNotNull())
    old = F.coalesce(F.col("properties"), F.create_map().cast("map<string,string>"))
    kept = F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(named), k))
    met = events.join(attrs, "product_id", "left")
    filled = met.where("_known").select(
        *[
            F.col("_category").alias(c)
            if c == "category"
            else F.col("_price").alias(c)
            if c == "price"
            else F.map_concat(kept, named).alias(c)
            if c == "properties"
            else F.col(c)
            for c in events.columns
        ]
    )
    return filled, met.where("_known IS NULL").select(*events.columns)


def fill_transport(events: DataFrame, batches: DataFrame, on: str = "batch_id") -> DataFrame:
    """Take ip and user agent of the carrying request only where the event has none."""
    carried = batches.select(on, F.col("ip").alias("_ip"), F.col("user_agent").alias("_agent"))
    return events.join(carried, on, "left").select(
        *[
            F.coalesce(F.col("ip"), F.col("_ip")).alias("ip")
            if c == "ip"
            else F.coalesce(F.col("user_agent"), F.col("_agent")).alias("user_agent")
            if c == "user_agent"
            else F.col(c)
            for c in events.columns
        ]
    )

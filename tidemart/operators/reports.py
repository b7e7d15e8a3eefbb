"""Documented queries over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import cents, money_units, units_to_decimal


def drift_report(bronze: DataFrame) -> DataFrame:
    """Rows with rescued fields per source file and ingest day."""
    return (
        bronze.where("_rescued_data IS NOT NULL")
        .groupBy("_source_file", "_ingest_date")
        .agg(F.count(F.lit(1)).alias("rescued_rows"))
    )


def producer_split(events: DataFrame, day: str | None = None) -> DataFrame:
    """Events per producer tag and type, most first."""
    shown = events if day is None else events.where(F.col("event_date") == F.to_date(F.lit(day)))
    return (
        shown.groupBy(F.try_element_at("properties", F.lit("source")).alias("producer"), "event_type")
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), "producer", "event_type")
    )


def event_type_counts(bronze: DataFrame, ingest_day: str) -> DataFrame:
    return (
        bronze.where(F.col("_ingest_date") == F.to_date(F.lit(ingest_day)))
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def gmv_by_category(sales: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    since = F.date_sub(F.to_date(F.lit(as_of)), days)
    sums = sales.where(F.col("sale_date") >= since).groupBy("category").agg(F.sum(money_units(F.col("gmv"))).alias("_gmv"))
    return sums.select("category", cents(units_to_decimal(F.col("_gmv"))).alias("gmv_30d")).orderBy(
        F.desc("gmv_30d"), "category"
    )


def winback_list(users360: DataFrame, min_ltv: float = 1000, limit: int = 500) -> DataFrame:
    """The most valuable lapsing users; the top-k is the report."""
    lapsing = users360.where((F.col("segment") == "lapsing") & (F.col("ltv") > min_ltv))
    return lapsing.select("user_id", "ltv", "last_order_ts").orderBy(F.desc("ltv"), "user_id").limit(limit)


def sales_preview(sales: DataFrame, limit: int = 50) -> DataFrame:
    return sales.orderBy(F.desc("sale_date"), F.desc("gmv"), "category", "country").limit(limit)


def conversion_trend(funnel: DataFrame, as_of: str, days: int = 90) -> DataFrame:
    since = F.date_sub(F.to_date(F.lit(as_of)), days)
    return funnel.where(F.col("event_date") >= since).select("event_date", "purchase_rate").orderBy("event_date")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    stacked = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        stacked = row if stacked is None else stacked.unionByName(row)
    return stacked


def conversation_tail(messages: DataFrame, exchanges: int = 6) -> DataFrame:
    """The last exchanges (two messages each) of every conversation.

    The rank filter keeps at most that many rows per conversation in each map task.
    """
    newest = Window.partitionBy("conv_id").orderBy(F.col("turn").desc())
    return messages.withColumn("_back", F.row_number().over(newest)).where(F.col("_back") <= 2 * exchanges).drop("_back")

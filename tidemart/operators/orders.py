"""Orders from purchase events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import cents, line_units, units_to_decimal
from ..schemas import ORDER_KEYS

ITEM = ("product_id", "category", "quantity", "unit_price", "line_total")


def order_lines(events: DataFrame) -> DataFrame:
    """Purchase events that name an order, as lines; no shuffle."""
    return events.where("order_id IS NOT NULL AND event_type = 'purchase'").select(
        *ORDER_KEYS,
        "event_id",
        "event_ts",
        "product_id",
        "category",
        "quantity",
        F.col("price").alias("unit_price"),
        (F.col("price") * F.col("quantity")).alias("line_total"),
        line_units(F.col("price"), F.col("quantity")).alias("_units"),
    )


def _sums() -> list[Column]:
    return [
        F.min("event_ts").alias("order_ts"),
        F.sum("_units").alias("_subtotal"),
        F.sum("quantity").alias("total_units"),
    ]


def _priced(sums: DataFrame, tax_rate: float, free_shipping_threshold: float, flat_shipping: float) -> DataFrame:
    """Tax, shipping and total; a null subtotal leaves tax and total null and pays shipping."""
    subtotal = units_to_decimal(F.col("_subtotal"))
    dec = lambda x: F.lit(str(x)).cast("decimal(12,6)")
    free = F.coalesce(subtotal > dec(free_shipping_threshold), F.lit(False))
    amounts = sums.withColumns({
        "status": F.lit("confirmed"),
        "currency": F.lit("USD"),
        "subtotal": subtotal.cast("double"),
        "_tax": F.round(subtotal * dec(tax_rate), 2),
        "_shipping": F.when(free, dec(0)).otherwise(dec(flat_shipping)),
        "order_date": F.to_date("order_ts"),
    })
    return amounts.withColumns({
        "tax": F.col("_tax").cast("double"),
        "shipping": F.col("_shipping").cast("double"),
        "total": cents(subtotal + F.col("_tax") + F.col("_shipping")),
    }).drop("_tax", "_shipping", "_subtotal")


def totals_of(
    lines: DataFrame, tax_rate: float = 0.08, free_shipping_threshold: float = 75.0, flat_shipping: float = 9.99
) -> DataFrame:
    """One row per order grain from its lines: every measure combines before the shuffle."""
    sums = lines.groupBy(*ORDER_KEYS).agg(*_sums())
    return _priced(sums, tax_rate, free_shipping_threshold, flat_shipping)


def order_totals(events: DataFrame, **rates: float) -> DataFrame:
    """One row per order grain without the lines."""
    return totals_of(order_lines(events), **rates)


def priced_lines(lines: DataFrame, totals: DataFrame) -> DataFrame:
    """Lines with the time and the total of their order.

    A join with one row per order on one side: the lines of a huge order may be split over tasks.
    """
    whole = totals.select(*[F.col(k).alias(f"_{k}") for k in ORDER_KEYS], "order_ts", "total")
    return lines.join(whole, [lines[k].eqNullSafe(whole[f"_{k}"]) for k in ORDER_KEYS]).drop(*[f"_{k}" for k in ORDER_KEYS])


def fact_orders(
    events: DataFrame, tax_rate: float = 0.08, free_shipping_threshold: float = 75.0, flat_shipping: float = 9.99
) -> DataFrame:
    """Orders with nested lines, one row per order grain.

    A view for consumers that ask for the nested form: all lines of an order meet in one array.
    What sums or explodes lines should read ``totals_of`` and ``order_lines`` instead.
    """
    nested = order_lines(events).groupBy(*ORDER_KEYS).agg(
        *_sums(), F.array_sort(F.collect_list(F.struct(*ITEM))).alias("items")
    )
    return _priced(nested, tax_rate, free_shipping_threshold, flat_shipping).select(
        *ORDER_KEYS, "order_ts", "items", "subtotal", "total_units", "status", "currency", "tax", "shipping", "total",
        "order_date",
    )


def repeated_order_ids(orders: DataFrame) -> DataFrame:
    """Order ids that take more than one row because session, country or payment differ."""
    return orders.groupBy("order_id").count().where("count > 1")

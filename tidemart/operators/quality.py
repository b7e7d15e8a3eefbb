"""SQL-predicate quality rules, all measured in one pass."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class QualityGateError(AssertionError):
    """A ``fail`` rule has failing rows."""


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    severity: str = "warn"


# Fixed rule sets of the contract.
BRONZE_EVENTS = (
    Rule("event_id_present", "event_id IS NOT NULL"),
    Rule("event_ts_present", "event_ts IS NOT NULL"),
)
BRONZE_USERS = (Rule("user_id_present", "user_id IS NOT NULL"),)
BRONZE_PRODUCTS = (Rule("product_id_present", "product_id IS NOT NULL"),)
EVENTS = (
    Rule("event_id_not_null", "event_id IS NOT NULL", "fail"),
    Rule("valid_event_type", "event_type IN ('page_view','add_to_cart','purchase','abandon_cart')", "fail"),
    Rule("session_id_silver_present", "session_id_silver IS NOT NULL", "fail"),
    Rule("non_negative_price", "price IS NULL OR price >= 0"),
    Rule("positive_quantity", "quantity IS NULL OR quantity > 0"),
    Rule("purchase_has_order_id", "event_type <> 'purchase' OR order_id IS NOT NULL", "fail"),
)
ORDERS = (
    Rule("order_total_positive", "total >= 0", "fail"),
    Rule("order_subtotal_consistent", "subtotal >= 0", "fail"),
    Rule("order_has_items", "size(items) > 0", "fail"),
    Rule("order_total_matches", "abs(total - (subtotal + tax + shipping)) < 0.05"),
)
DIM_USERS = (Rule("user_id_not_null", "user_id IS NOT NULL", "fail"),)
DIM_PRODUCTS = (Rule("product_id_not_null", "product_id IS NOT NULL", "fail"),)
DAILY_SALES = (
    Rule("non_negative_gmv", "gmv >= 0"),
    Rule("orders_match_units", "units >= orders"),
)
FUNNEL = (
    Rule(
        "rates_in_unit_interval",
        "(cart_rate IS NULL OR cart_rate BETWEEN 0 AND 1)"
        " AND (purchase_rate IS NULL OR purchase_rate BETWEEN 0 AND 1)"
        " AND (abandon_rate IS NULL OR abandon_rate BETWEEN 0 AND 1)",
    ),
)
CARTS = (Rule("non_negative_cart_value", "cart_value >= 0"),)
USER_360 = (Rule("known_segment", "segment IN ('prospect','active','lapsing','churned')"),)


def _counts(rules: list[Rule], null_fails: bool) -> list[Column]:
    def failing(rule: Rule) -> Column:
        holds = F.expr(rule.predicate)
        return ~F.coalesce(holds, F.lit(False)) if null_fails else ~holds

    return [F.count(F.lit(1)).alias("total")] + [
        F.count_if(failing(rule)).alias(f"failing_{i}") for i, rule in enumerate(rules)
    ]


def measure(df: DataFrame, rules: Iterable[Rule], null_fails: bool = False) -> DataFrame:
    """One row per rule: expectation, predicate, severity, total, failing, pass_rate.

    A predicate that is NULL does not fail unless ``null_fails``.
    """
    rules = list(rules)
    entries = F.array(*[
        F.struct(
            F.lit(r.name).alias("expectation"), F.lit(r.predicate).alias("predicate"),
            F.lit(r.severity).alias("severity"), F.col("total"), F.col(f"failing_{i}").alias("failing"),
        )
        for i, r in enumerate(rules)
    ])
    passed = (F.col("total") - F.col("failing")) / F.col("total")
    return (
        df.agg(*_counts(rules, null_fails))
        .select(F.inline(entries))
        .withColumn("pass_rate", F.when(F.col("total") > 0, passed).otherwise(1.0))
    )


def enforce(results: DataFrame | Iterable) -> None:
    """Raise when a ``fail`` rule has failing rows; the result has one row per rule."""
    rows = results.collect() if isinstance(results, DataFrame) else list(results)
    broken = [r for r in rows if r["severity"] == "fail" and r["failing"] > 0]
    if broken:
        raise QualityGateError(", ".join(f"{r['expectation']}: {r['failing']} of {r['total']}" for r in broken))


def checked_write(
    df: DataFrame, rules: Iterable[Rule], write: Callable[[DataFrame], None], null_fails: bool = False
) -> list[dict]:
    """Count violations while ``write`` stores the frame, without a second scan.

    Raises if a ``fail`` rule is broken: the caller makes the data visible only after this.
    """
    rules = list(rules)
    seen = Observation()
    write(df.observe(seen, *_counts(rules, null_fails)))
    try:
        counts = seen.get
    except Py4JJavaError:  # Spark drops the counting together with a plan that it finds to be empty
        if not df.isEmpty():
            raise
        counts = {"total": 0} | {f"failing_{i}": 0 for i in range(len(rules))}
    total = counts["total"]
    results = [
        {
            "expectation": r.name, "predicate": r.predicate, "severity": r.severity, "total": total,
            "failing": counts[f"failing_{i}"],
            "pass_rate": (total - counts[f"failing_{i}"]) / total if total else 1.0,
        }
        for i, r in enumerate(rules)
    ]
    enforce(results)
    return results

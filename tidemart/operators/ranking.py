"""Popularity over a rolling window and the hybrid re-rank."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import log_share, unit_interval
from ..schemas import PRODUCT_CATEGORIES
from .orders import priced_lines
from .retrieval import RERANK_POOL, tiered_search

# Fixed values of the ranking rule.
WEIGHTS = {"semantic": 0.60, "price": 0.15, "popularity": 0.25}
INTENT = {"purchases_7d": 0.6, "add_to_cart_7d": 0.3, "views_7d": 0.1}


def _recent(df: DataFrame, ts: str, as_of: str, days: int) -> DataFrame:
    now = F.to_timestamp(F.lit(as_of))
    return df.where(F.col(ts).between(now - F.make_dt_interval(days=F.lit(days)), now))


def event_signals(events: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    seen = _recent(events, "event_ts", as_of, days).where(
        F.col("product_id").isNotNull() & F.col("event_type").isin("page_view", "add_to_cart")
    )
    return seen.groupBy("product_id").agg(
        F.count_if(F.col("event_type") == "add_to_cart").alias("add_to_cart_7d"),
        F.count_if(F.col("event_type") == "page_view").alias("views_7d"),
    )


def order_signals(orders: DataFrame, as_of: str, days: int = 7, lines: DataFrame | None = None) -> DataFrame:
    """Units sold in the window, from the nested lines or from ``lines``."""
    recent = _recent(orders, "order_ts", as_of, days)
    sold = recent.select(F.inline("items")) if lines is None else priced_lines(lines, recent)
    return sold.where("product_id IS NOT NULL").groupBy("product_id").agg(
        F.sum("quantity").cast("bigint").alias("purchases_7d")
    )


def product_signals(
    events: DataFrame, orders: DataFrame, as_of: str, days: int = 7, lines: DataFrame | None = None
) -> DataFrame:
    """One row per product seen or sold in the window that ends at ``as_of``."""
    both = event_signals(events, as_of, days).join(order_signals(orders, as_of, days, lines), "product_id", "full_outer")
    return both.select(
        "product_id", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in INTENT]
    )


def popularity(signals: DataFrame) -> DataFrame:
    """Weighted log shares of the window's maxima, which one scalar subquery finds."""
    ceilings = signals.agg(F.struct(*[F.max(c).alias(c) for c in INTENT])).scalar()
    score = sum((F.lit(w) * log_share(F.col(c), ceilings[c]) for c, w in INTENT.items()), F.lit(0.0))
    return signals.withColumn("popularity_score", unit_interval(score))


def price_scores(candidates: DataFrame) -> DataFrame:
    """Cheapest of a query's candidates 1, dearest 0; all 1 where prices are equal."""
    price = F.col("price")
    value = F.when(price.isNull() | F.isnan(price) | (price < 0), 0.0).otherwise(price)
    pool = Window.partitionBy("query_id")
    valued = candidates.withColumn("_value", value)
    top, low = F.max("_value").over(pool), F.min("_value").over(pool)
    return valued.withColumn(
        "price_score", F.when(top == low, 1.0).otherwise((top - F.col("_value")) / (top - low))
    ).drop("_value")


def hybrid_rank(
    candidates: DataFrame,
    popularity_scores: DataFrame | None,
    limit: int | None = None,
    weights: dict[str, float] = WEIGHTS,
) -> DataFrame:
    """Re-rank each query's candidates (query_id, product_id, score, price, retrieval_rank).

    Adds semantic, price_score, popularity_score, final_score and rank; equal final scores
    keep their retrieval order.
    """
    scored = price_scores(candidates)
    if popularity_scores is None:
        scored = scored.withColumn("popularity_score", F.lit(0.0))
    else:
        scored = scored.join(popularity_scores.select("product_id", "popularity_score"), "product_id", "left")
    scored = scored.withColumns({
        "semantic": unit_interval(F.col("score")),
        "popularity_score": F.coalesce(F.col("popularity_score"), F.lit(0.0)),
    })
    final = (
        F.lit(weights["semantic"]) * F.col("semantic")
        + F.lit(weights["price"]) * F.col("price_score")
        + F.lit(weights["popularity"]) * F.col("popularity_score")
    )
    # Twelve places: equal candidates tie whatever order the engine added their parts in.
    scored = scored.withColumn("final_score", F.round(final, 12))
    order = Window.partitionBy("query_id").orderBy(F.col("final_score").desc(), "retrieval_rank")
    ranked = scored.withColumn("rank", F.row_number().over(order))
    return ranked if limit is None else ranked.where(F.col("rank") <= max(1, int(limit)))


def semantic_search(
    queries: DataFrame,
    embeddings: DataFrame,
    products: DataFrame,
    popularity_scores: DataFrame | None,
    dim: int,
    limit: int = 5,
    pool: int = RERANK_POOL,
    categories: Sequence[str] = PRODUCT_CATEGORIES,
    **blocks,
) -> DataFrame:
    """Tiered search with the re-rank on top, at most ``limit`` rows per query.

    Tiers 1 and 2 hand ``pool`` times the wanted rows to the ranker; tier 3 is not ranked, its scores are null and its order
    is that of the search.
    """
    found = tiered_search(queries, embeddings, products, dim, limit, categories, pool=limit * pool, **blocks)
    ranked = hybrid_rank(found.where("tier < 3"), popularity_scores, limit=limit)
    literal = found.where("tier = 3").withColumn("rank", F.col("retrieval_rank"))
    return ranked.unionByName(literal, allowMissingColumns=True)

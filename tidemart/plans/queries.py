"""One query per operator, over the whole test tables.

Results are flattened for comparison: timestamps and dates as text, integers as bigint,
string arrays sorted and joined.  Queries that write go to a fresh folder of the session's
shared scratch space and return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import bounded, history, marts, orders, quality, ranking, reports, retrieval, sessions
from ..operators import events as ev
from ..schemas import (
    EMBEDDING, EVENT, ORDER_KEYS, PRODUCT_TRACKED, USER, USER_TRACKED, with_ingest_columns,
)
from ..session import scratch_path, shuffles_dropped, stage, use_utc
from ..sources import landing, shop, tables
from ..streaming import dimensions, incremental, ingest, popularity, stateful
from .refresh import refresh

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DIM = 64
AS_OF = shop.AS_OF
LAST_DAY = "2024-01-30"
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
EVENT_OUT = [
    "event_id", "event_type", "event_ts", "user_id", "session_id", "device", "ip", "country", "product_id", "category",
    "price", "quantity", "cart_id", "order_id", "payment_method",
]


# Integer columns that hold nulls are shown as doubles: both engines hand those out alike.
NULLABLE_COUNTS = {"quantity", "orders_count", "sessions_count", "recency_days"}


def flat(df: DataFrame) -> DataFrame:
    def shown(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if f.name in NULLABLE_COUNTS:
            c = c.cast("double")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(F.array_sort(c), ",")
        return c.alias(f.name)

    return df.select(*[shown(f) for f in df.schema])


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_utc(spark)
        return flat(fn(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return fn


# ---- inputs ----------------------------------------------------------------------------

def _silver(spark, sf_dir, minutes=720, **options):
    return sessions.silver_events(shop.bronze_events(spark, sf_dir), minutes, **options)


def _stored(spark, df, label):
    """Write a frame that several branches read, so that it is computed once."""
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)


def _stored_silver(spark, sf_dir, minutes=720):
    return _stored(spark, _silver(spark, sf_dir, minutes), "silver")


def _silver_cols(df):
    keep = [c for c in EVENT_OUT if c != "session_id"]
    return df.select(*keep, "session_id_raw", "session_id_silver", "event_date")


def _orders(spark, sf_dir):
    return orders.fact_orders(_stored_silver(spark, sf_dir))


def _lines_and_totals(spark, events):
    """Order lines, written once, and the orders summed from them."""
    lines = _stored(spark, orders.order_lines(events), "lines")
    return lines, orders.totals_of(lines)


def _users(spark, sf_dir):
    return history.versions(_stored(spark, shop.user_snapshots(spark, sf_dir), "snapshots"), "user_id", USER_TRACKED)


def _products(spark, sf_dir):
    return history.versions(_stored(spark, shop.product_snapshots(spark, sf_dir), "snapshots"), "product_id", PRODUCT_TRACKED)


def _user_360(spark, sf_dir, as_of=AS_OF):
    events = _stored_silver(spark, sf_dir)
    return marts.user_360(_users(spark, sf_dir), orders.order_totals(events), events, as_of)


def _order_rows(df):
    return df.select(
        "order_id", "user_id", "session_id_silver", "country", "payment_method", "order_ts", "subtotal", "total_units",
        "status", "currency", "tax", "shipping", "total", "order_date", F.size("items").alias("lines"),
    )


# ---- Silver ----------------------------------------------------------------------------

@query
def dedup_latest(spark, sf_dir):
    return ev.clean_events(shop.bronze_events(spark, sf_dir)).select(*EVENT_OUT, "_ingest_ts")


@query
def sessionize_30(spark, sf_dir):
    return _silver_cols(_silver(spark, sf_dir, 30))


@query
def sessionize_720(spark, sf_dir):
    return _silver_cols(_silver(spark, sf_dir, 720))


@query
def sessionize_one_window(spark, sf_dir):
    return _silver_cols(_silver(spark, sf_dir, 720, method="window"))


@query
def sessionize_anonymous_apart(spark, sf_dir):
    return _silver_cols(_silver(spark, sf_dir, 720, anonymous_key="session_id"))


@query
def fact_orders(spark, sf_dir):
    return _order_rows(_orders(spark, sf_dir))


@query
def fact_orders_bulk(spark, sf_dir):
    """Orders rolled up from every row of lineitem."""
    return _order_rows(orders.fact_orders(shop.line_events(spark, sf_dir)))


@query
def order_totals_bulk(spark, sf_dir):
    return orders.order_totals(shop.line_events(spark, sf_dir)).drop("order_date")


@query
def order_lines(spark, sf_dir):
    lines = orders.order_lines(_silver(spark, sf_dir)).select("order_id", *orders.ITEM)
    return lines.withColumn("line_total", F.round("line_total", 4))


@query
def scd2_users(spark, sf_dir):
    return _users(spark, sf_dir).select(
        "user_id", "email", "country", "city", "marketing_opt_in", "loyalty_tier", "valid_from", "valid_to", "is_current", "version"
    )


@query
def scd2_products(spark, sf_dir):
    return _products(spark, sf_dir).select(
        "product_id", "name", "category", "brand", "price", "active", "valid_from", "valid_to", "is_current", "version"
    )


@query
def scd2_users_compat_hash(spark, sf_dir):
    dim = history.versions(shop.user_snapshots(spark, sf_dir), "user_id", USER_TRACKED, compat_hash=True)
    return dim.select("user_id", "loyalty_tier", "marketing_opt_in", "valid_from", "valid_to", "version")


# ---- marts -----------------------------------------------------------------------------

@query
def daily_sales(spark, sf_dir):
    return marts.daily_sales(_orders(spark, sf_dir))


@query
def daily_sales_order_aov(spark, sf_dir):
    lines, totals = _lines_and_totals(spark, _silver(spark, sf_dir))
    return marts.daily_sales(totals, aov="order", lines=lines)


@query
def daily_sales_bulk(spark, sf_dir):
    lines, totals = _lines_and_totals(spark, shop.line_events(spark, sf_dir))
    return marts.daily_sales(totals, lines=lines)


@query
def session_flags(spark, sf_dir):
    return marts.session_flags(_silver(spark, sf_dir))


@query
def daily_funnel(spark, sf_dir):
    return marts.funnel(_silver(spark, sf_dir))


@query
def daily_funnel_30(spark, sf_dir):
    return marts.funnel(_silver(spark, sf_dir, 30))


@query
def cart_value(spark, sf_dir):
    return marts.cart_value(_silver(spark, sf_dir))


@query
def purchasing_sessions(spark, sf_dir):
    return marts.purchasing_sessions(_silver(spark, sf_dir))


@query
def abandoned_carts(spark, sf_dir):
    return marts.abandoned_carts(_stored_silver(spark, sf_dir))


@query
def user_order_metrics(spark, sf_dir):
    return marts.user_order_metrics(orders.order_totals(_silver(spark, sf_dir)))


@query
def user_order_metrics_bulk(spark, sf_dir):
    return marts.user_order_metrics(orders.order_totals(shop.line_events(spark, sf_dir)))


@query
def user_activity(spark, sf_dir):
    return marts.user_activity(_silver(spark, sf_dir))


def _user_360_cols(df):
    return df.select(
        "user_id", "email", "loyalty_tier", "orders_count", "ltv", "avg_order_value", "last_order_ts", "first_order_ts",
        "sessions_count", "last_seen_ts", "recency_days", "segment",
    )


@query
def user_360(spark, sf_dir):
    return _user_360_cols(_user_360(spark, sf_dir))


@query
def user_360_february(spark, sf_dir):
    return _user_360_cols(_user_360(spark, sf_dir, "2024-02-15"))


@query
def user_360_july(spark, sf_dir):
    return _user_360_cols(_user_360(spark, sf_dir, "2024-07-15"))


# ---- joins -----------------------------------------------------------------------------

@query
def pit_orders_users(spark, sf_dir):
    """Each shipped line with the version of its buyer at shipping."""
    lines = shop.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    buyers = shop.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    facts = lines.join(buyers, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_partkey",
        F.concat(F.lit("u_"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.col("l_shipdate").cast("timestamp").alias("shipped_ts"),
    )
    facts, dim = _stored(spark, facts, "facts"), _stored(spark, _users(spark, sf_dir), "dim")
    return history.as_of_versions(facts, dim, "user_id", "shipped_ts", ["version", "loyalty_tier", "marketing_opt_in"])


@query
def pit_lines_products(spark, sf_dir):
    """Each order line with the catalogue price at the sale."""
    held = orders.order_lines(shop.line_events(spark, sf_dir)).select(
        *ORDER_KEYS, "event_ts", "product_id", "quantity", "unit_price", "_units")
    lines = _stored(spark, held, "lines")
    sold = orders.priced_lines(lines, orders.totals_of(lines)).select("order_id", "order_ts", "product_id", "quantity", "unit_price")
    sold, dim = _stored(spark, sold, "sold"), _products(spark, sf_dir)
    found = history.lines_at_sale_price(sold, dim, ["version", "price", "active"])
    return found.withColumnRenamed("price", "price_at_sale")


@query
def remarketing_list(spark, sf_dir):
    events = _stored_silver(spark, sf_dir)
    people = marts.user_360(_users(spark, sf_dir), orders.order_totals(events), events, AS_OF)
    return marts.remarketing_list(marts.abandoned_carts(events), people, AS_OF)


def _enrich(spark, sf_dir):
    bare = shop.first_delivery(spark, sf_dir).where("event_type = 'add_to_cart'").withColumns({
        "category": F.lit(None).cast("string"), "price": F.lit(None).cast("double"),
        "product_id": F.when(F.col("quantity") == 2, F.concat(F.lit("gone_"), "product_id")).otherwise(F.col("product_id")),
    })
    return ev.fill_from_product(bare, history.current(_products(spark, sf_dir)), source="web_chat")


@query
def enrich_cart_events(spark, sf_dir):
    filled, _ = _enrich(spark, sf_dir)
    return filled.select(
        "event_id", "product_id", "category", "price", "quantity",
        F.element_at("properties", "name").alias("name"), F.element_at("properties", "source").alias("source"),
    )


@query
def enrich_rejects(spark, sf_dir):
    _, unknown = _enrich(spark, sf_dir)
    return unknown.select("event_id", "product_id", "category", "price", F.element_at("properties", "source").alias("source"))


# ---- search ----------------------------------------------------------------------------

@query
def current_products(spark, sf_dir):
    table = tables.VersionedTable(spark, scratch_path(spark, "products_source"))
    table.publish(retrieval.product_documents(_products(spark, sf_dir)), allow_empty=False)
    return table.read()


@query
def product_search(spark, sf_dir):
    return retrieval.search_products(
        _products(spark, sf_dir), category="PROMO", query="Red", max_price=1500, limit=99, categories=CATEGORIES
    )


@query
def product_search_unknown_category(spark, sf_dir):
    return retrieval.search_products(_products(spark, sf_dir), category="toys", query="r_d", max_price=0, limit=10)


@query
def product_get(spark, sf_dir):
    """Current version of every product that was put into a cart."""
    carted = shop.first_delivery(spark, sf_dir).where("event_type = 'add_to_cart'")
    return retrieval.get_products(_products(spark, sf_dir), carted)


@query
def doc_text(spark, sf_dir):
    return retrieval.product_documents(_products(spark, sf_dir)).select("product_id", "doc_text")


@query
def embed_documents(spark, sf_dir):
    vectors = retrieval.embed(shop.table(spark, sf_dir, "documents"), dim=DIM, id_column="doc_id", text_column="text")
    return vectors.select("doc_id", F.posexplode("embedding").alias("pos", "v")).where("v <> 0").select(
        "doc_id", "pos", F.round(F.col("v").cast("double"), 5).alias("weight")
    )


@query
def embedding_build(spark, sf_dir):
    built = retrieval.build_embeddings(_products(spark, sf_dir), "hashed", "1", AS_OF, dim=DIM)
    table = tables.VersionedTable(spark, scratch_path(spark, "embeddings"))
    table.publish(built, allow_empty=False, model="hashed", dim=DIM)
    back = table.read(model="hashed", dim=DIM)
    return back.select(
        "product_id", "doc_text", "embedding_model_name", "embedding_version", "embed_ts",
        F.size("embedding").alias("dim"),
        F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")), 5).alias("norm"),
    )


@query
def embedding_audit(spark, sf_dir):
    return retrieval.embedding_audit(retrieval.build_embeddings(_products(spark, sf_dir), "hashed", "1", AS_OF, dim=DIM))


def _centroids(vectors: DataFrame, group: str) -> DataFrame:
    parts = vectors.select(group, F.posexplode("embedding").alias("pos", "v"))
    means = parts.groupBy(group, "pos").agg(F.avg(F.col("v").cast("double")).alias("m"))
    # One entry per dimension: the list is as long as a vector.
    return means.groupBy(group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda x: x["m"].cast("float")).alias("embedding")
    )


def _label_queries(vectors):
    centre = _centroids(vectors, "label")
    return centre.select(F.concat(F.lit("q_"), F.col("label").cast("string")).alias("query_id"), "embedding")


@query
def knn_topk(spark, sf_dir):
    """Nearest vectors to the mean of each label, over all vectors."""
    vectors = shop.embedding_vectors(spark, sf_dir)
    return retrieval.nearest(_label_queries(vectors), vectors, DIM, 10)


@query
def knn_topk_in_blocks(spark, sf_dir):
    """The same search by block pairs, the way a query set too large to broadcast runs."""
    vectors = shop.embedding_vectors(spark, sf_dir)
    return retrieval.nearest(
        _label_queries(vectors), vectors, DIM, 10, broadcast_rows=0, block_queries=4, block_candidates=200
    )


@query
def knn_topk_bounded(spark, sf_dir):
    """The same search over candidates laid out by pivots, whose blocks are skipped by their bounds."""
    vectors = shop.embedding_vectors(spark, sf_dir)
    asked = _label_queries(vectors).select("query_id", "embedding", F.lit(10).alias("k"))
    return bounded.bounded_top_k(asked, bounded.laid_out(vectors, DIM), DIM)


@query
def knn_texts(spark, sf_dir):
    """Documents nearest to each benchmark text, both encoded by the stand-in encoder."""
    asked = retrieval.embed(shop.table(spark, sf_dir, "benchmark"), dim=DIM, id_column="item_id", text_column="text")
    docs = retrieval.embed(shop.table(spark, sf_dir, "documents"), dim=DIM, id_column="doc_id", text_column="text")
    asked = asked.select(F.col("item_id").alias("query_id"), "embedding")
    hits = retrieval.nearest(asked, docs.select(F.col("doc_id").alias("product_id"), "embedding"), DIM, 5)
    return hits.withColumn("score", F.round("score", 4)).select("query_id", "score", "retrieval_rank")


def _filtered_queries(spark, sf_dir, vectors):
    """One query per category: its mean vector, the category, and a price ceiling."""
    part = shop.table(spark, sf_dir, "part").select(F.concat(F.lit("p_"), F.col("p_partkey").cast("string")).alias("product_id"), "p_type")
    centre = _centroids(vectors.join(part, "product_id").select("p_type", "embedding"), "p_type")
    return centre.select(
        F.col("p_type").alias("query_id"), "embedding", F.col("p_type").alias("category"),
        F.when(F.col("p_type") == "PROMO", 0.0).when(F.col("p_type") != "SMALL", 900.0).alias("max_price"),
        F.when(F.col("p_type") != "LARGE", F.lit("red")).alias("query"),
    )


@query
def knn_prefiltered(spark, sf_dir):
    vectors = shop.embedding_vectors(spark, sf_dir)
    products = history.current(_products(spark, sf_dir), active_only=True)
    candidates = vectors.join(products.select("product_id", "category", "price"), "product_id")
    return retrieval.nearest_prefiltered(_filtered_queries(spark, sf_dir, vectors), candidates, DIM, 15)


def _postfiltered(spark, sf_dir, k):
    """Hits first; versions are made of the snapshots of their products, not of every product."""
    vectors = shop.embedding_vectors(spark, sf_dir)
    asked = stage(_filtered_queries(spark, sf_dir, vectors), "asked")
    hits = stage(retrieval.oversampled(asked, vectors, DIM, k), "hits")
    theirs = shop.product_snapshots(spark, sf_dir, of=hits.select("product_id").distinct())
    products = history.versions(_stored(spark, theirs, "snapshots"), "product_id", PRODUCT_TRACKED)
    return retrieval.filtered_hits(hits, asked, products, CATEGORIES)


@query
def knn_postfiltered(spark, sf_dir):
    return _postfiltered(spark, sf_dir, 10).drop("currency")


@query
def literal_search(spark, sf_dir):
    vectors = shop.embedding_vectors(spark, sf_dir)
    found = retrieval.literal_search(_filtered_queries(spark, sf_dir, vectors), _products(spark, sf_dir), 25, CATEGORIES)
    return found.select("query_id", "product_id", "retrieval_rank")


def _tier_queries(spark, sf_dir, vectors):
    """Known category: tier 1.  Unknown category: tier 2, or tier 3 under a low price ceiling."""
    return _filtered_queries(spark, sf_dir, vectors).withColumns({
        "max_price": F.when(F.col("query_id") == "MEDIUM", 830.0).otherwise(F.col("max_price")),
        "category": F.when(F.col("query_id").isin("ECONOMY", "LARGE"), F.col("category")).otherwise("toys"),
    })


@query
def tiered_search(spark, sf_dir):
    vectors = shop.embedding_vectors(spark, sf_dir)
    return retrieval.tiered_search(_tier_queries(spark, sf_dir, vectors), vectors, _products(spark, sf_dir), DIM, 5, CATEGORIES).select(
        "query_id", "tier", "product_id", "score", "retrieval_rank", "name", "category", "price"
    )


# ---- ranking ---------------------------------------------------------------------------

SIGNAL_COLUMNS = list(dict.fromkeys([
    "event_id", "event_type", "event_ts", "user_id", "product_id", "category", "price", "quantity",
    *[c for c in ORDER_KEYS if c != "session_id_silver"],
]))


def _signals(spark, sf_dir):
    """Silver in the columns that signals are made of; latest copies are written once, as sessions read them twice."""
    clean = _stored(spark, ev.clean_events(shop.bronze_events(spark, sf_dir)).select(*SIGNAL_COLUMNS), "clean")
    events = _stored(spark, sessions.sessionize(clean, 720), "silver")
    lines, totals = _lines_and_totals(spark, events)
    return ranking.product_signals(events, totals, AS_OF, lines=lines)


@query
def product_signals(spark, sf_dir):
    return _signals(spark, sf_dir)


@query
def rolling_signals(spark, sf_dir):
    """The signals from counts per day: built before the last week's events arrived, then brought up to date."""
    silver = _stored_silver(spark, sf_dir)
    home = scratch_path(spark, "rolling")
    events = tables.VersionedTable(spark, f"{home}/events", ["event_date"])
    bought = tables.VersionedTable(spark, f"{home}/orders", ["order_date"])
    counts = popularity.RollingSignals(spark, tables.VersionedTable(spark, f"{home}/days", ["day"]), events, bought)
    for rows in (silver.where("event_date < DATE '2024-01-24'"), silver.where("event_date >= DATE '2024-01-24'")):
        events.append(rows)
        bought.append(orders.fact_orders(rows)) if not bought.exists() else bought.publish(orders.fact_orders(silver))
        counts.update()
    return counts.signals(AS_OF)


@query
def popularity_score(spark, sf_dir):
    found = ranking.popularity(_stored(spark, _signals(spark, sf_dir), "signals"))
    return found.withColumn("popularity_score", F.round("popularity_score", 6))


def _candidates(spark, sf_dir):
    return _postfiltered(spark, sf_dir, 20)


@query
def price_score(spark, sf_dir):
    scored = ranking.price_scores(_candidates(spark, sf_dir))
    return scored.select("query_id", "product_id", "price", F.round("price_score", 6).alias("price_score"))


@query
def semantic_search(spark, sf_dir):
    """Tiers, re-rank and trim in one call."""
    vectors = shop.embedding_vectors(spark, sf_dir)
    popular = ranking.popularity(_stored(spark, _signals(spark, sf_dir), "signals"))
    found = ranking.semantic_search(
        _tier_queries(spark, sf_dir, vectors), vectors, _products(spark, sf_dir), popular, DIM, 5, categories=CATEGORIES)
    return found.select("query_id", "tier", "product_id", "rank", F.round("final_score", 6).alias("final_score"))


@query
def hybrid_rank(spark, sf_dir):
    popular = ranking.popularity(_stored(spark, _signals(spark, sf_dir), "signals"))
    ranked = ranking.hybrid_rank(_candidates(spark, sf_dir), popular, limit=5)
    return ranked.select(
        "query_id", "product_id", "rank",
        *[F.round(c, 6).alias(c) for c in ("semantic", "price_score", "popularity_score", "final_score")],
    )


# ---- quality ---------------------------------------------------------------------------

def _measured(*suites):
    stacked = None
    for name, df, rules in suites:
        rows = quality.measure(df, rules).select(F.lit(name).alias("table_name"), "expectation", "severity", "total", "failing", "pass_rate")
        stacked = rows if stacked is None else stacked.unionByName(rows)
    return stacked


@query
def quality_bronze(spark, sf_dir):
    return _measured(
        ("events", shop.bronze_events(spark, sf_dir), quality.BRONZE_EVENTS + quality.BRONZE_USERS),
        ("users", shop.user_snapshots(spark, sf_dir), quality.BRONZE_USERS),
        ("products", shop.product_snapshots(spark, sf_dir), quality.BRONZE_PRODUCTS),
    )


@query
def quality_events(spark, sf_dir):
    return _measured(("events", _silver(spark, sf_dir), quality.EVENTS))


@query
def quality_dims(spark, sf_dir):
    return _measured(
        ("dim_users", _users(spark, sf_dir), quality.DIM_USERS), ("dim_products", _products(spark, sf_dir), quality.DIM_PRODUCTS)
    )


@query
def quality_orders(spark, sf_dir):
    return _measured(("fact_orders", _orders(spark, sf_dir), quality.ORDERS))


@query
def repeated_order_ids(spark, sf_dir):
    return orders.repeated_order_ids(_orders(spark, sf_dir))


@query
def quality_gold(spark, sf_dir):
    events = _stored_silver(spark, sf_dir)
    lines, sold = _lines_and_totals(spark, events)
    return _measured(
        ("daily_sales", marts.daily_sales(sold, lines=lines), quality.DAILY_SALES),
        ("funnel", marts.funnel(events), quality.FUNNEL),
        ("abandoned_carts", marts.abandoned_carts(events), quality.CARTS),
        ("user_360", marts.user_360(_users(spark, sf_dir), sold, events, AS_OF), quality.USER_360),
    )


@query
def quality_checked_publish(spark, sf_dir):
    """Rules counted while the table is written; the frame is read once."""
    table = tables.VersionedTable(spark, scratch_path(spark, "checked"), ["event_date"])
    table.publish(marts.funnel(_silver(spark, sf_dir)), quality.FUNNEL)
    return table.read()


# ---- tables ----------------------------------------------------------------------------

def _first_and_second(spark, sf_dir):
    first = shop.first_delivery(spark, sf_dir)
    return first, shop.second_delivery(first)


@query
def append_readback(spark, sf_dir):
    path = scratch_path(spark, "append")
    for delivery in _first_and_second(spark, sf_dir):
        tables.append(delivery.drop("properties"), path, ["_ingest_date"])
    return tables.read(spark, path).select(*EVENT_OUT, "_source_file", "_ingest_date")


@query
def overwrite_readback(spark, sf_dir):
    path = scratch_path(spark, "overwrite")
    first, second = _first_and_second(spark, sf_dir)
    tables.overwrite(first.drop("properties"), path, ["_ingest_date"])
    tables.overwrite(second.select("event_id", "price", "_ingest_date"), path, ["_ingest_date"])
    return tables.read(spark, path).select("event_id", "price", "_ingest_date")


def _upserted(spark, sf_dir, update_columns):
    first, second = _first_and_second(spark, sf_dir)
    day = F.to_date("event_ts").alias("event_date")
    table = tables.VersionedTable(spark, scratch_path(spark, "upsert"), ["event_date"])
    # What came by the middle of the month, then the whole first delivery (updates and inserts), then every corrected copy.
    early = first.where("_ingest_ts < TIMESTAMP '2024-01-16'")
    for delivered in (early, first):
        table.upsert(delivered.select(*EVENT_OUT, "_source_file", day), ["event_id"])
    table.upsert(second.select(*EVENT_OUT, "_source_file", day), ["event_id"], update_columns)
    return table.read().select("event_id", "event_date", "event_type", "price", "_source_file")


@query
def upsert_all(spark, sf_dir):
    return _upserted(spark, sf_dir, None)


@query
def upsert_some_columns(spark, sf_dir):
    return _upserted(spark, sf_dir, ["price"])


@query
def typed_table(spark, sf_dir):
    schema = with_ingest_columns(EVENT, dated=True)
    path = scratch_path(spark, "typed")
    name = "typed_" + path.rsplit("-", 1)[-1]
    tables.create_table(spark, name, schema, ["_ingest_date"], comment="Bronze events", location=path)
    rows = tables.conform(shop.first_delivery(spark, sf_dir), schema)
    rows.hint("rebalance", "_ingest_date").write.insertInto(name)
    return spark.read.table(name).select(*EVENT_OUT, "schema_version", "_ingest_ts", "_ingest_date")


@query
def publish_latest(spark, sf_dir):
    """Three versions, two kept; the last is what readers see."""
    table = tables.VersionedTable(spark, scratch_path(spark, "published"))
    for minutes in (30, 60, 720):
        table.publish(marts.funnel(_silver(spark, sf_dir, minutes)), keep=2, allow_empty=False, minutes=minutes)
    return table.read(minutes=720)


@query
def clustered_readback(spark, sf_dir):
    table = tables.VersionedTable(spark, scratch_path(spark, "clustered"))
    lines = shop.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate", "l_returnflag", "l_quantity")
    table.publish(lines)
    table.optimize(["l_shipdate", "l_partkey"], files=16)
    return table.read()


@query
def landing_json_readback(spark, sf_dir):
    path = scratch_path(spark, "landing")
    landing.write_landing(shop.first_delivery(spark, sf_dir).select(*EVENT.names), path, rows_per_file=2_000, gzip=True)
    return landing.read_json_lines(spark, path, EVENT).select(*EVENT_OUT)


@query
def staged_embeddings_readback(spark, sf_dir):
    path = scratch_path(spark, "staged")
    staged = retrieval.build_embeddings(_products(spark, sf_dir), "hashed", "1", AS_OF, dim=DIM)
    landing.write_snapshot(staged, path)
    return landing.load_embeddings(spark, path, EMBEDDING).select(
        "product_id", "doc_text", "embedding_model_name", "embed_ts", F.size("embedding").alias("dim")
    )


# ---- ingestion and streams -------------------------------------------------------------

def _landed_events(spark, sf_dir) -> str:
    path = scratch_path(spark, "landing")
    landing.write_landing(shop.first_delivery(spark, sf_dir).select(*EVENT.names), path)
    return path


@query
def stream_events_readback(spark, sf_dir):
    """Two runs to exhaustion: the second finds no new file."""
    src, out = _landed_events(spark, sf_dir), scratch_path(spark, "bronze")
    for _ in range(2):
        ingest.stream_events(spark, src, f"{out}/checkpoint", f"{out}/events_raw", EVENT)
    return spark.read.parquet(f"{out}/events_raw").select(*EVENT_OUT, "_rescued_data")


@query
def stream_snapshots_readback(spark, sf_dir):
    src, out = scratch_path(spark, "landing"), scratch_path(spark, "bronze")
    landing.write_snapshot(shop.user_snapshots(spark, sf_dir), f"{src}/users")
    ingest.stream_snapshot(spark, f"{src}/users", f"{out}/checkpoint", USER, f"{out}/users_raw")
    return tables.read(spark, f"{out}/users_raw", merge_schema=True).select(*USER.names, "_rescued_data")


def _drifting_lines(spark, sf_dir):
    """Event lines of a producer that drifted: text prices, new fields, missing sessions."""
    e = shop.first_delivery(spark, sf_dir)
    sent = e.withColumns({
        "session_id": F.when(F.col("price") <= 150, F.col("session_id")),
        "zz": F.when(F.col("country").isin("NATION_1", "NATION_2"), F.lit(9)),
    })
    line = F.to_json(F.struct(*[c for c in EVENT.names if c != "properties"], "properties", "zz"), {"timestampFormat": landing.WIRE_TIME})
    line = F.when(F.col("category") == "PROMO", F.regexp_replace(line, r'"price":[-0-9.E]+', '"price":"n/a"')).otherwise(line)
    line = F.when(F.col("price") > 400, F.concat(F.lit("{broken "), line)).otherwise(line)
    batch = F.when(F.col("device") == "desktop", "bulk").otherwise(F.concat_ws("_", "country", F.date_format("event_ts", "yyyyMMdd")))
    return sent.select(e["event_id"].alias("sent_id"), line.alias("value"), batch.alias("batch_id"))


@query
def rescued_fields(spark, sf_dir):
    parsed = landing.parse_lines(_drifting_lines(spark, sf_dir), EVENT)
    rescued = F.col("_rescued_data")
    return parsed.select(
        "sent_id", "event_id", "event_ts", "price", "session_id",
        F.get_json_object(rescued, "$.price").alias("rescued_price"),
        F.get_json_object(rescued, "$.zz").alias("rescued_zz"),
        F.get_json_object(rescued, "$._malformed").isNotNull().alias("malformed"),
    )


@query
def contract_check(spark, sf_dir):
    valid, rejected = landing.check_contract(_drifting_lines(spark, sf_dir), "batch_id")
    return valid.select("sent_id", "batch_id", F.lit("valid").alias("verdict"), "event_type", "price").unionByName(
        rejected.select("sent_id", "batch_id", F.col("reason").alias("verdict")), allowMissingColumns=True
    )


@query
def fill_transport_fields(spark, sf_dir):
    """Carrying requests: one per country and day."""
    events = shop.first_delivery(spark, sf_dir).withColumn("batch_id", F.concat_ws("_", "country", F.date_format("event_ts", "yyyyMMdd")))
    carriers = events.groupBy("batch_id").agg(
        F.concat(F.lit("192.168.0."), F.count(F.lit(1)).cast("string")).alias("ip"), F.concat(F.lit("agent/"), F.max("device")).alias("user_agent")
    )
    return ev.fill_transport(events, carriers).select("event_id", "batch_id", "ip", "user_agent")


def _bronze_files(spark, sf_dir) -> tuple[str, T.StructType]:
    """Both deliveries as a Bronze table of two appends."""
    path = scratch_path(spark, "bronze")
    tables.append(shop.first_delivery(spark, sf_dir), path)
    first = spark.read.parquet(path)  # the files of the first append
    tables.append(shop.second_delivery(first), path)
    return path, first.schema


@query
def stream_upsert(spark, sf_dir):
    """Silver events kept up to date by micro-batches, against one batch build."""
    path, schema = _bronze_files(spark, sf_dir)
    table = tables.VersionedTable(spark, scratch_path(spark, "silver"), ["event_date"])
    files = spark.read.parquet(path).inputFiles()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max(1, len(files) // 2)).parquet(path)
    stateful.silver_stream(stream, table, f"{table.path}_checkpoint", 720).awaitTermination()
    return _silver_cols(table.read())


@query
def stream_dedup_watermark(spark, sf_dir):
    path, schema = _bronze_files(spark, sf_dir)
    out = scratch_path(spark, "deduplicated")
    stream = spark.readStream.schema(schema).parquet(path).select("event_id", "event_type", "event_ts", "user_id", "product_id")
    ingest.append_stream(stateful.deduplicated(stream), out, f"{out}_checkpoint").awaitTermination()
    return spark.read.parquet(out)


@query
def late_split(spark, sf_dir):
    on_time, held = stateful.split_late(shop.bronze_events(spark, sf_dir))
    return on_time.select("event_id", "_source_file", F.lit("on_time").alias("verdict")).unionByName(
        held.select("event_id", "_source_file", F.col("quarantine_reason").alias("verdict"))
    )


@query
def live_sessions(spark, sf_dir):
    """Closed by one heartbeat row far behind the last event, which itself is not shown."""
    path = scratch_path(spark, "clicks")
    clicks = shop.first_delivery(spark, sf_dir).select("user_id", F.date_trunc("second", "event_ts").alias("event_ts"))
    tables.append(clicks, path)
    beat = clicks.agg((F.max("event_ts") + F.make_dt_interval(days=F.lit(3))).alias("event_ts"))
    tables.append(beat.select(F.lit("heartbeat").alias("user_id"), "event_ts"), path)
    out = scratch_path(spark, "live")
    stream = spark.readStream.schema(clicks.schema).parquet(path)
    ingest.append_stream(stateful.live_sessions(stream, 720), out, f"{out}_checkpoint").awaitTermination()
    return spark.read.parquet(out).where("user_id IS NULL OR user_id <> 'heartbeat'")


def _land(spark, sent, src: str) -> None:
    """Event files, packed, as a refresh keeps its landing files beside all that it makes of them."""
    with shuffles_dropped(spark):
        landing.write_landing(sent, f"{src}/events", gzip=True)


def _land_snapshots(spark, sf_dir, src: str) -> None:
    with shuffles_dropped(spark):
        landing.write_snapshot(shop.user_snapshots(spark, sf_dir), f"{src}/users", gzip=True)
        landing.write_snapshot(shop.product_snapshots(spark, sf_dir), f"{src}/products", gzip=True)


def _landed(spark, sf_dir) -> str:
    src = scratch_path(spark, "landing")
    _land(spark, shop.first_delivery(spark, sf_dir).select(*EVENT.names), src)
    _land_snapshots(spark, sf_dir, src)
    return src


@query
def medallion_refresh(spark, sf_dir):
    """Landing files to marts in one call; shows the funnel it published."""
    made = refresh(spark, _landed(spark, sf_dir), scratch_path(spark, "warehouse"), AS_OF, 720)
    return made["fact_funnel"].read()


@query
def refresh_twice(spark, sf_dir):
    """A refresh without the last day's events and one after they landed; shows the daily sales that led to."""
    src, home = scratch_path(spark, "landing"), scratch_path(spark, "warehouse")
    every = shop.first_delivery(spark, sf_dir).select(*EVENT.names)
    last = F.to_date("event_ts") == F.to_date(F.lit(LAST_DAY))
    _land(spark, every.where(~last), src)
    _land_snapshots(spark, sf_dir, src)
    refresh(spark, src, home, AS_OF, 720)
    _land(spark, every.where(last), src)
    return refresh(spark, src, home, AS_OF, 720)["fact_daily_sales"].read()


@query
def refreshed_tables(spark, sf_dir):
    """Rows of each of the eight tables that a refresh publishes."""
    made = refresh(spark, _landed(spark, sf_dir), scratch_path(spark, "warehouse"), AS_OF, 720)
    counts = [t.read().agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, t in made.items()]
    return reduce(DataFrame.unionByName, counts)


@query
def stream_additive_schema(spark, sf_dir):
    """A stream that goes on with a column more: earlier rows read it as null."""
    src, out = scratch_path(spark, "landing"), scratch_path(spark, "bronze")
    odd = F.substring("event_id", 3, 20).cast("bigint") % 2 == 1
    sent = shop.first_delivery(spark, sf_dir).select(*EVENT.names)
    wider = T.StructType([*EVENT.fields, T.StructField("campaign", T.StringType())])
    later = sent.where(odd).withColumn("campaign", F.concat(F.lit("c_"), "event_type"))
    for rows, schema in ((sent.where(~odd), EVENT), (later, wider)):
        landing.write_landing(rows, src)
        ingest.stream_events(spark, src, f"{out}/checkpoint", f"{out}/events", schema)
    return tables.read(spark, f"{out}/events", merge_schema=True).select("event_id", "event_type", "campaign", "_rescued_data")


@query
def bronze_rules_stream(spark, sf_dir):
    """The Bronze rules as the ingesting stream counts them."""
    out, rules = scratch_path(spark, "bronze"), quality.BRONZE_EVENTS
    watched = ingest.stream_events(spark, _landed_events(spark, sf_dir), f"{out}/checkpoint", f"{out}/events", EVENT, rules=rules)
    rows = [(r["expectation"], r["total"], r["failing"], r["pass_rate"]) for r in ingest.counted(watched, rules)]
    return spark.createDataFrame(rows, "expectation string, total bigint, failing bigint, pass_rate double")


@query
def quarantine_stream(spark, sf_dir):
    """On-time rows and held ones, written by one stream to two sinks."""
    path, schema = _bronze_files(spark, sf_dir)
    out = scratch_path(spark, "split")
    stream = spark.readStream.schema(schema).parquet(path)
    ingest.split_stream(stream, stateful.split_late, f"{out}/good", f"{out}/held", f"{out}/checkpoint").awaitTermination()
    shown = lambda name, verdict: spark.read.schema(T.StructType([*schema.fields, T.StructField("quarantine_reason", T.StringType())])).parquet(f"{out}/{name}").select(
        "event_id", "_source_file", verdict.alias("verdict"))
    return shown("good", F.lit("on_time")).unionByName(shown("held", F.col("quarantine_reason")))


@query
def scd2_users_by_deliveries(spark, sf_dir):
    """User versions from snapshots that arrive in three deliveries, the latest changes first."""
    snapshots = _stored(spark, shop.user_snapshots(spark, sf_dir), "snapshots")
    table = tables.VersionedTable(spark, scratch_path(spark, "users"))
    dimension = dimensions.Dimension(spark, table, "user_id", USER_TRACKED)
    lot = F.pmod(F.xxhash64("user_id", "updated_ts"), F.lit(3))
    for n in (2, 0, 1):
        dimension.merge(snapshots.where(lot == n), n)
    return table.read().select(
        "user_id", "email", "country", "city", "marketing_opt_in", "loyalty_tier", "valid_from", "valid_to", "is_current", "version"
    )


# ---- reports ---------------------------------------------------------------------------

@query
def backfill_window(spark, sf_dir):
    """Silver from what was ingested before the 20th, then a replay of the days from there on."""
    bronze = shop.delivered_twice(_stored(spark, shop.first_delivery(spark, sf_dir), "first"))
    table = tables.VersionedTable(spark, scratch_path(spark, "silver"), ["event_date"], keys=["event_id"])
    clean = _stored(spark, ev.clean_events(bronze.where("_ingest_ts < TIMESTAMP '2024-01-20'")), "clean")
    table.publish(sessions.sessionize(clean, 720), anonymous_key=None)
    incremental.SilverEvents(spark, table, 720).merge(sessions.ingested_between(bronze, "2024-01-20", "2024-03-01"))
    return _silver_cols(table.read())


@query
def drift_report(spark, sf_dir):
    parsed = landing.parse_lines(_drifting_lines(spark, sf_dir), EVENT)
    marked = parsed.withColumns({"_source_file": F.col("batch_id"), "_ingest_date": F.to_date("event_ts")})
    return reports.drift_report(marked)


@query
def producer_split(spark, sf_dir):
    return reports.producer_split(_silver(spark, sf_dir))


@query
def event_type_counts(spark, sf_dir):
    return reports.event_type_counts(shop.bronze_events(spark, sf_dir), "2024-01-15")


@query
def gmv_by_category(spark, sf_dir):
    return reports.gmv_by_category(marts.daily_sales(_orders(spark, sf_dir)), AS_OF)


@query
def winback_top(spark, sf_dir):
    return reports.winback_list(_user_360(spark, sf_dir, "2024-07-15"), min_ltv=1000)


@query
def sales_preview(spark, sf_dir):
    return reports.sales_preview(marts.daily_sales(_orders(spark, sf_dir)))


@query
def funnel_trend(spark, sf_dir):
    return reports.conversion_trend(marts.funnel(_silver(spark, sf_dir)), AS_OF)


@query
def table_counts(spark, sf_dir):
    names = [
        "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
        "benchmark", "labels", "conversations",
    ]
    return reports.table_counts({n: shop.table(spark, sf_dir, n) for n in names})


@query
def conversation_tail(spark, sf_dir):
    return reports.conversation_tail(shop.table(spark, sf_dir, "conversations"), exchanges=2)

"""Shop tables derived from the test tables (TPC-H-like tables plus an event stream).

The mapping is plain column arithmetic over whole tables, so the same rows can be stated in
SQL.  Every event is delivered twice, the second time an hour later with a corrected price.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SCHEMA_VERSION
from ..session import use_utc

AS_OF = "2024-01-31 00:00:00"

# Fixed mapping of the test tables' event types.
TYPE_NAMES = {
    "view": "page_view", "click": "add_to_cart", "purchase": "purchase", "error": "abandon_cart", "signup": "signup",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment", "n_name"
    )


def _event(kind, user, custkey_text, day) -> dict:
    """Columns common to both event sources."""
    has_cart = kind.isin("add_to_cart", "purchase", "abandon_cart")
    return {
        "event_type": kind,
        "user_id": user,
        "session_id": F.concat(F.lit("s_"), custkey_text, F.lit("_"), day),
        "device": F.when(F.col("c_acctbal") > 5000, "desktop").otherwise("mobile"),
        "user_agent": F.lit(None).cast("string"),
        "ip": F.when(F.col("c_acctbal") > 0, F.concat(F.lit("10.0.0."), F.length("c_name").cast("string"))),
        "country": F.col("n_name"),
        "page_url": F.when(kind == "page_view", F.concat(F.lit("/p/"), F.col("product_id"))),
        "referrer": F.lit(None).cast("string"),
        "product_id": F.col("product_id"),
        "category": F.col("p_type"),
        "price": F.col("price"),
        "quantity": F.when(kind != "page_view", F.col("quantity")).cast("int"),
        "cart_id": F.when(has_cart, F.concat(F.lit("c_"), custkey_text, F.lit("_"), day)),
        "order_id": F.when(kind == "purchase", F.col("order_id")),
        "payment_method": F.when(kind == "purchase", F.when(F.col("price") >= 100, "wire").otherwise("card")),
        "discount_code": F.lit(None).cast("string"),
        "properties": F.create_map(F.lit("source"), F.when(F.col("c_acctbal") > 0, "web").otherwise("store")),
        "schema_version": F.lit(SCHEMA_VERSION),
    }


def first_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze events, one copy each.  Customers of one market segment browse anonymously."""
    use_utc(spark)
    raw = table(spark, sf_dir, "events").withColumns({
        "k": F.get_json_object("props", "$.k").cast("long"),
        "event_ts": F.col("ts").cast("timestamp"),
    })
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    joined = (
        raw.join(_customers(spark, sf_dir), F.col("user_id") == F.col("c_custkey"), "left")
        .join(part, F.col("k") == F.col("p_partkey"), "left")
    )
    day = F.date_format("event_ts", "yyyyMMdd")
    who = F.col("user_id").cast("string")
    named = joined.select(
        "event_id", "event_ts", "k", "event_type", "user_id", "p_type", "c_acctbal", "c_name", "c_mktsegment", "n_name",
        F.concat(F.lit("p_"), F.col("k").cast("string")).alias("product_id"),
        F.col("value").alias("price"),
        (F.lit(1) + F.col("event_id") % 3).alias("quantity"),
        F.concat(F.lit("o_"), who, F.lit("_"), day).alias("order_id"),
    )
    kind = F.create_map(*[F.lit(x) for pair in TYPE_NAMES.items() for x in pair])[F.col("event_type")]
    user = F.when(F.col("c_mktsegment") != "MACHINERY", F.concat(F.lit("u_"), who))
    shared = _event(kind, user, who, day)
    # Ingest lag grows with k: 20 minutes a step, so the last quarter is over a day late.
    ingest = F.col("event_ts") + F.make_dt_interval(mins=(F.col("k") * 20).cast("int"))
    return named.select(
        F.concat(F.lit("e_"), F.col("event_id").cast("string")).alias("event_id"),
        *[shared[c].alias(c) if c in shared else F.col(c) for c in _ORDER[1:]],
        ingest.alias("_ingest_ts"),
        F.lit("first").alias("_source_file"),
        F.to_date(ingest).alias("_ingest_date"),
    )


_ORDER = [
    "event_id", "event_type", "event_ts", "user_id", "session_id", "device", "user_agent", "ip", "country", "page_url",
    "referrer", "product_id", "category", "price", "quantity", "cart_id", "order_id", "payment_method",
    "discount_code", "properties", "schema_version",
]


def _delivered(first: DataFrame, copy) -> DataFrame:
    """Copy 0 is the first delivery, copy 1 the second."""
    at = F.col("_ingest_ts") + F.make_dt_interval(hours=copy)
    return first.withColumns({
        "price": F.col("price") + copy,
        "_ingest_ts": at,
        "_ingest_date": F.to_date(at),
        "_source_file": F.when(copy == 0, "first").otherwise("second"),
    })


def second_delivery(first: DataFrame) -> DataFrame:
    return _delivered(first, F.lit(1))


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both deliveries from one scan."""
    return delivered_twice(first_delivery(spark, sf_dir))


def delivered_twice(first: DataFrame) -> DataFrame:
    copies = first.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1))))
    return _delivered(copies, F.col("_copy")).drop("_copy")


def line_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as a cleaned, sessionised purchase event (the largest table)."""
    use_utc(spark)
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_suppkey", "l_linenumber", "l_shipdate"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    customers = _customers(spark, sf_dir).select("c_custkey", "n_name")
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    )
    text = lambda c: F.col(c).cast("string")
    return joined.select(
        F.concat_ws("_", F.lit("e"), text("l_orderkey"), text("l_partkey"), text("l_suppkey"), text("l_linenumber"),
                    F.date_format("l_shipdate", "yyyyMMdd")).alias("event_id"),
        F.lit("purchase").alias("event_type"),
        F.col("o_orderdate").cast("timestamp").alias("event_ts"),
        F.concat(F.lit("u_"), text("o_custkey")).alias("user_id"),
        F.concat(F.lit("u_"), text("o_custkey"), F.lit("_1")).alias("session_id_silver"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("p_"), text("l_partkey")).alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.concat(F.lit("o_"), text("l_orderkey")).alias("order_id"),
        F.col("o_orderpriority").alias("payment_method"),
    )


def user_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot per customer and order day."""
    use_utc(spark)
    days = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderdate").agg(
        F.max("o_orderpriority").alias("loyalty_tier"),
        F.bool_or(F.col("o_orderstatus") == "F").alias("marketing_opt_in"),
    )
    joined = days.join(_customers(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"), "left")
    at = F.col("o_orderdate").cast("timestamp")
    return joined.select(
        F.concat(F.lit("u_"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
        F.lit(None).cast("string").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.col("n_name").alias("country"),
        F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("city"),
        at.alias("signup_ts"),
        "marketing_opt_in",
        "loyalty_tier",
        at.alias("updated_ts"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
    )


def product_snapshots(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    """A snapshot per part and shipping day: the best discount sets the price; of the products ``of`` (product_id), if given."""
    use_utc(spark)
    lines = table(spark, sf_dir, "lineitem")
    if of is not None:  # before the days are grouped
        product = F.concat(F.lit("p_"), F.col("l_partkey").cast("string"))
        lines = lines.join(of, product == of["product_id"], "left_semi")
    days = lines.groupBy("l_partkey", "l_shipdate").agg(
        F.max("l_discount").alias("discount"),
        F.bool_or(F.col("l_returnflag") != "R").alias("active"),
    )
    joined = days.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    key = F.col("l_partkey").cast("string")
    return joined.select(
        F.concat(F.lit("p_"), key).alias("product_id"),
        F.concat(F.lit("sku-"), key).alias("sku"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.lit(None).cast("string").alias("subcategory"),
        F.col("p_brand").alias("brand"),
        F.round(
            F.col("p_retailprice").cast("decimal(18,2)") * (F.lit(1) - F.col("discount").cast("decimal(4,2)")), 2
        ).cast("double").alias("price"),
        F.lit("USD").alias("currency"),
        "active",
        F.col("l_shipdate").cast("timestamp").alias("updated_ts"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
    )


def embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("p_"), F.col("vec_id").cast("string")).alias("product_id"), "embedding", "label"
    )

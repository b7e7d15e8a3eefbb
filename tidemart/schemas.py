"""Pinned schemas and the fixed values of the shop's data contract."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the contract.
SCHEMA_VERSION = "1.0.0"
EVENT_TYPES = ("page_view", "add_to_cart", "purchase", "abandon_cart")
USER_TRACKED = ("email", "country", "city", "marketing_opt_in", "loyalty_tier")
PRODUCT_TRACKED = ("name", "category", "subcategory", "brand", "price", "currency", "active")
ORDER_KEYS = ("order_id", "user_id", "session_id_silver", "country", "payment_method")
PRODUCT_CATEGORIES = ("electronics", "appliances", "furniture")

TEXT, TIME, MONEY, WHOLE, FLAG = T.StringType(), T.TimestampType(), T.DoubleType(), T.IntegerType(), T.BooleanType()


def pinned(required: str, **types: T.DataType) -> T.StructType:
    """A schema from name=type pairs; the names listed in ``required`` are NOT NULL."""
    needed = set(required.split())
    return T.StructType([T.StructField(name, kind, name not in needed) for name, kind in types.items()])


EVENT = pinned(
    "event_id event_type event_ts session_id schema_version",
    event_id=TEXT, event_type=TEXT, event_ts=TIME, user_id=TEXT, session_id=TEXT, device=TEXT, user_agent=TEXT,
    ip=TEXT, country=TEXT, page_url=TEXT, referrer=TEXT, product_id=TEXT, category=TEXT, price=MONEY, quantity=WHOLE,
    cart_id=TEXT, order_id=TEXT, payment_method=TEXT, discount_code=TEXT, properties=T.MapType(TEXT, TEXT),
    schema_version=TEXT,
)

USER = pinned(
    "user_id signup_ts updated_ts schema_version",
    user_id=TEXT, email=TEXT, first_name=TEXT, last_name=TEXT, country=TEXT, city=TEXT, signup_ts=TIME,
    marketing_opt_in=FLAG, loyalty_tier=TEXT, updated_ts=TIME, schema_version=TEXT,
)

PRODUCT = pinned(
    "product_id sku name category price currency active updated_ts schema_version",
    product_id=TEXT, sku=TEXT, name=TEXT, category=TEXT, subcategory=TEXT, brand=TEXT, price=MONEY, currency=TEXT,
    active=FLAG, updated_ts=TIME, schema_version=TEXT,
)

ORDER_ITEM = pinned(
    "product_id quantity unit_price", product_id=TEXT, sku=TEXT, category=TEXT, quantity=WHOLE, unit_price=MONEY
)

ORDER = pinned(
    "order_id user_id order_ts status currency subtotal tax shipping total items schema_version",
    order_id=TEXT, user_id=TEXT, session_id=TEXT, order_ts=TIME, status=TEXT, currency=TEXT, subtotal=MONEY, tax=MONEY,
    shipping=MONEY, total=MONEY, payment_method=TEXT, country=TEXT, items=T.ArrayType(ORDER_ITEM), schema_version=TEXT,
)

INGEST_COLUMNS = pinned("_ingest_ts", _ingest_ts=TIME, _source_file=TEXT)

# As staged: the time of embedding is still text.
EMBEDDING = pinned(
    "product_id", product_id=TEXT, doc_text=TEXT, embedding=T.ArrayType(T.FloatType()), embedding_model_name=TEXT,
    embedding_version=TEXT, embed_ts=TEXT,
)


def loosened(schema: T.StructType) -> T.StructType:
    """The same fields, all nullable: files may miss required fields, and such rows stay."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def with_ingest_columns(schema: T.StructType, dated: bool = False) -> T.StructType:
    fields = schema.fields + INGEST_COLUMNS.fields
    if dated:
        fields = fields + [T.StructField("_ingest_date", T.DateType(), False)]
    return T.StructType(fields)

"""The registered queries stated in SQL over the test tables, for a second engine."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


def _ts(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {name or column}"


def _day(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {name or column}"


# ---- shared steps ----------------------------------------------------------------------

CUSTOMERS = """
people AS (
  SELECT c_custkey, c_name, c_acctbal, c_mktsegment, n_name
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
)"""

DELIVERIES = CUSTOMERS + """,
keyed AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
              WHEN 'error' THEN 'abandon_cart' ELSE event_type END AS kind,
         strftime(ts, '%Y%m%d') AS day
  FROM events
),
first_delivery AS (
  SELECT 'e_' || event_id AS event_id, kind AS event_type, ts AS event_ts,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'u_' || user_id END AS user_id,
         's_' || user_id || '_' || day AS session_id,
         CASE WHEN c_acctbal > 5000 THEN 'desktop' ELSE 'mobile' END AS device,
         CASE WHEN c_acctbal > 0 THEN '10.0.0.' || length(c_name) END AS ip,
         n_name AS country, 'p_' || k AS product_id, p_type AS category, value AS price,
         CASE WHEN kind <> 'page_view' THEN CAST(1 + event_id % 3 AS BIGINT) END AS quantity,
         CASE WHEN kind IN ('add_to_cart', 'purchase', 'abandon_cart') THEN 'c_' || user_id || '_' || day END AS cart_id,
         CASE WHEN kind = 'purchase' THEN 'o_' || user_id || '_' || day END AS order_id,
         CASE WHEN kind = 'purchase' THEN CASE WHEN value >= 100 THEN 'wire' ELSE 'card' END END AS payment_method,
         CASE WHEN c_acctbal > 0 THEN 'web' ELSE 'store' END AS source,
         ts + to_minutes(CAST(20 * k AS INTEGER)) AS _ingest_ts, 'first' AS _source_file
  FROM keyed LEFT JOIN people ON user_id = c_custkey LEFT JOIN part ON k = p_partkey
),
second_delivery AS (
  SELECT * REPLACE (price + 1.0 AS price, _ingest_ts + to_hours(1) AS _ingest_ts, 'second' AS _source_file)
  FROM first_delivery
),
bronze AS (SELECT * FROM first_delivery UNION ALL SELECT * FROM second_delivery)"""

CLEAN = DELIVERIES + """,
clean AS (
  SELECT * EXCLUDE (nth) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY _ingest_ts DESC) AS nth FROM bronze
    WHERE event_id IS NOT NULL AND event_ts IS NOT NULL
      AND event_type IN ('page_view', 'add_to_cart', 'purchase', 'abandon_cart')
  ) WHERE nth = 1
)"""


def _numbered(source: str, minutes: int, visitor: str = "user_id", label: str = "coalesce(user_id, 'anon')") -> str:
    return f"""
timed AS (
  SELECT *, floor(epoch(event_ts)) - lag(floor(epoch(event_ts))) OVER (PARTITION BY {visitor} ORDER BY event_ts) AS idle
  FROM {source}
),
silver AS (
  SELECT * EXCLUDE (idle, session_id), session_id AS session_id_raw, CAST(event_ts AS DATE) AS event_date,
         {label} || '_' || CAST(sum(CASE WHEN idle IS NULL OR idle / 60.0 > {minutes} THEN 1 ELSE 0 END)
           OVER (PARTITION BY {visitor} ORDER BY event_ts) AS BIGINT) AS session_id_silver
  FROM timed
)"""


def _silver(minutes: int = 720, **options) -> str:
    return CLEAN + "," + _numbered("clean", minutes, **options)


def _order_steps(lines: str) -> str:
    """``lines`` has the five keys, event_ts, price and quantity."""
    return f"""
line_units AS (SELECT *, CAST(round(price * 10000) AS BIGINT) * quantity AS units FROM {lines}),
order_sums AS (
  SELECT order_id, user_id, session_id_silver, country, payment_method, min(event_ts) AS order_ts,
         CAST(sum(units) AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS sub,
         CAST(sum(quantity) AS BIGINT) AS total_units, count(*) AS lines
  FROM line_units GROUP BY 1, 2, 3, 4, 5
),
order_parts AS (
  SELECT *, round(sub * CAST(0.08 AS DECIMAL(3,2)), 2) AS t,
         CASE WHEN sub > 75 THEN CAST(0 AS DECIMAL(4,2)) ELSE CAST(9.99 AS DECIMAL(4,2)) END AS s FROM order_sums
),
orders_f AS (
  SELECT order_id, user_id, session_id_silver, country, payment_method, order_ts, CAST(sub AS DOUBLE) AS subtotal,
         total_units, 'confirmed' AS status, 'USD' AS currency, CAST(t AS DOUBLE) AS tax, CAST(s AS DOUBLE) AS shipping,
         CAST(round(sub + t + s, 2) AS DOUBLE) AS total, CAST(order_ts AS DATE) AS order_date, lines
  FROM order_parts
)"""


PURCHASES = """
purchases AS (SELECT * FROM silver WHERE event_type = 'purchase' AND order_id IS NOT NULL)"""


def _orders(minutes: int = 720) -> str:
    return _silver(minutes) + "," + PURCHASES + "," + _order_steps("purchases")


BULK_LINES = CUSTOMERS + """,
bulk AS (
  SELECT 'u_' || o_custkey AS user_id, 'u_' || o_custkey || '_1' AS session_id_silver, n_name AS country,
         o_orderpriority AS payment_method, 'o_' || l_orderkey AS order_id, o_orderdate AS event_ts,
         'p_' || l_partkey AS product_id, p_type AS category, p_retailprice AS price, CAST(l_quantity AS BIGINT) AS quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
       LEFT JOIN people ON o_custkey = c_custkey
)"""
BULK = BULK_LINES + "," + _order_steps("bulk")

ORDER_OUT = f"""order_id, user_id, session_id_silver, country, payment_method, {_ts('order_ts')}, subtotal, total_units, status,
  currency, tax, shipping, total, {_day('order_date')}, lines"""

USER_DIM = """
user_days AS (
  SELECT o_custkey, o_orderdate, max(o_orderpriority) AS loyalty_tier, bool_or(o_orderstatus = 'F') AS marketing_opt_in
  FROM orders GROUP BY 1, 2
),
user_snaps AS (
  SELECT 'u_' || o_custkey AS user_id, lower(replace(c_name, '#', '.')) || '@example.com' AS email, c_name AS last_name,
         n_name AS country, CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS city, marketing_opt_in, loyalty_tier,
         o_orderdate AS updated_ts
  FROM user_days LEFT JOIN people ON o_custkey = c_custkey
),
user_steps AS (
  SELECT *, row(email, country, city, marketing_opt_in, loyalty_tier) AS state,
         lag(row(email, country, city, marketing_opt_in, loyalty_tier)) OVER w AS before, row_number() OVER w AS pos
  FROM user_snaps WINDOW w AS (PARTITION BY user_id ORDER BY updated_ts)
),
users AS (
  SELECT user_id, email, country, city, marketing_opt_in, loyalty_tier, updated_ts AS valid_from,
         lead(updated_ts) OVER w AS valid_to, lead(updated_ts) OVER w IS NULL AS is_current, row_number() OVER w AS version
  FROM user_steps WHERE pos = 1 OR state IS DISTINCT FROM before
  WINDOW w AS (PARTITION BY user_id ORDER BY updated_ts)
)"""

PRODUCT_DIM = """
part_days AS (
  SELECT l_partkey, l_shipdate, max(l_discount) AS discount, bool_or(l_returnflag <> 'R') AS active
  FROM lineitem GROUP BY 1, 2
),
product_snaps AS (
  SELECT 'p_' || l_partkey AS product_id, 'sku-' || l_partkey AS sku, p_name AS name, p_type AS category, p_brand AS brand,
         CAST(round(CAST(p_retailprice AS DECIMAL(18,2)) * (1 - CAST(discount AS DECIMAL(4,2))), 2) AS DOUBLE) AS price,
         active, l_shipdate AS updated_ts
  FROM part_days JOIN part ON l_partkey = p_partkey
),
product_steps AS (
  SELECT *, lag(price) OVER w AS old_price, lag(active) OVER w AS old_active, row_number() OVER w AS pos
  FROM product_snaps WINDOW w AS (PARTITION BY product_id ORDER BY updated_ts)
),
products AS (
  SELECT product_id, sku, name, category, brand, price, active, updated_ts AS valid_from, lead(updated_ts) OVER w AS valid_to,
         lead(updated_ts) OVER w IS NULL AS is_current, row_number() OVER w AS version
  FROM product_steps WHERE pos = 1 OR price <> old_price OR active <> old_active
  WINDOW w AS (PARTITION BY product_id ORDER BY updated_ts)
),
on_sale AS (SELECT * FROM products WHERE is_current AND active)"""

# An average of money in whole ten-thousandths, rounded half-up to cents.
_MEAN = "CASE WHEN count({0}) > 0 THEN ((2 * CAST(sum({0}) AS BIGINT) + 100 * count({0})) // (200 * count({0}))) / 100.0 END"

USER_METRICS = f"""
user_metrics AS (
  SELECT user_id, count(order_id) AS orders_count,
         CAST(CAST(sum(CAST(total AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DOUBLE) AS ltv,
         {_MEAN.format('u')} AS avg_order_value, max(order_ts) AS last_order_ts, min(order_ts) AS first_order_ts
  FROM (SELECT *, CAST(round(total * 10000) AS BIGINT) AS u FROM orders_f) GROUP BY 1
)"""

ACTIVITY = """
activity AS (
  SELECT user_id, count(DISTINCT session_id_silver) AS sessions_count, max(event_ts) AS last_seen_ts FROM silver GROUP BY 1
)"""


def _user_360(as_of: str = "2024-01-31") -> str:
    return _orders() + "," + USER_DIM + "," + USER_METRICS + "," + ACTIVITY + f""",
user_360 AS (
  SELECT *, CASE WHEN orders_count IS NULL THEN 'prospect' WHEN recency_days <= 30 THEN 'active'
                 WHEN recency_days <= 180 THEN 'lapsing' ELSE 'churned' END AS segment
  FROM (
    SELECT u.user_id, email, loyalty_tier, orders_count, ltv, avg_order_value, last_order_ts, first_order_ts, sessions_count,
           last_seen_ts, date_diff('day', CAST(last_order_ts AS DATE), DATE '{as_of}') AS recency_days
    FROM users u LEFT JOIN user_metrics m ON u.user_id = m.user_id LEFT JOIN activity a ON u.user_id = a.user_id
    WHERE u.is_current
  )
)"""


USER_360_OUT = f"""SELECT user_id, email, loyalty_tier, CAST(orders_count AS DOUBLE) AS orders_count, ltv, avg_order_value,
  {_ts('last_order_ts')}, {_ts('first_order_ts')}, CAST(sessions_count AS DOUBLE) AS sessions_count, {_ts('last_seen_ts')},
  CAST(recency_days AS DOUBLE) AS recency_days, segment FROM user_360"""

CARTS = """
carts AS (
  SELECT session_id_silver, user_id, cart_id, country, min(event_ts) AS cart_started_ts, max(event_ts) AS last_cart_event_ts,
         CAST(round(CAST(sum(CAST(round(price * 10000) AS BIGINT) * quantity) AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(5,4)), 2) AS DOUBLE) AS cart_value,
         CAST(sum(quantity) AS BIGINT) AS items_in_cart,
         array_to_string(list_sort(list(DISTINCT category) FILTER (category IS NOT NULL)), ',') AS categories
  FROM silver WHERE event_type = 'add_to_cart' GROUP BY 1, 2, 3, 4
),
abandoned AS (
  SELECT *, CAST(cart_started_ts AS DATE) AS cart_date, user_id IS NOT NULL AS remarketable FROM carts
  WHERE session_id_silver NOT IN (SELECT session_id_silver FROM silver WHERE event_type = 'purchase')
)"""

CART_OUT = f"""session_id_silver, user_id, cart_id, country, {_ts('cart_started_ts')}, {_ts('last_cart_event_ts')}, cart_value,
  items_in_cart, categories"""

FUNNEL = """
flags AS (
  SELECT CAST(event_ts AS DATE) AS event_date, session_id_silver,
         CAST(bool_or(event_type = 'page_view') AS BIGINT) AS viewed, CAST(bool_or(event_type = 'add_to_cart') AS BIGINT) AS carted,
         CAST(bool_or(event_type = 'purchase') AS BIGINT) AS purchased, CAST(bool_or(event_type = 'abandon_cart') AS BIGINT) AS abandoned
  FROM silver GROUP BY 1, 2
),
funnel AS (
  SELECT *, CASE WHEN sessions_viewed > 0 THEN CAST(sessions_carted AS DOUBLE) / sessions_viewed END AS cart_rate,
         CASE WHEN sessions_viewed > 0 THEN CAST(sessions_purchased AS DOUBLE) / sessions_viewed END AS purchase_rate,
         CASE WHEN sessions_carted > 0 THEN CAST(sessions_abandoned AS DOUBLE) / sessions_carted END AS abandon_rate
  FROM (
    SELECT event_date, CAST(sum(viewed) AS BIGINT) AS sessions_viewed, CAST(sum(carted) AS BIGINT) AS sessions_carted,
           CAST(sum(purchased) AS BIGINT) AS sessions_purchased, CAST(sum(abandoned) AS BIGINT) AS sessions_abandoned
    FROM flags GROUP BY 1
  )
)"""
FUNNEL_OUT = f"""SELECT {_day('event_date')}, sessions_viewed, sessions_carted, sessions_purchased, sessions_abandoned, cart_rate,
  purchase_rate, abandon_rate FROM funnel"""


def _sales(lines: str, aov: str = "line") -> str:
    """Daily sales from lines joined to their order's total."""
    joined = f"""
sold AS (
  SELECT CAST(o.order_ts AS DATE) AS sale_date, l.category, o.country, o.order_id, o.user_id, o.session_id_silver,
         o.payment_method, l.quantity, CAST(round(l.price * 10000) AS BIGINT) * l.quantity AS line_u,
         CAST(round(o.total * 10000) AS BIGINT) AS total_u
  FROM orders_f o JOIN {lines} l ON o.order_id = l.order_id AND o.user_id IS NOT DISTINCT FROM l.user_id
    AND o.session_id_silver = l.session_id_silver AND o.country IS NOT DISTINCT FROM l.country
    AND o.payment_method IS NOT DISTINCT FROM l.payment_method
)"""
    if aov == "order":
        joined += """,
per_order AS (
  SELECT sale_date, category, country, order_id, user_id, session_id_silver, payment_method, sum(quantity) AS quantity,
         sum(line_u) AS line_u, max(total_u) AS total_u
  FROM sold GROUP BY ALL
)"""
    return joined + f""",
sales AS (
  SELECT sale_date, category, country, count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS units,
         CAST(round(CAST(sum(line_u) AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(5,4)), 2) AS DOUBLE) AS gmv,
         {_MEAN.format('total_u')} AS avg_order_value
  FROM {'per_order' if aov == 'order' else 'sold'} GROUP BY 1, 2, 3
)"""


SALES_OUT = f"SELECT {_day('sale_date')}, category, country, orders, units, gmv, avg_order_value FROM sales"

SIGNALS = f"""
event_signals AS (
  SELECT product_id, count(*) FILTER (event_type = 'add_to_cart') AS carts, count(*) FILTER (event_type = 'page_view') AS views
  FROM silver WHERE event_ts BETWEEN {AS_OF} - INTERVAL 7 DAY AND {AS_OF} AND product_id IS NOT NULL
    AND event_type IN ('page_view', 'add_to_cart') GROUP BY 1
),
order_signals AS (
  SELECT l.product_id, CAST(sum(l.quantity) AS BIGINT) AS bought
  FROM orders_f o JOIN purchases l ON o.order_id = l.order_id AND o.user_id IS NOT DISTINCT FROM l.user_id
    AND o.session_id_silver = l.session_id_silver AND o.country IS NOT DISTINCT FROM l.country
    AND o.payment_method IS NOT DISTINCT FROM l.payment_method
  WHERE o.order_ts BETWEEN {AS_OF} - INTERVAL 7 DAY AND {AS_OF} AND l.product_id IS NOT NULL GROUP BY 1
),
signals AS (
  SELECT coalesce(e.product_id, o.product_id) AS product_id, coalesce(bought, 0) AS purchases_7d,
         coalesce(carts, 0) AS add_to_cart_7d, coalesce(views, 0) AS views_7d
  FROM event_signals e FULL JOIN order_signals o ON e.product_id = o.product_id
),
popular AS (
  SELECT *, least(1, 0.6 * share(purchases_7d, max(purchases_7d) OVER ()) + 0.3 * share(add_to_cart_7d, max(add_to_cart_7d) OVER ())
    + 0.1 * share(views_7d, max(views_7d) OVER ())) AS popularity_score
  FROM signals
)"""
for _c in ("purchases_7d", "add_to_cart_7d", "views_7d"):
    SIGNALS = SIGNALS.replace(
        f"share({_c}, max({_c}) OVER ())",
        f"(CASE WHEN max({_c}) OVER () > 0 THEN ln(1.0 + CAST({_c} AS DOUBLE)) / ln(1.0 + CAST(max({_c}) OVER () AS DOUBLE)) ELSE 0 END)",
    )

EVENT_OUT = f"""event_id, event_type, {_ts('event_ts')}, user_id, session_id, device, ip, country, product_id, category, price,
  CAST(quantity AS DOUBLE) AS quantity, cart_id, order_id, payment_method"""
SILVER_OUT = f"""SELECT {EVENT_OUT.replace('session_id,', '')}, session_id_raw, session_id_silver, {_day('event_date')} FROM silver"""

# ---- vectors ---------------------------------------------------------------------------

VECTORS = """
vectors AS (SELECT 'p_' || vec_id AS product_id, CAST(embedding AS DOUBLE[]) AS v, embedding, label FROM embeddings)"""


def _centroids(source: str, group: str) -> str:
    return f"""
cells AS (SELECT {group} AS g, unnest(v) AS x, unnest(range(len(v))) AS pos FROM {source}),
centroids AS (
  SELECT g, CAST(CAST(list(m ORDER BY pos) AS FLOAT[]) AS DOUBLE[]) AS q FROM (SELECT g, pos, avg(x) AS m FROM cells GROUP BY 1, 2)
  GROUP BY 1
)"""


LABEL_KNN = f"""WITH {VECTORS}, {_centroids('vectors', 'label')},
scored AS (SELECT 'q_' || g AS query_id, product_id, round(list_dot_product(q, v), 6) AS score FROM centroids, vectors),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, product_id) AS retrieval_rank FROM scored)
SELECT query_id, product_id, score, retrieval_rank FROM ranked WHERE retrieval_rank <= 10"""

ASKED = VECTORS + """,
typed AS (SELECT p_type, v FROM vectors JOIN part ON product_id = 'p_' || p_partkey)""" + "," + _centroids("typed", "p_type") + """,
asked AS (
  SELECT g AS query_id, q, g AS category, CASE WHEN g = 'PROMO' THEN 0.0 WHEN g <> 'SMALL' THEN 900.0 END AS max_price,
         CASE WHEN g <> 'LARGE' THEN 'red' END AS query
  FROM centroids
)"""


def _prefiltered(asked: str, k: int) -> str:
    return f"""
pre AS (
  SELECT * FROM (
    SELECT query_id, product_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, product_id) AS retrieval_rank
    FROM (
      SELECT query_id, c.product_id, round(list_dot_product(q, v), 6) AS score
      FROM {asked} a, vectors c JOIN on_sale s ON c.product_id = s.product_id
      WHERE (a.category IS NULL OR s.category = a.category) AND (NOT coalesce(max_price > 0, FALSE) OR s.price <= max_price)
    )
  ) WHERE retrieval_rank <= {k}
)"""


_KNOWN = "('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD')"


def _postfiltered(asked: str, k: int) -> str:
    return f"""
hits AS (
  SELECT * FROM (
    SELECT query_id, product_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, product_id) AS retrieval_rank
    FROM (SELECT query_id, product_id, round(list_dot_product(q, v), 6) AS score FROM {asked}, vectors)
  ) WHERE retrieval_rank <= {5 * k}
),
post AS (
  SELECT h.query_id, h.product_id, score, retrieval_rank, name, s.category, price
  FROM hits h JOIN on_sale s ON h.product_id = s.product_id JOIN {asked} a ON h.query_id = a.query_id
  WHERE (a.category IS NULL OR a.category NOT IN {_KNOWN} OR s.category = a.category)
    AND (NOT coalesce(max_price > 0, FALSE) OR price <= max_price)
)"""


def _literal(asked: str, k: int) -> str:
    return f"""
lit AS (
  SELECT * FROM (
    SELECT query_id, s.product_id, row_number() OVER (PARTITION BY query_id ORDER BY price, s.product_id) AS retrieval_rank
    FROM {asked} a, on_sale s
    WHERE (a.category IS NULL OR a.category NOT IN {_KNOWN} OR s.category = a.category)
      AND (NOT coalesce(max_price > 0, FALSE) OR price <= max_price)
      AND (coalesce(query, '') = '' OR lower(name) LIKE '%' || lower(query) || '%')
  ) WHERE retrieval_rank <= {k}
)"""


def _tiers(pool: int, limit: int) -> str:
    """chosen: per query the rows of its first tier that has any, cut to the pool (tiers 1, 2) or the limit (tier 3)."""
    return f"""
wanted AS (
  SELECT * REPLACE (CASE WHEN query_id = 'MEDIUM' THEN 830.0 ELSE max_price END AS max_price,
    CASE WHEN query_id IN ('ECONOMY', 'LARGE') THEN category ELSE 'toys' END AS category) FROM asked
),
spoken AS (SELECT * FROM wanted WHERE coalesce(trim(query), '') <> ''),
{_prefiltered('spoken', pool)}, {_postfiltered('spoken', pool)}, {_literal('wanted', limit)},
stacked AS (
  SELECT query_id, 1 AS tier, product_id, score, retrieval_rank FROM pre
  UNION ALL SELECT query_id, 2, product_id, score, retrieval_rank FROM post
  UNION ALL SELECT query_id, 3, product_id, NULL, retrieval_rank FROM lit
),
chosen AS (
  SELECT * FROM (
    SELECT *, min(tier) OVER (PARTITION BY query_id) AS best,
           row_number() OVER (PARTITION BY query_id, tier ORDER BY retrieval_rank) AS place FROM stacked
  ) JOIN on_sale USING (product_id)
  WHERE tier = best AND place <= {pool}
)"""


def _tokens(source: str, id_column: str, name: str) -> str:
    """Unit vectors of the stand-in encoder as (id, pos, w), w at single precision."""
    return f"""
{name}_words AS (SELECT {id_column} AS id, unnest(string_split(text, ' ')) AS word FROM {source}),
{name}_counts AS (
  SELECT id, CAST('0x' || substr(md5(word), 1, 4) AS INTEGER) % 64 AS pos, CAST(count(*) AS DOUBLE) AS n
  FROM {name}_words WHERE word <> '' GROUP BY 1, 2
),
{name}_vec AS (
  SELECT id, pos, CAST(CAST(n / sqrt(sum(n * n) OVER (PARTITION BY id)) AS FLOAT) AS DOUBLE) AS w FROM {name}_counts
)"""


CANDIDATES = "WITH " + ASKED + "," + PRODUCT_DIM + "," + _postfiltered("asked", 20)

PRICED = """
priced AS (
  SELECT *, CASE WHEN max(price) OVER w = min(price) OVER w THEN 1.0
                 ELSE (max(price) OVER w - price) / (max(price) OVER w - min(price) OVER w) END AS price_score
  FROM post WINDOW w AS (PARTITION BY query_id)
)"""


# ---- quality ---------------------------------------------------------------------------

def _rule(table_name: str, source: str, name: str, predicate: str, severity: str = "warn") -> str:
    return f"""SELECT '{table_name}' AS table_name, '{name}' AS expectation, '{severity}' AS severity, count(*) AS total,
  count(*) FILTER (NOT ({predicate})) AS failing,
  CASE WHEN count(*) > 0 THEN CAST(count(*) - count(*) FILTER (NOT ({predicate})) AS DOUBLE) / count(*) ELSE 1.0 END AS pass_rate
FROM {source}"""


def _rules(*rows: tuple) -> str:
    return " UNION ALL ".join(_rule(*r) for r in rows)


# ---- drift -----------------------------------------------------------------------------

DRIFT = DELIVERIES + """,
sent AS (
  SELECT *, price > 400 AS malformed, category = 'PROMO' AS text_price, country IN ('NATION_1', 'NATION_2') AS extra,
         price <= 150 AS has_session,
         CASE WHEN device = 'desktop' THEN 'bulk' ELSE country || '_' || strftime(event_ts, '%Y%m%d') END AS batch_id
  FROM first_delivery
)"""


def build() -> dict[str, str]:
    silver, sold = _silver(), _orders()
    sql: dict[str, str] = {}

    # Silver
    sql["dedup_latest"] = f"WITH {CLEAN} SELECT {EVENT_OUT}, {_ts('_ingest_ts')} FROM clean"
    sql["sessionize_30"] = f"WITH {_silver(30)} {SILVER_OUT}"
    sql["sessionize_720"] = sql["sessionize_one_window"] = f"WITH {silver} {SILVER_OUT}"
    apart = _silver(
        visitor="coalesce('u' || user_id, 'a' || session_id)", label="coalesce(user_id, 'anon_' || session_id)"
    )
    sql["sessionize_anonymous_apart"] = f"WITH {apart} {SILVER_OUT}"
    sql["fact_orders"] = f"WITH {sold} SELECT {ORDER_OUT} FROM orders_f"
    sql["fact_orders_bulk"] = f"WITH {BULK} SELECT {ORDER_OUT} FROM orders_f"
    sql["order_totals_bulk"] = f"""WITH {BULK} SELECT order_id, user_id, session_id_silver, country, payment_method,
      {_ts('order_ts')}, subtotal, total_units, status, currency, tax, shipping, total FROM orders_f"""
    sql["order_lines"] = f"""WITH {sold} SELECT order_id, product_id, category, CAST(quantity AS DOUBLE) AS quantity, price AS unit_price,
      round(price * quantity, 4) AS line_total FROM purchases"""
    sql["scd2_users"] = f"""WITH {CUSTOMERS}, {USER_DIM} SELECT user_id, email, country, city, marketing_opt_in, loyalty_tier,
      {_ts('valid_from')}, {_ts('valid_to')}, is_current, version FROM users"""
    sql["scd2_users_compat_hash"] = f"""WITH {CUSTOMERS}, {USER_DIM} SELECT user_id, loyalty_tier, marketing_opt_in,
      {_ts('valid_from')}, {_ts('valid_to')}, version FROM users"""
    sql["scd2_products"] = f"""WITH {PRODUCT_DIM} SELECT product_id, name, category, brand, price, active, {_ts('valid_from')},
      {_ts('valid_to')}, is_current, version FROM products"""

    # marts
    sql["daily_sales"] = f"WITH {sold}, {_sales('purchases')} {SALES_OUT}"
    sql["daily_sales_order_aov"] = f"WITH {sold}, {_sales('purchases', 'order')} {SALES_OUT}"
    sql["daily_sales_bulk"] = f"WITH {BULK}, {_sales('bulk')} {SALES_OUT}"
    sql["session_flags"] = f"WITH {silver}, {FUNNEL} SELECT {_day('event_date')}, session_id_silver, viewed, carted, purchased, abandoned FROM flags"
    sql["daily_funnel"] = f"WITH {silver}, {FUNNEL} {FUNNEL_OUT}"
    sql["daily_funnel_30"] = f"WITH {_silver(30)}, {FUNNEL} {FUNNEL_OUT}"
    for name in ("publish_latest", "quality_checked_publish"):
        sql[name] = sql["daily_funnel"]
    sql["cart_value"] = f"WITH {silver}, {CARTS} SELECT {CART_OUT} FROM carts"
    sql["purchasing_sessions"] = f"WITH {silver} SELECT DISTINCT session_id_silver FROM silver WHERE event_type = 'purchase'"
    sql["abandoned_carts"] = f"WITH {silver}, {CARTS} SELECT {CART_OUT}, {_day('cart_date')}, remarketable FROM abandoned"
    metrics = f"SELECT user_id, CAST(orders_count AS DOUBLE) AS orders_count, ltv, avg_order_value, {_ts('last_order_ts')}, {_ts('first_order_ts')} FROM user_metrics"
    sql["user_order_metrics"] = f"WITH {sold}, {USER_METRICS} {metrics}"
    sql["user_order_metrics_bulk"] = f"WITH {BULK}, {USER_METRICS} {metrics}"
    sql["user_activity"] = f"WITH {silver}, {ACTIVITY} SELECT user_id, CAST(sessions_count AS DOUBLE) AS sessions_count, {_ts('last_seen_ts')} FROM activity"
    sql["user_360"] = f"WITH {_user_360()} {USER_360_OUT}"
    sql["user_360_february"] = f"WITH {_user_360('2024-02-15')} {USER_360_OUT}"
    sql["user_360_july"] = f"WITH {_user_360('2024-07-15')} {USER_360_OUT}"

    # joins
    sql["pit_orders_users"] = f"""WITH {CUSTOMERS}, {USER_DIM}
      SELECT l_orderkey, l_partkey, u.user_id, {_ts('l_shipdate', 'shipped_ts')}, version, loyalty_tier, marketing_opt_in
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN users u ON u.user_id = 'u_' || o_custkey
        AND l_shipdate >= valid_from AND (valid_to IS NULL OR l_shipdate < valid_to)"""
    sql["pit_lines_products"] = f"""WITH {BULK}, {PRODUCT_DIM}
      SELECT order_id, {_ts('event_ts', 'order_ts')}, b.product_id, CAST(quantity AS DOUBLE) AS quantity, b.price AS unit_price, version,
        p.price AS price_at_sale, active
      FROM bulk b JOIN products p ON p.product_id = b.product_id AND event_ts >= valid_from
        AND (valid_to IS NULL OR event_ts < valid_to)"""
    sql["remarketing_list"] = f"""WITH {_user_360()}, {CARTS}
      SELECT user_id, email, cart_id, cart_value, categories, {_ts('cart_started_ts')}
      FROM abandoned JOIN user_360 USING (user_id)
      WHERE remarketable AND cart_started_ts >= {AS_OF} - INTERVAL 7 DAY AND segment IN ('active', 'lapsing')"""
    carted = f"WITH {DELIVERIES}, {PRODUCT_DIM}, carted AS (SELECT * FROM first_delivery WHERE event_type = 'add_to_cart')"
    # Some carts name a product that no snapshot has.
    tried = carted.replace("SELECT * FROM first_delivery", """SELECT * REPLACE (
      CASE WHEN quantity = 2 THEN 'gone_' || product_id ELSE product_id END AS product_id) FROM first_delivery""")
    sql["enrich_cart_events"] = f"""{tried} SELECT event_id, product_id, p.category, p.price, CAST(quantity AS DOUBLE) AS quantity, name, 'web_chat' AS source
      FROM carted JOIN products p USING (product_id) WHERE is_current"""
    sql["enrich_rejects"] = f"""{tried} SELECT event_id, product_id, CAST(NULL AS VARCHAR) AS category, CAST(NULL AS DOUBLE) AS price,
      source FROM carted WHERE product_id NOT IN (SELECT product_id FROM products WHERE is_current)"""

    # search
    text = "name || ' | ' || category || ' | ' || brand AS doc_text"
    sql["current_products"] = f"""WITH {PRODUCT_DIM} SELECT product_id, sku, name, category, brand, price, 'USD' AS currency, {text}
      FROM on_sale"""
    sql["product_search"] = f"""WITH {PRODUCT_DIM} SELECT product_id, name, category, price, 'USD' AS currency FROM on_sale
      WHERE category = 'PROMO' AND lower(name) LIKE '%red%' AND price <= 1500 ORDER BY price, product_id LIMIT 25"""
    sql["product_search_unknown_category"] = f"""WITH {PRODUCT_DIM} SELECT product_id, name, category, price, 'USD' AS currency
      FROM on_sale WHERE lower(name) LIKE '%r_d%' ORDER BY price, product_id LIMIT 10"""
    sql["product_get"] = f"""{carted} SELECT product_id, name, category, price, 'USD' AS currency FROM products
      WHERE is_current AND product_id IN (SELECT product_id FROM carted)"""
    sql["doc_text"] = f"WITH {PRODUCT_DIM} SELECT product_id, {text} FROM on_sale"
    sql["embed_documents"] = f"""WITH {_tokens('documents', 'doc_id', 'd')}
      SELECT CAST(id AS VARCHAR) AS doc_id, CAST(pos AS BIGINT) AS pos, round(w, 5) AS weight FROM d_vec"""
    meta = "'hashed' AS embedding_model_name, '1' AS embedding_version, '2024-01-31 00:00:00.000000' AS embed_ts"
    sql["embedding_build"] = f"""WITH {PRODUCT_DIM} SELECT product_id, {text}, {meta}, CAST(64 AS BIGINT) AS dim,
      CAST(1.0 AS DOUBLE) AS norm FROM on_sale"""
    sql["staged_embeddings_readback"] = f"""WITH {PRODUCT_DIM} SELECT product_id, {text}, 'hashed' AS embedding_model_name,
      '2024-01-31 00:00:00.000000' AS embed_ts, CAST(64 AS BIGINT) AS dim FROM on_sale"""
    sql["embedding_audit"] = f"""WITH {PRODUCT_DIM} SELECT 'hashed' AS embedding_model_name, '1' AS embedding_version,
      count(*) AS vectors FROM on_sale"""
    sql["knn_topk"] = sql["knn_topk_in_blocks"] = LABEL_KNN
    sql["knn_texts"] = f"""WITH {_tokens('documents', 'doc_id', 'd')}, {_tokens('benchmark', 'item_id', 'b')},
      scored AS (
        SELECT CAST(b.id AS VARCHAR) AS query_id, CAST(d.id AS VARCHAR) AS product_id, round(sum(b.w * d.w), 6) AS score
        FROM b_vec b JOIN d_vec d USING (pos) GROUP BY 1, 2
      ),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, product_id) AS retrieval_rank FROM scored)
      SELECT query_id, round(score, 4) AS score, retrieval_rank FROM ranked WHERE retrieval_rank <= 5"""
    sql["knn_prefiltered"] = f"""WITH {ASKED}, {PRODUCT_DIM}, {_prefiltered('asked', 15)}
      SELECT query_id, product_id, score, retrieval_rank FROM pre"""
    sql["knn_postfiltered"] = f"""WITH {ASKED}, {PRODUCT_DIM}, {_postfiltered('asked', 10)}
      SELECT query_id, product_id, score, retrieval_rank, name, category, price FROM post"""
    sql["literal_search"] = f"""WITH {ASKED}, {PRODUCT_DIM}, {_literal('asked', 25)}
      SELECT query_id, product_id, retrieval_rank FROM lit"""
    sql["tiered_search"] = f"""WITH {ASKED}, {PRODUCT_DIM}, {_tiers(5, 5)}
      SELECT query_id, CAST(tier AS BIGINT) AS tier, product_id, score, retrieval_rank, name, category, price FROM chosen"""

    # ranking
    sql["product_signals"] = f"WITH {sold}, {SIGNALS} SELECT product_id, purchases_7d, add_to_cart_7d, views_7d FROM signals"
    sql["popularity_score"] = f"""WITH {sold}, {SIGNALS} SELECT product_id, purchases_7d, add_to_cart_7d, views_7d,
      round(popularity_score, 6) AS popularity_score FROM popular"""
    sql["price_score"] = f"{CANDIDATES}, {PRICED} SELECT query_id, product_id, price, round(price_score, 6) AS price_score FROM priced"
    sql["hybrid_rank"] = f"""{CANDIDATES}, {PRICED}, {sold}, {SIGNALS},
      parts AS (
        SELECT query_id, product_id, retrieval_rank, greatest(0.0, least(1.0, score)) AS semantic, price_score,
               coalesce(popularity_score, 0.0) AS popularity_score
        FROM priced LEFT JOIN popular USING (product_id)
      ),
      finals AS (SELECT *, round(0.60 * semantic + 0.15 * price_score + 0.25 * popularity_score, 12) AS final_score FROM parts)
      SELECT query_id, product_id, rank, round(semantic, 6) AS semantic, round(price_score, 6) AS price_score,
        round(popularity_score, 6) AS popularity_score, round(final_score, 6) AS final_score
      FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY final_score DESC, retrieval_rank) AS rank FROM finals)
      WHERE rank <= 5"""

    sql["semantic_search"] = f"""WITH {ASKED}, {PRODUCT_DIM}, {_tiers(20, 5)}, {PRICED.replace('FROM post', 'FROM chosen WHERE tier < 3')},
      {sold}, {SIGNALS},
      finals AS (
        SELECT query_id, tier, product_id, retrieval_rank, round(0.60 * greatest(0.0, least(1.0, score)) + 0.15 * price_score
          + 0.25 * coalesce(popularity_score, 0.0), 12) AS final_score
        FROM priced LEFT JOIN popular USING (product_id)
      )
      SELECT query_id, CAST(tier AS BIGINT) AS tier, product_id, rank, round(final_score, 6) AS final_score
      FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY final_score DESC, retrieval_rank) AS rank FROM finals)
      WHERE rank <= 5
      UNION ALL SELECT query_id, CAST(tier AS BIGINT), product_id, retrieval_rank, NULL FROM chosen WHERE tier = 3"""

    # quality
    sql["quality_bronze"] = f"WITH {DELIVERIES}, {USER_DIM}, {PRODUCT_DIM} " + _rules(
        ("events", "bronze", "event_id_present", "event_id IS NOT NULL"),
        ("events", "bronze", "event_ts_present", "event_ts IS NOT NULL"),
        ("events", "bronze", "user_id_present", "user_id IS NOT NULL"),
        ("users", "user_snaps", "user_id_present", "user_id IS NOT NULL"),
        ("products", "product_snaps", "product_id_present", "product_id IS NOT NULL"),
    )
    sql["quality_events"] = f"WITH {silver} " + _rules(
        ("events", "silver", "event_id_not_null", "event_id IS NOT NULL", "fail"),
        ("events", "silver", "valid_event_type", "event_type IN ('page_view', 'add_to_cart', 'purchase', 'abandon_cart')", "fail"),
        ("events", "silver", "session_id_silver_present", "session_id_silver IS NOT NULL", "fail"),
        ("events", "silver", "non_negative_price", "price IS NULL OR price >= 0"),
        ("events", "silver", "positive_quantity", "quantity IS NULL OR quantity > 0"),
        ("events", "silver", "purchase_has_order_id", "event_type <> 'purchase' OR order_id IS NOT NULL", "fail"),
    )
    sql["quality_dims"] = f"WITH {CUSTOMERS}, {USER_DIM}, {PRODUCT_DIM} " + _rules(
        ("dim_users", "users", "user_id_not_null", "user_id IS NOT NULL", "fail"),
        ("dim_products", "products", "product_id_not_null", "product_id IS NOT NULL", "fail"),
    )
    sql["quality_orders"] = f"WITH {sold} " + _rules(
        ("fact_orders", "orders_f", "order_total_positive", "total >= 0", "fail"),
        ("fact_orders", "orders_f", "order_subtotal_consistent", "subtotal >= 0", "fail"),
        ("fact_orders", "orders_f", "order_has_items", "lines > 0", "fail"),
        ("fact_orders", "orders_f", "order_total_matches", "abs(total - (subtotal + tax + shipping)) < 0.05"),
    )
    sql["repeated_order_ids"] = f"WITH {sold} SELECT order_id, count(*) AS count FROM orders_f GROUP BY 1 HAVING count(*) > 1"
    rates = " AND ".join(f"({r} IS NULL OR {r} BETWEEN 0 AND 1)" for r in ("cart_rate", "purchase_rate", "abandon_rate"))
    sql["quality_gold"] = f"WITH {_user_360()}, {CARTS}, {FUNNEL}, {_sales('purchases')} " + _rules(
        ("daily_sales", "sales", "non_negative_gmv", "gmv >= 0"),
        ("daily_sales", "sales", "orders_match_units", "units >= orders"),
        ("funnel", "funnel", "rates_in_unit_interval", rates),
        ("abandoned_carts", "abandoned", "non_negative_cart_value", "cart_value >= 0"),
        ("user_360", "user_360", "known_segment", "segment IN ('prospect', 'active', 'lapsing', 'churned')"),
    )

    # tables
    sql["append_readback"] = f"WITH {DELIVERIES} SELECT {EVENT_OUT}, _source_file, {_day('_ingest_ts', '_ingest_date')} FROM bronze"
    sql["overwrite_readback"] = f"WITH {DELIVERIES} SELECT event_id, price, {_day('_ingest_ts', '_ingest_date')} FROM second_delivery"
    sql["upsert_all"] = f"WITH {DELIVERIES} SELECT event_id, {_day('event_ts', 'event_date')}, event_type, price, _source_file FROM second_delivery"
    sql["upsert_some_columns"] = f"""WITH {DELIVERIES} SELECT s.event_id, {_day('s.event_ts', 'event_date')}, s.event_type, s.price,
      'first' AS _source_file FROM second_delivery s JOIN first_delivery f USING (event_id)"""
    sql["typed_table"] = f"""WITH {DELIVERIES} SELECT {EVENT_OUT}, '1.0.0' AS schema_version, {_ts('_ingest_ts')},
      {_day('_ingest_ts', '_ingest_date')} FROM first_delivery"""
    sql["clustered_readback"] = f"SELECT l_orderkey, l_partkey, {_ts('l_shipdate')}, l_returnflag, l_quantity FROM lineitem"
    sql["landing_json_readback"] = f"WITH {DELIVERIES} SELECT {EVENT_OUT} FROM first_delivery"

    # ingestion and streams
    sql["stream_events_readback"] = f"WITH {DELIVERIES} SELECT {EVENT_OUT}, CAST(NULL AS VARCHAR) AS _rescued_data FROM first_delivery"
    sql["stream_snapshots_readback"] = f"""WITH {CUSTOMERS}, {USER_DIM} SELECT user_id, email, CAST(NULL AS VARCHAR) AS first_name,
      last_name, country, city, {_ts('updated_ts', 'signup_ts')}, marketing_opt_in, loyalty_tier, {_ts('updated_ts')},
      '1.0.0' AS schema_version, CAST(NULL AS VARCHAR) AS _rescued_data FROM user_snaps"""
    sql["rescued_fields"] = f"""WITH {DRIFT} SELECT event_id AS sent_id, CASE WHEN NOT malformed THEN event_id END AS event_id,
      CASE WHEN NOT malformed THEN {_ts('event_ts').removesuffix(' AS event_ts')} END AS event_ts,
      CASE WHEN NOT malformed AND NOT text_price THEN price END AS price,
      CASE WHEN NOT malformed AND has_session THEN session_id END AS session_id,
      CASE WHEN NOT malformed AND text_price THEN 'n/a' END AS rescued_price,
      CASE WHEN NOT malformed AND extra THEN '9' END AS rescued_zz, malformed FROM sent"""
    sql["contract_check"] = f"""WITH {DRIFT} , judged AS (
        SELECT *, CASE WHEN malformed THEN 'malformed_json' WHEN count(*) OVER (PARTITION BY batch_id) > 1000 THEN 'batch_too_large'
          WHEN extra THEN 'unknown_field' WHEN NOT has_session THEN 'missing_field' WHEN text_price THEN 'bad_value'
          WHEN event_type = 'signup' THEN 'unknown_event_type' ELSE 'valid' END AS verdict FROM sent)
      SELECT event_id AS sent_id, batch_id, verdict, CASE WHEN verdict = 'valid' THEN event_type END AS event_type,
        CASE WHEN verdict = 'valid' THEN price END AS price FROM judged"""
    sql["fill_transport_fields"] = f"""WITH {DELIVERIES}, batched AS (
        SELECT *, country || '_' || strftime(event_ts, '%Y%m%d') AS batch_id FROM first_delivery)
      SELECT event_id, batch_id, coalesce(ip, '192.168.0.' || count(*) OVER w) AS ip, 'agent/' || max(device) OVER w AS user_agent
      FROM batched WINDOW w AS (PARTITION BY batch_id)"""
    sql["stream_upsert"] = sql["backfill_window"] = sql["sessionize_720"]
    sql["stream_dedup_watermark"] = f"""WITH {DELIVERIES} SELECT event_id, event_type, {_ts('event_ts')}, user_id, product_id
      FROM first_delivery"""
    sql["late_split"] = f"""WITH {DELIVERIES} SELECT event_id, _source_file,
      CASE WHEN _ingest_ts - event_ts > INTERVAL 24 HOUR THEN 'late' ELSE 'on_time' END AS verdict FROM bronze"""
    sql["live_sessions"] = f"""WITH {DELIVERIES},
      clicks AS (SELECT user_id, date_trunc('second', event_ts) AS ts FROM first_delivery),
      gaps AS (SELECT *, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS gap FROM clicks),
      grouped AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap > INTERVAL 720 MINUTE THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts) AS n FROM gaps)
      SELECT user_id, count(*) AS events, {_ts('min(ts)', 'first_ts')}, {_ts('max(ts)', 'last_ts')} FROM grouped GROUP BY user_id, n"""
    once = DELIVERIES + """,
clean AS (SELECT * FROM first_delivery WHERE event_type <> 'signup')""" + "," + _numbered("clean", 720)
    sql["medallion_refresh"] = f"WITH {once}, {FUNNEL} {FUNNEL_OUT}"
    sold_once = once + "," + PURCHASES + "," + _order_steps("purchases")
    sql["refresh_twice"] = f"WITH {sold_once}, {_sales('purchases')} {SALES_OUT}"
    refreshed = {
        "events": "silver", "dim_users_scd2": "users", "dim_products_scd2": "products", "fact_orders": "orders_f", "fact_daily_sales": "sales",
        "fact_funnel": "funnel", "fact_abandoned_carts": "abandoned", "dim_user_360": "(SELECT DISTINCT user_id FROM users)"}
    sql["refreshed_tables"] = f"WITH {sold_once}, {USER_DIM}, {PRODUCT_DIM}, {CARTS}, {FUNNEL}, {_sales('purchases')} " + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {source}" for name, source in refreshed.items())
    sql["bronze_rules_stream"] = f"""WITH {DELIVERIES} SELECT * FROM (
      SELECT 'event_id_present' AS expectation, count(*) AS total, count(*) FILTER (event_id IS NULL) AS failing,
        count(event_id) / count(*) AS pass_rate FROM first_delivery
      UNION ALL SELECT 'event_ts_present', count(*), count(*) FILTER (event_ts IS NULL), count(event_ts) / count(*) FROM first_delivery)"""
    sql["stream_additive_schema"] = f"""WITH {DELIVERIES} SELECT event_id, event_type,
      CASE WHEN CAST(substr(event_id, 3) AS BIGINT) % 2 = 1 THEN 'c_' || event_type END AS campaign, CAST(NULL AS VARCHAR) AS _rescued_data
      FROM first_delivery"""
    sql["quarantine_stream"] = sql["late_split"]
    sql["knn_topk_bounded"] = sql["knn_topk"]
    sql["rolling_signals"] = sql["product_signals"]
    sql["scd2_users_by_deliveries"] = sql["scd2_users"]

    # reports
    sql["drift_report"] = f"""WITH {DRIFT} SELECT batch_id AS _source_file,
      CASE WHEN NOT malformed THEN strftime(event_ts, '%Y-%m-%d') END AS _ingest_date, count(*) AS rescued_rows
      FROM sent WHERE malformed OR text_price OR extra GROUP BY 1, 2"""
    sql["producer_split"] = f"WITH {silver} SELECT source AS producer, event_type, count(*) AS rows FROM silver GROUP BY 1, 2"
    sql["event_type_counts"] = f"""WITH {DELIVERIES} SELECT event_type, count(*) AS rows FROM bronze
      WHERE CAST(_ingest_ts AS DATE) = DATE '2024-01-15' GROUP BY 1"""
    sql["gmv_by_category"] = f"""WITH {sold}, {_sales('purchases')} SELECT category,
      CAST(CAST(sum(CAST(gmv AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DOUBLE) AS gmv_30d
      FROM sales WHERE sale_date >= DATE '2024-01-01' GROUP BY 1"""
    sql["winback_top"] = f"""WITH {_user_360('2024-07-15')} SELECT user_id, ltv, {_ts('last_order_ts')} FROM user_360
      WHERE segment = 'lapsing' AND ltv > 1000 ORDER BY ltv DESC, user_id LIMIT 500"""
    sql["sales_preview"] = f"""WITH {sold}, {_sales('purchases')},
      top AS (SELECT * FROM sales ORDER BY sale_date DESC, gmv DESC, category, country LIMIT 50) {SALES_OUT.replace('FROM sales', 'FROM top')}"""
    sql["funnel_trend"] = f"WITH {silver}, {FUNNEL} SELECT {_day('event_date')}, purchase_rate FROM funnel WHERE event_date >= DATE '2023-11-02'"
    names = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
    sql["table_counts"] = " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows FROM {n}" for n in names)
    sql["conversation_tail"] = """SELECT conv_id, turn, role, text FROM (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations) WHERE back <= 4"""
    return sql

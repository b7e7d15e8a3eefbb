from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemart.operators import events as ev
from tidemart.operators import marts
from tidemart.operators.sessions import backfill, renumbered, sessionize, silver_events
from tidemart.sources import shop

T0 = datetime(2024, 1, 1, 12)
COLUMNS = "event_id string, user_id string, session_id string, event_ts timestamp, event_type string"


def make(spark, rows):
    """rows: (id, user, session, seconds after T0[, type])."""
    full = [(i, u, s, T0 + timedelta(seconds=sec), *(rest or ["page_view"])) for i, u, s, sec, *rest in rows]
    return spark.createDataFrame(full, COLUMNS)


def ids(df):
    return {r.event_id: r.session_id_silver for r in df.collect()}


def test_gap_is_whole_seconds_and_strict(spark):
    gaps = [0, 1799, 3599, 5399.9, 7200.9]
    rows = [(f"e{i}", "u", "s", s) for i, s in enumerate(gaps)]
    for method in ("slots", "window"):
        got = ids(sessionize(make(spark, rows), 30, method=method))
        # 29:59, 30:00 and 30:00.9 continue; 7200.9 - 5399.9 is 1801 whole seconds.
        assert [got[f"e{i}"] for i in range(5)] == ["u_1", "u_1", "u_1", "u_1", "u_2"]


def test_equal_times_share_the_new_session(spark):
    rows = [("a", "u", "s", 0), ("b", "u", "s", 2400), ("c", "u", "s", 2400)]
    for method in ("slots", "window"):
        got = ids(sessionize(make(spark, rows), 30, method=method))
        assert got == {"a": "u_1", "b": "u_2", "c": "u_2"}


def test_slots_equal_window_on_the_test_events(spark, sf_dir):
    clean = ev.clean_events(shop.bronze_events(spark, sf_dir)).drop("properties")
    for minutes in (0, 0.5, 30, 720):
        a, b = sessionize(clean, minutes), sessionize(clean, minutes, method="window")
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_a_hot_visitor_gets_the_same_ids(spark):
    """One anonymous visitor with a third of all rows, many at the same second."""
    n = spark.range(30_000).select(
        F.concat(F.lit("e"), "id").alias("event_id"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("u"), (F.col("id") % 500).cast("string"))).alias("user_id"),
        F.lit("s").alias("session_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.xxhash64("id"), F.lit(400_000))).alias("event_ts"),
    )
    a, b = sessionize(n, 1), sessionize(n, 1, method="window")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_anonymous_visitors_share_sessions_unless_told_apart(spark):
    rows = [("a", None, "s1", 0, "add_to_cart"), ("b", None, "s2", 60, "add_to_cart"), ("c", None, "s2", 90, "purchase")]
    events = make(spark, rows).withColumns({
        "price": F.lit(1.0), "quantity": F.lit(1), "cart_id": F.col("session_id"), "country": F.lit("BR"), "category": F.lit("x"),
    })
    assert marts.abandoned_carts(sessionize(events)).count() == 0
    apart = marts.abandoned_carts(sessionize(events, anonymous_key="session_id"))
    assert [r.cart_id for r in apart.collect()] == ["s1"]


def test_domain_filter_and_latest_copy(spark):
    rows = [("a", "2024-01-01", "page_view", 1.0), ("a", "2024-01-02", "page_view", 2.0), ("b", "2024-01-01", "signup", 3.0),
            (None, "2024-01-01", "page_view", 4.0)]
    df = spark.createDataFrame(rows, "event_id string, _ingest_ts string, event_type string, price double").withColumns({
        "_ingest_ts": F.to_timestamp("_ingest_ts"), "event_ts": F.to_timestamp(F.lit("2024-01-01")),
    })
    assert [(r.event_id, r.price) for r in ev.clean_events(df).collect()] == [("a", 2.0)]


def test_dedup_sends_one_row_per_key_and_task(spark, sf_dir):
    plan = ev.clean_events(shop.bronze_events(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the shuffle


def test_renumbering_after_late_arrivals_equals_a_full_build(spark, sf_dir):
    bronze = shop.bronze_events(spark, sf_dir).drop("properties")
    early = bronze.where("_ingest_ts < TIMESTAMP '2024-01-15'")
    late = bronze.where("_ingest_ts >= TIMESTAMP '2024-01-15'")
    silver = silver_events(early, 720)
    change = renumbered(silver, late, 720)
    after = silver.join(change.select("event_id"), "event_id", "left_anti").unionByName(change)
    full = silver_events(bronze, 720).select(*after.columns)
    assert after.exceptAll(full).isEmpty() and full.exceptAll(after).isEmpty()


def test_backfill_keeps_numbers_of_earlier_sessions(spark):
    rows = [("a", "u", "s", 0), ("b", "u", "s", 4000), ("c", "u", "s", 8000)]
    bronze = make(spark, rows).withColumns({
        "_ingest_ts": F.col("event_ts"),
        "_ingest_date": F.when(F.col("event_id") == "a", F.to_date(F.lit("2024-01-01"))).otherwise(F.to_date(F.lit("2024-01-02"))),
    })
    change = backfill(silver_events(bronze), bronze, "2024-01-02", "2024-01-02")
    assert ids(change) == {"b": "u_2", "c": "u_3"}


def test_midnight_session_counts_on_both_days(spark):
    rows = [("a", "u", "s", 42_600), ("b", "u", "s", 43_800, "add_to_cart")]  # 23:50 and 00:10
    got = {str(r.event_date): (r.sessions_viewed, r.sessions_carted, r.cart_rate) for r in marts.funnel(sessionize(make(spark, rows))).collect()}
    assert got == {"2024-01-01": (1, 0, 0.0), "2024-01-02": (0, 1, None)}


def test_product_fill_and_rejects(spark):
    events = spark.createDataFrame(
        [("e1", "p1", None, None, {"source": "web", "x": "1"}), ("e2", "p9", None, None, None)],
        "event_id string, product_id string, category string, price double, properties map<string,string>",
    )
    products = spark.createDataFrame([("p1", "Desk", "furniture", 5.0)], "product_id string, name string, category string, price double")
    filled, unknown = ev.fill_from_product(events, products, "web_chat")
    row = filled.first()
    assert (row.category, row.price, row.properties) == ("furniture", 5.0, {"source": "web_chat", "name": "Desk", "x": "1"})
    assert [r.event_id for r in unknown.collect()] == ["e2"]


def test_transport_fields_are_only_filled(spark):
    events = spark.createDataFrame([("a", "b1", "1.1.1.1", None), ("b", "b1", None, None)], "event_id string, batch_id string, ip string, user_agent string")
    batches = spark.createDataFrame([("b1", "2.2.2.2", "ua")], "batch_id string, ip string, user_agent string")
    got = {r.event_id: (r.ip, r.user_agent) for r in ev.fill_transport(events, batches).collect()}
    assert got == {"a": ("1.1.1.1", "ua"), "b": ("2.2.2.2", "ua")}


def test_renumbering_keeps_anonymous_visitors_apart(spark, sf_dir):
    bronze = shop.bronze_events(spark, sf_dir).drop("properties").withColumn(
        "user_id", F.when(F.hash("session_id") % 3 != 0, F.col("user_id")))
    early = bronze.where("_ingest_ts < TIMESTAMP '2024-01-15'")
    late = bronze.where("_ingest_ts >= TIMESTAMP '2024-01-15'")
    silver = silver_events(early, 720, anonymous_key="session_id")
    change = renumbered(silver, late, 720, "session_id")
    after = silver.join(change.select("event_id"), "event_id", "left_anti").unionByName(change)
    full = silver_events(bronze, 720, anonymous_key="session_id").select(*after.columns)
    assert after.exceptAll(full).isEmpty() and full.exceptAll(after).isEmpty()


def test_endless_prices_have_no_amount(spark):
    from tidemart.functions.columns import money_units

    rows = [(float("inf"),), (float("-inf"),), (float("nan"),), (None,), (1.25,)]
    assert [r[0] for r in spark.createDataFrame(rows, "p double").select(money_units(F.col("p"))).collect()] == [None] * 4 + [12500]

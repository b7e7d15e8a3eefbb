from datetime import datetime, timedelta

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tidemart.operators import history, marts, orders
from tidemart.schemas import PRODUCT_TRACKED, USER_TRACKED
from tidemart.sources import shop

D = datetime(2024, 1, 1)


def snaps(spark, rows):
    return spark.createDataFrame([(k, D + timedelta(days=d), *v) for k, d, *v in rows], "k string, updated_ts timestamp, a string, b string, c string")


def test_versions_open_on_change_only(spark):
    df = snaps(spark, [("x", 0, "1", "1", "1"), ("x", 1, "1", "1", "1"), ("x", 2, "2", "1", "1"), ("x", 3, "1", "1", "1"), (None, 0, "1", "1", "1")])
    got = [(r.version, r.valid_from.day, r.valid_to and r.valid_to.day, r.is_current) for r in history.versions(df, "k", ["a", "b", "c"]).orderBy("version").collect()]
    assert got == [(1, 1, 3, False), (2, 3, 4, False), (3, 4, None, True)]


def test_moved_null_is_a_change_except_for_the_old_hash(spark):
    df = snaps(spark, [("x", 0, "a", None, "b"), ("x", 1, "a", "b", None)])
    assert history.versions(df, "k", ["a", "b", "c"]).count() == 2
    assert history.versions(df, "k", ["a", "b", "c"], compat_hash=True).count() == 1


def test_sliced_keys_get_the_same_versions(spark, sf_dir):
    for frame, key, tracked in ((shop.user_snapshots(spark, sf_dir), "user_id", USER_TRACKED), (shop.product_snapshots(spark, sf_dir), "product_id", PRODUCT_TRACKED)):
        plain = history.versions(frame, key, tracked)
        sliced = history.versions(frame, key, tracked, rows_per_task=2)
        assert plain.exceptAll(sliced).isEmpty() and sliced.exceptAll(plain).isEmpty()


def test_sliced_keys_keep_versions_without_a_time(spark):
    start = datetime(2024, 1, 1)
    rows = [("k", f"s{i}", None) for i in range(3)] + [("k", f"t{i}", start + timedelta(hours=i)) for i in range(4)]
    frame = spark.createDataFrame([*rows, ("n", "x", None), ("n", "y", None)], "key string, state string, at timestamp")
    want = history.versions(frame, "key", ["state"], "at").collect()
    for rows_per_task in (1, 2, 5):
        got = history.versions(frame, "key", ["state"], "at", rows_per_task=rows_per_task).collect()
        assert sorted(map(str, got)) == sorted(map(str, want))
    assert sorted(r.version for r in want if r.key == "k") == list(range(1, 8))


def test_a_boundary_fact_meets_one_version(spark):
    dim = history.versions(snaps(spark, [("x", 0, "1", "", ""), ("x", 5, "2", "", "")]), "k", ["a"])
    facts = spark.createDataFrame([("f0", "x", D - timedelta(days=1)), ("f1", "x", D), ("f2", "x", D + timedelta(days=5)), ("f3", "y", D)], "id string, k string, ts timestamp")
    for options in ({}, {"rows_per_task": 1}):
        inner = history.as_of_versions(facts, dim, "k", "ts", ["version"], **options)
        assert {r.id: r.version for r in inner.collect()} == {"f1": 1, "f2": 2}
        left = history.as_of_versions(facts, dim, "k", "ts", ["version"], how="left", **options)
        assert {r.id: r.version for r in left.collect()} == {"f0": None, "f1": 1, "f2": 2, "f3": None}


def test_as_of_equals_a_range_join(spark, sf_dir):
    dim = history.versions(shop.product_snapshots(spark, sf_dir), "product_id", PRODUCT_TRACKED)
    facts = shop.line_events(spark, sf_dir).select("event_id", "product_id", "event_ts")
    d = dim.select(F.col("product_id").alias("pid"), "valid_from", "valid_to", "version", "price")
    joined = facts.join(d, (F.col("product_id") == F.col("pid")) & (F.col("event_ts") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("event_ts") < F.col("valid_to"))))
    want = joined.select("event_id", "product_id", "event_ts", "version", "price")
    for options in ({}, {"rows_per_task": 3}):
        got = history.as_of_versions(facts, dim, "product_id", "event_ts", ["version", "price"], **options)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def purchases(spark, rows):
    """rows: (event, order, product, category, price, quantity, country)."""
    return spark.createDataFrame(
        [(e, "purchase", o, "u", "u_1", c, "card", D + timedelta(minutes=i), p, cat, price, q) for i, (e, o, p, cat, price, q, c) in enumerate(rows)],
        "event_id string, event_type string, order_id string, user_id string, session_id_silver string, country string, payment_method string,"
        " event_ts timestamp, product_id string, category string, price double, quantity int",
    )


def test_golden_order(spark):
    row = orders.fact_orders(purchases(spark, [("e1", "o", "p1", "x", 199.0, 1, "BR"), ("e2", "o", "p2", "x", 79.0, 2, "BR")])).first()
    assert (row.subtotal, row.tax, row.shipping, row.total, row.total_units) == (357.0, 28.56, 0.0, 385.56, 3)
    assert [i.line_total for i in row["items"]] == [199.0, 158.0]


def test_null_price_order_pays_shipping(spark):
    row = orders.fact_orders(purchases(spark, [("e1", "o", "p1", "x", None, 1, "BR")])).first()
    assert (row.subtotal, row.tax, row.total, row.shipping) == (None, None, None, 9.99)


def test_order_over_two_countries_is_reported(spark):
    sold = orders.fact_orders(purchases(spark, [("e1", "o", "p1", "x", 1.0, 1, "BR"), ("e2", "o", "p2", "x", 1.0, 1, "US")]))
    assert sold.count() == 2
    assert [r.order_id for r in orders.repeated_order_ids(sold).collect()] == ["o"]


def test_a_long_order_is_one_row_and_both_line_sources_agree(spark):
    """One order with a third of all lines."""
    rows = [(f"e{i}", "big" if i % 3 == 0 else f"o{i}", f"p{i}", "x", 1.5, 2, "BR") for i in range(300)]
    events = purchases(spark, rows)
    nested, lines = orders.fact_orders(events), orders.order_lines(events)
    totals = orders.totals_of(lines)
    assert nested.count() == totals.count() == 201
    same = totals.columns
    assert nested.select(same).exceptAll(totals).isEmpty() and totals.exceptAll(nested.select(same)).isEmpty()
    for aov in ("line", "order"):
        a, b = marts.daily_sales(nested, aov), marts.daily_sales(totals, aov, lines)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    a, b = orders.priced_lines(lines, totals), nested.select("order_id", "order_ts", "total", F.inline("items"))
    assert a.select(b.columns).exceptAll(b).isEmpty() and a.count() == 300


def test_orders_with_null_keys_keep_their_lines(spark):
    events = purchases(spark, [("e1", "o", "p1", "x", 2.0, 1, None), ("e2", "o", "p2", "x", 3.0, 1, None)])
    lines = orders.order_lines(events)
    assert [r.total for r in orders.priced_lines(lines, orders.totals_of(lines)).collect()] == [15.39, 15.39]


def test_two_ways_to_average_orders(spark):
    x = [(f"x{i}", "X", f"p{i}", "c", 27.53, 1, "BR") for i in range(3)]
    sold = orders.fact_orders(purchases(spark, [*x, ("y", "Y", "p", "c", 9.27, 1, "BR")]))
    totals = {r.order_id: r.total for r in sold.collect()}
    line, order = marts.daily_sales(sold).first(), marts.daily_sales(sold, "order").first()
    assert line.avg_order_value == round((3 * totals["X"] + totals["Y"]) / 4, 2)
    assert order.avg_order_value == round((totals["X"] + totals["Y"]) / 2, 2)
    assert (line.orders, line.units) == (order.orders, order.units) == (2, 4)


def test_segments(spark):
    users = spark.createDataFrame([(u, True) for u in ("a", "l", "c", "p")], "user_id string, is_current boolean")
    sold = spark.createDataFrame(
        [("o1", "a", 1.0, datetime(2024, 1, 1)), ("o2", "l", 1.0, datetime(2023, 12, 31)), ("o3", "c", 1.0, datetime(2023, 8, 3))],
        "order_id string, user_id string, total double, order_ts timestamp",
    )
    seen = spark.createDataFrame([], "user_id string, session_id_silver string, event_ts timestamp")
    got = {r.user_id: (r.segment, r.recency_days) for r in marts.user_360(users, sold, seen, "2024-01-31").collect()}
    assert got == {"a": ("active", 30), "l": ("lapsing", 31), "c": ("churned", 181), "p": ("prospect", None)}


def test_versions_shuffle_each_tracked_column_once(spark):
    """No second copy of the tracked columns travels; nulls, NaN and a change that only moves a value still count."""
    nan = float("nan")
    rows = [("p", "2024-01-01", "x", None, nan), ("p", "2024-01-02", "x", None, nan), ("p", "2024-01-03", None, "x", nan),
            ("p", "2024-01-04", None, "x", None), ("p", "2024-01-05", None, "x", -0.0), ("p", "2024-01-06", None, "x", 0.0)]
    frame = spark.createDataFrame(rows, "k string, t string, a string, b string, c double").withColumn("updated_ts", F.col("t").cast("timestamp"))
    made = history.versions(frame, "k", ["a", "b", "c"])
    assert [r.t[-2:] for r in made.orderBy("version").collect()] == ["01", "03", "04", "05"]
    sliced = history.versions(frame, "k", ["a", "b", "c"], rows_per_task=2)
    assert [r.t[-2:] for r in sliced.orderBy("version").collect()] == ["01", "03", "04", "05"]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "struct(" not in plan


def test_a_delivery_of_snapshots_is_written_once(spark, monkeypatch):
    from tidemart.session import scratch_path
    from tidemart.sources.tables import VersionedTable
    from tidemart.streaming.dimensions import Dimension

    rows = [(k, f"2024-01-0{d}", c) for k in "ab" for d, c in ((1, "x"), (2, "x"), (3, "y"), (4, "y"), (5, "x"))]
    frame = lambda some: spark.createDataFrame(some, "k string, t string, color string").select("k", F.col("t").cast("timestamp").alias("updated_ts"), "color")
    table = VersionedTable(spark, scratch_path(spark, "dim"))
    dim = Dimension(spark, table, "k", ["color"])
    dim.merge(frame(rows[2::3]), 0)
    read = []
    monkeypatch.setattr("pyspark.sql.DataFrameWriter.parquet", lambda w, path, *a, _own=DataFrameWriter.parquet: read.append(path) or _own(w, path, *a))
    dim.merge(frame(rows[::3]), 1)
    monkeypatch.undo()
    assert sum(p.startswith(f"{table.path}_snapshots/v=") for p in read) == 1
    assert not [p for p in read if p.startswith((f"{table.path}_work/", f"{table.path}/_staging/"))]  # no more are the versions
    dim.merge(frame(rows[1::3]), 2)
    dim.merge(frame(rows[1::3]), 2)  # repeated
    dim.merge(frame([]), 3)
    assert dim.snapshots.read().count() == 10
    want = history.versions(frame(rows), "k", ["color"])
    assert sorted(map(str, table.read().select(*want.columns).collect())) == sorted(map(str, want.collect()))

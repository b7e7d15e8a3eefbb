"""Change propagation: a refresh after new landing files equals a full one and writes only what changed."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemart.operators import quality as q
from tidemart.plans.refresh import Refresh
from tidemart.schemas import EVENT
from tidemart.session import scratch_path
from tidemart.sources import landing, shop

FACTS = ("fact_orders", "fact_daily_sales", "fact_funnel", "fact_abandoned_carts")


def shown(table):
    df = table.read()
    drop = [c for c in df.columns if c.startswith("_")]
    df = df.drop(*drop)
    return sorted(str(tuple(r[c] for c in sorted(df.columns))) for r in df.collect())


def test_second_refresh_equals_a_full_one_and_writes_few_days(spark, sf_dir):
    src, more = scratch_path(spark, "landing"), scratch_path(spark, "landing")
    every = shop.first_delivery(spark, sf_dir).select(*EVENT.names)
    last = every.agg(F.to_date(F.max("event_ts"))).first()[0]
    every = every.where(F.to_date("event_ts") > F.lit(last - timedelta(days=5)))
    part = F.to_date("event_ts") == F.lit(last)  # earlier rows would renumber the sessions of all days behind them
    for path in (src, more):
        landing.write_landing(every.where(~part | (F.crc32("event_id") % 3 > 0)), f"{path}/events")
        landing.write_snapshot(shop.user_snapshots(spark, sf_dir), f"{path}/users")
        landing.write_snapshot(shop.product_snapshots(spark, sf_dir), f"{path}/products")
    first = Refresh(spark, src, scratch_path(spark, "warehouse"), 720)
    first.run("2024-01-31")
    assert first.bronze_counts["events"][0]["total"] > 0 and first.bronze_counts["users"][0]["pass_rate"] == 1.0
    late = every.where(part & (F.crc32("event_id") % 3 == 0))
    for path in (src, more):
        landing.write_landing(late, f"{path}/events")
    made = first.run("2024-01-31")
    full = Refresh(spark, more, scratch_path(spark, "warehouse"), 720).run("2024-01-31")
    for name, table in made.items():
        assert shown(table) == shown(full[name]), name
    for name in FACTS:
        days = first.written[name]
        assert (days or name == "fact_abandoned_carts") and all((last - d).days <= 1 for d in days), (name, days)
    again = {name: t.version() for name, t in made.items()}
    first.run("2024-01-31")
    assert all(t.version() == again[name] for name, t in made.items() if name in (*FACTS, "events"))


def lines(spark, rows):
    kinds = "event_id string, event_type string, event_ts timestamp, session_id string, schema_version string"
    return spark.createDataFrame([(e, "page_view", at, "s", "1.0.0") for e, at in rows], kinds)


def test_quarantine_holds_each_row_once_after_a_failure(spark, monkeypatch):
    from tidemart.streaming import ingest
    from tidemart.streaming.stateful import split_late

    src, out = scratch_path(spark, "landing"), scratch_path(spark, "out")
    now = datetime.now()
    landing.write_landing(lines(spark, [("new", now), ("old", now - timedelta(days=9))]), src)

    def start():
        return ingest.stream_events(
            spark, src, f"{out}/c", f"{out}/good", EVENT, rules=q.BRONZE_EVENTS, split=split_late, quarantine=f"{out}/held")

    write = ingest._write_once
    monkeypatch.setattr(ingest, "_write_once", lambda rows, target, *a: (_ for _ in ()).throw(OSError("lost")) if target.endswith("held") else write(rows, target, *a))
    with pytest.raises(Exception, match="lost"):
        start()
    monkeypatch.undo()
    start()
    landing.write_landing(lines(spark, [("newer", now), ("older", now - timedelta(days=3))]), src)
    query = start()
    start()
    assert sorted(r.event_id for r in spark.read.parquet(f"{out}/good").collect()) == ["new", "newer"]
    assert sorted((r.event_id, r.quarantine_reason) for r in spark.read.parquet(f"{out}/held").collect()) == [("old", "late"), ("older", "late")]
    assert ingest.counted(query, q.BRONZE_EVENTS)[0]["total"] == 2


def test_fail_rules_stop_a_stream_before_its_batch_is_seen(spark):
    from tidemart.streaming import ingest

    src, out = scratch_path(spark, "landing"), scratch_path(spark, "out")
    rules = [q.Rule("has_user", "user_id IS NOT NULL"), q.Rule("recent", "event_ts >= TIMESTAMP '2024-01-01'", "fail")]
    landing.write_landing(lines(spark, [("a", datetime(2024, 1, 2)), ("b", datetime(2024, 1, 3))]), src)
    query = ingest.stream_events(spark, src, f"{out}/c", f"{out}/t", EVENT, rules=rules)
    assert [(r["expectation"], r["total"], r["failing"]) for r in ingest.counted(query, rules)] == [("has_user", 2, 2), ("recent", 2, 0)]
    landing.write_landing(lines(spark, [("c", datetime(2023, 1, 2)), ("d", datetime(2024, 1, 3))]), src)
    with pytest.raises(Exception, match="recent"):
        ingest.stream_events(spark, src, f"{out}/c", f"{out}/t", EVENT, rules=rules)
    assert sorted(r.event_id for r in spark.read.parquet(f"{out}/t").collect()) == ["a", "b"]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_snapshots_gives_the_same_versions(spark, seed):
    import random

    from tidemart.operators.history import versions
    from tidemart.sources.tables import VersionedTable
    from tidemart.streaming.dimensions import Dimension

    rng = random.Random(seed)
    rows = [(rng.choice("abc"), rng.choice("xy"), rng.choice([None, "m", "n"]), datetime(2024, 1, 1) + timedelta(hours=rng.randrange(40)), i) for i in range(40)]
    schema = "k string, color string, size string, updated_ts timestamp, row int"
    table = VersionedTable(spark, scratch_path(spark, "dim"))
    dim = Dimension(spark, table, "k", ["color", "size"])
    given = rng.sample(rows, len(rows))
    for b, at in enumerate(range(0, 40, 10)):
        batch = spark.createDataFrame(given[at:at + 10], schema)
        dim.merge(batch, b)
        if b == 2:
            dim.merge(batch, b)  # repeated after a failure
    assert dim.snapshots.read().count() == 40
    want = versions(spark.createDataFrame(rows, schema), "k", ["color", "size"])
    assert sorted(map(str, table.read().select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_moving_windows_equal_full_counts(spark):
    import random

    from tidemart.operators.ranking import product_signals
    from tidemart.sources.tables import VersionedTable
    from tidemart.streaming.popularity import RollingSignals

    rng = random.Random(7)
    home, start = scratch_path(spark, "rolling"), datetime(2024, 1, 1)
    events = VersionedTable(spark, f"{home}/events", ["event_date"])
    orders = VersionedTable(spark, f"{home}/orders", ["order_date"])
    rolling = RollingSignals(spark, VersionedTable(spark, f"{home}/days", ["day"]), events, orders)
    kinds = "product_id string, event_type string, event_ts timestamp"
    bought = "order_id string, order_ts timestamp, items array<struct<product_id string, quantity int>>"
    for lo, hi in ((0, 14), (10, 12), (13, 20)):
        at = lambda: start + timedelta(days=rng.randrange(lo, hi), seconds=rng.choice([0, rng.randrange(86_400)]))  # noqa: B023, E731
        seen = [(rng.choice(["p1", "p2", "p3", None]), rng.choice(["page_view", "add_to_cart", "purchase"]), at()) for _ in range(40)]
        sold = [(f"o{i}", at(), [(rng.choice(["p1", "p4", None]), rng.choice([1, 2, None]))]) for i in range(12)]
        events.append(spark.createDataFrame(seen, kinds).withColumn("event_date", F.to_date("event_ts")))
        orders.append(spark.createDataFrame(sold, bought).withColumn("order_date", F.to_date("order_ts")))
        counted = rolling.update()
        assert counted and all(lo <= (d - start.date()).days < hi for d in counted) and rolling.update() == []
    for as_of in ("2024-01-15 00:00:00", "2024-01-12 13:30:00", "2024-02-20 00:00:00"):
        want = product_signals(events.read(), orders.read(), as_of)
        assert sorted(rolling.signals(as_of).select(*want.columns).collect()) == sorted(want.collect()), as_of


def test_a_large_dimension_is_built_by_lots_of_keys(spark, monkeypatch):
    """Each lot shuffles its own rows; nothing is visible before the last one is written and all have passed their rules."""
    from tidemart.operators.history import versions
    from tidemart.operators.quality import QualityGateError, Rule
    from tidemart.sources import tables
    from tidemart.sources.tables import VersionedTable
    from tidemart.streaming import dimensions

    rows = [(k, color, datetime(2024, 1, 1) + timedelta(hours=h)) for h in range(4) for k, color in (*zip("abcdefgh", "xxyyxyxy"), ("i", None), (None, "x"))]
    rows += [("a", "z", datetime(2024, 1, 2)), ("a", "z", datetime(2024, 1, 2))]
    given = spark.createDataFrame(rows, "k string, color string, updated_ts timestamp")
    written, write = [], tables.checked_write
    monkeypatch.setattr(tables, "checked_write", lambda df, *a, **o: written.append(write(df, *a, **o)) or written[-1])
    monkeypatch.setattr(dimensions, "LOT_ROWS", 10, raising=False)
    table = VersionedTable(spark, scratch_path(spark, "dim"))
    dimensions.Dimension(spark, table, "k", ["color"]).merge(given)
    want = versions(given, "k", ["color"])
    assert len(written) == 1 + 4 and table.pointer()["rows"] == want.count() == sum(w[-1]["total"] for w in written[1:])  # 38 snapshots with a key
    assert sorted(map(str, table.read().select(*want.columns).collect())) == sorted(map(str, want.collect()))
    refused = VersionedTable(spark, scratch_path(spark, "dim"))
    with pytest.raises(QualityGateError):
        dimensions.Dimension(spark, refused, "k", ["color"], [Rule("known", "k <> 'a'", "fail")]).merge(given)
    assert not refused.exists()


def test_tables_are_written_packed(spark):
    import glob

    import pyarrow.parquet as pq

    from tidemart.sources import tables
    from tidemart.streaming import ingest

    home = scratch_path(spark, "packed")
    frame = spark.createDataFrame([(i, i % 2) for i in range(100)], "id int, day int")
    table = tables.VersionedTable(spark, f"{home}/t", ["day"])
    table.publish(frame)
    table.optimize(["id"], 2)
    tables.append(frame, f"{home}/plain")
    ingest.append_stream(spark.readStream.schema(frame.schema).parquet(f"{home}/plain"), f"{home}/bronze", f"{home}/c").awaitTermination()
    for part in ("t/v=1/*", "t/v=2/*", "plain", "bronze"):
        files = glob.glob(f"{home}/{part}/*.parquet")
        held = [pq.ParquetFile(f).metadata for f in files]
        assert files and all(m.row_group(0).column(0).compression == "ZSTD" for m in held if m.num_row_groups), part

"""Incremental Silver against full builds, and what it opens."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemart.operators.sessions import silver_events
from tidemart.session import scratch_path
from tidemart.sources.tables import VersionedTable
from tidemart.streaming.incremental import SilverEvents

SCHEMA = "event_id string, event_type string, event_ts timestamp, user_id string, session_id string, price double, _ingest_ts timestamp, _source_file string"
START = datetime(2024, 1, 1, 20)


def deliveries(rng, n, events=70, days=6):
    """Rows in ingest order, in ``n`` batches: late ones, repeated ids whose visitor or time changes, unknown types."""
    out = []
    for b in range(n):
        for _ in range(events // n):
            e = rng.randrange(events)
            late = rng.random() < 0.4
            at = START + timedelta(minutes=rng.randrange(0, days * 1440) if late else (b * days * 1440) // n + rng.randrange(0, days * 1440 // n))
            out.append((b, (f"e{e}", rng.choice(["page_view", "purchase", "signup", "page_view"]), at, rng.choice(["u1", "u2", "u3_x", None]),
                            rng.choice("st"), float(rng.randrange(3)), START + timedelta(hours=b, minutes=rng.randrange(3)), rng.choice("fg"))))
    return out


@pytest.mark.parametrize("seed,key", [(1, None), (2, "session_id")])
def test_any_order_of_batches_equals_a_full_build(spark, seed, key):
    rng = random.Random(seed)
    given = deliveries(rng, 4)
    table = VersionedTable(spark, scratch_path(spark, "silver"), ["event_date"])
    silver = SilverEvents(spark, table, 600, key)
    for b in rng.sample(range(4), 4):
        batch = spark.createDataFrame([r for i, r in given if i == b], SCHEMA)
        silver.merge(batch, keep=3)
    full = silver_events(spark.createDataFrame([r for _, r in given], SCHEMA), 600, anonymous_key=key)
    got = table.read().select(*full.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, full.collect())) and silver.state_is_current()
    version = table.version()
    again = silver.merge(batch)  # repeated after a failure: the same rows
    assert sorted(map(str, table.read().select(*full.columns).collect())) == sorted(map(str, full.collect())) and again >= version


def test_rows_in_order_open_their_own_days_only(spark, monkeypatch):
    rows = [(f"e{i}", "page_view", START + timedelta(hours=6 * i), f"u{i % 2}", "s", 1.0, START + timedelta(hours=6 * i), "f") for i in range(40)]
    table = VersionedTable(spark, scratch_path(spark, "silver"), ["event_date"])
    silver = SilverEvents(spark, table, 600)
    silver.merge(spark.createDataFrame(rows[:36], SCHEMA))
    opened = []
    read = table._read_files
    monkeypatch.setattr(table, "_read_files", lambda pointer, files: opened.extend(files) or read(pointer, files))
    monkeypatch.setattr(table, "read", None)  # never the whole table
    silver.merge(spark.createDataFrame(rows[36:], SCHEMA))
    last = {str(r[2].date()) for r in rows[34:]}
    assert all(any(f"event_date={d}/" in f for d in last) for f in opened)
    monkeypatch.undo()
    assert table.read().count() == 40


def test_state_is_made_anew_when_silver_moved_on(spark):
    rows = [(f"e{i}", "page_view", START + timedelta(hours=2 * i), "u", "s", 1.0, START, "f") for i in range(12)]
    table = VersionedTable(spark, scratch_path(spark, "silver"), ["event_date"])
    silver = SilverEvents(spark, table, 60)
    silver.merge(spark.createDataFrame(rows[:6], SCHEMA))
    table.publish(silver_events(spark.createDataFrame(rows[:9], SCHEMA), 60), anonymous_key=None)  # by another job
    assert not silver.state_is_current()
    silver.merge(spark.createDataFrame(rows[9:], SCHEMA))
    assert {r.session_id_silver for r in table.read().collect()} == {f"u_{i}" for i in range(1, 13)}
    with pytest.raises(ValueError, match="differs"):
        SilverEvents(spark, table, 60, "session_id").merge(spark.createDataFrame(rows, SCHEMA))
    assert silver.merge(spark.createDataFrame([], SCHEMA)) >= 1 and table.read().count() == 12


def test_whole_rows_are_written_once_per_merge(spark, monkeypatch):
    """Beside the arrived rows themselves, only keys, ranks and numbers are written down between the steps."""
    rows = [(f"e{i}", "page_view", START + timedelta(hours=3 * i), f"u{i % 3}", "s", 1.0, START, "f") for i in range(24)]
    late = [("n", "page_view", START + timedelta(hours=4), "u0", "s", 2.0, START, "f"), (*rows[5][:5], 9.0, START, "g"), (*rows[7][:5], 9.0, START, "a")]
    table = VersionedTable(spark, scratch_path(spark, "silver"), ["event_date"])
    silver = SilverEvents(spark, table, 600)
    silver.merge(spark.createDataFrame(rows, SCHEMA))
    staged, stage = [], silver._stage
    monkeypatch.setattr(silver, "_stage", lambda df: staged.append(df.columns) or stage(df))
    silver.merge(spark.createDataFrame(late[:2], SCHEMA))
    assert sum("price" in c for c in staged) == 1
    silver.merge(spark.createDataFrame(late, SCHEMA))  # two equal copies and an older one
    full = silver_events(spark.createDataFrame(rows + late, SCHEMA), 600)
    assert sorted(map(str, table.read().select(*full.columns).collect())) == sorted(map(str, full.collect()))


def test_rows_are_hashed_for_ties_alone(spark, monkeypatch):
    from tidemart.streaming import incremental

    rows = [(f"e{i}", "page_view", START, "u", "s", float(i), START, "f") for i in range(9)]
    silver = SilverEvents(spark, VersionedTable(spark, scratch_path(spark, "silver"), ["event_date"]), 600)
    hashed, own = [], incremental.fingerprint
    monkeypatch.setattr(incremental, "fingerprint", lambda df: hashed.append(df) or own(df))
    frame = lambda *some: spark.createDataFrame(some, SCHEMA).withColumn("_visitor", F.lit("u")).withColumn("_day", F.to_date("event_ts"))
    stored, fresh = frame(*rows), lambda *some: spark.createDataFrame(some, SCHEMA)
    met = silver._met(fresh(*((*r[:7], "g") for r in rows[:4]), *((*r[:7], "a") for r in rows[4:]), ("n", *rows[0][1:])), stored)
    assert {r.event_id: r._newer for r in met.collect()} == {f"e{i}": i < 4 for i in range(9)} and not hashed
    assert [r._newer for r in silver._met(fresh(rows[0]), stored).collect()] == [False] and len(hashed) == 2  # equal copies
    other = fresh((*rows[0][:5], 7.5, *rows[0][6:]))
    a, b = (df.select(own(df.select(*fresh(rows[0]).columns))).first()[0] for df in (other, stored.where("event_id = 'e0'")))
    assert [r._newer for r in silver._met(other, stored).collect()] == [a > b]

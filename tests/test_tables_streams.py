from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemart.operators import quality
from tidemart.plans.queries import QUERIES
from tidemart.schemas import EVENT, PRODUCT, with_ingest_columns
from tidemart.session import scratch_path
from tidemart.sources import landing, tables
from tidemart.streaming import ingest, stateful

RULES = [quality.Rule("id", "event_id IS NOT NULL", "fail"), quality.Rule("price", "price >= 0")]


def priced(spark, rows):
    return spark.createDataFrame(rows, "event_id string, price double")


def test_rules_in_one_pass(spark):
    df = priced(spark, [("a", 10.0), (None, 5.0), ("c", -1.0), ("d", None)])
    got = {r.expectation: (r.total, r.failing, r.pass_rate) for r in quality.measure(df, RULES).collect()}
    assert got == {"id": (4, 1, 0.75), "price": (4, 1, 0.75)}
    strict = {r.expectation: r.failing for r in quality.measure(df, RULES, null_fails=True).collect()}
    assert strict == {"id": 1, "price": 2}
    assert [r.pass_rate for r in quality.measure(df.limit(0), RULES).collect()] == [1.0, 1.0]


def test_enforce_raises_for_fail_only(spark):
    quality.enforce([{"severity": "warn", "failing": 5, "total": 9, "expectation": "w"}])
    with pytest.raises(quality.QualityGateError):
        quality.enforce(quality.measure(priced(spark, [(None, 1.0)]), RULES))


def test_broken_rule_leaves_the_old_version_visible(spark):
    table = tables.VersionedTable(spark, scratch_path(spark, "t"))
    table.publish(priced(spark, [("a", 1.0)]), RULES)
    with pytest.raises(quality.QualityGateError):
        table.publish(priced(spark, [(None, 1.0)]), RULES)
    with pytest.raises(ValueError):
        table.publish(priced(spark, []), allow_empty=False)
    assert table.read().collect() == priced(spark, [("a", 1.0)]).collect()
    table.publish(priced(spark, []))
    assert table.read().count() == 0


def test_versions_are_pruned_and_details_checked(spark):
    table = tables.VersionedTable(spark, scratch_path(spark, "t"))
    for i in range(4):
        table.publish(priced(spark, [("a", float(i))]), keep=2, dim=8)
    assert len(table._written()) == 2 and table.read(dim=8).first().price == 3.0
    with pytest.raises(ValueError):
        table.read(dim=9)


def test_upsert_rewrites_only_matched_folders(spark):
    table = tables.VersionedTable(spark, scratch_path(spark, "t"), ["day"])
    frame = lambda rows: spark.createDataFrame(rows, "id string, day string, x int, y int")
    table.upsert(frame([("a", "d1", 1, 1), ("b", "d2", 1, 1), ("c", "d3", 1, 1)]), ["id"])
    table.upsert(frame([("a", "d2", 2, 2), ("n", "d3", 2, 2)]), ["id"])  # a moves to another folder
    assert sorted(tuple(r) for r in table.read().select("id", "day", "x").collect()) == [("a", "d2", 2), ("b", "d2", 1), ("c", "d3", 1), ("n", "d3", 2)]
    assert table.folders() == {"day=d2": [1, 2], "day=d3": [1, 2]}
    table.upsert(frame([("b", "d2", 9, 9), ("z", "d4", 9, 9)]), ["id"], update_columns=["y"])
    assert {r.id: (r.x, r.y) for r in table.read().collect()} == {"a": (2, 2), "b": (1, 9), "c": (1, 1), "n": (2, 2), "z": (9, 9)}
    with pytest.raises(ValueError):
        table.upsert(frame([("b", "d2", 1, 1), ("b", "d2", 2, 2)]), ["id"])
    again = table.upsert(frame([("z", "d4", 9, 9)]), ["id"])
    assert table.read(again).count() == 5


def test_clustering_narrows_file_ranges(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 1000).alias("a"), (F.col("id") * 104_729 % 1000).alias("b"), F.concat(F.lit("u"), "id").alias("s"))
    laid = tables.clustered(df, ["a", "b"], 16)
    spans = laid.groupBy(F.spark_partition_id()).agg((F.max("a") - F.min("a")).alias("a"), (F.max("b") - F.min("b")).alias("b")).collect()
    # A file that lies across a jump of the curve may be wide; on the whole files are narrow.
    assert len(spans) == 16 and sum(r.a * r.b for r in spans) / 16 < 0.3 * 1000 * 1000
    assert laid.exceptAll(df).isEmpty() and laid.count() == 20_000
    with pytest.raises(ValueError):
        tables.clustered(df, ["a"], 4, partition_by=["a"])


def test_required_columns_are_enforced(spark):
    full = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in PRODUCT])
    with pytest.raises(Exception, match="required column"):
        tables.conform(full, PRODUCT).collect()


def line(**fields):
    import json

    return json.dumps({"event_id": "e", "event_type": "purchase", "event_ts": "2024-01-01T12:00:00+02:00", "session_id": "s", **fields})


def test_rescue(spark):
    lines = [line(price="x", zz=9), line(price=1.5, properties={"a": 1}), "{oops", "{}"]
    rows = landing.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"), EVENT).collect()
    assert rows[0].price is None and '"price":"x"' in rows[0]._rescued_data and '"zz":"9"' in rows[0]._rescued_data
    assert rows[1].price == 1.5 and rows[1].properties == {"a": "1"} and rows[1]._rescued_data is None
    assert rows[1].event_ts == datetime(2024, 1, 1, 10)
    assert "oops" in rows[2]._rescued_data and rows[3]._rescued_data is None


def test_contract(spark):
    lines = [line(), line(zz=1), line(event_type="signup"), line(session_id=None), line(quantity="many"), "nope", line(event_id=None)]
    valid, refused = landing.check_contract(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert sorted(r.reason for r in refused.collect()) == [
        "bad_value", "malformed_json", "missing_field", "null_field", "unknown_event_type", "unknown_field"]
    rows = valid.collect()
    assert len(rows) == 1 and all(r.schema_version == "1.0.0" and r.event_id.startswith("e") for r in rows)
    big = spark.range(1001).select(F.lit(line()).alias("value"), F.lit("b").alias("batch"))
    assert landing.check_contract(big, "batch")[0].count() == 0


def events(spark, n, start=0):
    return spark.createDataFrame(
        [(f"e{i}", "page_view", datetime(2024, 1, 1) + timedelta(minutes=i), "s", "1.0.0") for i in range(start, start + n)],
        "event_id string, event_type string, event_ts timestamp, session_id string, schema_version string",
    )


def test_files_are_taken_once_and_folders_are_no_columns(spark):
    src, out = scratch_path(spark, "landing"), scratch_path(spark, "bronze")
    for start in (0, 5):
        landing.write_landing(events(spark, 5, start), src, rows_per_file=2)
        ingest.stream_events(spark, src, f"{out}/c", f"{out}/t", EVENT)
    got = spark.read.parquet(f"{out}/t")
    assert got.count() == 10 and got.select("event_id").distinct().count() == 10
    assert got.columns == [*EVENT.names, "_rescued_data", "_source_file", "_ingest_ts", "_ingest_date"]
    assert set(with_ingest_columns(EVENT, dated=True).names) <= set(got.columns)


def test_triggers():
    assert ingest.trigger("availableNow") == {"availableNow": True}
    assert ingest.trigger("continuous") == {"processingTime": "30 seconds"}
    assert ingest.trigger("5 minutes") == {"processingTime": "5 minutes"}


def test_late_and_drifted_rows_are_held(spark):
    df = events(spark, 3).withColumns({
        "_ingest_ts": F.col("event_ts") + F.when(F.col("event_id") == "e1", F.expr("INTERVAL 1441 MINUTES")).otherwise(F.expr("INTERVAL 1440 MINUTES")),
        "_rescued_data": F.when(F.col("event_id") == "e2", "{}"),
    })
    ok, held = stateful.split_late(df)
    assert [r.event_id for r in ok.collect()] == ["e0"]
    assert {r.event_id: r.quarantine_reason for r in held.collect()} == {"e1": "late", "e2": "drifted"}


def test_scratch_is_under_the_sessions_checkpoint_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_every_query_has_sql():
    from tidemart.plans import oracles

    assert set(oracles.build()) == set(QUERIES)


@pytest.mark.parametrize("name", ["medallion_refresh", "stream_upsert"])
def test_whole_paths_run(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_upsert_finds_folders_of_any_name(spark):
    table = tables.VersionedTable(spark, scratch_path(spark, "t"), ["place"])
    names = ["United States", "a:b", "50%", "x+y", "Köln", "a=b/c", "p%20q", None]
    frame = lambda n: spark.createDataFrame([(str(i), p, n) for i, p in enumerate(names)], "id string, place string, n int")
    table.upsert(frame(1), ["id"])
    table.upsert(frame(2), ["id"])
    assert sorted((r.id, r.place or "", r.n) for r in table.read().collect()) == [(str(i), p or "", 2) for i, p in enumerate(names)]


def test_details_of_an_upserted_table_must_match(spark):
    table = tables.VersionedTable(spark, scratch_path(spark, "t"))
    table.upsert(priced(spark, [("a", 1.0)]), ["event_id"], anonymous_key=None)
    table.upsert(priced(spark, [("b", 1.0)]), ["event_id"], anonymous_key=None)
    with pytest.raises(ValueError):
        table.upsert(priced(spark, [("c", 1.0)]), ["event_id"], anonymous_key="session_id")


def test_text_is_clustered_beyond_a_common_prefix(spark):
    df = spark.range(4000).select(F.concat(F.lit("https://example.com/"), F.lpad(F.hash("id").cast("string"), 12, "0")).alias("url"), "id")
    laid = tables.clustered(df, ["url"], 8, bits=4).withColumn("part", F.spark_partition_id())
    ranges = laid.groupBy("part").agg(F.min("url").alias("low"), F.max("url").alias("high")).orderBy("low").collect()
    assert len(ranges) > 4 and all(a.high <= b.low for a, b in zip(ranges, ranges[1:]))


def test_text_cut_points_count_all_rows(spark):
    hashed = spark.range(300).select(F.format_string("v%03d", "id").alias("v")).orderBy(F.xxhash64("v"))
    least = hashed.first().v  # the row with the smallest hash, repeated more often than any sample is long
    rows = spark.range(30_000).select(F.format_string("v%03d", F.col("id") % 300).alias("v"))
    rows = rows.unionByName(spark.range(12_000).select(F.lit(least).alias("v"))).unionByName(spark.createDataFrame([(None,)], "v string"))
    values = sorted(r.v for r in rows.collect() if r.v is not None)
    want = sorted({values[int(i / 8 * len(values))] for i in range(1, 8)})
    assert tables._cut_points(rows, ["v"], 8) == [want] and len(want) > 4
    assert tables._cut_points(rows.where("v IS NULL"), ["v"], 8) == [[]]


def test_contract_refuses_endless_prices_and_null_ids(spark):
    base = '"event_type": "page_view", "event_ts": "2024-01-01T00:00:00Z", "session_id": "s"'
    lines = [
        ("{%s, \"price\": Infinity}" % base, "bad_value"), ("{%s, \"price\": 1e999}" % base, "bad_value"),
        ("{%s, \"event_id\": null}" % base, "null_field"), ("{%s, \"price\": 1.5}" % base, None),
    ]
    posted = spark.createDataFrame([(v,) for v, _ in lines], "value string")
    valid, rejects = landing.check_contract(posted)
    assert {r.value: r.reason for r in rejects.collect()} == {v: r for v, r in lines if r}
    assert [r.price for r in valid.collect()] == [1.5]


def test_first_refresh_may_find_no_files(spark):
    from tidemart.plans.refresh import refresh

    made = refresh(spark, _empty_landing(spark), scratch_path(spark, "warehouse"), "2024-01-31")
    assert len(made) == 8 and all(t.read().count() == 0 for t in made.values())


def _empty_landing(spark):
    path = scratch_path(spark, "landing")
    for name in ("events", "users", "products"):
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        at.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(at)
    return path


def test_appends_may_add_columns(spark):
    path = scratch_path(spark, "wide")
    tables.append(priced(spark, [("a", 1.0)]), path)
    tables.append(priced(spark, [("b", 2.0)]).withColumn("note", F.lit("new")), path)
    wide = spark.read.option("mergeSchema", "true").parquet(path)
    assert {(r.event_id, r.note) for r in wide.collect()} == {("a", None), ("b", "new")}


# ---- entries of files ------------------------------------------------------------------

def test_bloom_filter_lets_no_key_down():
    import numpy as np

    from tidemart.sources import manifest

    rng = np.random.default_rng(1)
    held = rng.integers(-2**63, 2**63 - 1, 5_000)
    made = manifest.bloom(held)
    assert all(manifest.may_hold(made, held[i:i + 1]) for i in range(0, 5_000, 7))
    others = rng.integers(-2**63, 2**63 - 1, 4_000)
    assert sum(manifest.may_hold(made, others[i:i + 1]) for i in range(4_000)) < 80
    assert not manifest.may_hold(manifest.bloom(held[:0]), others) and not manifest.may_hold(made, others[:0])


def test_a_merge_opens_only_files_that_may_match(spark, monkeypatch):
    table = tables.VersionedTable(spark, scratch_path(spark, "t"), ["day"], keys=["id"])
    frame = lambda ids, n: spark.createDataFrame([(f"k{i}", f"d{i % 20:02d}", n) for i in ids], "id string, day string, n int")
    table.publish(frame(range(2_000), 1))
    opened = []
    read = table._read_files
    monkeypatch.setattr(table, "_read_files", lambda pointer, files: opened.append(sorted(files)) or read(pointer, files))
    table.upsert(frame([40, 60, 2_040], 2), ["id"])  # one day, two rows known
    assert [f for fs in opened for f in fs if "day=d00" not in f] == [] and len(opened) == 1
    got = {r.id: (r.day, r.n) for r in table.read().collect()}
    assert len(got) == 2_001 and {k for k, v in got.items() if v[1] == 2} == {"k40", "k60", "k2040"}
    assert {r.day for r in table.changed_partitions(1, 2).collect()} == {"d00"}
    assert {r.day for r in table.changed_partitions(2).collect()} == set()
    assert table.changed_partitions(None).count() == 20
    assert table.read_partitions(spark.createDataFrame([("d03",), ("zz",)], "day string")).count() == 100
    assert {r.id for r in table.read_matching(frame([41, 9_999], 0), ["id"]).collect()} == {"k41"}


@pytest.mark.parametrize("asked", [0, 10**6])
def test_many_merges_equal_a_plain_map(spark, monkeypatch, asked):
    """With and without filters, beyond the point where entries are written together, null keys included."""
    import random

    monkeypatch.setattr(tables, "MOST_ASKED", asked)
    monkeypatch.setattr(tables, "KEPT_DELTAS", 4)
    rng = random.Random(asked)
    table = tables.VersionedTable(spark, scratch_path(spark, "t"), ["day"])
    want, nulls = {}, 0
    for step in range(6):
        rows = {rng.randrange(60): rng.choice("abc") for _ in range(12)}
        want |= {i: (d, step) for i, d in rows.items()}
        nulls += 1
        table.upsert(spark.createDataFrame([*((i, d, step) for i, d in rows.items()), (None, "a", step)], "id long, day string, n int"), ["id"], keep=2)
        got = table.read().collect()
        assert {r.id: (r.day, r.n) for r in got if r.id is not None} == want and len(got) == len(want) + nulls
    assert len(table._published()) == 2 and table.read(table._published()[0]).count() <= len(got)
    assert len(table.pointer()["parts"]) <= 4


def test_optimize_lays_only_what_is_new(spark):
    table = tables.VersionedTable(spark, scratch_path(spark, "t"), stats=["a"])
    frame = lambda lo, hi: spark.range(lo, hi).select((F.col("id") * 7919 % 1000).alias("a"), F.concat(F.lit("u"), "id").alias("s"), "id")
    table.publish(frame(0, 8_000))
    first = table.optimize(["a"], 8)
    assert table.optimize(["a"], 8) == first and len(table._written()) == 2
    narrow = table.files().where("min_a <= 10 AND max_a >= 10").count()
    assert narrow <= 2 < table.files().count()
    laid = {r.file for r in table.files().collect()}
    table.upsert(frame(7_990, 9_000), ["id"])
    kept = {r.file for r in table.files().collect()} & laid
    assert table.optimize(["a"], 8) > first
    assert kept <= {r.file for r in table.files().collect()} and table.files().where("layout IS NULL").count() == 0
    assert table.read().exceptAll(frame(0, 9_000)).isEmpty() and table.read().count() == 9_000


def test_entries_hold_a_bounded_number_of_keys(spark, monkeypatch):
    """A long file has several entries, made in memory that does not grow with it; merges still find its rows."""
    import tracemalloc

    import numpy as np

    from tidemart.sources import manifest

    hashes = np.arange(1_000_000, dtype=np.int64)
    tracemalloc.start()
    manifest.bloom(hashes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20
    monkeypatch.setattr(manifest, "ENTRY_ROWS", 1_000, raising=False)
    table = tables.VersionedTable(spark, scratch_path(spark, "a b+c%"), ["day"], keys=["id"])
    frame = lambda ids, n: spark.createDataFrame([(i, "x:y", n) for i in ids], "id long, day string, n int").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        table.publish(frame(range(4_000), 1))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    held = table.files().collect()
    assert sum(r.rows for r in held) == 4_000 and len(held) >= 4 and max(r.rows for r in held) < 2_000
    table.upsert(frame([5, 3_995, 4_001], 2), ["id"])
    got = {r.id: r.n for r in table.read().collect()}
    assert len(got) == 4_001 == table.read().count() and {i for i, n in got.items() if n == 2} == {5, 3_995, 4_001}


def test_only_lines_with_something_to_rescue_are_read_as_a_map(spark):
    from tidemart.schemas import PRODUCT
    from tidemart.sources import landing

    given = ['{"product_id":"a","price":1.5}', '{"product_id":"b","price":"n/a"}', '{"product_id":"c","zz":1}', '{"price":1', "{}", "[1]", "",
             '{"price":1,"price":null}', '{"name":"d","price":null,"brand":"x"}', '{"_corrupt_line":"x"}', None]
    frame = spark.createDataFrame(list(enumerate(given)), "i int, value string")
    known = F.array(*[F.lit(f.name) for f in PRODUCT])
    parsed = {r.i: r for r in landing._parsed_for_rescue(frame, PRODUCT, "value", known).collect()}
    assert parsed[0]._clean and parsed[8]._clean and parsed[0]._raw is None and parsed[8]._null is None
    rescued = {r.i: r._rescued_data for r in landing.parse_lines(frame, PRODUCT).collect()}
    assert rescued[0] is rescued[4] is rescued[8] is None
    assert rescued[1] == '{"price":"n/a"}' and rescued[2] == '{"zz":"1"}' and rescued[9] == '{"_corrupt_line":"x"}'
    assert "_malformed" in rescued[3] and "_malformed" in rescued[5] and rescued[7] is not None


def test_bronze_rules_land_what_the_stream_reads(spark, sf_dir, monkeypatch):
    from tidemart.plans import queries as q

    def refused(*_, **__):
        raise AssertionError("a snapshot that nothing reads was landed")

    monkeypatch.setattr(q.landing, "write_snapshot", refused)
    assert q.QUERIES["bronze_rules_stream"](spark, sf_dir).count() == 2


def test_files_whose_rows_are_all_replaced_are_not_read_again(spark, monkeypatch):
    table = tables.VersionedTable(spark, scratch_path(spark, "t"), ["place"])
    frame = lambda rows: spark.createDataFrame(rows, "id string, place string, n int")
    table.upsert(frame([("a", "x", 1), ("b", "x", 1), ("c", "y", 1), ("d", "y", 1), (None, "z", 1), ("e", "z", 1)]), ["id"])
    opened, read = [], table._read_files
    monkeypatch.setattr(table, "_read_files", lambda pointer, files: opened.extend(files) or read(pointer, files))
    table.upsert(frame([("a", "x", 2), ("b", "y", 2), ("c", "y", 2), ("e", "z", 2)]), ["id"])
    monkeypatch.undo()
    assert {f.split("/")[1] for f in opened} == {"place=y", "place=z"}  # a null key is never replaced
    want = [("", "z", 1), ("a", "x", 2), ("b", "y", 2), ("c", "y", 2), ("d", "y", 1), ("e", "z", 2)]
    assert sorted((r.id or "", r.place, r.n) for r in table.read().collect()) == want


def test_backfill_reads_the_source_tables_once(spark, sf_dir, monkeypatch):
    """What is published and what is replayed come from rows that were written down, not from the source tables again."""
    from tidemart.streaming.incremental import SilverEvents

    given = []
    monkeypatch.setattr(tables.VersionedTable, "publish", lambda self, df, *a, **o: given.append(df))
    monkeypatch.setattr(SilverEvents, "merge", lambda self, bronze, keep=10: given.append(bronze))
    with pytest.raises(FileNotFoundError):  # nothing was published here
        QUERIES["backfill_window"](spark, sf_dir)
    assert len(given) == 2 and not [f for df in given for f in df.inputFiles() if sf_dir in f]


def _own_shop(spark, monkeypatch):
    """The queries' deliveries and snapshots, of a few rows made here."""
    from tidemart.plans import queries as q
    from tidemart.schemas import USER, loosened

    def whole(rows, schema):
        return spark.createDataFrame([], loosened(schema)).unionByName(rows, allowMissingColumns=True)

    at = F.to_timestamp(F.lit("2024-01-01")) + F.make_dt_interval(hours=F.col("id").cast("int"))
    keyed = lambda key: spark.range(25).select((F.col("id") % 5).cast("string").alias(key), at.alias("updated_ts")).coalesce(1)
    made = {"events": whole(events(spark, 25), EVENT), "users": whole(keyed("user_id"), USER), "products": whole(keyed("product_id"), PRODUCT)}
    for function, name in (("first_delivery", "events"), ("user_snapshots", "users"), ("product_snapshots", "products")):
        monkeypatch.setattr(q.shop, function, lambda *_, rows=made[name]: rows)
    return q, made


def _landed_files(src):
    import os

    return [f"{d}/{f}" for d, _, names in os.walk(src) for f in names if f.startswith("part-")]


def test_a_refresh_finds_its_landing_files_packed(spark, sf_dir, monkeypatch):
    """Plain lines took most of the disk of a refresh.  A packed snapshot has files enough for several tasks, and the same rows."""
    q, made = _own_shop(spark, monkeypatch)
    monkeypatch.setattr(landing, "PACKED_ROWS", 10, raising=False)
    src = q._landed(spark, sf_dir)
    for name, rows in made.items():
        files = _landed_files(f"{src}/{name}")
        assert files and all(f.endswith(".json.gz") for f in files), files
        back = landing.read_json_lines(spark, f"{src}/{name}", rows.schema)
        assert back.count() == 25 and back.select("updated_ts" if name != "events" else "event_ts").exceptAll(
            rows.select("updated_ts" if name != "events" else "event_ts")).isEmpty()
        assert name == "events" or len(files) >= 3
    one = scratch_path(spark, "landing")
    landing.write_snapshot(made["users"], one, files=1, gzip=True)
    assert len(_landed_files(one)) == 1


def test_a_refresh_leaves_no_shuffle_files(spark, sf_dir, monkeypatch):
    import time

    from tidemart import session

    def shuffled():
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        found = manager.getAllFiles().mkString("\n").split("\n")
        return {f.rsplit("/", 1)[-1] for f in found if "/shuffle_" in f}

    q, _ = _own_shop(spark, monkeypatch)
    before = shuffled()
    made = q.refresh(spark, q._landed(spark, sf_dir), scratch_path(spark, "warehouse"), q.AS_OF, 720)
    left = shuffled() - before
    for _ in range(50):  # they go in the background
        if not left:
            break
        time.sleep(0.2)
        left = shuffled() - before
    assert not left and spark.conf.get(session.DROP_SHUFFLES) == "false"
    counts = {name: table.read().count() for name, table in made.items()}
    assert len(counts) == 8 and counts["events"] == 25 and counts["dim_users_scd2"] == counts["dim_products_scd2"] == 5


def test_both_deliveries_of_a_repeated_refresh_are_packed(spark, sf_dir, monkeypatch):
    q, made = _own_shop(spark, monkeypatch)
    both = made["events"].unionByName(events(spark, 4, 29 * 1440), allowMissingColumns=True)
    monkeypatch.setattr(q.shop, "first_delivery", lambda *_: both)
    seen = []

    class Shown:
        def read(self):
            return spark.range(1)

    def refreshed(spark, src, home, *_):
        seen.append((_landed_files(src), landing.read_json_lines(spark, f"{src}/events", EVENT).count()))
        return {"fact_daily_sales": Shown()}

    monkeypatch.setattr(q, "refresh", refreshed)
    q.QUERIES["refresh_twice"](spark, sf_dir)
    assert [n for _, n in seen] == [25, 29]
    assert all(f.endswith(".json.gz") for files, _ in seen for f in files), seen

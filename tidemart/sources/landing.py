"""Landing files: JSON lines in and out, rescue of drifted fields, contract check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import EVENT, EVENT_TYPES, SCHEMA_VERSION, loosened

MAX_BATCH = 1_000  # most events of one posted batch

WIRE_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

# Folders such as dt=2024-01-01 must not become columns.
FILE_OPTIONS = {"recursiveFileLookup": "true"}
WRITE_OPTIONS = {"ignoreNullFields": "false", "timestampFormat": WIRE_TIME}
# Lines repeat their field names: packed they take about an eighth of the disk.  The fastest level does that at over twice the default's speed.
PACKED_OPTIONS = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
PACKED_ROWS = 250_000  # of a snapshot file: tasks can share files, but not a packed one


TEXT_MAP = T.MapType(T.StringType(), T.StringType())


def _parsed_twice(lines: DataFrame, schema: T.StructType, line: str) -> DataFrame:
    """``lines`` plus _typed (the pinned fields), _raw (a plain key-value map) and _null (names
    of pinned fields without a value).

    The explode of one element keeps later filters from being pushed below the parsing, which
    would repeat it for every field they look at.
    """
    both = F.struct(
        F.from_json(F.col(line), loosened(schema)).alias("typed"), F.from_json(F.col(line), TEXT_MAP).alias("raw")
    )
    once = lines.select("*", F.explode(F.array(both)).alias("_json"))
    null = F.array_compact(F.array(*[F.when(F.col(f"_json.typed.{f.name}").isNull(), F.lit(f.name)) for f in schema]))
    return once.select(
        *lines.columns, F.col("_json.typed").alias("_typed"), F.col("_json.raw").alias("_raw"), null.alias("_null")
    )


CORRUPT = "_corrupt_line"


def _parsed_for_rescue(lines: DataFrame, schema: T.StructType, line: str, known: Column) -> DataFrame:
    """As :func:`_parsed_twice`, but lines that hold nothing to rescue are _clean and have neither _raw nor _null.

    A line is clean if all its values fit and its keys are known and no key comes twice.  Most lines are, and the plain map costs
    more than the pinned fields.
    """
    guarded = T.StructType([*loosened(schema).fields, T.StructField(CORRUPT, T.StringType())])
    both = F.struct(
        F.from_json(F.col(line), guarded, {"columnNameOfCorruptRecord": CORRUPT}).alias("typed"),
        F.json_object_keys(F.col(line)).alias("keys"),
    )
    once = lines.select("*", F.explode(F.array(both)).alias("_json"))
    keys = F.col("_json.keys")
    plain = (keys == known) | (
        (F.cardinality(keys) > 0) & (F.cardinality(F.array_except(keys, known)) == 0)
        & (F.cardinality(F.array_distinct(keys)) == F.cardinality(keys)))
    clean = F.coalesce(F.col(f"_json.typed.{CORRUPT}").isNull() & plain, F.lit(False))
    judged = once.select(*lines.columns, "_json", F.col("_json.typed").alias("_typed"), clean.alias("_clean"))
    # Asked of _json, which goes no further: a column made of the very fields that are named next would double what Spark infers
    # for a later filter with each of them.
    null = F.array_compact(F.array(*[F.when(F.col(f"_json.typed.{f.name}").isNull(), F.lit(f.name)) for f in schema]))
    return judged.select(
        *lines.columns, "_typed", "_clean", F.when(~F.col("_clean"), F.from_json(F.col(line), TEXT_MAP)).alias("_raw"),
        F.when(~F.col("_clean"), null).alias("_null"))


def parse_lines(lines: DataFrame, schema: T.StructType, line: str = "value") -> DataFrame:
    """JSON text to the pinned columns plus ``_rescued_data``; other columns pass through.

    Keys that are unknown, or whose value does not fit the pinned type, are kept as JSON; a
    line that is no JSON object is kept whole.
    """
    known = F.array(*[F.lit(f.name) for f in schema])
    parsed = _parsed_for_rescue(lines, schema, line, known)
    stray = F.map_filter(
        F.col("_raw"),
        lambda k, v: ~F.array_contains(known, k) | (v.isNotNull() & F.array_contains(F.col("_null"), k)),
    )
    broken = F.coalesce(F.cardinality("_raw"), F.lit(0)) < 1
    empty = F.col(line).rlike(r"^\s*\{\s*\}\s*$")
    rescued = (
        F.when(F.col("_clean"), None)
        .when(empty, None)
        .when(broken, F.to_json(F.struct(F.col(line).alias("_malformed"))))
        .when(F.cardinality(stray) > 0, F.to_json(stray))
    )
    passed = [c for c in lines.columns if c != line]
    return parsed.select(*[F.col(f"_typed.{f.name}").alias(f.name) for f in schema], rescued.alias("_rescued_data"), *passed)


def with_ingest_metadata(df: DataFrame, dated: bool) -> DataFrame:
    """_ingest_ts, _source_file and, for events, _ingest_date.  The one place that reads a clock."""
    stamped = df.withColumn("_ingest_ts", F.current_timestamp())
    if "_source_file" not in df.columns:
        stamped = stamped.withColumn("_source_file", F.col("_metadata.file_path"))
    return stamped.withColumn("_ingest_date", F.to_date("_ingest_ts")) if dated else stamped


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).options(**FILE_OPTIONS).json(path)


def load_embeddings(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Staged embedding lines with the timestamp given as text."""
    return read_json_lines(spark, path, schema).withColumn("embed_ts", F.col("embed_ts").cast("timestamp"))


def write_landing(df: DataFrame, path: str, ts: str = "event_ts", rows_per_file: int = 5_000, gzip: bool = False) -> None:
    """JSON lines under dt=YYYY-MM-DD/.  Rebalancing splits a day that holds most rows."""
    dated = df.withColumn("dt", F.date_format(F.col(ts), "yyyy-MM-dd"))
    writer = dated.hint("rebalance", "dt").write.mode("append").partitionBy("dt")
    if gzip:
        writer = writer.options(**PACKED_OPTIONS)
    writer.option("maxRecordsPerFile", rows_per_file).options(**WRITE_OPTIONS).json(path)


def write_snapshot(df: DataFrame, path: str, files: int | None = None, gzip: bool = False) -> None:
    """Entity snapshot as JSON lines; ``files=1`` writes one file, for small entity tables only."""
    writer = (df.coalesce(files) if files else df).write.mode("append").options(**WRITE_OPTIONS)
    if gzip:
        writer = writer.options(**PACKED_OPTIONS)
        if not files:
            writer = writer.option("maxRecordsPerFile", PACKED_ROWS)
    writer.json(path)


def check_contract(posted: DataFrame, batch: str | None = None, line: str = "value", max_batch: int = MAX_BATCH) -> tuple[DataFrame, DataFrame]:
    """Split posted event lines into contract-clean events and rejects with a reason.

    Refused are: malformed JSON, unknown fields, missing or null required fields, a null id or version, unknown event
    types, values that do not fit or are not finite, and batches of more than ``max_batch`` events.  Times become UTC,
    property values text; a missing id or version is filled in.
    """
    optional = {"event_id", "schema_version"}
    required = [f.name for f in EVENT if not f.nullable and f.name not in optional]
    known = F.array(*[F.lit(f.name) for f in EVENT])
    parsed = _parsed_twice(posted, EVENT, line)
    given = F.map_keys(F.map_filter("_raw", lambda _, v: v.isNotNull()))
    nulls = F.map_keys(F.map_filter("_raw", lambda _, v: v.isNull()))
    endless = [F.abs(F.col(f"_typed.{f.name}")) == float("inf") for f in EVENT if f.dataType.typeName() == "double"]
    size = F.lit(1)
    if batch:
        sizes = posted.groupBy(batch).agg(F.count(F.lit(1)).alias("_size"))
        parsed = parsed.join(sizes, batch, "left")
        size = F.coalesce(F.col("_size"), F.lit(1))
    keys = F.map_keys("_raw")
    reasons = {
        "malformed_json": keys.isNull() | (F.size(keys) == 0),
        "batch_too_large": size > max_batch,
        "unknown_field": F.size(F.array_except(keys, known)) > 0,
        "missing_field": F.size(F.array_except(F.array(*map(F.lit, required)), given)) > 0,
        "null_field": F.size(F.array_intersect(nulls, F.array(*map(F.lit, sorted(optional))))) > 0,
        "bad_value": (F.size(F.array_intersect(given, F.col("_null"))) > 0) | F.coalesce(F.greatest(F.lit(False), *endless), F.lit(False)),
        "unknown_event_type": ~F.col("_typed.event_type").isin(*EVENT_TYPES),
    }
    reason = F.coalesce(*[F.when(broken, F.lit(name)) for name, broken in reasons.items()])
    judged = parsed.withColumn("reason", reason)
    passed = [c for c in posted.columns if c != line]
    new_id = F.concat(F.lit("e_"), F.regexp_replace(F.uuid(), "-", ""))
    filled = {"event_id": new_id, "schema_version": F.lit(SCHEMA_VERSION)}
    valid = judged.where("reason IS NULL").select(
        *[
            (F.coalesce(F.col(f"_typed.{f.name}"), filled[f.name]) if f.name in filled else F.col(f"_typed.{f.name}")).alias(f.name)
            for f in EVENT
        ],
        *passed,
    )
    return valid, judged.where("reason IS NOT NULL").select(line, "reason", *passed)

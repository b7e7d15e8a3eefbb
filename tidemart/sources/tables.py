"""Tables as Parquet: append, overwrite, pinned creation, clustering, versioned publishing."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Sequence
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import fingerprint
from ..operators.quality import Rule, checked_write
from .manifest import MOST_ASKED, entries, entry_schema, filtered, holding, in_ranges, key_hash, ranged


# ---- plain writes ----------------------------------------------------------------------

PACKED = {"compression": "zstd"}  # about two thirds of the disk that the default takes, at its speed


def _store(df: DataFrame, target: str, mode: str, partition_by: Sequence[str]) -> None:
    """``target`` is a path if it holds a slash, else a table name."""
    # Rebalancing gives each partition folder few, even files and splits a hot folder.
    writer = (df.hint("rebalance", *partition_by) if partition_by else df).write.mode(mode).options(**PACKED)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in target:
        writer.parquet(target)
    else:
        writer.format("parquet").saveAsTable(target)


def append(df: DataFrame, target: str, partition_by: Sequence[str] = ()) -> None:
    _store(df, target, "append", partition_by)


def overwrite(df: DataFrame, target: str, partition_by: Sequence[str] = ()) -> None:
    _store(df, target, "overwrite", partition_by)


def read(spark: SparkSession, target: str, merge_schema: bool = False) -> DataFrame:
    if "/" in target:
        return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(target)
    return spark.read.table(target)


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    comment: str = "",
    location: str | None = None,
    properties: dict[str, str] | None = None,
) -> None:
    """Empty typed table from a pinned schema; does nothing if it exists."""
    quote = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema)
    ddl = [f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"]
    if partition_by:
        ddl.append("PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_by) + ")")
    if location:
        ddl.append(f"LOCATION {quote(location)}")
    ddl.append(f"COMMENT {quote(comment)}")
    if properties:
        ddl.append("TBLPROPERTIES (" + ", ".join(f"{quote(k)} = {quote(v)}" for k, v in properties.items()) + ")")
    spark.sql(" ".join(ddl))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The pinned columns in order and type; a null in a NOT NULL column fails the job."""
    def pinned(f: T.StructField) -> Column:
        value = F.col(f.name).cast(f.dataType)
        if f.nullable:
            return value.alias(f.name)
        refused = F.raise_error(F.lit(f"null in required column {f.name}")).cast(f.dataType)
        return F.coalesce(value, refused).alias(f.name)

    return df.select(*[pinned(f) for f in schema])


# ---- clustering ------------------------------------------------------------------------

SAMPLE_ROWS = 10_000  # bound of the sample of distinct texts that divides their counting among tasks
TEXT_RANGES = 256


def _ordered(df: DataFrame, column: str) -> Column:
    """An order-keeping number per value; text as it is."""
    kind = df.schema[column].dataType
    c = F.col(column)
    if isinstance(kind, T.StringType):
        return c
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    return c.cast("double")


def _text_cuts(df: DataFrame, column: str, shares: list[float]) -> list[str]:
    """Exact quantiles of all rows, by a running sum over the distinct texts within value ranges.

    A sample of the distinct texts only sets the ranges, not the result.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    sample = sorted((r.v for r in counts.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE_ROWS).collect()), key=str.encode)
    borders = [sample[i * len(sample) // TEXT_RANGES] for i in range(1, TEXT_RANGES)] if sample else []
    ranged = counts.withColumn("part", _bucket(F.col("v"), sorted(set(borders), key=str.encode)))
    sums = sorted(ranged.groupBy("part").agg(F.sum("n").alias("n")).collect())  # TEXT_RANGES rows at most
    before, total = [], 0
    for part, n in sums:
        before.append((part, total))
        total += n
    if not total:
        return []
    offsets = df.sparkSession.createDataFrame(before, "part int, before bigint")
    so_far = Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.join(F.broadcast(offsets), "part").withColumn("till", F.col("before") + F.sum("n").over(so_far))
    wanted = F.array(*[F.lit(int(s * total)).cast("bigint") for s in shares])
    met = F.exists(wanted, lambda w: (w < F.col("till")) & (w >= F.col("till") - F.col("n")))
    return [r.v for r in placed.where(met).select("v").collect()]


def _cut_points(df: DataFrame, columns: Sequence[str], parts: int) -> list[list]:
    """``parts`` - 1 quantiles of all rows per column: approximate for numbers, exact for text."""
    shares = [i / parts for i in range(1, parts)]
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    numbers = [c for c in columns if c not in texts]
    found: dict[str, list] = {}
    if numbers:
        row = df.agg(*[F.percentile_approx(_ordered(df, c), shares, 10_000).alias(f"q{i}") for i, c in enumerate(numbers)]).first()
        found |= {c: row[i] or [] for i, c in enumerate(numbers)}
    found |= {c: _text_cuts(df, c, shares) for c in texts}
    return [sorted(set(found[c]), key=lambda v: v.encode() if isinstance(v, str) else v) for c in columns]


def _bucket(value: Column, cuts: list, low: int = 0) -> Column:
    """Position among sorted cut points, by a balanced tree of comparisons."""
    if not cuts:
        return F.lit(low)
    mid = len(cuts) // 2
    return F.when(value <= cuts[mid], _bucket(value, cuts[:mid], low)).otherwise(
        _bucket(value, cuts[mid + 1:], low + mid + 1)
    )


def clustered(
    df: DataFrame, columns: Sequence[str], files: int, partition_by: Sequence[str] = (), bits: int = 5
) -> DataFrame:
    """Lay rows along a bit-interleaved curve so that Parquet min/max can skip files.

    The cut points of each column are approximate quantiles: 2**bits - 1 numbers, whatever
    the size of the table.  The row hash ends the range key, so equal rows can be split.
    """
    clash = set(columns) & set(partition_by)
    if clash:
        raise ValueError(f"partition columns cannot be clustered: {sorted(clash)}")
    curve = F.lit(0).cast("long")
    for i, (c, cuts) in enumerate(zip(columns, _cut_points(df, columns, 2**bits), strict=True)):
        bucket = F.coalesce(_bucket(_ordered(df, c), cuts), F.lit(0)).cast("long")
        for bit in range(bits):
            one = F.shiftright(bucket, bit).bitwiseAND(F.lit(1).cast("long"))
            curve = curve.bitwiseOR(F.shiftleft(one, bit * len(columns) + i))
    keys = [*partition_by, "_curve", *columns, "_hash"]
    return (
        df.withColumns({"_curve": curve, "_hash": fingerprint(df)})
        .repartitionByRange(files, *keys)
        .sortWithinPartitions(*keys)
        .drop("_curve", "_hash")
    )


# ---- merging ---------------------------------------------------------------------------

def require_unique(source: DataFrame, keys: Sequence[str]) -> None:
    """A merge is undefined if two source rows could claim one target row."""
    known = source.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    twice = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"source has several rows for {twice[0].asDict()}")


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str], update_columns: Sequence[str] | None = None) -> DataFrame:
    """Target after an upsert: matched rows updated, others inserted.  Null keys never match."""
    keys = list(keys)
    if update_columns is None:
        kept = target.join(source.select(*keys), keys, "left_anti").select(*[f"`{c}`" for c in target.columns])
        return kept.unionByName(source, allowMissingColumns=True)
    news = source.select(*keys, F.struct(*update_columns).alias("_new"))
    joined = target.join(news, keys, "left")
    updated = joined.select(*[
        F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in update_columns else F.col(c)
        for c in target.columns
    ])
    inserted = source.join(target.select(*keys), keys, "left_anti")
    return updated.unionByName(inserted, allowMissingColumns=True)


# ---- versioned tables ------------------------------------------------------------------

KEPT_DELTAS = 16  # after so many merges the entries of all current files are written together again


class VersionedTable:
    """Data first, pointer last.

    ``<path>/v=<n>/`` holds the files one publish or merge wrote, ``<path>/_files/v=<n>/`` an entry for each of them (see
    :mod:`manifest`), ``<path>/_gone/v=<n>/`` the names of the files it replaced, and ``<path>/_published/<n>.json`` makes all
    that visible: it names the versions whose entries, less what is gone, make up the table.  Nothing is ever overwritten, so readers
    see a whole version or the one before.  The driver learns the names of files that are opened, as for any Parquet read; of
    files that a merge leaves alone it learns nothing.

    ``keys`` are the columns whose values the entries hold a Bloom filter of; they default to those of the first merge.
    ``stats`` are further columns whose least and greatest values are recorded.
    """

    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str] = (), keys: Sequence[str] = (), stats: Sequence[str] = ()):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_by = list(partition_by)
        self.keys, self.stats = list(keys), list(stats)

    # file system (any Hadoop-supported one)
    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def _published(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names(f"{self.path}/_published") if re.fullmatch(r"\d+\.json", n))

    def _numbers(self, folder: str) -> list[int]:
        return sorted(int(n[2:]) for n in self._names(folder) if re.fullmatch(r"v=\d+", n))

    def _written(self) -> list[int]:
        return self._numbers(self.path)

    # reading
    def exists(self) -> bool:
        return bool(self._published())

    def version(self) -> int | None:
        return max(self._published(), default=None)

    def pointer(self, version: int | None = None) -> dict:
        published = self._published()
        if not published:
            raise FileNotFoundError(f"nothing published under {self.path}")
        version = published[-1] if version is None else version
        fs, p = self._fs(f"{self.path}/_published/{version}.json")
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def files(self, version: int | None = None) -> DataFrame:
        """The entries of a version's files: file, rows, keys, layout, min_ and max_ of the ranged columns, part_ values."""
        return self._entries(self.pointer(version))

    def _entries(self, pointer: dict) -> DataFrame:
        schema = T.StructType.fromJson(pointer["schema"])
        kinds = entry_schema(schema, pointer["ranges"], self.partition_by)
        if not pointer["parts"]:
            return self.spark.createDataFrame([], kinds)
        found = self.spark.read.schema(kinds).parquet(*[f"{self.path}/_files/v={v}" for v in pointer["parts"]])
        gone = [f"{self.path}/_gone/v={v}" for v in pointer["gone"]]
        if gone:
            found = found.join(self.spark.read.schema("file string").parquet(*gone), "file", "left_anti")
        return found.select(*kinds.names)

    def folders(self, version: int | None = None) -> dict[str, list[int]]:
        """Partition folders with the versions that have files there; for small tables."""
        at = F.regexp_extract("file", r"^v=(\d+)/(?:(.*)/)?[^/]*$", 1).cast("int")
        folder = F.regexp_extract("file", r"^v=(\d+)/(?:(.*)/)?[^/]*$", 2)
        rows = self.files(version).groupBy(folder.alias("folder")).agg(F.sort_array(F.collect_set(at)).alias("versions")).collect()
        return {r.folder: list(r.versions) for r in rows}

    def changed_partitions(self, since: int | None, until: int | None = None) -> DataFrame:
        """Distinct partition values of the files that one of two versions has and the other has not; all of ``until``'s if
        ``since`` is None."""
        parts = [F.col(f"`part_{c}`").alias(c) for c in self.partition_by]
        new = self.files(until)
        if since is None:
            return new.select(*parts).distinct()
        old = self.files(since)
        return new.join(old, "file", "left_anti").select(*parts).unionByName(old.join(new, "file", "left_anti").select(*parts)).distinct()

    def _read_files(self, pointer: dict, files: Iterable[str]) -> DataFrame:
        schema = T.StructType.fromJson(pointer["schema"])
        paths = [f"{self.path}/{f}" for f in sorted(files)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        # Without a base path of their own, files of several versions would show v as a column.
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths).select(*schema.names)

    def _named(self, found: DataFrame) -> list[str]:
        return [r.file for r in found.select("file").distinct().collect()]

    def read(self, version: int | None = None, **expected) -> DataFrame:
        """The latest (or a kept) version; ``expected`` details must match what was published."""
        pointer = self.pointer(version)
        self._require(pointer["details"], expected)
        return self._read_files(pointer, self._named(self._entries(pointer)))

    def _partition_files(self, pointer: dict, wanted: DataFrame) -> list[str]:
        parts = wanted.select(*[F.col(f"`{c}`").alias(f"part_{c}") for c in self.partition_by])
        found = self._entries(pointer)
        same = [found[c].eqNullSafe(parts[c]) for c in parts.columns]
        return self._named(found.join(parts, same, "left_semi"))

    def read_partitions(self, wanted: DataFrame, version: int | None = None) -> DataFrame:
        """The rows of the partitions that ``wanted`` (distinct partition values) names; other files are not opened."""
        pointer = self.pointer(version)
        return self._read_files(pointer, self._partition_files(pointer, wanted))

    def read_written(self, version: int) -> DataFrame:
        """The rows that one publish, append or merge wrote."""
        schema = T.StructType.fromJson(self.pointer(version)["schema"])
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(f"{self.path}/v={version}").select(*schema.names)

    def read_around(self, source: DataFrame, keys: Sequence[str]) -> DataFrame:
        """All rows of the files that may hold a row with the keys of ``source``, to be joined by the caller."""
        pointer = self.pointer()
        return self._read_files(pointer, self._candidates(pointer, source, keys) or [])

    def read_matching(self, source: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The rows that share their keys with ``source``; only files that may hold one are opened."""
        return self.read_around(source, keys).join(source.select(*keys).distinct(), list(keys), "left_semi")

    @staticmethod
    def _require(details: dict, expected: dict) -> None:
        wrong = {k: (details.get(k), v) for k, v in expected.items() if details.get(k) != v}
        if wrong:
            raise ValueError(f"published table differs from what is expected: {wrong}")

    # writing
    def _write_version(self, df: DataFrame, rules: Iterable[Rule], layout: str | None = None, more: Iterable[DataFrame] = ()) -> tuple[int, int]:
        version = max(self._written() + self._published(), default=0) + 1
        counted = [*rules, Rule("rows", "TRUE")]
        rows, mode = 0, "error"

        def write(observed: DataFrame) -> None:
            if layout is None:
                return _store(observed, f"{self.path}/v={version}", mode, self.partition_by)
            writer = observed.write.mode(mode).options(**PACKED)  # the rows are laid already
            (writer.partitionBy(*self.partition_by) if self.partition_by else writer).parquet(f"{self.path}/v={version}")

        for lot in chain([df], more):
            rows += checked_write(lot, counted, write)[-1]["total"]
            mode = "append"
        return version, rows

    def _describe(self, version: int, schema: T.StructType, layout: str | None) -> DataFrame:
        """Entries of the files that ``version`` wrote."""
        placed = self.spark.read.schema(schema).option("basePath", self.path).parquet(f"{self.path}/v={version}").withColumn("_file", F.col("_metadata.file_path"))
        return entries(placed, schema, filtered(schema, self.keys), self._ranges(schema), self.partition_by, layout)

    def _ranges(self, schema: T.StructType) -> list[str]:
        return ranged(schema, [c for c in dict.fromkeys([*self.keys, *self.stats]) if c in schema.names])

    def _place(self, uri: Column) -> Column:
        """A file, below the table's folder, by its name on disk."""
        # The path is a URI: decoded once it gives that name.  A plus sign stands for itself there.
        encoded = F.regexp_extract(uri, r"/(v=\d+/(?:[^/]+/){%d}[^/]+)$" % len(self.partition_by), 1)
        return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))

    def _point(self, pointer: dict) -> None:
        fs, final = self._fs(f"{self.path}/_published/{pointer['version']}.json")
        _, draft = self._fs(f"{self.path}/_drafts/{uuid.uuid4().hex}")
        out = fs.create(draft)
        try:
            out.write(bytearray(json.dumps(pointer).encode()))
        finally:
            out.close()
        fs.mkdirs(final.getParent())
        if fs.exists(final) or not fs.rename(draft, final):
            raise RuntimeError(f"version {pointer['version']} was published by another writer")

    def publish(
        self,
        df: DataFrame,
        rules: Iterable[Rule] = (),
        keep: int = 0,
        allow_empty: bool = True,
        notes: dict | None = None,
        more: Iterable[DataFrame] = (),
        **details,
    ) -> int:
        """Replace the table.  A broken ``fail`` rule or a refused empty result stays invisible.

        ``details`` can be asked for when reading; ``notes`` are free.  ``more`` are further lots of rows, each taken and written
        when the one before it is: what one lot needs while it is computed need not lie beside what another needs.
        """
        version, rows = self._write_version(df, rules, more=more)
        if not rows and not allow_empty:
            raise ValueError("refusing to publish an empty result")
        if rows:
            self._describe(version, df.schema, None).write.parquet(f"{self.path}/_files/v={version}")
        self._point({
            "version": version, "rows": rows, "details": details, "notes": notes or {}, "schema": df.schema.jsonValue(),
            "keys": self.keys, "ranges": self._ranges(df.schema), "parts": [version] if rows else [], "gone": [],
        })
        self.prune(keep)
        return version

    def upsert(
        self, source: DataFrame, keys: Sequence[str], update_columns: Sequence[str] | None = None,
        rules: Iterable[Rule] = (), keep: int = 0, notes: dict | None = None, settled: bool = False, asked: DataFrame | None = None,
        **details,
    ) -> int:
        """Idempotent merge; creates the table if absent.  ``rules`` guard the rows written.

        ``details`` are recorded when the table is created and must match them later.

        The source is written down first: it is computed once, and every step sees the same rows.  ``settled`` says that it is
        cheap to read again and has one row per key; then neither is done.  ``asked`` holds the keys of such a source where they
        are cheaper to read than the source itself, which is then computed once, by the write; it may have several rows per key then,
        which take the place of all rows of that key.
        """
        if settled:
            return self._merge(source, source if asked is None else asked, list(keys), update_columns, rules, keep, notes, details)
        staging = f"{self.path}/_staging/{uuid.uuid4().hex}"
        source.write.parquet(staging)
        try:
            rows = self.spark.read.schema(source.schema).parquet(staging)
            require_unique(rows, keys)
            return self._merge(rows, rows, list(keys), update_columns, rules, keep, notes, details)
        finally:
            self._delete(staging)

    def append(self, rows: DataFrame, rules: Iterable[Rule] = (), keep: int = 0, notes: dict | None = None, **details) -> int:
        """Add rows; nothing that is there is read."""
        if not self.exists():
            return self.publish(rows, rules, keep, notes=notes, **details)
        pointer = self.pointer()
        self._require(pointer["details"], details)
        return self._replace(pointer, rows, [], rules, keep, notes)

    def replace_partitions(
        self, wanted: DataFrame, rows: DataFrame, rules: Iterable[Rule] = (), keep: int = 0, notes: dict | None = None
    ) -> int:
        """``rows`` take the place of all rows in the partitions that ``wanted`` names."""
        pointer = self.pointer()
        return self._replace(pointer, rows, self._partition_files(pointer, wanted), rules, keep, notes)

    def note(self, notes: dict) -> int:
        """The same table under new notes."""
        pointer = self.pointer()
        version = max(self._written() + self._published(), default=0) + 1
        self._mark(version)
        self._point({**pointer, "version": version, "notes": notes})
        return version

    def _merge(
        self, source: DataFrame, asked: DataFrame, keys: list[str], update_columns, rules: Iterable[Rule], keep: int, notes: dict | None,
        details: dict,
    ) -> int:
        if not self.exists():
            self.keys = self.keys or keys
            return self.publish(source, rules, keep, notes=notes, **details)
        pointer = self.pointer()
        self._require(pointer["details"], details)
        hit = self._matched_files(pointer, asked, keys)
        if hit is None:
            return pointer["version"]
        if update_columns is None:  # rows of files that are replaced as a whole are not needed
            partly = [f for f, rest in hit.items() if rest]
            kept = self._read_files(pointer, partly)
            kept = kept.join(asked.select(*keys), keys, "left_anti").select(*kept.columns) if partly else kept
            result = kept.unionByName(source, allowMissingColumns=True)
        else:
            result = merged(self._read_files(pointer, hit), source, keys, update_columns)
        return self._replace(pointer, result, list(hit), rules, keep, notes)

    def _replace(self, pointer: dict, result: DataFrame, gone: list[str], rules: Iterable[Rule], keep: int, notes: dict | None, layout: str | None = None) -> int:
        """A version in which the files ``gone`` are replaced by those of ``result``."""
        self.keys, self.stats = pointer["keys"], list(dict.fromkeys([*pointer["ranges"], *self.stats]))
        version, rows = self._write_version(result, rules, layout)
        parts, lost = list(pointer["parts"]), list(pointer["gone"])
        if gone:
            self.spark.createDataFrame([(f,) for f in gone], "file string").coalesce(1).write.parquet(f"{self.path}/_gone/v={version}")
            lost.append(version)
        if rows:
            self._describe(version, result.schema, layout).write.parquet(f"{self.path}/_files/v={version}")
            parts.append(version)
        after = {
            "version": version, "rows": None, "details": pointer["details"], "notes": notes or {}, "schema": result.schema.jsonValue(),
            "keys": self.keys, "ranges": self._ranges(result.schema), "parts": parts, "gone": lost,
        }
        if len(parts) + len(lost) > KEPT_DELTAS:
            whole = f"{self.path}/_files/v={version + 1}"
            self._entries(after).write.parquet(whole)  # numbered as a version of its own, which has no data
            after |= {"parts": [version + 1], "gone": []}
            self._mark(version + 1)
        self._point(after)
        self.prune(keep)
        return version

    def _mark(self, version: int) -> None:
        """Takes a version number that no data will have."""
        fs, p = self._fs(f"{self.path}/v={version}")
        fs.mkdirs(p)

    def _candidates(self, pointer: dict, source: DataFrame, keys: Sequence[str]) -> list[str] | None:
        """Files that may hold a row with the keys of ``source``: by value ranges, then by Bloom filter.  None if it has no row."""
        schema = T.StructType.fromJson(pointer["schema"])
        source = source.select(*[F.col(f"`{k}`").cast(schema[k].dataType).alias(k) for k in keys])  # hashes depend on the type
        bounds = [c for c in keys if c in pointer["ranges"]]
        asked = source.agg(F.count(F.lit(1)).alias("n"), *[f(f"`{c}`").alias(f"{f.__name__}_{i}") for i, c in enumerate(bounds) for f in (F.min, F.max)]).first()
        if not asked.n:
            return None
        found = self._entries(pointer).where(in_ranges({
            c: (asked[f"min_{i}"], asked[f"max_{i}"]) for i, c in enumerate(bounds) if asked[f"min_{i}"] is not None}))
        if list(keys) == pointer["keys"] == filtered(schema, keys) and asked.n <= MOST_ASKED:
            hashes = source.select(key_hash(keys).alias("h")).where("h IS NOT NULL").toPandas()["h"]  # at most MOST_ASKED
            found = holding(found, hashes.to_numpy(np.int64))
        return self._named(found)

    def _matched_files(self, pointer: dict, source: DataFrame, keys: Sequence[str]) -> dict[str, bool] | None:
        """Files with a row to update, and whether they have others besides; None if ``source`` has no row."""
        some = self._candidates(pointer, source, keys)
        if not some:
            return None if some is None else {}
        schema = T.StructType.fromJson(pointer["schema"])
        placed = (
            self.spark.read.schema(schema).option("basePath", self.path).parquet(*[f"{self.path}/{f}" for f in some])
            .select(*[f"`{k}`" for k in keys], F.col("_metadata.file_path").alias("_uri"))
        )
        met = placed.join(source.select(*keys), list(keys), "left_semi").groupBy("_uri").agg(F.count(F.lit(1)).alias("met"))
        held = self._entries(pointer).groupBy("file").agg(F.sum("rows").alias("held"))
        found = met.select(self._place(F.col("_uri")).alias("file"), "met").join(held, "file")
        return {r.file: r.rest for r in found.select("file", (F.col("met") < F.col("held")).alias("rest")).collect()}

    def optimize(self, columns: Sequence[str], files: int, keep: int = 0) -> int:
        """Lay the files that are not yet clustered by ``columns`` along their curve, in about ``files`` files for the whole table.

        Files that an earlier call has laid stay as they are; where there is nothing else, nothing is written.
        """
        pointer = self.pointer()
        layout = ",".join(columns)
        found = self._entries(pointer)
        loose = ~F.col("layout").eqNullSafe(layout)
        names = self._named(found.where(loose))
        if not names:
            return pointer["version"]
        share = found.agg(F.sum(F.when(loose, F.col("rows")).otherwise(0)) / F.sum("rows")).first()[0]
        self.stats = list(dict.fromkeys([*pointer["ranges"], *columns]))
        laid = clustered(self._read_files(pointer, names), columns, max(1, round(files * share)), self.partition_by)
        return self._replace(pointer, laid, names, (), keep, pointer["notes"], layout)

    def prune(self, keep: int) -> None:
        """Drop all but the newest ``keep`` versions, and what no kept version names."""
        if keep <= 0:
            return
        published = self._published()
        held = published[-keep:]
        if held == published:
            return
        pointers = [self.pointer(p) for p in held]
        at = F.regexp_extract("file", r"^v=(\d+)/", 1).cast("int")
        used = {r.v for p in pointers for r in self._entries(p).select(at.alias("v")).distinct().collect()} | set(held)  # version numbers
        described = {v for p in pointers for v in p["parts"]}
        gone = {v for p in pointers for v in p["gone"]}
        for v in published[:-keep]:
            self._delete(f"{self.path}/_published/{v}.json")
        for folder, wanted in ((self.path, used | described), (f"{self.path}/_files", described), (f"{self.path}/_gone", gone)):
            for v in self._numbers(folder):
                if v not in wanted and v < held[-1]:
                    self._delete(f"{folder}/v={v}")

"""What a table knows about its files: rows, value ranges, partition values and a Bloom filter over the keys.

Entries are rows of a table, written by the tasks that read a new version's files once.  A merge asks the entries which files may
hold one of its keys, and opens those only.  A file that several tasks read, or that has many rows, has several entries; it may
hold a key if any of them says so, so no entry is ever put together from parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS_PER_KEY = 12
PROBES = 6
ENTRY_ROWS = 1 << 19  # rows after which a file gets an entry more, so that a task holds a bounded number of hashes
CHUNK = 1 << 16  # hashes that are worked on at a time
MOST_ASKED = 200_000  # keys of a merge that are sent to the tasks; a larger merge compares keys by a join

# Types whose least and greatest values are recorded.  Floats are left out: their order has no place for NaN.
RANGED = (
    T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType,
    T.BooleanType,
)


def key_hash(keys: Sequence[str]) -> Column:
    """Null where a key is null: such rows match nothing."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(f"`{k}`").isNotNull()
    return F.when(known, F.xxhash64(*[F.col(f"`{k}`") for k in keys]))


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bits that a hash sets or asks for, a column each."""
    h = hashes.view(np.uint64)
    first, step = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([(first + np.uint64(i) * step) % np.uint64(bits) for i in range(PROBES)], 1).astype(np.int64)


def bloom(hashes: np.ndarray) -> bytes:
    bits = max(64, -(-BITS_PER_KEY * len(hashes) // 64) * 64)
    out = np.zeros(bits, bool)
    for at in range(0, len(hashes), CHUNK):
        out[_places(hashes[at:at + CHUNK], bits)] = True
    return np.packbits(out).tobytes()


def may_hold(filter_: bytes, hashes: np.ndarray) -> bool:
    """Whether any of the keys may be among those the filter was made of."""
    bits = np.frombuffer(filter_, np.uint8)
    for at in range(0, len(hashes), CHUNK):
        places = _places(hashes[at:at + CHUNK], 8 * len(bits))
        if ((bits[places >> 3] >> (7 - (places & 7)) & 1) == 1).all(1).any():
            return True
    return False


def ranged(schema: T.StructType, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if isinstance(schema[c].dataType, RANGED)]


def filtered(schema: T.StructType, keys: Sequence[str]) -> list[str]:
    """``keys`` if a filter can stand for them; equal floats may have different hashes."""
    return list(keys) if not any(isinstance(schema[k].dataType, (T.FloatType, T.DoubleType)) for k in keys) else []


def entry_schema(schema: T.StructType, ranges: Sequence[str], partition_by: Sequence[str]) -> T.StructType:
    bounds = [T.StructField(f"{end}_{c}", schema[c].dataType) for c in ranges for end in ("min", "max")]
    parts = [T.StructField(f"part_{c}", schema[c].dataType) for c in partition_by]
    return T.StructType([
        T.StructField("file", T.StringType()), T.StructField("rows", T.LongType()), T.StructField("keys", T.BinaryType()),
        T.StructField("layout", T.StringType()), *bounds, *parts])


def place(uri: str, depth: int) -> str:
    """A file's name on disk below its table's folder, ``depth`` partition folders down."""
    found = re.search(r"/(v=\d+/(?:[^/]+/){%d}[^/]+)$" % depth, uri)
    return unquote(found[1]) if found else ""


def entries(placed: DataFrame, schema: T.StructType, keys: Sequence[str], ranges: Sequence[str], partition_by: Sequence[str], layout: str | None) -> DataFrame:
    """Entries of the files of ``placed``, a table with their URIs in ``_file``.

    Rows come file by file, and an entry ends with its file or after ``ENTRY_ROWS`` rows: a task holds the hashes of one entry.
    """
    out = entry_schema(schema, ranges, partition_by)
    hashed = key_hash(keys) if keys else F.lit(None).cast("long")
    picked = placed.select(
        F.col("_file"), hashed.alias("_hash"), *[F.col(f"`{c}`").alias(f"r{i}") for i, c in enumerate(ranges)],
        *[F.col(f"`{c}`").alias(f"p{i}") for i, c in enumerate(partition_by)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, rows, hashes, bounds, parts = None, 0, [], [], []

        def done() -> pa.RecordBatch:
            values = {"file": place(name, len(partition_by)), "rows": rows, "keys": bloom(np.concatenate(hashes)) if keys else None, "layout": layout}
            for c, (low, high) in zip(ranges, bounds, strict=True):
                values |= {f"min_{c}": low, f"max_{c}": high}
            values |= {f"part_{c}": v for c, v in zip(partition_by, parts, strict=True)}
            return pa.RecordBatch.from_pylist([values], arrow)

        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        for batch in batches:
            files = batch.column("_file").dictionary_encode()
            ids = files.indices.to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(ids)) + 1, [len(ids)]])
            for at, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if at == end:
                    continue
                part, own = batch.slice(at, end - at), files.dictionary[int(ids[at])].as_py()
                if own != name:
                    if name is not None:
                        yield done()
                    name, rows, hashes, bounds = own, 0, [], [(None, None)] * len(ranges)
                    parts = [part.column(f"p{i}")[0].as_py() for i in range(len(partition_by))]
                rows += end - at
                hashes.append(part.column("_hash").drop_null().to_numpy(zero_copy_only=False))
                for i in range(len(ranges)):
                    found = pc.min_max(part.column(f"r{i}")).as_py()
                    lows, highs = ([v for v in pair if v is not None] for pair in zip(bounds[i], (found["min"], found["max"]), strict=True))
                    bounds[i] = (min(lows, default=None), max(highs, default=None))
                if rows >= ENTRY_ROWS:
                    yield done()
                    name = None
        if name is not None:
            yield done()

    return picked.mapInArrow(run, out)


def in_ranges(asked: dict[str, tuple]) -> Column:
    """Entries whose recorded ranges meet ``{column: (least, greatest)}``; unknown ones may."""
    holds = F.lit(True)
    for c, (low, high) in asked.items():
        least, greatest = F.col(f"`min_{c}`"), F.col(f"`max_{c}`")
        holds = holds & (least.isNull() | ((least <= F.lit(high)) & (greatest >= F.lit(low))))
    return holds


def holding(found: DataFrame, hashes: np.ndarray) -> DataFrame:
    """(file): entries whose filter lets one of ``hashes`` through; at most ``MOST_ASKED`` of them are sent to the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met = [not f.is_valid or may_hold(f.as_buffer(), hashes) for f in batch.column("keys")]
            yield pa.RecordBatch.from_arrays([batch.column("file").filter(pa.array(met, pa.bool_()))], ["file"])

    return found.select("file", "keys").mapInArrow(run, "file string")

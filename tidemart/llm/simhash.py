"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are 64-bit majority votes over the XXH64 values of 4-word shingles.  Two fingerprints are linked when they
differ in at most ``RADIUS`` bits.  Equal fingerprints form one class first, so copies cost one row from there on.

Comparison is exact and runs in tiles: numpy exclusive-or of a tile pair and a bit count of the result.  Tiles are ordered
by population count, and a tile pair whose counts differ by more than the radius is skipped, since each differing bit
changes the count by one.  A tile pair that already lies in one component is skipped as well: it cannot change the result.

All tile pairs of a corpus would still grow with its square, as most fingerprints have 28 to 36 bits set.  So the tile grid is
laid out per value of a pair of bit segments: of six segments, four differing bits leave two untouched, hence every linked
pair meets in at least one of the fifteen grids.  No link is lost.  A grid with more than ``GRID_ROWS`` fingerprints is cut
into blocks whose pairs go to different tasks.

A task returns a spanning forest of the links it finds, never all pairs; stars of these give the components.

Null and empty texts have fingerprint zero and are linked like any other.  Null doc_ids are allowed: they count last
when a component takes its smallest doc_id.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, staged
from .components import components

RADIUS = 4
WORDS = 4
SEED = 42
SEGMENTS = (11, 11, 11, 11, 10, 10)  # widths; two of six survive four differing bits
TILE = 1024
GRID_ROWS = 50_000
BLOCK = 1 << 16


def fingerprint(text: str | None) -> int:
    """The unsigned fingerprint of one text."""
    # On bytes, lower() changes A-Z only and split() cuts at 09-0D and 20 only.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < WORDS:
        shingles = iter([b" ".join(words)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(WORDS)), strict=False))
        n = len(words) - WORDS + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        size = min(BLOCK, n - at)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED, size)) if size == n else
                             (xxhash.xxh64_intdigest(next(shingles), SEED) for _ in range(size)), np.uint64, size)
        ones += np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp): fp holds the fingerprint's bits in a signed bigint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(fp)], ["doc_id", "text_hash", "fp"])

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, f"doc_id {kind}, text_hash bigint, fp bigint")


def grid_keys(classes: DataFrame, widths: tuple[int, ...] = SEGMENTS) -> DataFrame:
    """(grid, fp): one row per fingerprint and pair of segments; grid holds the pair's number and its bits."""
    starts = [sum(widths[:i]) for i in range(len(widths))]

    def part(i: int) -> F.Column:
        return F.shiftrightunsigned("fp", starts[i]).bitwiseAND(F.lit((1 << widths[i]) - 1).cast("bigint"))

    keys = [
        F.lit(k << 32).cast("bigint") + F.shiftleft(part(i), widths[j]) + part(j)
        for k, (i, j) in enumerate(combinations(range(len(widths)), 2))
    ]
    return classes.select("fp", F.explode(F.array(*keys)).alias("grid"))


def in_cells(keys: DataFrame, grid_rows: int = GRID_ROWS) -> DataFrame:
    """(grid, cell, fp): grids above ``grid_rows`` are cut into blocks; a cell holds two blocks of them.

    The list of large grids is written down before the join, so that a large grid can be split there.
    """
    large = staged(keys.sparkSession, keys.groupBy("grid").count().where(F.col("count") > grid_rows).select(
        "grid", F.ceil(F.col("count") / grid_rows).cast("int").alias("blocks")), "large-grids")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    cells = F.expr("transform(sequence(0, blocks - 1), b -> least(own, b) * blocks + greatest(own, b))")
    return (
        keys.join(large, "grid", "left").withColumn("own", own)
        .select("grid", "fp", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(cells)).alias("cell"))
    )


class _Forest:
    """Union-find over 0..n-1; the root is the smallest member."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def _linked_tiles(forest: _Forest, left: np.ndarray, right: np.ndarray, a: int, b: int, radius: int) -> None:
    """Join what is linked between two tiles that begin at ``a`` and ``b``."""
    near = np.bitwise_count(left[:, None] ^ right[None, :]) <= radius
    if a == b:
        np.fill_diagonal(near, False)
    hits = np.count_nonzero(near)
    if not hits:
        return
    if hits <= 2 * TILE:
        for i, j in zip(*np.nonzero(near), strict=True):
            forest.join(a + int(i), b + int(j))
        return
    # Many links: spread least labels over the whole tile at once.
    x = np.array([forest.root(a + i) for i in range(len(left))])
    y = np.array([forest.root(b + j) for j in range(len(right))])
    x0, y0, big = x, y, np.iinfo(np.int64).max
    while True:
        x1 = np.minimum(x, np.where(near, y[None, :], big).min(1))
        y1 = np.minimum(y, np.where(near, x1[:, None], big).min(0))
        if np.array_equal(x, x1) and np.array_equal(y, y1):
            break
        x, y = x1, y1
    for old, new in {*zip(x0.tolist(), x.tolist(), strict=True), *zip(y0.tolist(), y.tolist(), strict=True)}:
        forest.join(old, new)


def forest_of(values: np.ndarray, radius: int = RADIUS, tile: int = TILE) -> list[tuple[int, int]]:
    """(place, root place) links that connect what is within ``radius``; ``values`` are uint64 in order of bit count."""
    forest, n = _Forest(len(values)), len(values)
    ones = np.bitwise_count(values)
    for a in range(0, n, tile):
        left, most = values[a:a + tile], int(ones[min(a + tile, n) - 1])
        for b in range(a, n, tile):
            if int(ones[b]) - most > radius:  # and so are all tiles behind it
                break
            right = values[b:b + tile]
            if b > a and n > 2 * tile:
                roots = {forest.root(i) for i in range(a, a + len(left))} | {forest.root(i) for i in range(b, b + len(right))}
                if len(roots) == 1:
                    continue
            _linked_tiles(forest, left, right, a, b, radius)
    return [(i, r) for i in range(n) if (r := forest.root(i)) != i]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (grid, cell, bit count); a run of equal (grid, cell) is compared at once."""
    rest: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def compare(grid, cell, fp, u: list, v: list) -> None:
        edges = np.flatnonzero((grid[1:] != grid[:-1]) | (cell[1:] != cell[:-1])) + 1
        starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(fp)]])
        for s in np.flatnonzero(ends - starts > 1):
            values = fp[starts[s]:ends[s]]
            for i, r in forest_of(values.view(np.uint64)):
                u.append(int(values[i]))
                v.append(int(values[r]))

    def columns(parts):
        return [np.concatenate(c) for c in zip(*parts, strict=True)]

    def out(u: list, v: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    for batch in batches:
        grid, cell, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("grid", "cell", "fp"))
        if not len(fp):
            continue
        same = (grid == grid[-1]) & (cell == cell[-1])
        cut = 0 if same.all() else len(fp) - int(np.argmin(same[::-1]))
        if cut:
            u, v = [], []
            rest.append((grid[:cut], cell[:cut], fp[:cut]))
            compare(*columns(rest), u, v)
            rest = []
            if u:
                yield out(u, v)
        elif rest and (rest[-1][0][-1], rest[-1][1][-1]) != (grid[0], cell[0]):
            u, v = [], []
            compare(*columns(rest), u, v)
            rest = []
            if u:
                yield out(u, v)
        rest.append((grid[cut:], cell[cut:], fp[cut:]))
    if rest:
        u, v = [], []
        compare(*columns(rest), u, v)
        if u:
            yield out(u, v)


def links(spark: SparkSession, classes: DataFrame, grid_rows: int = GRID_ROWS) -> DataFrame:
    """(u, v): a spanning forest of the links between distinct fingerprints."""
    cells = in_cells(grid_keys(classes), grid_rows)
    dealt = cells.repartition("grid", "cell").sortWithinPartitions("grid", "cell", F.bit_count("fp"))
    return dealt.select("grid", "cell", "fp").mapInArrow(_links, "u bigint, v bigint")


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, grid_rows: int = GRID_ROWS) -> DataFrame:
    """(doc_id, text_hash, fp, group_fp, component_id) per document; group_fp names the component."""
    prints = staged(spark, fingerprints(docs), "fingerprints")
    classes = staged(spark, prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "classes")
    roots = components(spark, links(spark, classes, grid_rows)).select(F.col("u").alias("fp"), F.col("root").alias("group_fp"))
    grouped = staged(spark, classes.join(roots, "fp", "left").withColumn("group_fp", F.coalesce("group_fp", "fp")), "grouped")
    least = staged(spark, grouped.groupBy("group_fp").agg(F.min("least_id").alias("component_id")), "least-ids")
    named = grouped.select("fp", "group_fp").join(least, "group_fp")
    return prints.join(named, "fp").select("doc_id", "text_hash", "fp", "group_fp", "component_id")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest doc_id (then text hash); columns as they were.

    Repeated rows (equal doc_id and text) count as one document: one of them stays.
    """
    groups = near_duplicate_groups(spark, docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("text_hash"))).alias("first")
    stay = staged(spark, groups.groupBy("group_fp").agg(first).select(
        F.col("first.doc_id").alias("stay_id"), F.col("first.text_hash").alias("stay_hash")), "staying")
    d = docs.alias("d")
    met = d.join(
        stay.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.stay_id")) & (F.xxhash64("d.text") == F.col("s.stay_hash")))
    return met.dropDuplicates(["stay_id", "stay_hash"]).select("d.*")

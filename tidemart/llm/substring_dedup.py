"""Substring deduplication by content-defined chunks.

A gear rolling hash runs over the bytes of a text: ``h = 2 h + GEAR[byte]`` in 16 bits, so it depends on the last 16 bytes
only.  A chunk ends where the hash falls below a threshold, or is the least within ``REACH`` places on both sides, and the chunk has
its least size.  The second rule cuts stretches in which the hash never falls below the threshold; in a repetition it holds once a
period, at the same place of each, so copies of a repetition are cut alike too.  Boundaries follow content: after
an insertion they fall into step again, and passages that two texts share are cut alike.  Chunks are told apart by a
128-bit digest.

A chunk repeats when an earlier place in the same document, or an earlier document, has it: one with a smaller doc_id or, under the
same doc_id, with a smaller hash of its text; documents without a doc_id come last.  Consecutive repeated
chunks form a run, which is extended byte by byte into the chunks beside it, as far as the first copy's document has the same
bytes around its chunk; runs of at least ``LEAST_BYTES`` bytes are then reported, and can be cut out.

Behind a chunk, the document and the first copy's cannot agree for more than the next chunk and the ``REACH`` bytes that decide its
end, or that chunk would repeat itself.  Before it there is no such bound: ``LOOK`` bytes are compared, and where all of them agree
sixteen times as many, and so on.  Only such surroundings leave the texts, each once.

Most chunks occur once.  They are told from the others by half of their digest alone, counted map-side; only chunks whose half
repeats travel with their places.  The tables of repeated halves, of first copies and of texts around chunks are written down before they
are joined, so both sides of each join have an exchange of their own and the skew-join rule splits a passage that a third of
all documents hold.  Of the first copy's text one stretch per chunk is fetched, which covers all its copies ask for.  A document is never
joined with another one.  What is read no more is deleted on the way.

Null and empty texts have no chunks.  Repeated rows (one doc_id and text) count as one document, also those without a doc_id.
Chunks of null doc_ids repeat those of known ones, never the reverse.  Offsets are bytes of the UTF-8 text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import dropped, small_batches, staged

LEAST_CHUNK = 20
REACH = 24
LOOK = 256
MEAN_GAP = 20  # mean distance of cut places; chunks then have about 40 bytes
LEAST_BYTES = 112
#: A fixed pseudo-random number for each byte, from a rule.
GEAR = np.array([xxhash.xxh64_intdigest(bytes([b]), 7) & 0xFFFF for b in range(256)], np.uint16)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte.  Doubling the window four times gives the sum of 16 shifted terms."""
    h = GEAR[data]
    for width in (1, 2, 4, 8):
        wider = h.copy()
        wider[width:] += h[:-width] << np.uint16(width)
        h = wider
    return h


def low_places(h: np.ndarray, reach: int = REACH) -> np.ndarray:
    """Where no hash within ``reach`` places on both sides is less; never nearer to an end of the text."""
    span = 2 * reach + 1
    if len(h) < span:
        return np.zeros(0, np.int64)
    least, width = h, 1
    while 2 * width <= span:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    rest = span - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    return np.flatnonzero(h[reach:len(h) - reach] == least) + reach


def cut_places(data: np.ndarray, least: int = LEAST_CHUNK, gap: int = MEAN_GAP) -> list[int]:
    """Ends of the chunks of one text; the last is the text's end."""
    cuts, last = [], 0
    h = gear_hashes(data) if len(data) else np.zeros(0, np.uint16)
    for at in (np.union1d(np.flatnonzero(h < (1 << 16) // gap), low_places(h)) + 1).tolist():
        if at - last >= least:
            cuts.append(at)
            last = at
    if last < len(data):
        cuts.append(len(data))
    return cuts


def chunks_of(text: str | None, least: int = LEAST_CHUNK, gap: int = MEAN_GAP) -> list[tuple[int, int, bytes]]:
    """(start, size, digest) of the chunks of one text."""
    raw = (text or "").encode()
    out, start = [], 0
    for end in cut_places(np.frombuffer(raw, np.uint8), least, gap):
        out.append((start, end - start, xxhash.xxh3_128_digest(raw[start:end])))
        start = end
    return out


def chunks(docs: DataFrame, least: int = LEAST_CHUNK, gap: int = MEAN_GAP) -> DataFrame:
    """(doc_id, text_hash, row, start, size, next_size, again, hi, lo): one row per chunk.

    ``row`` numbers the rows of ``docs``; ``again`` tells that the document has had the chunk before.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                found = [chunks_of(t, least, gap) for t in part.column("text").to_pylist()]
                again = []
                for cs in found:
                    seen: set = set()
                    for _, _, d in cs:
                        again.append(d in seen)
                        seen.add(d)
                flat = [c for cs in found for c in cs]
                digests = np.frombuffer(b"".join([c[2] for c in flat]), "<i8").reshape(-1, 2)
                rows = np.repeat(np.arange(len(found)), [len(cs) for cs in found])
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(rows)), part.column("text_hash").take(pa.array(rows)), part.column("row").take(pa.array(rows)),
                    pa.array([c[0] for c in flat], pa.int32()),
                    pa.array([c[1] for c in flat], pa.int32()),
                    pa.array([n for cs in found for n in [*[c[1] for c in cs[1:]], *[0] * bool(cs)]], pa.int32()), pa.array(again, pa.bool_()),
                    pa.array(np.ascontiguousarray(digests[:, 0])), pa.array(np.ascontiguousarray(digests[:, 1])),
                ], ["doc_id", "text_hash", "row", "start", "size", "next_size", "again", "hi", "lo"])

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("row"), "text").mapInArrow(
        run, f"doc_id {kind}, text_hash bigint, row bigint, start int, size int, next_size int, again boolean, hi bigint, lo bigint")


def common_ends(mine: bytes, theirs: bytes, left: int, size: int) -> tuple[int, int]:
    """By how many bytes two equal chunks can be extended, to the left and to the right, in whole characters of ``mine``."""
    def same(n: int, equal) -> int:
        low = 0
        while low < n:
            mid = (low + n + 1) // 2
            low, n = (mid, n) if equal(mid) else (low, mid - 1)
        return low

    end = left + size
    before = same(left, lambda k: mine[left - k:left] == theirs[left - k:left])
    after = same(min(len(mine), len(theirs)) - end, lambda k: mine[end:end + k] == theirs[end:end + k])
    while 0 < before < left and mine[left - before] >> 6 == 2:
        before -= 1
    while after and end + after < len(mine) and mine[end + after] >> 6 == 2:
        after -= 1
    return before, after


def _same(a: DataFrame, b: DataFrame, names: dict[str, str]):
    """Join condition: the columns of ``a`` equal those of ``b``, null as a value of its own."""
    tests = [a[x].eqNullSafe(b[y]) for x, y in names.items()]
    return reduce(lambda x, y: x & y, tests)


def _extents(spark: SparkSession, docs: DataFrame, repeats: DataFrame, look: int) -> DataFrame:
    """``repeats`` with before and after: the bytes by which each can be extended, at most ``look`` to the left."""
    edges = repeats.withColumn("left", F.least("gap", "first_start", F.lit(look))).withColumn("right", F.col("size") + F.col("room"))
    # One stretch per chunk, that covers what all its copies ask for.
    asked = edges.select("doc_id", "text_hash", "start", "left", "right").union(
        edges.select("first_doc_id", "first_hash", "first_start", "left", "right")
    ).groupBy("doc_id", "text_hash", "start").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    per_text = asked.groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).agg(
        F.collect_list(F.struct("start", "left", "right")).alias("asked"))  # of one document, one for each of its chunks at the most
    per_text = staged(spark, per_text, "asked")
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    pieces = staged(spark, (
        texts.join(per_text, _same(texts, per_text, {"doc_id": "d", "text_hash": "h"}))
        .select("d", "h", F.col("text").cast("binary").alias("raw"), F.explode("asked").alias("a"))
        .select("d", "h", F.col("a.start").alias("s"), F.col("a.left").alias("l"),
                F.substring("raw", F.col("a.start") - F.col("a.left") + 1, F.col("a.left") + F.col("a.right")).alias("piece"))
    ), "pieces")
    mine = pieces.toDF("d1", "h1", "s1", "my_left", "mine")
    theirs = pieces.toDF("d2", "h2", "s2", "their_left", "theirs")
    joined = edges.join(mine, _same(edges, mine, {"doc_id": "d1", "text_hash": "h1", "start": "s1"}))
    joined = joined.join(theirs, _same(joined, theirs, {"first_doc_id": "d2", "first_hash": "h2", "first_start": "s2"}))
    names = repeats.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = [batch.column(n).to_pylist() for n in ("mine", "my_left", "theirs", "their_left", "left", "right", "size")]
            ends = [common_ends(mine[a - left:a + right], theirs[b - left:b + right], left, size)
                    for mine, a, theirs, b, left, right, size in zip(*asked, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array([e[0] for e in ends], pa.int32()), pa.array([e[1] for e in ends], pa.int32())],
                [*names, "before", "after"])

    kinds = T.StructType([*repeats.schema.fields, T.StructField("before", T.IntegerType()), T.StructField("after", T.IntegerType())])
    found = joined.select(*names, "left", "right", "mine", "my_left", "theirs", "their_left").mapInArrow(run, kinds)
    found = staged(spark, found, "extents")
    dropped(spark, pieces)
    return found


def extended(spark: SparkSession, docs: DataFrame, repeats: DataFrame) -> DataFrame:
    """``repeats`` with before and after, however far their documents agree."""
    look, parts = LOOK, []
    while True:
        found = _extents(spark, docs, repeats, look)
        further = (F.col("before") == look) & (F.least("gap", "first_start") > look)
        parts.append(found.where(~further))
        rest = found.where(further)
        if rest.isEmpty():
            return reduce(DataFrame.unionByName, parts)
        repeats, look = rest.drop("before", "after"), 16 * look


def repeated_runs(spark: SparkSession, docs: DataFrame, least_bytes: int = LEAST_BYTES, least: int = LEAST_CHUNK,
                  gap: int = MEAN_GAP) -> DataFrame:
    """(doc_id, text_hash, run_start, run_bytes, first_doc_id, shared_bytes): repeated runs of every document.

    A run has one row for each document that holds the first copy of some of its chunks, with the bytes found there.
    """
    cut = staged(spark, chunks(docs, least, gap), "chunks")
    twice = staged(spark, cut.groupBy("lo").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("lo"), "repeated-halves")
    known_rows = staged(spark, cut.where("start = 0").select("row", "doc_id", "text_hash"), "chunk-rows")
    some = staged(spark, cut.drop("doc_id", "text_hash").join(twice, "lo", "left_semi").join(known_rows, "row"), "some-chunks")
    dropped(spark, cut)
    holder = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash", "start"))
    known = staged(spark, some.groupBy("hi", "lo").agg(F.count("*").alias("copies"), holder.alias("first")).where("copies > 1")
                   .select("hi", "lo", F.col("first.doc_id").alias("first_doc_id"), F.col("first.text_hash").alias("first_hash"),
                           F.col("first.start").alias("first_start")), "first-copies")
    document = ("doc_id", "text_hash")
    repeats = some.join(known, ["hi", "lo"]).where(
        "again OR NOT (doc_id <=> first_doc_id AND text_hash = first_hash)").drop("hi", "lo", "again", "row")
    by_place = Window.partitionBy(*document).orderBy("start")
    # Repeated rows bring a place twice; it is taken once.
    placed = repeats.withColumn("earlier", F.lag("start", 1, -1).over(by_place)).where("start > earlier").drop("earlier")
    end = F.col("start") + F.col("size")
    behind = F.lead("start").over(by_place) - end
    # gap: bytes since the repeat before it; room: bytes that can agree behind it.
    placed = placed.withColumn("gap", F.col("start") - F.lag(end, 1, 0).over(by_place)).withColumn(
        "room", F.least(behind, F.when(F.col("next_size") > 0, F.col("next_size") + REACH + 1).otherwise(0))).drop("next_size")
    placed = staged(spark, placed, "repeats")
    inner = placed.where("gap = 0 AND room = 0").withColumns({"before": F.lit(0), "after": F.lit(0)})
    whole = inner.unionByName(extended(spark, docs, placed.where("gap > 0 OR room > 0")))
    # Where two repeats meet between them, the bytes count once.
    sized = whole.withColumn("earlier", F.lag("start", 1, -1).over(by_place)).where("start > earlier") \
        .withColumn("ended", F.lag(end + F.col("after"), 1, -1).over(by_place))
    sized = sized.withColumn("from", F.greatest(F.col("start") - F.col("before"), "ended")).withColumn("bytes", end + F.col("after") - F.col("from"))
    runs = sized.withColumn("run", F.sum((F.col("from") > F.col("ended")).cast("int")).over(by_place))
    by_run = Window.partitionBy(*document, "run")
    return (
        runs.groupBy(*document, "run", "first_doc_id")
        .agg(F.min("from").alias("from"), F.sum("bytes").alias("shared_bytes"))
        .withColumn("run_bytes", F.sum("shared_bytes").over(by_run)).withColumn("run_start", F.min("from").over(by_run))
        .where(F.col("run_bytes") >= least_bytes)
        .select(*document, F.col("run_start").cast("bigint").alias("run_start"), "run_bytes", "first_doc_id", "shared_bytes")
    )


def without_runs(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """``docs`` with the bytes of ``runs`` cut out of their texts; other columns as they were."""
    names = docs.columns
    cuts = "cuts_"
    while cuts in names:
        cuts += "_"
    per_doc = runs.select("doc_id", "text_hash", "run_start", "run_bytes").distinct().groupBy(
        F.col("doc_id").alias("cut_id_"), F.col("text_hash").alias("cut_hash_")).agg(
        F.sort_array(F.collect_list(F.struct("run_start", "run_bytes"))).alias(cuts))  # the runs of one document

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, places in zip(batch.column("text").to_pylist(), batch.column(cuts).to_pylist(), strict=True):
                if places:
                    raw, out, at = text.encode(), [], 0
                    for p in places:
                        out.append(raw[at:p["run_start"]])
                        at = p["run_start"] + p["run_bytes"]
                    text = b"".join([*out, raw[at:]]).decode("utf-8", "ignore")  # a cut may fall within a character
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names], names)

    same = docs["doc_id"].eqNullSafe(per_doc["cut_id_"]) & (F.xxhash64(docs["text"]) == per_doc["cut_hash_"])
    joined = docs.join(per_doc, same, "left").drop("cut_id_", "cut_hash_")
    return joined.mapInArrow(cut, T.StructType(docs.schema.fields))

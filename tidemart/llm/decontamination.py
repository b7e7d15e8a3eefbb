"""Benchmark decontamination with one Aho-Corasick automaton.

Words are runs of characters other than ASCII separators, after lower-casing A-Z.  Every window of ``WINDOW`` consecutive
words of a benchmark item (a shorter item is one window) is a pattern; the automaton holds each distinct window once, with
the items it comes from.  A document is normalised to single spaces and scanned once.  Matches mark words, and word places lead
back to offsets in the original text.

The benchmark is read to the driver only after its size was asked for: items are dealt into blocks of at most
``BLOCK_WORDS`` words, one automaton each.  One block is the usual case.  Further blocks cost one more scan each, of the same
documents, and their hits are united.  Only an item that is larger than a block by itself makes a block exceed the bound.

Null texts have no words.  Items with a null item_id mark words but are not counted as items.  Items repeated under one id
count once.  An empty benchmark leaves all documents without hits.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, small_batches, staged

WINDOW = 13
BLOCK_WORDS = 100_000
SHARE = 20  # a document is contaminated when at least one word in SHARE is hit

#: The word pattern over texts that still have capital letters.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_TO_SPACES = bytes(0x20 if i in _SEPARATORS else i for i in range(256))


def words_of(text: str | None) -> list[bytes]:
    # lower() on bytes changes A-Z only; bytes above 7F belong to words.
    return (text or "").encode().lower().translate(_TO_SPACES).split()


def windows_of(text: str | None, size: int = WINDOW) -> Iterator[tuple[str, int]]:
    """(window with a space at both ends, its number of words)."""
    words = words_of(text)
    if words:
        n = min(size, len(words))
        for i in range(len(words) - n + 1):
            yield f" {b' '.join(words[i:i + n]).decode()} ", n


def automaton(items: list[tuple[object, str | None]], size: int = WINDOW) -> ahocorasick.Automaton:
    """Values: (number of words, item ids)."""
    found: dict[str, tuple[int, set]] = defaultdict(lambda: (0, set()))
    for item_id, text in items:
        for window, n in windows_of(text, size):
            found[window] = (n, found[window][1] | ({item_id} if item_id is not None else set()))
    machine = ahocorasick.Automaton()
    for window, (n, ids) in found.items():
        machine.add_word(window, (n, tuple(ids)))
    if found:
        machine.make_automaton()
    return machine


def scan(machine: ahocorasick.Automaton, text: str | None) -> tuple[int, set, np.ndarray]:
    """Number of words, ids of items met, places of the words hit."""
    words = words_of(text)
    items: set = set()
    none = np.zeros(0, np.int64)
    if not words or not len(machine):
        return len(words), items, none
    flat = f" {b' '.join(words).decode()} "
    matches = list(machine.iter(flat))
    if not matches:
        return len(words), items, none
    spaces = [m.start() for m in re.finditer(" ", flat)]
    step = np.zeros(len(words) + 1, np.int64)
    for end, (n, ids) in matches:
        last = bisect_left(spaces, end)  # a match ends at the space behind its last word
        step[last - n] += 1
        step[last] -= 1
        items.update(ids)
    return len(words), items, np.flatnonzero(np.cumsum(step[:-1]))


def spans(text: str, hit: np.ndarray) -> list[tuple[int, int]]:
    """Character ranges of the original text that runs of hit words cover."""
    if not len(hit):
        return []
    places = [m.span() for m in WORD.finditer(text)]
    runs = np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1)
    return [(places[r[0]][0], places[r[-1]][1]) for r in runs]


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))

_BUILT: dict[str, list] = {}


def blocks_of(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple]]:
    """Items in blocks of bounded size, one at a time; counted by Spark before any text is fetched."""
    sized = benchmark.where("text IS NOT NULL").select(
        "item_id", "text", F.ceil((F.length("text") + 1) / 2).alias("size"))  # a word has a character and a separator
    total = sized.agg(F.sum("size")).first()[0] or 0
    count = -(-int(total) // block_words) or 1
    if count == 1:
        yield [(r.item_id, r.text) for r in sized.collect()]
        return
    dealt = sized.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(2 * count)))
    for b in range(2 * count):
        block = [(r.item_id, r.text) for r in dealt.where(F.col("block") == b).collect()]
        if block:
            yield block


def _scan_schema(docs: DataFrame, names: list[str]) -> T.StructType:
    return T.StructType([docs.schema[c] for c in names] + [
        T.StructField("n_words", T.LongType()), T.StructField("hit", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", SPANS),
    ])


def _scanned(docs: DataFrame, items: list[tuple], names: list[str], size: int) -> DataFrame:
    """``names`` columns plus n_words, hit (places), items, spans."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(items)  # one block
    token = hashlib.sha256(repr((size, items)).encode()).hexdigest()
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One automaton per worker process, not per task.
        from tidemart.llm import decontamination as here

        if token not in here._BUILT:
            here._BUILT.clear()
            here._BUILT[token] = [automaton(sent.value, size)]
        machine = here._BUILT[token][0]
        for batch in batches:
            n_words, hits, met, ranges = [], [], [], []
            for text in batch.column("text").to_pylist():
                n, ids, hit = scan(machine, text)
                n_words.append(n)
                hits.append(hit)
                met.append(sorted(map(str, ids)))
                ranges.append([{"start": s, "end": e} for s, e in spans(text or "", hit)])
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in names), pa.array(n_words, pa.int64()), pa.array(hits, pa.list_(pa.int64())),
                pa.array(met, pa.list_(pa.string())), pa.array(ranges, kind),
            ], [*names, "n_words", "hit", "items", "spans"])

    asked = names if "text" in names else [*names, "text"]
    return docs.select(*[f"`{c}`" for c in asked]).mapInArrow(run, _scan_schema(docs, names))


def _united(docs: DataFrame, blocks: Iterable[list[tuple]], names: list[str], size: int) -> DataFrame:
    """As :func:`_scanned` for several blocks: a scan for each, whose word places are united per document before spans are read off."""
    spark = docs.sparkSession
    rid, own, places, ids = (free_name(docs, n) for n in ("row", "text", "hit", "items"))
    rows = staged(spark, docs.withColumn(rid, F.monotonically_increasing_id()), "numbered")
    met = None
    for block in blocks:
        one = staged(spark, _scanned(rows, block, [rid], size).where("size(hit) > 0").select(rid, "hit", "items"), "scanned")
        met = one if met is None else met.unionByName(one)
    both = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))  # noqa: E731  of one document
    met = met.groupBy(rid).agg(both("hit").alias(places), both("items").alias(ids))
    joined = rows.join(met, rid, "left").select(*[f"`{c}`" for c in names], F.col("text").alias(own), places, ids)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(own).to_pylist()]
            hits, items = ([x or [] for x in batch.column(c).to_pylist()] for c in (places, ids))
            ranges = [[{"start": s, "end": e} for s, e in spans(t, np.array(h, np.int64))] for t, h in zip(texts, hits, strict=True)]
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in names), pa.array([sum(1 for _ in WORD.finditer(t)) for t in texts], pa.int64()),
                pa.array(hits, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string())), pa.array(ranges, kind),
            ], [*names, "n_words", "hit", "items", "spans"])

    return joined.mapInArrow(run, _scan_schema(docs, names))


def contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, size: int = WINDOW,
                  share: int = SHARE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``keep`` columns (all, if None) plus n_words, n_hit, items (ids as sorted text), spans, contaminated.

    Columns of these names in ``docs`` are replaced.
    """
    small_batches(docs.sparkSession)
    made = ("n_words", "hit", "n_hit", "items", "spans", "contaminated")
    names = [c for c in (keep if keep is not None else docs.columns) if c not in made]
    blocks = blocks_of(benchmark, block_words)
    block, another = next(blocks, []), next(blocks, None)
    if another is None:
        found = _scanned(docs, block, names, size)
    else:
        found = _united(docs, chain([block, another], blocks), names, size)
    n_hit = F.size("hit").cast("long")
    return found.select(*[f"`{c}`" for c in names], "n_words", n_hit.alias("n_hit"), "items", "spans",
                        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"))

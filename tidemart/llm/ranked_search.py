"""Ranked lexical search by NRA: no random access, only sequential reads of lists sorted by impact.

One pass turns every text into its terms that some item asks for, with their counts, and is written down; number and length of
documents and document frequencies come from it.  A task then takes its documents in blocks of bounded size, sorts the
postings of each term of a block by impact, and for every item reads the item's lists from the top, some entries of each
at a time.  Each document of the block has a lower score (what was read) and an upper one (plus what its unread lists may
still give, the impact next in each).  Reading ends when no document whose two bounds differ could still be among the k best,
ties by doc_id included: then membership, order and final scores are settled, by integers throughout.  A task keeps its k best from
block to block, so that later blocks end their reading early.  The k best of the tasks are ranked per item in two steps, first
within groups of tasks.

Items are searched in parts whose terms number about ``PART_TERMS``, so what is sent to every task stays bounded; each part
is a pass over all documents.

Null and empty texts have no term, do not count as documents and are never found; items without a term find nothing.
Repeated rows are documents of their own, with ranks of their own.  A null doc_id comes after all others in ties.  Rows of equal
item_id are items of their own.  Very long texts are one row of counts.  An empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small_batches, staged

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
K = 10
PART_TERMS = 200_000  # terms of the items searched in one pass
BLOCK_DOCS, BLOCK_POSTINGS = 8_192, 2_000_000  # of one block
FIRST_READ = 64  # entries of each list in the first round; doubled each time
TASK_GROUP = 512  # tasks whose results are ranked together in the first step
NO_ID = np.iinfo(np.int64).max


def terms_of(text: str | None) -> list[str]:
    return TERM.findall((text or "").encode().translate(LOWER).decode())


# ---- index -----------------------------------------------------------------------------

def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): distinct terms per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(set(terms_of(t))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(terms, pa.list_(pa.string()))], ["item_id", "terms"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, terms array<string>")


def doc_counts(docs: DataFrame, numbers: dict[str, int]) -> DataFrame:
    """(doc_id, n, ids, tfs) of documents with a term: all their terms, and those of ``numbers`` with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = numbers.keys()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = terms_of(text)
                if found:
                    counts = Counter(found)
                    known = asked & counts.keys()
                    rows.append((doc_id, len(found), [numbers[t] for t in known], [counts[t] for t in known]))
            ids, n, lists, tfs = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(lists, pa.list_(pa.int32())),
                pa.array(tfs, pa.list_(pa.int32()))], ["doc_id", "n", "ids", "tfs"])

    texts = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(run, "doc_id long, n long, ids array<int>, tfs array<int>")


def document_frequencies(counted: DataFrame, size: int) -> list[int]:
    """Documents with each of ``size`` numbered terms; tasks sum up what they see."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size, np.int64)
        for batch in batches:
            seen += np.bincount(batch.column("ids").flatten().to_numpy(), minlength=size)
        at = np.nonzero(seen)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at], pa.int64())], ["id", "df"])

    out = [0] * size
    for r in counted.select("ids").mapInArrow(run, "id int, df long").groupBy("id").agg(F.sum("df").alias("df")).collect():
        out[r.id] = r.df
    return out


def weight(total: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1)))


class Block:
    """Posting lists of a block of documents: per term, documents by falling impact."""

    def __init__(self, batches: list[pa.RecordBatch], total: int, length: int, size: int):
        column = lambda name: pa.chunked_array([b.column(name) for b in batches]).combine_chunks()
        ids, n = column("doc_id"), column("n").to_numpy()
        self.doc_ids = ids.fill_null(int(NO_ID)).to_numpy()
        self.null = ids.is_null().to_numpy(zero_copy_only=False)
        terms, tfs = column("ids"), column("tfs").flatten().to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(len(n)), terms.value_lengths().to_numpy())
        m = 10 + 90 * n * total // length
        impact = 1_000_000_000 * tfs // (1000 * tfs + 8 * m[doc])
        term = terms.flatten().to_numpy()
        order = np.lexsort((-impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.ends = np.cumsum(np.bincount(term, minlength=size))

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(self.ends[term - 1] if term else 0, self.ends[term])
        return self.doc[own], self.impact[own]


def nra(block: Block, terms: list[int], weights: list[int], best: list[tuple[int, int, bool]], k: int) -> tuple[list, int]:
    """The k best of ``best`` and the block as (-score, doc_id, doc_id is null), least first; and the entries read."""
    lists = [(w, *block.postings(t)) for t in terms if (w := weights[t]) > 0]
    lists = [x for x in lists if len(x[1])]
    if not lists:
        return best, 0
    lower = np.zeros(len(block.doc_ids), np.int64)
    unread = np.ones((len(lists), len(lower)), bool)
    frontier = np.zeros(len(lists), np.int64)
    at, step = 0, FIRST_READ
    while True:
        for i, (w, docs, impacts) in enumerate(lists):
            read = docs[at:at + step]
            lower[read] += w * impacts[at:at + step]  # a document is in a list once
            unread[i, read] = False
            frontier[i] = w * impacts[at + step] if at + step < len(docs) else 0
        at, step = at + step, 2 * step
        open_lists = np.nonzero(frontier)[0]
        upper = lower + (frontier[open_lists] @ unread[open_lists] if len(open_lists) else 0)
        settled = (upper == lower) & (lower > 0)
        rows = np.nonzero(settled)[0]
        if len(rows) > k:
            least = np.partition(lower[rows], len(rows) - k)[len(rows) - k]
            rows = rows[lower[rows] >= least]
            rows = rows[np.lexsort((block.doc_ids[rows], -lower[rows]))[:k]]
        now = sorted([*best, *((-int(lower[r]), int(block.doc_ids[r]), bool(block.null[r])) for r in rows)])[:k]
        if not len(open_lists):
            break
        open_docs = upper > lower
        if len(now) == k:
            score, doc_id = -now[-1][0], now[-1][1]
            open_docs &= (upper > score) | ((upper == score) & (block.doc_ids < doc_id))
        if not open_docs.any():
            break
    return now, sum(min(at, len(docs)) for _, docs, _ in lists)


# ---- search ----------------------------------------------------------------------------

def _best_of_tasks(counted: DataFrame, items: list[tuple[int, list[int]]], weights: list[int], total: int, length: int, k: int) -> DataFrame:
    """(item, doc_id, score): the k best documents of every task for every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list] = {item: [] for item, _ in items}
        held: list[pa.RecordBatch] = []

        def search() -> None:
            block = Block(held, total, length, len(weights))
            for item, terms in items:
                best[item], _ = nra(block, terms, weights, best[item], k)
            held.clear()

        docs = postings = 0
        for batch in batches:
            lengths = np.cumsum(batch.column("ids").value_lengths().to_numpy())
            begin = 0
            while begin < batch.num_rows:  # as many rows as the block may still take, one at least
                before = lengths[begin - 1] if begin else 0
                fits = int(np.searchsorted(lengths, before + BLOCK_POSTINGS - postings, "right")) - begin
                take = max(1 if not held else 0, min(fits, BLOCK_DOCS - docs, batch.num_rows - begin))
                if take:
                    held.append(batch.slice(begin, take))
                    docs, postings, begin = docs + take, postings + int(lengths[begin + take - 1] - before), begin + take
                if begin < batch.num_rows:
                    search()
                    docs = postings = 0
        if held:
            search()
        rows = [(item, None if null else doc_id, -score) for item, found in best.items() for score, doc_id, null in found]
        item, doc_id, score = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), pa.array(doc_id, pa.int64()), pa.array(score, pa.int64())], ["item", "doc_id", "score"])

    return counted.mapInArrow(run, "item long, doc_id long, score long")


def top_documents(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = K, part_terms: int = PART_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): every item's ``k`` documents of highest score above 0, equal scores by doc_id."""
    small_batches(spark)
    asked = staged(spark, item_terms(items).withColumn("item", F.monotonically_increasing_id()), "search-items")
    terms = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("n")).first().n
    parts = max(1, math.ceil(terms / part_terms))
    found = None
    for part in range(parts):
        rows = asked.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part).select("item", "terms").collect()  # about part_terms terms
        numbers = {t: i for i, t in enumerate(sorted({t for r in rows for t in r.terms}))}
        counted = staged(spark, doc_counts(docs, numbers), "search-counts")
        total, length = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = [weight(total, df) for df in document_frequencies(counted, len(numbers))]
        best = _best_of_tasks(counted, [(r.item, [numbers[t] for t in r.terms]) for r in rows], weights, total, length, k)
        best = staged(spark, best.withColumn("tasks", (F.spark_partition_id() / TASK_GROUP).cast("int")), "search-best")
        found = best if found is None else found.unionByName(best)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for by in (["item", "tasks"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
    return found.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")

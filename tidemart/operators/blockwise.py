"""Top-k per query over all candidates without forming query-candidate rows.

Every query must meet every candidate, but a pair is only ever an entry of a numpy score
block inside a task: each task keeps its k best per query, and only those are shuffled.

* A query set that fits a checked bound is broadcast, and candidates stay where they are.
* A larger one is cut into blocks of queries and of candidates; each block pair is one
  cogroup of bounded size.

Both give the same result.  Order: score descending, then candidate id ascending.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A scorer gets a block of queries and a block of candidates and returns a float64 matrix
# (queries x candidates) with NaN where the pair is no match.
Scorer = Callable[[pa.Table, pa.Table], np.ndarray]

BROADCAST_ROWS = 4_096
BROADCAST_BYTES = 32 << 20
BLOCK_QUERIES = 1_024
BLOCK_CANDIDATES = 50_000
TILE = 256

HITS = T.StructType().add("query_id", "string").add("product_id", "string").add("score", "double")
_ARROW_HITS = pa.schema([("query_id", pa.string()), ("product_id", pa.string()), ("score", pa.float64())])


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best matches, ties by id."""
    if k < 1:
        return np.zeros(0, dtype=np.intp)
    found = np.flatnonzero(~np.isnan(scores))
    if found.size > k:
        floor = np.partition(scores[found], found.size - k)[found.size - k]
        found = found[scores[found] >= floor]
    return found[np.lexsort((ids[found], -scores[found]))][:k]


def _block_hits(queries: pa.Table, candidates: pa.Table, scorer: Scorer) -> pa.Table:
    qids = np.asarray(queries["query_id"].to_pylist(), dtype=object)
    ks = queries["k"].to_numpy()
    ids = np.asarray(candidates["product_id"].to_pylist(), dtype=object)
    out_q, out_c, out_s = [], [], []
    for lo in range(0, queries.num_rows, TILE):
        scores = scorer(queries.slice(lo, TILE), candidates)
        for row, values in enumerate(scores):
            best = _best(ids, values, int(ks[lo + row]))
            out_q.extend([qids[lo + row]] * best.size)
            out_c.extend(ids[best])
            out_s.extend(values[best])
    return pa.table([out_q, out_c, np.asarray(out_s, dtype="float64")], schema=_ARROW_HITS)


def _narrowed(hits: pa.Table, ks: dict[str, int]) -> pa.Table:
    """Keep k per query of hits gathered over several batches."""
    order = hits.sort_by([("query_id", "ascending"), ("score", "descending"), ("product_id", "ascending")])
    qids = order["query_id"].to_pylist()
    keep, last, n = [], None, 0
    for i, q in enumerate(qids):
        n = 1 if q != last else n + 1
        last = q
        if n <= ks[q]:
            keep.append(i)
    return order.take(pa.array(keep, pa.int64()))


def top_k(
    queries: DataFrame,
    candidates: DataFrame,
    scorer: Scorer,
    *,
    broadcast_rows: int = BROADCAST_ROWS,
    block_queries: int = BLOCK_QUERIES,
    block_candidates: int = BLOCK_CANDIDATES,
) -> DataFrame:
    """(query_id, product_id, score, retrieval_rank) for the ``k`` best of each query.

    ``queries`` carries query_id (string), k (int) and what the scorer reads; ``candidates``
    product_id (string) and what the scorer reads.
    """
    spark = queries.sparkSession
    probe = queries.limit(broadcast_rows + 1).toArrow()  # never more rows than the bound
    if probe.num_rows <= broadcast_rows and probe.nbytes <= BROADCAST_BYTES:
        held = spark.sparkContext.broadcast(probe.combine_chunks())

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked = held.value
            ks = dict(zip(asked["query_id"].to_pylist(), asked["k"].to_pylist()))
            kept = _ARROW_HITS.empty_table()
            for batch in batches:
                hits = _block_hits(asked, pa.Table.from_batches([batch]), scorer)
                kept = _narrowed(pa.concat_tables([kept, hits]), ks)
            yield from kept.to_batches()

        hits = candidates.mapInArrow(scan, HITS)
    else:
        n_q = -(-queries.count() // block_queries)
        n_c = -(-candidates.count() // block_candidates) or 1
        # Each side is repeated once per block of the other side.
        q = queries.withColumns({
            "_qb": F.pmod(F.xxhash64("query_id"), F.lit(n_q)),
            "_cb": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_c - 1).cast("long"))),
        })
        c = candidates.withColumns({
            "_cb": F.pmod(F.xxhash64("product_id"), F.lit(n_c)),
            "_qb": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_q - 1).cast("long"))),
        })

        def pair(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return _ARROW_HITS.empty_table()
            return _block_hits(left, right, scorer)

        hits = q.groupBy("_qb", "_cb").cogroup(c.groupBy("_qb", "_cb")).applyInArrow(pair, HITS)

    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "product_id")
    ranked = hits.withColumn("retrieval_rank", F.row_number().over(best))
    if probe.num_rows == 0:
        return ranked
    limits = queries.select("query_id", "k")
    return ranked.join(limits, "query_id").where("retrieval_rank <= k").drop("k")

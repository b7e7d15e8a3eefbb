"""Exact top-k by inner product that skips blocks of candidates by an upper bound.

Candidates are laid out once: a bounded sample of them serves as pivots, every candidate goes to its nearest pivot, and a run of rows
of one pivot is a block with a centroid and a radius.  No candidate of a block can score above ``q . centroid + |q| * radius``.
A query starts with the k-th best score among the pivots, which are candidates too, and raises it as its task goes on; blocks
whose bound stays below it are not scored.  The result is that of :func:`blockwise.top_k`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from .blockwise import _ARROW_HITS, BROADCAST_BYTES, BROADCAST_ROWS, HITS, _best, _narrowed, top_k
from .retrieval import SCORE_PLACES, _matrix, dot_scorer

PIVOTS = 256  # bound of the sample
SLACK = 2.0 * 10.0 ** -SCORE_PLACES  # scores are rounded, bounds are not


def _sample(candidates: DataFrame, pivots: int) -> pa.Table:
    rows = candidates.select("product_id", "embedding").orderBy(F.xxhash64("product_id"), "product_id").limit(pivots)
    return rows.toArrow()


def laid_out(candidates: DataFrame, dim: int, pivots: int = PIVOTS) -> DataFrame:
    """(pivot, product_id, embedding), written in order of the nearest pivot; a pivot with most rows is dealt to several files."""
    asked = candidates.select("product_id", "embedding")
    points = _matrix(_sample(asked, pivots), dim)
    half = (points * points).sum(1) / 2
    schema = T.StructType([T.StructField("pivot", T.IntegerType()), *asked.schema.fields])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                nearest = (_matrix(pa.Table.from_batches([batch]), dim) @ points.T - half).argmax(1)
                yield pa.RecordBatch.from_arrays([pa.array(nearest, pa.int32()), *batch.columns], ["pivot", *batch.schema.names])

    dealt = asked.mapInArrow(assign, schema).withColumn("_hash", F.xxhash64("product_id"))
    return stage(dealt.repartitionByRange("pivot", "_hash").sortWithinPartitions("pivot").drop("_hash"), "laid-out")


def _runs(batch: pa.RecordBatch) -> Iterator[pa.Table]:
    pivot = batch.column("pivot").to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(pivot)) + 1).tolist(), len(pivot)]
    for at, end in zip(cuts[:-1], cuts[1:], strict=True):
        if end > at:
            yield pa.Table.from_batches([batch.slice(at, end - at)])


def _scan(batches: Iterator[pa.RecordBatch], asked: pa.Table, floors: np.ndarray, dim: int) -> Iterator[tuple[int, int, pa.Table]]:
    """(scored pairs, skipped pairs, the best hits so far) after every batch."""
    queries, qids, ks = _matrix(asked, dim), asked["query_id"].to_pylist(), asked["k"].to_numpy()
    lengths, limits = np.sqrt((queries * queries).sum(1)), dict(zip(qids, ks.tolist(), strict=True))
    place = {q: i for i, q in enumerate(qids)}
    floors, kept = floors.copy(), _ARROW_HITS.empty_table()
    for batch in batches:
        scored = skipped = 0
        blocks = []
        for run in _runs(batch):
            held = _matrix(run, dim)
            centre = held.mean(0)
            radius = np.sqrt(((held - centre) ** 2).sum(1).max())
            blocks.append((queries @ centre + lengths * radius, run, held))
        # Promising blocks first: they raise the floors for the others.
        for bounds, run, held in sorted(blocks, key=lambda b: -b[0].max(initial=-np.inf)):
            rows = np.flatnonzero(bounds >= floors - SLACK)
            scored, skipped = scored + len(rows) * len(held), skipped + (len(qids) - len(rows)) * len(held)
            ids, out = np.asarray(run["product_id"].to_pylist(), dtype=object), ([], [], [])
            for row, values in zip(rows, np.round(queries[rows] @ held.T, SCORE_PLACES), strict=True):
                best = _best(ids, values, int(ks[row]))
                if 0 < ks[row] <= best.size:
                    floors[row] = max(floors[row], values[best[-1]])
                out[0].extend([qids[row]] * best.size)
                out[1].extend(ids[best])
                out[2].extend(values[best])
            kept = pa.concat_tables([kept, pa.table([out[0], out[1], np.asarray(out[2], "float64")], schema=_ARROW_HITS)])
        kept = _narrowed(kept, limits)
        seen: dict[str, list[float]] = {}
        for q, s in zip(kept["query_id"].to_pylist(), kept["score"].to_pylist(), strict=True):
            seen.setdefault(q, []).append(s)
        for q, scores in seen.items():
            if 0 < limits[q] <= len(scores):
                floors[place[q]] = max(floors[place[q]], min(scores))
        yield scored, skipped, kept


def _prepared(queries: DataFrame, laid: DataFrame, dim: int, pivots: int) -> tuple[pa.Table, np.ndarray] | None:
    """The queries and their first floors; None if they exceed what may be sent to every task."""
    asked = queries.select("query_id", "k", "embedding").limit(BROADCAST_ROWS + 1).toArrow().combine_chunks()
    if asked.num_rows > BROADCAST_ROWS or asked.nbytes > BROADCAST_BYTES:
        return None
    floors = np.full(asked.num_rows, -np.inf)
    known = _sample(laid, pivots)
    if asked.num_rows and known.num_rows:
        scores = np.sort(np.round(_matrix(asked, dim) @ _matrix(known, dim).T, SCORE_PLACES), 1)[:, ::-1]
        for i, k in enumerate(asked["k"].to_pylist()):
            if 1 <= k <= known.num_rows:
                floors[i] = scores[i, k - 1]
    return asked, floors


def bounded_top_k(queries: DataFrame, laid: DataFrame, dim: int, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, product_id, score, retrieval_rank) of queries (query_id, k, embedding) over candidates that :func:`laid_out` wrote."""
    prepared = _prepared(queries, laid, dim, pivots)
    if prepared is None:
        return top_k(queries, laid.drop("pivot"), dot_scorer(dim))
    asked, floors = prepared

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for _, _, kept in _scan(batches, asked, floors, dim):
            pass
        if kept is not None:
            yield from kept.to_batches()

    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "product_id")
    ranked = laid.mapInArrow(scan, HITS).withColumn("retrieval_rank", F.row_number().over(best))
    return ranked.join(queries.select("query_id", "k"), "query_id").where("retrieval_rank <= k").drop("k")


def work_saved(queries: DataFrame, laid: DataFrame, dim: int, pivots: int = PIVOTS) -> DataFrame:
    """(scored, skipped): pairs of query and candidate that a search multiplies, and those that bounds spare it."""
    asked, floors = _prepared(queries, laid, dim, pivots)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for scored, skipped, _ in _scan(batches, asked, floors, dim):
            yield pa.RecordBatch.from_pydict({"scored": [scored], "skipped": [skipped]})

    return laid.mapInArrow(scan, "scored long, skipped long").agg(F.sum("scored").alias("scored"), F.sum("skipped").alias("skipped"))

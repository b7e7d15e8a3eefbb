"""Exact deduplication with a heavy-hitter split, in DataFrame functions only.

Texts are equal when identical after lower-casing A-Z; null counts as empty.  A frequent-items summary (Misra-Gries
counters, ``approx_top_k`` over the digests) names at most ``tracked`` digests that may be frequent.  An exact count
verifies them: those with at least ``heavy_rows`` rows are heavy, and their winners, at most ``tracked`` rows, are
broadcast, so that rows of heavy digests are settled in the map tasks.  No remaining digest is frequent; the remaining
rows meet by an ordinary shuffle on the digest.

Of equal texts the row with the largest doc_id stays; null counts as smallest.  Among repeated rows (equal text and doc_id)
exactly one stays.  An empty table gives an empty result; extra columns ride along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import free_name, lower_ascii, staged

TRACKED = 256  # bound of the broadcast winners
HEAVY_ROWS = 1_000


def digest(text) -> F.Column:
    return F.sha2(lower_ascii(text).cast("binary"), 256)


def heavy_winners(digests: DataFrame, by: str = "digest", order: list[str] | None = None, tracked: int = TRACKED,
                  heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """(digest, group_size, winner): digests of at least ``heavy_rows`` rows, at most ``tracked`` of them.

    A frequent-items summary with ``n`` counters keeps every value that holds over 1 / n of the rows; an exact
    count decides.  ``winner`` is the struct of ``order`` that is largest.
    """
    named = digests.groupBy().agg(F.expr(f"approx_top_k({by}, {tracked}, {8 * tracked})").alias("top"))
    candidates = named.select(F.explode("top.item").alias(by))
    best = F.max(F.struct(*(order or ["doc_id", "rid"]))).alias("winner")
    return (
        digests.join(F.broadcast(candidates), by)  # at most ``tracked`` rows
        .groupBy(by).agg(F.count("*").alias("group_size"), best)
        .where(F.col("group_size") >= heavy_rows)
    )


def exact_groups(spark: SparkSession, docs: DataFrame, tracked: int = TRACKED, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = staged(spark, docs.select(
        "doc_id", digest(F.col("text")).alias("digest"), F.monotonically_increasing_id().alias("rid"),
    ), "digests")
    heavy = staged(spark, heavy_winners(rows, tracked=tracked, heavy_rows=heavy_rows), "heavy-digests")
    marked = rows.join(F.broadcast(heavy), "digest", "left")  # at most ``tracked`` rows
    out = ("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))
    settled = marked.where("winner IS NOT NULL").select(
        "doc_id", "digest", "group_size", F.col("winner.doc_id").alias("keep_id"),
        (F.col("rid") == F.col("winner.rid")).alias("kept"),
    )
    group = Window.partitionBy("digest")
    rest = marked.where("winner IS NULL").select(
        "doc_id", "digest", "rid", F.count("*").over(group).alias("group_size"),
        F.max(F.struct("doc_id", "rid")).over(group).alias("winner"),
    ).select(
        "doc_id", "digest", "group_size", F.col("winner.doc_id").alias("keep_id"),
        (F.col("rid") == F.col("winner.rid")).alias("kept"),
    )
    return settled.select(*out).unionByName(rest.select(*out))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, tracked: int = TRACKED, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """``docs`` without its exact copies, all columns as they were.

    Digests are staged to find the heavy ones.  Of those, map tasks let only rows with the winning doc_id through;
    the other rows are ranked per digest, where Spark's group limit drops losers before the shuffle as well.
    """
    by, rank, winner, size = (free_name(docs, n) for n in ("digest", "place", "winner", "group_size"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = staged(spark, docs.select("doc_id", digest(F.col("text")).alias("digest")), "digests")
    heavy = staged(
        spark, heavy_winners(rows, order=["doc_id"], tracked=tracked, heavy_rows=heavy_rows), "heavy-digests"
    ).select(F.col("digest").alias(by), F.col("winner").alias(winner), F.col("group_size").alias(size))
    marked = docs.withColumn(by, digest(F.col("text"))).join(F.broadcast(heavy), by, "left")  # at most ``tracked`` rows
    # Rows of a heavy digest with a smaller doc_id than the winner's end here, in the map tasks.
    open_rows = marked.where(f"`{size}` IS NULL OR doc_id <=> `{winner}`.doc_id")
    order = Window.partitionBy(by).orderBy(F.col("doc_id").desc_nulls_last())
    return open_rows.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).select(*columns)

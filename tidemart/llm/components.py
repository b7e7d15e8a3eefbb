"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged


def _large_star(spark: SparkSession, links: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is linked to the vertex's least neighbour."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = staged(spark, both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``links`` point from larger to smaller: all smaller neighbours, and the vertex, go to the least of them."""
    least = staged(spark, links.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = links.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(spark: SparkSession, links: DataFrame, rounds: int = 60) -> DataFrame:
    """(u, root) for every linked vertex but the roots; ``links`` has bigint columns u and v.

    Each round is written to the shared folder, so lineage stays short.  It ends when a round changes nothing: then
    every vertex points to the least vertex of its component.  Minima combine map-side.  They are written down before the join
    with the links, which has one row per vertex on their side: both sides have an exchange of their own then (or the minima
    are small enough to be broadcast), so the skew-join rule splits a vertex with a third of all links.
    """
    def tidy(df: DataFrame) -> DataFrame:
        return df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())

    now = staged(spark, tidy(links), "links")
    seen = mark(now)
    for _ in range(rounds):
        wide = staged(spark, tidy(_large_star(spark, now)), "links")
        now = staged(spark, tidy(_small_star(spark, wide)), "links")
        if (new := mark(now)) == seen:
            return now.select("u", F.col("v").alias("root"))
        seen = new
    raise RuntimeError(f"links did not settle in {rounds} rounds")

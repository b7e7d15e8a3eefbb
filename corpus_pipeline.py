"""A corpus pipeline: toxicity, exact copies, near duplicates, benchmark passages, then token ids.

Each stage takes (spark, docs, sf_dir), and its result is written as Parquet in the shared folder and read again as the next
stage's docs.  All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import decontamination, exact_dedup, sentencepiece_codec, simhash, toxicity
from tidemart.llm.common import read_table, staged
from tidemart.llm.queries import SENTENCEPIECE_MODEL, vocabulary_path
from tidemart.session import use_utc


def filtered(docs: DataFrame, judge, keep: str) -> DataFrame:
    """Rows of ``docs`` for which ``keep`` holds after ``judge``; columns are renamed meanwhile, as the judge adds its own."""
    numbered = docs.toDF(*[c if c == "text" else f"c{i}_" for i, c in enumerate(docs.columns)])
    return judge(numbered).where(keep).select(*numbered.columns).toDF(*docs.columns)


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar does not reject; fitted on labelled rows of ``docs``."""
    model = toxicity.fit(spark, docs, read_table(spark, sf_dir, "labels"))
    return filtered(docs, lambda d: toxicity.score_texts(d, model), "predicted = 0")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, the one with the largest doc_id; A-Z in either case count as equal."""
    return exact_dedup.drop_exact_copies(spark, docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked, the one with the smallest doc_id."""
    return simhash.drop_near_duplicates(spark, docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which fewer than one word in twenty stands in a passage of a benchmark item."""
    benchmark = read_table(spark, sf_dir, "benchmark")
    return filtered(docs, lambda d: decontamination.contamination(d, benchmark), "NOT contaminated")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``ids``, their SentencePiece ids, ``n_tokens``, and ``same``, whether the ids decode to the text."""
    coded = sentencepiece_codec.encode(docs, vocabulary_path(SENTENCEPIECE_MODEL), decoded=True)
    return coded.select(
        *[f"`{c}`" for c in docs.columns if c not in ("ids", "n_tokens", "same", "decoded")], "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("same"))


STAGES = [
    ("toxicity", clean_language),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("decontamination", benchmark_passages),
    ("sentencepiece", pieces),
]

#: Hashing votes, an automaton and a tokenizer's merges have no SQL form; the tests hold a brute-force version against it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""One query per operator of this subpackage, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import use_utc
from . import archives, decontamination, exact_dedup, licenses, pii, ranked_search, sentencepiece_codec, simhash, spelling
from . import substring_dedup, token_files, toxicity, url_filter
from .common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SENTENCEPIECE_MODEL = "piece_bpe_32k.model"
TOKENIZER = "word_bpe_49k.json"


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_utc(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_sentencepiece(spark, sf_dir):
    """doc_id, n_tokens, ids_crc32, same: every document encoded, and whether decoding gives its text."""
    return sentencepiece_codec.round_trip(read_table(spark, sf_dir, "documents"), vocabulary_path(SENTENCEPIECE_MODEL))


@query
def op2_license_scan(spark, sf_dir):
    return licenses.license_matches(read_table(spark, sf_dir, "documents"))


@query
def op3_decontamination(spark, sf_dir):
    found = decontamination.contamination(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), "contaminated",
    )


@query
def op4_arc_to_warc(spark, sf_dir):
    arcs = archives.write_arcs(spark, read_table(spark, sf_dir, "pages"))
    records = archives.read_warcs(spark, archives.convert(spark, arcs))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op5_simhash(spark, sf_dir):
    groups = simhash.near_duplicate_groups(spark, read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op6_url_filter(spark, sf_dir):
    return url_filter.judged(read_table(spark, sf_dir, "pages"), keep=["page_id"]).drop("terms")


@query
def op7_token_files(spark, sf_dir):
    files = token_files.write_tokens(spark, read_table(spark, sf_dir, "documents"), vocabulary_path(TOKENIZER))
    return token_files.read_tokens(spark, files, digest_only=True)


@query
def op8_substring_dedup(spark, sf_dir):
    return substring_dedup.repeated_runs(spark, read_table(spark, sf_dir, "documents")).drop("text_hash")


@query
def op9_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(spark, read_table(spark, sf_dir, "documents"))


@query
def op10_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(spark, docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score_texts(docs, model, keep=["doc_id"])
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", F.size("clauses").alias("clauses"))


@query
def op11_spelling_groups(spark, sf_dir):
    return spelling.spelling_groups(spark, read_table(spark, sf_dir, "documents"))


@query
def op12_pii(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return pii.digests(pii.find_spans(docs, pii.fit(spark, docs), keep=["doc_id"]), ["doc_id"])


@query
def op13_ranked_search(spark, sf_dir):
    return ranked_search.top_documents(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))

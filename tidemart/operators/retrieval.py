"""Product documents, embeddings and batch product search."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import joined_text
from ..schemas import PRODUCT_CATEGORIES
from ..session import scratch_path, stage
from .blockwise import top_k
from .history import current

Encoder = Callable[[list[str]], np.ndarray]

# Fixed values of the search contract.
OVERSAMPLE = 5          # post-filtered search retrieves this many times the wanted hits
RERANK_POOL = 4         # candidates handed to the ranker per wanted result
PREFILTERED_MAX = 20    # most hits of a pre-filtered search, unless the caller sets another bound
LITERAL_MAX = 25        # most rows of a literal search, unless the caller sets another bound
SCORE_PLACES = 6


# ---- catalogue reads -------------------------------------------------------------------

def product_documents(dimension: DataFrame) -> DataFrame:
    """Current, active products with the text that is embedded."""
    return current(dimension, active_only=True).select(
        "product_id", "sku", "name", "category", "brand", "price", "currency",
        joined_text(F.col("name"), F.col("category"), F.col("brand")).alias("doc_text"),
    )


def like_pattern(text: Column, escape: bool = False) -> Column:
    """The pattern of a literal search; ``%`` and ``_`` are wildcards unless escaped."""
    lowered = F.lower(text)
    if escape:
        lowered = F.regexp_replace(lowered, r"([\\%_])", r"\\$1")
    return F.concat(F.lit("%"), lowered, F.lit("%"))


def search_products(
    dimension: DataFrame,
    category: str | None = None,
    query: str | None = None,
    max_price: float | None = None,
    limit: int = 5,
    categories: Sequence[str] = PRODUCT_CATEGORIES,
    escape: bool = False,
    most: int | None = LITERAL_MAX,
) -> DataFrame:
    """Cheapest current, active products; unknown categories and prices <= 0 do not filter.

    ``limit`` is read as 1 to ``most`` (no upper bound if None).
    """
    found = current(dimension, active_only=True)
    if category in categories:
        found = found.where(F.col("category") == category)
    if query:
        found = found.where(F.like(F.lower("name"), like_pattern(F.lit(query), escape)))
    if max_price is not None and max_price > 0:
        found = found.where(F.col("price") <= float(max_price))
    columns = ["product_id", "name", "category", "price", "currency"]
    return found.select(*columns).orderBy("price", "product_id").limit(_bounded(int(limit), most))


def _bounded(k: int, most: int | None) -> int:
    return max(k, 1) if most is None else min(max(k, 1), most)


def get_products(dimension: DataFrame, wanted: DataFrame) -> DataFrame:
    """Batch lookup: the current version of each wanted product_id."""
    columns = ["product_id", "name", "category", "price", "currency"]
    return current(dimension).select(*columns).join(wanted.select("product_id").distinct(), "product_id", "left_semi")


def get_product(dimension: DataFrame, product_id: str) -> DataFrame:
    return (
        current(dimension)
        .where(F.col("product_id") == product_id)
        .select("product_id", "name", "category", "price", "currency")
        .limit(1)
    )


# ---- embeddings ------------------------------------------------------------------------

def hashed_token_counts(texts: list[str], dim: int = 64) -> np.ndarray:
    """Stand-in encoder: counts of space-separated tokens by the leading 16 bits of their MD5."""
    slots: dict[str, int] = {}
    out = np.zeros((len(texts), dim), dtype="float64")
    for row, text in enumerate(texts):
        tokens = text.split(" ")
        for token in set(tokens).difference(slots):
            slots[token] = int(hashlib.md5(token.encode()).hexdigest()[:4], 16) % dim
        out[row] = np.bincount([slots[t] for t in tokens if t], minlength=dim)
    return out


def embed(documents: DataFrame, encoder: Encoder | None = None, dim: int = 64, id_column: str = "product_id",
          text_column: str = "doc_text") -> DataFrame:
    """Encode texts batch by batch into L2-normalised float vectors of a checked dimension."""
    encode = encoder or partial(hashed_token_counts, dim=dim)
    schema = pa.schema([(id_column, pa.string()), (text_column, pa.string()), ("embedding", pa.list_(pa.float32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = np.asarray(encode([t or "" for t in batch.column(1).to_pylist()]), dtype="float64")
            if vectors.shape != (batch.num_rows, dim):
                raise ValueError(f"encoder gave shape {vectors.shape}, expected ({batch.num_rows}, {dim})")
            norms = np.linalg.norm(vectors, axis=1, keepdims=True)
            unit = np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0).astype("float32")
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, unit.size + 1, dim), pa.int32()), pa.array(unit.ravel(), pa.float32())
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], schema=schema)

    named = documents.select(F.col(id_column).cast("string"), F.col(text_column))
    return named.mapInArrow(run, f"{id_column} string, {text_column} string, embedding array<float>")


def build_embeddings(dimension: DataFrame, model: str, version: str, embed_ts: str, encoder: Encoder | None = None,
                     dim: int = 64) -> DataFrame:
    vectors = embed(product_documents(dimension).select("product_id", "doc_text"), encoder, dim)
    return vectors.withColumns({
        "embedding_model_name": F.lit(model),
        "embedding_version": F.lit(version),
        "embed_ts": F.to_timestamp(F.lit(embed_ts)),
    })


def embedding_audit(embeddings: DataFrame) -> DataFrame:
    return embeddings.groupBy("embedding_model_name", "embedding_version").agg(F.count(F.lit(1)).alias("vectors"))


# ---- scorers ---------------------------------------------------------------------------

def _matrix(table: pa.Table, dim: int) -> np.ndarray:
    lists = table["embedding"].combine_chunks()
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    if not (lengths == dim).all():
        raise ValueError(f"vector of dimension other than {dim}")
    return lists.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(lists), dim)


def _admitted(queries: pa.Table, candidates: pa.Table) -> np.ndarray:
    """Which candidates pass each query's category and max_price (null: no filter)."""
    admitted = np.ones((queries.num_rows, candidates.num_rows), dtype=bool)
    if "max_price" not in queries.column_names:
        return admitted
    prices = candidates["price"].to_numpy()
    names, codes = np.unique(np.asarray(candidates["category"].fill_null("").to_pylist(), dtype=str), return_inverse=True)
    code_of = {name: i for i, name in enumerate(names)}
    for row, (category, ceiling) in enumerate(zip(queries["category"].to_pylist(), queries["max_price"].to_pylist())):
        if category is not None:
            admitted[row] &= codes == code_of.get(category, -1)
        if ceiling is not None:
            admitted[row] &= prices <= ceiling
    return admitted


def dot_scorer(dim: int):
    def score(queries: pa.Table, candidates: pa.Table) -> np.ndarray:
        dots = _matrix(queries, dim) @ _matrix(candidates, dim).T
        return np.where(_admitted(queries, candidates), np.round(dots, SCORE_PLACES), np.nan)

    return score


def filtered_slices(queries: pa.Table, candidates: pa.Table) -> Iterator[tuple[list[int], list[int], np.ndarray]]:
    """(queries, how many each admits, candidates): per wanted category its candidates by price, as many as any query admits.

    A query admits a beginning of its list, so nothing else needs a score.
    """
    prices = candidates["price"].to_numpy()
    names, codes = np.unique(np.asarray(candidates["category"].fill_null("").to_pylist(), dtype=str), return_inverse=True)
    code_of = {name: i for i, name in enumerate(names)}
    by_price = np.argsort(prices, kind="stable")  # what has no price, or none that compares, comes last
    wanted: dict[str | None, list[tuple[int, float | None]]] = {}
    for row, (category, ceiling) in enumerate(zip(queries["category"].to_pylist(), queries["max_price"].to_pylist())):
        wanted.setdefault(category, []).append((row, ceiling))
    for category, asked in wanted.items():
        own = by_price if category is None else by_price[codes[by_price] == code_of.get(category, -1)]
        known = prices[own][:int(np.count_nonzero(~np.isnan(prices[own])))]
        counts = [len(own) if c is None else int(np.searchsorted(known, c, "right")) for _, c in asked]
        if max(counts):
            yield [row for row, _ in asked], counts, own[:max(counts)]


def filtered_dot_scorer(dim: int):
    """As :func:`dot_scorer` for queries with filters; only pairs that pass them are multiplied."""
    def score(queries: pa.Table, candidates: pa.Table) -> np.ndarray:
        asked, held = _matrix(queries, dim), _matrix(candidates, dim)
        out = np.full((len(asked), len(held)), np.nan)
        for rows, counts, places in filtered_slices(queries, candidates):
            dots = np.round(asked[rows] @ held[places].T, SCORE_PLACES)
            for row, count, values in zip(rows, counts, dots):
                out[row, places[:count]] = values[:count]
        return out

    return score


def literal_scorer(queries: pa.Table, candidates: pa.Table) -> np.ndarray:
    """Cheapest first among names that match; a missing price sorts before all others."""
    names = candidates["name_lower"]
    price = candidates["price"].to_numpy()
    missing = candidates["price"].is_null().to_numpy()
    scores = np.where(missing, np.inf, np.where(np.isnan(price), -np.inf, -price))  # a NaN price is a match, and last
    out = np.full((queries.num_rows, candidates.num_rows), np.nan)
    admitted = _admitted(queries, candidates)
    for row, pattern in enumerate(queries["pattern"].to_pylist()):
        if pattern is None:
            hit = admitted[row]
        else:
            hit = admitted[row] & pc.fill_null(pc.match_like(names, pattern), False).to_numpy()
        out[row, hit] = scores[hit]
    return out


# ---- searches --------------------------------------------------------------------------

def with_filters(queries: DataFrame, categories: Sequence[str] | None = PRODUCT_CATEGORIES) -> DataFrame:
    """Filters that do not count become null: prices <= 0, and categories outside the known set."""
    category = F.col("category")
    if categories is not None:
        category = F.when(category.isin(*categories), category)
    return queries.withColumns({
        "category": category,
        "max_price": F.when(F.col("max_price") > 0, F.col("max_price")),
    })


def nearest(queries: DataFrame, candidates: DataFrame, dim: int, k: int | Column, **blocks) -> DataFrame:
    """Exact inner-product top-k of ``queries`` (query_id, embedding) over all candidates."""
    k = F.lit(k) if isinstance(k, int) else k
    asked = queries.select("query_id", "embedding", k.cast("int").alias("k"))
    return top_k(asked, candidates.select("product_id", "embedding"), dot_scorer(dim), **blocks)


def nearest_prefiltered(
    queries: DataFrame, candidates: DataFrame, dim: int, k: int, most: int | None = PREFILTERED_MAX, **blocks
) -> DataFrame:
    """Filter by each query's category and max_price, then the top-k (1 to ``most``, None: any) of what is left.

    Here any non-null category filters, known or not.
    """
    asked = with_filters(queries, categories=None).select(
        "query_id", "embedding", "category", "max_price", F.lit(_bounded(k, most)).alias("k")
    )
    return top_k(asked, candidates.select("product_id", "embedding", "category", "price"), filtered_dot_scorer(dim), **blocks)


def nearest_postfiltered(
    queries: DataFrame,
    candidates: DataFrame,
    products: DataFrame,
    dim: int,
    k: int,
    oversample: int = OVERSAMPLE,
    categories: Sequence[str] = PRODUCT_CATEGORIES,
    **blocks,
) -> DataFrame:
    """Score first, then join current attributes and filter; not trimmed back to k."""
    return filtered_hits(oversampled(queries, candidates, dim, k, oversample, **blocks), queries, products, categories)


def oversampled(queries: DataFrame, candidates: DataFrame, dim: int, k: int, oversample: int = OVERSAMPLE, **blocks) -> DataFrame:
    """The hits of a post-filtered search before its filter."""
    return nearest(queries, candidates, dim, max(k, 1) * max(oversample, 1), **blocks)


def filtered_hits(hits: DataFrame, queries: DataFrame, products: DataFrame, categories: Sequence[str] = PRODUCT_CATEGORIES) -> DataFrame:
    """Hits with the current attributes of their products, if they pass their query's filter.

    ``products`` needs no versions but those of the hits' products.
    """
    wants = with_filters(queries, categories).select(
        "query_id", F.col("category").alias("_category"), F.col("max_price").alias("_ceiling")
    )
    attrs = current(products, active_only=True).select("product_id", "name", "category", "price", "currency")
    return (
        hits.join(attrs, "product_id")
        .join(wants, "query_id")
        .where(F.col("_category").isNull() | (F.col("category") == F.col("_category")))
        .where(F.col("_ceiling").isNull() | (F.col("price") <= F.col("_ceiling")))
        .drop("_category", "_ceiling")
    )


GRAM = 3  # letters that must stand together for a name to be looked up


def _grams(text: Column) -> Column:
    """Distinct runs of ``GRAM`` characters; null or shorter texts have none."""
    places = F.when(F.length(text) >= GRAM, F.sequence(F.lit(1), F.length(text) - (GRAM - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(GRAM))))


def _looked_up(asked: DataFrame, names: DataFrame) -> DataFrame:
    """Literal hits of queries with ``grams``: names that hold the rarest of them, verified against the pattern.

    Grams meet by equality, and only grams that some query has are counted or carried.  The k best of a query are cut within
    map tasks before they are shuffled.
    """
    wanted = stage(asked.select("query_id", F.explode("grams").alias("gram")), "grams")
    held = names.withColumn("gram", F.explode(_grams(F.col("name_lower")))).join(wanted.select("gram").distinct(), "gram", "left_semi")
    counts = held.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = wanted.join(counts, "gram", "left").groupBy("query_id").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("g"))
    rarest = stage(rarest.where("g.n > 0").select("query_id", F.col("g.gram").alias("gram")), "rarest")
    met = held.join(rarest, "gram").join(asked.drop("grams").withColumnsRenamed({"category": "_category"}), "query_id")
    passed = (
        F.expr("name_lower LIKE pattern")
        & (F.col("_category").isNull() | (F.coalesce("category", F.lit("")) == F.col("_category")))
        & (F.col("max_price").isNull() | (F.col("price") <= F.col("max_price")) & ~F.isnan("price"))
    )
    score = F.when(F.col("price").isNull(), float("inf")).when(F.isnan("price"), float("-inf")).otherwise(-F.col("price"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "product_id")
    return (
        met.where(passed).select("query_id", "product_id", score.alias("score"), "k")
        .withColumn("retrieval_rank", F.row_number().over(best)).where(F.col("retrieval_rank") <= F.col("k")).drop("k")
    )


def literal_search(queries: DataFrame, products: DataFrame, k: int, categories: Sequence[str] = PRODUCT_CATEGORIES,
                   most: int | None = LITERAL_MAX, **blocks) -> DataFrame:
    """Name search for many queries; a null or empty text filters on category and price only.

    Queries with ``GRAM`` plain characters in a row are looked up in an index of names.  The others, those without a text
    among them, are compared with all names.
    """
    text = F.when(F.col("query") != "", F.col("query"))
    lowered = F.lower(text)
    # A backslash may take a wildcard's meaning away: such texts are compared with all names.
    plain = F.when(~F.contains(lowered, F.lit("\\")), F.split(lowered, "[%_]"))
    grams = F.array_distinct(F.flatten(F.transform(plain, _grams)))
    bound = _bounded(k, most)
    asked = stage(with_filters(queries, categories).select(
        "query_id", like_pattern(text).alias("pattern"), "category", "max_price", F.lit(bound).alias("k"), grams.alias("grams")), "asked")
    names = current(products, active_only=True).select(
        "product_id", F.lower("name").alias("name_lower"), "category", "price"
    )
    indexed = F.coalesce(F.size("grams") > 0, F.lit(False))
    rest = asked.where(~indexed).drop("grams")
    if asked.where(indexed).isEmpty():
        return top_k(rest, names, literal_scorer, **blocks)
    found = _looked_up(asked.where(indexed), names).where(F.col("retrieval_rank") <= bound)
    if rest.isEmpty():
        return found
    compared = top_k(rest, names, literal_scorer, **blocks)
    return compared.unionByName(found.select(*compared.columns))


def _written(df: DataFrame, label: str) -> DataFrame:
    """The hits of a tier, at most k rows per query, so that later tiers see who is still without any."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def tiered_search(
    queries: DataFrame,
    embeddings: DataFrame,
    products: DataFrame,
    dim: int,
    limit: int = 5,
    categories: Sequence[str] = PRODUCT_CATEGORIES,
    pool: int | None = None,
    **blocks,
) -> DataFrame:
    """First tier with any row wins per query: pre-filtered, post-filtered, literal.

    A tier is asked only for the queries that the tiers before it left without a row; blank queries go to the filter search.
    Literal rows carry no score and are at most ``limit``.  The vector tiers give at most ``pool`` rows (a ranker's
    headroom; ``limit`` by default).  ``queries`` has query_id, query, embedding, category and max_price.
    """
    pool = pool or limit
    blank = F.trim(F.coalesce(F.col("query"), F.lit(""))) == ""
    spoken = queries.where(~blank)
    # Every tier reads the catalogue: its current rows are written down, so that the versions are made once.
    products = stage(current(products, active_only=True).select(
        "product_id", "name", "category", "price", "currency", "is_current", "active"), "catalogue")
    attrs = products.select("product_id", "name", "category", "price", "currency")
    vectors = embeddings.select("product_id", "embedding").join(attrs.select("product_id", "category", "price"), "product_id")
    columns = ["query_id", "product_id", "score", "retrieval_rank"]
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("retrieval_rank"))

    def trimmed(hits: DataFrame, tier: int) -> DataFrame:
        kept = hits.select(*columns).withColumn("_place", place).where(F.col("_place") <= pool).drop("_place")
        return _written(kept, f"tier-{tier}")

    def without_rows(asked: DataFrame, hits: DataFrame) -> DataFrame:
        return asked.join(hits.select("query_id").distinct(), "query_id", "left_anti")

    first = trimmed(nearest_prefiltered(spoken, vectors, dim, pool, most=None, **blocks), 1)
    second = trimmed(nearest_postfiltered(
        without_rows(spoken, first), embeddings, products, dim, pool, categories=categories, **blocks), 2)
    rest = without_rows(without_rows(queries, first), second).withColumn("query", F.when(~blank, F.col("query")))
    third = literal_search(rest, products, limit, categories, **blocks).withColumn("score", F.lit(None).cast("double"))
    tiers = [hits.select(*columns, F.lit(n).alias("tier")) for n, hits in enumerate((first, second, third), start=1)]
    return tiers[0].unionByName(tiers[1]).unionByName(tiers[2]).join(attrs, "product_id")

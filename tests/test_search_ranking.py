import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemart.operators import ranking, retrieval
from tidemart.operators.blockwise import top_k

CATALOG = "product_id string, name string, category string, price double, currency string, is_current boolean, active boolean"


@pytest.fixture(scope="module")
def catalog(spark):
    rows = [
        ("p1", "Red desk", "furniture", 50.0, "USD", True, True), ("p2", "red LAMP", "furniture", 20.0, "USD", True, True),
        ("p3", "Blue lamp", "electronics", 10.0, "USD", True, True), ("p4", "Red pan", "appliances", 5.0, "USD", True, False),
        ("p5", "Red cup", "appliances", 5.0, "USD", False, True),
    ]
    return spark.createDataFrame(rows, CATALOG)


def found(df):
    return [r.product_id for r in df.collect()]


def test_filter_search(catalog):
    assert found(retrieval.search_products(catalog, query="RED")) == ["p2", "p1"]
    assert found(retrieval.search_products(catalog, category="toys", limit=0)) == ["p3"]
    assert found(retrieval.search_products(catalog, category="furniture", max_price=0)) == ["p2", "p1"]
    assert found(retrieval.search_products(catalog, max_price=20)) == ["p3", "p2"]
    assert found(retrieval.search_products(catalog, query="l_mp", limit=99)) == ["p3", "p2"]
    assert found(retrieval.search_products(catalog, query="l_mp", escape=True)) == []
    assert found(retrieval.get_product(catalog, "p4")) == ["p4"]


def test_limit_stops_at_25(spark):
    many = spark.range(40).select(F.col("id").cast("string").alias("product_id"), F.lit("n").alias("name"), F.lit("furniture").alias("category"),
                                  F.col("id").cast("double").alias("price"), F.lit("USD").alias("currency"), F.lit(True).alias("is_current"), F.lit(True).alias("active"))
    assert retrieval.search_products(many, limit=99).count() == 25


def vectors(spark, n, dim, seed, id_column, prefix):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[n // 2] = v[0]  # an exact copy: ties go by id
    rows = [(f"{prefix}{i:04d}", [float(x) for x in row]) for i, row in enumerate(v)]
    return spark.createDataFrame(rows, f"{id_column} string, embedding array<float>"), v.astype("float32").astype("float64")


def test_both_block_plans_equal_brute_force(spark):
    q, qv = vectors(spark, 9, 8, 1, "query_id", "q")
    c, cv = vectors(spark, 300, 8, 2, "product_id", "c")
    want = set()
    for i, row in enumerate(np.round(qv @ cv.T, 6)):
        order = sorted(range(300), key=lambda j: (-row[j], j))[:7]
        want |= {(f"q{i:04d}", f"c{j:04d}", n + 1) for n, j in enumerate(order)}
    for options in ({}, {"broadcast_rows": 0, "block_queries": 4, "block_candidates": 50}, {"broadcast_rows": 3}):
        got = retrieval.nearest(q, c.repartition(5), 8, 7, **options)
        assert {(r.query_id, r.product_id, r.retrieval_rank) for r in got.collect()} == want


def test_k_beyond_the_catalog_and_no_queries(spark):
    q, _ = vectors(spark, 2, 4, 1, "query_id", "q")
    c, _ = vectors(spark, 3, 4, 2, "product_id", "c")
    assert retrieval.nearest(q, c, 4, 50).count() == 6
    assert retrieval.nearest(q.limit(0), c, 4, 5).count() == 0


def test_wrong_dimension_is_an_error(spark):
    q, _ = vectors(spark, 2, 4, 1, "query_id", "q")
    c, _ = vectors(spark, 3, 5, 2, "product_id", "c")
    with pytest.raises(Exception, match="dimension"):
        retrieval.nearest(q, c, 4, 1).collect()


def test_encoder_shape_is_checked_and_vectors_are_unit(spark):
    docs = spark.createDataFrame([("a", "x y x"), ("b", None)], "product_id string, doc_text string")
    rows = {r.product_id: r.embedding for r in retrieval.embed(docs, dim=16).collect()}
    assert abs(sum(x * x for x in rows["a"]) - 1) < 1e-6 and not any(rows["b"])
    with pytest.raises(Exception, match="encoder gave shape"):
        retrieval.embed(docs, lambda texts: np.zeros((len(texts), 3)), dim=16).collect()


def test_tiers(spark, catalog):
    emb = spark.createDataFrame([("p1", [1.0, 0.0]), ("p2", [0.0, 1.0])], "product_id string, embedding array<float>")
    rows = [
        ("t1", "desk", [1.0, 0.0], "furniture", None), ("t2", "desk", [1.0, 0.0], "toys", None),
        ("t3", "lamp", [1.0, 0.0], "electronics", None), ("blank", "  ", [1.0, 0.0], None, 15.0), ("none", "zzz", [1.0, 0.0], None, 1.0),
    ]
    asked = spark.createDataFrame(rows, "query_id string, query string, embedding array<float>, category string, max_price double")
    got = {}
    for r in retrieval.tiered_search(asked, emb, catalog, 2).orderBy("retrieval_rank").collect():
        got.setdefault((r.query_id, r.tier), []).append((r.product_id, r.score))
    assert got == {
        ("t1", 1): [("p1", 1.0), ("p2", 0.0)], ("t2", 2): [("p1", 1.0), ("p2", 0.0)], ("t3", 3): [("p3", None)], ("blank", 3): [("p3", None)],
    }


def test_golden_ranking(spark):
    rows = [("q", "p1", 0.92, 800.0, 1), ("q", "p2", 0.88, 200.0, 2), ("q", "p4", 0.86, 350.0, 3), ("q", "p3", 0.81, 50.0, 4), ("q", "p5", 0.79, 150.0, 5)]
    cand = spark.createDataFrame(rows, "query_id string, product_id string, score double, price double, retrieval_rank int")
    pop = spark.createDataFrame([("p1", 0.05), ("p3", 0.40), ("p5", 0.95)], "product_id string, popularity_score double")
    got = ranking.hybrid_rank(cand, pop).orderBy("rank").collect()
    want = [("p5", 0.841), ("p3", 0.736), ("p2", 0.648), ("p4", 0.606), ("p1", 0.565)]
    assert [r.product_id for r in got] == [p for p, _ in want]
    assert all(abs(r.final_score - s) <= 0.001 for r, (_, s) in zip(got, want))
    assert ranking.hybrid_rank(cand, pop, limit=0).count() == 1


def test_ties_and_odd_values(spark):
    rows = [("q", "a", float("nan"), None, 2), ("q", "b", None, -1.0, 1), ("q", "c", 7.0, float("nan"), 3)]
    cand = spark.createDataFrame(rows, "query_id string, product_id string, score double, price double, retrieval_rank int")
    got = ranking.hybrid_rank(cand, None).orderBy("rank").collect()
    assert [(r.product_id, r.semantic, r.price_score) for r in got] == [("c", 1.0, 1.0), ("b", 0.0, 1.0), ("a", 0.0, 1.0)]


def test_popularity(spark):
    rows = [("p1", 10, 0, 3), ("p2", 0, 0, 0)]
    got = {r.product_id: r.popularity_score for r in ranking.popularity(spark.createDataFrame(rows, "product_id string, purchases_7d long, add_to_cart_7d long, views_7d long")).collect()}
    assert got["p2"] == 0.0 and abs(got["p1"] - 0.7) < 1e-12


def test_top_k_with_hot_ties(spark):
    """Most candidates share one score: the smallest ids win, in every plan."""
    c = spark.range(2_000).select(F.format_string("c%04d", "id").alias("product_id"), F.array(F.lit(1.0).cast("float")).alias("embedding"))
    q = spark.createDataFrame([("q", [1.0], 3)], "query_id string, embedding array<float>, k int")
    for options in ({}, {"broadcast_rows": 0, "block_candidates": 300}):
        got = top_k(q, c.repartition(4), retrieval.dot_scorer(1), **options).orderBy("retrieval_rank")
        assert [r.product_id for r in got.collect()] == ["c0000", "c0001", "c0002"]


def test_literal_search_keeps_products_without_a_number(spark):
    rows = [("p1", "red a", "furniture", float("nan"), "USD", True, True), ("p2", "red b", "furniture", 3.0, "USD", True, True)]
    asked = spark.createDataFrame([("q", "red", None, None)], "query_id string, query string, category string, max_price double")
    hits = retrieval.literal_search(asked, spark.createDataFrame(rows, CATALOG), 5)
    assert [(r.product_id, r.retrieval_rank) for r in hits.orderBy("retrieval_rank").collect()] == [("p2", 1), ("p1", 2)]


def test_tiers_are_trimmed_and_bounds_can_be_lifted(spark):
    c, _ = vectors(spark, 60, 8, 2, "product_id", "c")
    q, _ = vectors(spark, 2, 8, 1, "query_id", "q")
    products = c.select("product_id", F.lit("red x").alias("name"), F.lit("furniture").alias("category"), F.lit(5.0).alias("price"),
                        F.lit("USD").alias("currency"), F.lit(True).alias("is_current"), F.lit(True).alias("active"))
    asked = q.withColumns({"query": F.lit("red"), "max_price": F.lit(None).cast("double"),
                           "category": F.when(F.col("query_id") == "q0000", "toys").otherwise("furniture")})
    got = retrieval.tiered_search(asked, c, products, 8, 5).groupBy("query_id", "tier").count().collect()
    assert {tuple(r) for r in got} == {("q0000", 2, 5), ("q0001", 1, 5)}
    candidates = c.join(products.drop("name"), "product_id")
    for most, n in ((retrieval.PREFILTERED_MAX, 20), (None, 40)):
        hits = retrieval.nearest_prefiltered(asked.where("query_id = 'q0001'"), candidates, 8, 40, most=most)
        assert hits.count() == n
    assert retrieval.nearest(q, c, 8, 0).count() == 0
    popular = spark.createDataFrame([], "product_id string, popularity_score double")
    found = ranking.semantic_search(asked, c, products, popular, 8, 5).groupBy("query_id").count().collect()
    assert {tuple(r) for r in found} == {("q0000", 5), ("q0001", 5)}


def test_literal_search_by_index_equals_comparing_all_names(spark):
    import random
    import re

    rng = random.Random(3)
    rows = []
    for i in range(300):
        name = " ".join(rng.choice(["Red", "Blue", "CHAIR", "desk", "Äpfel", "lamp", "x_y", "50%", "a\\b"]) for _ in range(3))
        price = rng.choice([None, float("nan"), *(float(p) for p in range(1, 40))])
        rows.append((f"p{i}", name if i % 17 else None, rng.choice(["electronics", "home", None]), price))
    texts = ["chair", "d_sk", "red%lamp", "Äpf", "%", "x\\_y", "zzz", "", None, "re", "50\\%", "lue de", "b_ue%apf", "chairchair"]
    asked = [(f"q{i}", t, c, m) for i, t in enumerate(texts) for c, m in [(None, None)]]
    asked += [("f1", "chair", "home", 20.0), ("f2", "lamp", "nowhere", None), ("f3", "desk", None, 5.0)]
    dim = spark.createDataFrame(rows, "product_id string, name string, category string, price double").withColumns({
        "is_current": F.lit(True), "active": F.lit(True)})
    queries = spark.createDataFrame(asked, "query_id string, query string, category string, max_price double")
    got = {}
    for r in retrieval.literal_search(queries, dim, 7, categories=("electronics", "home")).collect():
        got.setdefault(r.query_id, []).append((r.retrieval_rank, r.product_id, r.score))

    def pattern(text):
        out, at = "", 0
        text = f"%{text.lower()}%"
        while at < len(text):
            if text[at] == "\\" and at + 1 < len(text):
                out, at = out + re.escape(text[at + 1]), at + 2
                continue
            out += {"%": ".*", "_": "."}.get(text[at], re.escape(text[at]))
            at += 1
        return re.compile(out, re.S)

    for qid, text, category, most in asked:
        hits = []
        for pid, name, c, price in rows:
            if text and (name is None or not pattern(text).fullmatch(name.lower())):
                continue
            if category in ("electronics", "home") and c != category:
                continue
            if most is not None and not (price is not None and price <= most):
                continue
            score = float("inf") if price is None else float("-inf") if price != price else -price
            hits.append((-score, pid, score))
        want = [(i, pid, s) for i, (_, pid, s) in enumerate(sorted(hits, key=lambda h: (h[0], h[1]))[:7], 1)]
        assert sorted(got.get(qid, [])) == want, (qid, text)


def test_filters_come_before_scores():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(5)
    n, m, dim = 400, 12, 8
    price = [None if i % 23 == 0 else float("nan") if i % 29 == 0 else float(rng.integers(1, 60)) for i in range(n)]
    held = pa.table({"product_id": [str(i) for i in range(n)], "embedding": rng.normal(size=(n, dim)).tolist(),
                     "category": [None if i % 31 == 0 else "abcd"[i % 4] for i in range(n)], "price": price})
    asked = pa.table({"query_id": [str(i) for i in range(m)], "k": [5] * m, "embedding": rng.normal(size=(m, dim)).tolist(),
                      "category": ["a", "b", None, "a", "zz", None, "c", "a", "b", "d", "d", "c"],
                      "max_price": [None, 20.0, None, 9.0, None, 30.0, 0.5, 59.0, 20.0, None, 40.0, 1.0]})
    want, got = retrieval.dot_scorer(dim)(asked, held), retrieval.filtered_dot_scorer(dim)(asked, held)
    assert np.array_equal(np.isnan(want), np.isnan(got)) and np.allclose(want, got, atol=1e-9, equal_nan=True)
    multiplied = sum(len(rows) * len(places) for rows, _, places in retrieval.filtered_slices(asked, held))
    assert (~np.isnan(want)).sum() <= multiplied < 0.5 * n * m


@pytest.mark.parametrize("spread", [0.02, 3.0])
def test_bounded_search_equals_scoring_all(spark, spread):
    from tidemart.operators import bounded

    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 6))
    rows = [(f"p{i:04d}", (centres[i % 12] + spread * rng.normal(size=6)).round(3).tolist()) for i in range(1_500)]
    rows += [(f"twin{i}", rows[7][1]) for i in range(30)]
    held = spark.createDataFrame(rows, "product_id string, embedding array<double>").repartition(3)
    asked = spark.createDataFrame(
        [(f"q{i}", k, (centres[i % 12] * 2).tolist()) for i, k in enumerate([5, 1, 40, 0, 12])], "query_id string, k int, embedding array<double>")
    laid = bounded.laid_out(held, 6, 24)
    want = top_k(asked, held, retrieval.dot_scorer(6)).select("query_id", "retrieval_rank", "product_id", "score").collect()
    got = bounded.bounded_top_k(asked, laid, 6, 24).select("query_id", "retrieval_rank", "product_id", "score").collect()
    assert sorted(got) == sorted(want) and len(want) == 58
    saved = bounded.work_saved(asked, laid, 6, 24).first()
    assert saved.scored + saved.skipped == 5 * len(rows) and (spread > 1 or saved.skipped > 0.6 * 5 * len(rows))
    assert bounded.bounded_top_k(asked, laid.limit(0), 6, 24).count() == 0


def test_tiers_make_the_versions_once(spark, sf_dir):
    """The catalogue is written down before the tiers read it: its frame has no window left."""
    from tidemart.plans import queries as q

    products = q._products(spark, sf_dir)
    vectors = q.shop.embedding_vectors(spark, sf_dir)
    found = retrieval.tiered_search(q._tier_queries(spark, sf_dir, vectors), vectors, products, q.DIM, 5, q.CATEGORIES)
    assert "valid_from" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.where("name IS NULL").isEmpty() and not found.isEmpty()


def test_versions_are_made_of_the_hits_products_alone(spark, sf_dir, monkeypatch):
    from tidemart.operators import history
    from tidemart.plans import queries

    given, make = [], history.versions
    monkeypatch.setattr(history, "versions", lambda snapshots, *a, **o: given.append(snapshots) or make(snapshots, *a, **o))
    found = queries._candidates(spark, sf_dir)
    monkeypatch.undo()
    vectors = queries.shop.embedding_vectors(spark, sf_dir)
    asked = queries._filtered_queries(spark, sf_dir, vectors)
    hits = queries.retrieval.oversampled(asked, vectors, queries.DIM, 20)
    theirs = queries.shop.product_snapshots(spark, sf_dir).join(hits, "product_id", "left_semi")
    assert [g.count() for g in given] == [theirs.count()]
    want = queries.retrieval.nearest_postfiltered(asked, vectors, queries._products(spark, sf_dir), queries.DIM, 20, categories=queries.CATEGORIES)
    assert sorted(map(str, found.collect())) == sorted(map(str, want.select(*found.columns).collect()))


def test_signals_carry_their_own_columns(spark, sf_dir, monkeypatch):
    from tidemart.plans import queries

    written, store = {}, queries._stored
    monkeypatch.setattr(queries, "_stored", lambda spark, df, label: written.setdefault(label, df.columns) and store(spark, df, label))
    queries._signals(spark, sf_dir)
    assert set(written) == {"clean", "silver", "lines"} and "properties" not in written["silver"] and "page_url" not in written["clean"]

"""Ranked search against brute force over all documents, and the stopping rule against full reads."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from edge_rows import TEXTS, edge_docs, no_docs
from tidemart.llm import ranked_search as rs
from tidemart.llm.common import read_table
from tidemart.llm.queries import QUERIES

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_top(docs, items, k=10):
    """[(item_id, rank, doc_id, score)] by scoring every document for every item."""
    counts = [(d, Counter(re.findall(TERM, (t or "").translate(LOW)))) for d, t in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    total, length = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item_id, text in items:
        asked = set(re.findall(TERM, (text or "").translate(LOW)))
        scored = []
        for d, c, n in counts:
            m = 100 - 90 + (90 * n * total) // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in asked & c.keys())
            if score > 0:
                scored.append((-score, d is None, d, score))
        out += [(item_id, i, d, s) for i, (_, _, d, s) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return out


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_equals_brute_force(spark, sf_dir):
    docs, items = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    want = plain_top([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    got = QUERIES["op13_ranked_search"](spark, sf_dir)
    assert rows_of(got) == sorted(want, key=repr) and len(want) > 100
    assert dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}


@pytest.mark.parametrize("block_docs,postings,part_terms", [(3, 10**6, 10**6), (8192, 7, 4), (8192, 10**6, 10**6)])
def test_ties_copies_nulls_and_blocks(spark, monkeypatch, block_docs, postings, part_terms):
    """Few terms give many equal scores; blocks and parts of any size give the same rows."""
    monkeypatch.setattr(rs, "BLOCK_DOCS", block_docs)
    monkeypatch.setattr(rs, "BLOCK_POSTINGS", postings)
    rng = random.Random(5)
    docs = [(rng.choice((None, *range(40))), " ".join(rng.choices(["a", "B", "ç", "1", "x-y"], k=rng.randint(0, 6)))) for _ in range(150)]
    items = [(1, "A b"), (1, "a  b b"), (2, "ç x"), (3, None), (4, ""), (5, "unknown"), (None, "y 1 a b Ç x"), (6, "1")]
    got = rs.top_documents(
        spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"), part_terms=part_terms)
    assert rows_of(got) == sorted(plain_top(docs, items), key=repr)


def test_reading_stops_early_and_stays_exact():
    """Lists of the named shape: the k best equal a full sum, and less is read where scores differ clearly."""
    rng = np.random.default_rng(3)
    size, n_docs, total, length = 6, 4_000, 4_000, 400_000
    rows = [{"doc_id": int(d), "n": 100, "ids": sorted(rng.choice(size, 5, replace=False).tolist())} for d in rng.permutation(n_docs)]
    for i, r in enumerate(rows):
        r["tfs"] = rng.integers(1, 3, 5).tolist() if i % 50 else [60] * 5
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))])
    block = rs.Block(pa.Table.from_pylist(rows, schema).to_batches(), total, length, size)
    weights = [rs.weight(total, len(block.postings(t)[0])) for t in range(size)]
    full = Counter()
    for t in (0, 1, 2):
        for d, i in zip(*block.postings(t)):
            full[int(block.doc_ids[d])] += weights[t] * int(i)
    want = sorted((-s, d, False) for d, s in full.items() if s)[:10]
    found, read = rs.nra(block, [0, 1, 2], weights, [], 10)
    assert found == want
    assert read < 0.9 * sum(len(block.postings(t)[0]) for t in (0, 1, 2))
    again, later = rs.nra(block, [0, 1, 2], weights, [(-10**12, 0, False)] * 10, 10)
    assert again == [(-10**12, 0, False)] * 10 and later == 3 * rs.FIRST_READ  # nothing here can enter


def test_edge_rows(spark):
    items = [(1, "alpha1 beta1 one"), (2, "word3 TAIL19999"), (3, "\U0001f600 ÄÖ")]
    asked = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, score string")
    assert rows_of(rs.top_documents(spark, edge_docs(spark), asked)) == sorted(plain_top(TEXTS, items), key=repr)
    assert rs.top_documents(spark, no_docs(spark), asked).count() == 0
    assert rs.top_documents(spark, edge_docs(spark), asked.limit(0)).count() == 0

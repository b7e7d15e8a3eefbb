"""Spelling variants against a brute-force version over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from edge_rows import TEXTS, edge_docs, no_docs
from tidemart.llm import spelling
from tidemart.llm.common import read_table
from tidemart.llm.queries import QUERIES

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows, noise=199, least_count=5):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= least_count}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_groups(counts):
    """All pairs that share a word with one letter taken out or masked, each then judged by ``near``."""
    holes = {}
    for w in counts:
        for i in range(len(w)):
            for key in {w[:i] + "?" + w[i + 1:], w[:i] + w[i + 1:]}:
                holes.setdefault(key, set()).add(w)
        holes.setdefault(w, set()).add(w)
    links = {w: set() for w in counts}
    for ws in holes.values():
        for a in ws:
            links[a].update(b for b in ws if near(a, b))
    form = {}
    for w, others in links.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(links[w]), counts[form[w]] if form[w] else None)
    return out


def as_map(df):
    rows = df.collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


def test_holes_find_all_near_pairs():
    rng = random.Random(4)
    words = {"".join(rng.choices("abé", k=rng.randint(6, 8))) for _ in range(150)}
    got = plain_groups(dict.fromkeys(words, 5))
    assert {w: v[3] for w, v in got.items()} == {w: sum(near(w, o) for o in words) for w in words}


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in read_table(spark, sf_dir, "documents").collect()]
    want = plain_groups(plain_counts(rows))
    assert as_map(QUERIES["op11_spelling_groups"](spark, sf_dir)) == want
    assert any(v[0] for v in want.values()) and any(v[3] > 3 for v in want.values())


@pytest.mark.parametrize("tile_words", [3, 40, 2048])
def test_few_letters_and_many_slices(spark, tile_words):
    """Few letters make large blocks: slices of any size give the same pairs."""
    rng = random.Random(8)
    words = ["".join(rng.choices("aéÿ", k=rng.randint(6, 9))) for _ in range(220)]
    often = {w: rng.choice((1, 1, 7, 50)) for w in words}
    rows = [(i, " ".join(w for w in words for _ in range(often[w]))) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_groups(plain_counts(rows, noise=11))
    got = as_map(spelling.spelling_groups(spark, docs, noise=11, tile_words=tile_words))
    assert got == want and any(v[1] not in (w, v[0]) for w, v in want.items())


def test_one_edit_pieces(monkeypatch):
    monkeypatch.setattr(spelling, "CELLS", 16)
    rng = random.Random(2)
    for add in (0, 1):
        a = [bytes(rng.choices(b"ab", k=7)) for _ in range(300)]
        b = [bytes(rng.choices(b"ab", k=7 + add)) for _ in range(300)]
        assert spelling.one_edit(a, b).tolist() == [near(x.decode(), y.decode()) for x, y in zip(a, b)]
    counts = spelling.letter_counts([b"abcdef", b"abcdee", b"abcd", "ÿ".encode("latin-1") * 3000])
    assert counts.dtype == np.float64
    pairs = [(int(i), int(j)) for x in spelling.close_pairs(counts, counts) for i, j in zip(*x)]
    assert sorted(pairs) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (2, 0), (2, 2), (3, 3)]


def test_edge_rows(spark):
    huge = "é" * 1_500_000
    extra = [(20, f"{huge} x {huge[1:]}"), (21, f"{huge}"), (None, "WordlessÄ wordlessÄ wordlessıÄ×÷")]
    rows = TEXTS * 5 + extra * 5
    docs = edge_docs(spark)
    for _ in range(4):
        docs = docs.unionByName(edge_docs(spark))
    more = spark.createDataFrame(extra * 5, "doc_id long, text string")
    docs = docs.unionByName(more, allowMissingColumns=True)
    counts = plain_counts(rows)
    assert as_map(spelling.spelling_groups(spark, docs)) == {
        **plain_groups({w: n for w, n in counts.items() if len(w) < 1000}),
        huge: (None, huge, 10, 1, None), huge[1:]: (None, huge[1:], 5, 1, None)}
    assert spelling.spelling_groups(spark, no_docs(spark)).count() == 0

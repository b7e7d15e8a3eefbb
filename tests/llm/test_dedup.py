"""Exact, near and substring deduplication against plain versions."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from edge_rows import BASE, TEXTS, edge_docs, no_docs
from tidemart.llm import common, components, exact_dedup, simhash
from tidemart.llm import substring_dedup as sub
from tidemart.llm.common import read_table
from tidemart.llm.queries import QUERIES


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_groups(texts):
    groups = defaultdict(list)
    for doc_id, text in texts:
        groups[low(text)].append(doc_id)
    return groups


def test_exact_groups_equal_plain(spark):
    groups = plain_groups(TEXTS)
    for heavy_rows in (2, 1000):
        out = exact_dedup.exact_groups(spark, edge_docs(spark), heavy_rows=heavy_rows).collect()
        by_digest = defaultdict(list)
        for r in out:
            by_digest[r.text_sha256].append(r)
        assert len(out) == len(TEXTS) and len(by_digest) == len(groups)
        for text, ids in groups.items():
            rows = by_digest[hashlib.sha256(text.encode()).hexdigest()]
            known = [i for i in ids if i is not None]
            assert {r.keep_id for r in rows} == {max(known, default=None)} and {r.group_size for r in rows} == {len(ids)}
            assert sum(r.kept for r in rows) == 1 and all(r.doc_id == r.keep_id for r in rows if r.kept)
    assert exact_dedup.exact_groups(spark, no_docs(spark)).count() == 0


def test_drop_exact_copies(spark):
    want = sorted((max((i for i in ids if i is not None), default=-1), text) for text, ids in plain_groups(TEXTS).items())
    for heavy_rows in (2, 1000):
        out = exact_dedup.drop_exact_copies(spark, edge_docs(spark), heavy_rows=heavy_rows)
        assert out.columns == edge_docs(spark).columns
        assert sorted((-1 if r.doc_id is None else r.doc_id, low(r.text)) for r in out.collect()) == want
    assert exact_dedup.drop_exact_copies(spark, no_docs(spark)).count() == 0


def test_heavy_winners_are_exact(spark):
    rows = [(i, "a" if i % 3 else f"u{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, digest string")
    [r] = exact_dedup.heavy_winners(df, order=["doc_id"], heavy_rows=100).collect()
    assert (r.digest, r.group_size, r.winner.doc_id) == ("a", 2000, 2999)


def test_exact_path_is_native(spark, sf_dir):
    plan = QUERIES["op9_exact_dedup"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


# ---- near duplicates ---------------------------------------------------------------------

def plain_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low(text)) if w]
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs):
    """Least doc_id reachable, by comparing every two fingerprints."""
    prints = sorted({f for _, f in pairs})
    parent = {f: f for f in prints}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(prints):
        for b in prints[i + 1:]:
            if (a ^ b).bit_count() <= 4:
                parent[root(a)] = root(b)
    least = {}
    for doc_id, f in pairs:
        if doc_id is not None:
            least[root(f)] = min(doc_id, least.get(root(f), doc_id))
    return [(doc_id, f, least.get(root(f))) for doc_id, f in pairs]


def test_fingerprints():
    for _, text in TEXTS:
        assert simhash.fingerprint(text) == plain_fingerprint(text)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0
    size, simhash.BLOCK = simhash.BLOCK, 7
    try:
        assert simhash.fingerprint(BASE) == plain_fingerprint(BASE)
    finally:
        simhash.BLOCK = size


def near_values(rng, n, seeds):
    out = set()
    base = [rng.getrandbits(64) for _ in range(seeds)]
    while len(out) < n:
        v = rng.choice(base)
        for b in rng.sample(range(64), rng.randint(0, 5)):
            v ^= 1 << b
        out.add(v)
        if rng.random() < 0.3:
            base.append(v)
    return sorted(out, key=lambda v: (v.bit_count(), v))


def test_tiles_connect_like_all_pairs():
    rng = random.Random(5)
    for n, seeds, tile in ((300, 40, 16), (300, 2, 64), (40, 40, 1024), (600, 3, 512)):
        values = near_values(rng, n, seeds)
        links = simhash.forest_of(np.array(values, np.uint64), tile=tile)
        parent = list(range(n))
        for i, r in links:
            parent[i] = r
        want = {f: c for c, f, _ in []} or plain_components([(i, v) for i, v in enumerate(values)])
        groups = defaultdict(set)
        for i, _, c in want:
            groups[c].add(i)
        assert {frozenset(g) for g in groups.values()} == {
            frozenset(i for i in range(n) if parent[i] == r) for r in set(parent)}


def test_dense_tile_is_joined_without_pairs():
    values = sorted({1 << a | 1 << b for a in range(64) for b in range(64)}, key=lambda v: (v.bit_count(), v))
    links = simhash.forest_of(np.array(values, np.uint64))
    assert len(links) == len(values) - 1


def test_links_through_grids_and_cells(spark):
    rng = random.Random(7)
    values = near_values(rng, 400, 60)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    classes = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    for grid_rows in (simhash.GRID_ROWS, 5):
        roots = {r.u: r.root for r in components.components(spark, simhash.links(spark, classes, grid_rows)).collect()}
        got = defaultdict(set)
        for i, s in enumerate(signed):
            got[roots.get(s, s)].add(i)
        want = defaultdict(set)
        for i, _, c in plain_components([(i, v) for i, v in enumerate(values)]):
            want[c].add(i)
        assert {frozenset(g) for g in got.values()} == {frozenset(g) for g in want.values()}


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000)]
    roots = {r.u: r.root for r in components.components(spark, spark.createDataFrame(links, "u long, v long")).collect()}
    assert {roots[i] for i in range(1, 101)} == {0} and {roots[i] for i in range(1001, 1200)} == {1000}
    assert components.components(spark, spark.createDataFrame([], "u long, v long")).count() == 0


def test_hot_keys_of_joins_are_split(spark, tmp_path):
    """A vertex with most links, and a grid with most fingerprints, do not end in one task of a join."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        star = spark.range(40_000).select(F.col("id").alias("v"), F.lit(-1).cast("long").alias("u")).unionByName(
            spark.range(4_000).selectExpr("-10 - id AS u", "id + 100000 AS v")).repartition(8)
        star = common.staged(spark, star, "star")
        keys = common.staged(spark, spark.range(40_000).selectExpr("id AS fp", "IF(id % 5 = 0, id, 7) AS grid").repartition(8), "keys")
        for df in (components._large_star(spark, star), components._small_star(spark, star.select(F.col("v").alias("u"), F.lit(-5).cast("long").alias("v"))
                   .unionByName(star.select(F.lit(999_999).cast("long").alias("u"), "v"))), simhash.in_cells(keys, 1_000)):
            df.write.mode("overwrite").parquet(f"{tmp_path}/out")
            df.collect()
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_near_duplicates_equal_plain(spark, sf_dir):
    out = QUERIES["op5_simhash"](spark, sf_dir).collect()
    docs = [(r.doc_id, r.text) for r in read_table(spark, sf_dir, "documents").collect()]
    want = plain_components([(i, plain_fingerprint(t)) for i, t in docs])
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in out) == sorted((i, f"{f:016x}", c) for i, f, c in want)


def test_near_duplicate_edges(spark):
    out = simhash.near_duplicate_groups(spark, edge_docs(spark)).collect()
    want = plain_components([(i, plain_fingerprint(t)) for i, t in TEXTS])

    def key(x):
        return tuple((v is None, v or 0) for v in x)

    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in out), key=key) == sorted(want, key=key)
    kept = simhash.drop_near_duplicates(spark, edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    rows = kept.collect()
    assert len(rows) == len({c for _, _, c in want})
    assert {r.doc_id for r in rows} == {c for _, _, c in want}
    assert simhash.drop_near_duplicates(spark, no_docs(spark)).count() == 0


# ---- substrings --------------------------------------------------------------------------

def test_gear_hash_is_the_rolling_one():
    data = np.frombuffer(BASE.encode(), np.uint8)
    h, rolled = 0, []
    for b in data.tolist():
        h = (2 * h + int(sub.GEAR[b])) % (1 << 16)
        rolled.append(h)
    assert sub.gear_hashes(data)[15:].tolist() == rolled[15:]


def test_chunks_cover_texts_and_resist_insertions():
    rng = random.Random(2)
    text = " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(2000))
    cut = sub.chunks_of(text)
    assert cut[0][0] == 0 and sum(c[1] for c in cut) == len(text) and all(c[1] >= sub.LEAST_CHUNK for c in cut[:-1])
    moved = {c[2] for c in sub.chunks_of(text[:500] + "inserted words " + text[500:])}
    assert len({c[2] for c in cut} - moved) <= 6
    assert sub.chunks_of(None) == sub.chunks_of("") == []
    assert len(sub.chunks_of("a" * 10_000)) >= 1


def prose(rng, n):
    return " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(n))


def test_planted_passages_are_found_and_cut(spark):
    rng = random.Random(4)
    passages = [prose(rng, 55) for _ in range(20)]
    texts = {i: prose(rng, 200) for i in range(100)}
    holders = defaultdict(list)
    for p, passage in enumerate(passages):
        for i in rng.sample(range(80), 3):
            texts[i] = f"{texts[i]} {passage} {prose(rng, 30)}"
            holders[p].append(i)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    runs = sub.repeated_runs(spark, docs)
    rows = runs.collect()
    found = {(r.doc_id, r.first_doc_id) for r in rows}
    assert all((i, min(ids)) in found for ids in holders.values() for i in ids if i != min(ids))
    assert not {r.doc_id for r in rows} - {i for ids in holders.values() for i in ids}
    cut = {r.doc_id: r.text for r in sub.without_runs(docs, runs).collect()}
    gone = defaultdict(int)
    for doc_id, start, size in {(r.doc_id, r.run_start, r.run_bytes) for r in rows}:
        gone[doc_id] += size
    assert all(len(cut[i]) == len(texts[i]) - gone[i] for i in texts)


def test_runs_reach_the_passage_ends(spark):
    rng = random.Random(9)
    passages = [prose(rng, 45) for _ in range(60)] + [f"{w} {w[::-1]}x " * 20 for w in ("lorem", "tooth", "sand", "orchid", "dials")]
    rows = []
    for i, p in enumerate(passages):
        rows += [(2 * i, f"{prose(rng, 90)} {p} {prose(rng, 40)}"), (2 * i + 1, f"{prose(rng, 60)} {p} {prose(rng, 70)}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    best = defaultdict(int)
    for r in sub.repeated_runs(spark, docs).collect():
        best[r.doc_id] = max(best[r.doc_id], r.run_bytes)
    for i, p in enumerate(passages):
        assert best[2 * i + 1] >= (len(p) if i < 60 else len(p) - 12), (i, p)  # a repetition may align a period later


def test_texts_under_one_or_no_id_repeat(spark):
    rng = random.Random(21)
    one, none, twice = (prose(rng, 60) for _ in range(3))
    texts = [
        (5, f"{prose(rng, 40)} {one} {prose(rng, 20)}"), (5, f"{prose(rng, 30)} {one} {prose(rng, 30)}"),
        (None, f"{prose(rng, 40)} {none} {prose(rng, 20)}"), (None, f"{prose(rng, 30)} {none} {prose(rng, 30)}"),
        (None, f"{twice} {prose(rng, 30)} {twice}"), (6, prose(rng, 80)), (6, prose(rng, 80)),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    runs = sub.repeated_runs(spark, docs)
    rows = runs.collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.first_doc_id) for r in rows) == [(-1, None), (-1, None), (5, 5)]
    assert len({r.text_hash for r in rows}) == 3 and all(r.run_bytes >= min(map(len, (one, none, twice))) for r in rows)
    left = [r.text for r in sub.without_runs(docs, runs).collect()]
    assert [sum(t.count(p) for t in left) for p in (one, none, twice)] == [1, 1, 1]


def test_extension_goes_past_its_first_look(spark):
    rng = random.Random(12)
    shared = prose(rng, 400)
    texts = [(1, prose(rng, 50) + " =1= " + shared + " =1= " + prose(rng, 50)), (2, prose(rng, 40) + " =2= " + shared + " =2= " + prose(rng, 60))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    at = {i: t.encode().index(shared.encode()) for i, t in texts}
    # A single chunk in the passage's middle, as if no other had been cut alike.
    mid = len(shared) // 2
    one = spark.createDataFrame([(2, at[2] + mid, 20, 1, at[1] + mid, at[2] + mid, 40)],
        "doc_id long, start int, size int, first_doc_id long, first_start int, gap int, room int")
    hashes = docs.select("doc_id", F.xxhash64("text").alias("h"))
    one = one.join(hashes.toDF("doc_id", "text_hash"), "doc_id").join(hashes.toDF("first_doc_id", "first_hash"), "first_doc_id")
    [r] = sub.extended(spark, docs, one).collect()
    assert (r.before, r.after) == (mid + 2, 40)  # with the "= " before it
    assert sub.common_ends("aé".encode() + b"X", "aè".encode() + b"X", 0, 1) == (0, 0)


def test_substring_edges(spark):
    runs = sub.repeated_runs(spark, edge_docs(spark))
    ids = {r.doc_id for r in runs.collect()}
    assert 8 in ids and 3 in ids and 13 in ids and None in ids and not ids & {4, 5, 6, 1}
    out = sub.without_runs(edge_docs(spark), runs)
    assert out.columns == edge_docs(spark).columns and out.count() == len(TEXTS)
    assert sub.repeated_runs(spark, no_docs(spark)).count() == 0


def plain_repeats(texts, gram):
    """Per text: True for every byte within ``gram`` bytes that stand earlier in this text or in an earlier one.  ``texts`` in order."""
    seen, out = set(), []
    for text in texts:
        raw = (text or "").encode()
        met = np.zeros(len(raw), bool)
        for at in range(len(raw) - gram + 1):
            piece = raw[at:at + gram]
            if piece in seen:
                met[at:at + gram] = True
            else:
                seen.add(piece)
        out.append(met)
    return out


def stretches(met):
    edges = np.flatnonzero(np.diff(np.concatenate([[False], met, [False]]).astype(int)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def test_substring_query_against_all_repeats(spark, sf_dir):
    """Nothing is reported that does not repeat, byte by byte, and nearly all long repeats are, up to their ends."""
    docs = sorted(((r.doc_id, r.text) for r in read_table(spark, sf_dir, "documents").collect()), key=lambda r: r[0])
    rows = QUERIES["op8_substring_dedup"](spark, sf_dir).collect()
    runs = defaultdict(set)
    for r in rows:
        runs[r.doc_id].add((r.run_start, r.run_start + r.run_bytes))
    assert all(e - s >= sub.LEAST_BYTES for spans in runs.values() for s, e in spans)
    short = plain_repeats([t for _, t in docs], sub.LEAST_CHUNK)
    long = plain_repeats([t for _, t in docs], 300)
    found = missed = 0
    for (doc_id, _), repeated, longer in zip(docs, short, long):
        reported = np.zeros(len(repeated), bool)
        for s, e in runs[doc_id]:
            reported[s:e] = True
        assert not (reported & ~repeated).any(), doc_id
        for s, e in stretches(longer):
            found += int(reported[s:e].sum())
            missed += int((~reported[s:e]).sum())
    assert found > 50_000 and missed < 0.02 * found

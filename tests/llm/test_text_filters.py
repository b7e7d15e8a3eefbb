"""Toxicity, decontamination, URL filter and license scan against plain versions."""

import hashlib
import random
import re
import zlib

import pytest

from edge_rows import BASE, TEXTS, edge_docs, no_docs
from tidemart.llm import decontamination as dc
from tidemart.llm import licenses, toxicity, url_filter
from tidemart.llm.common import read_table
from tidemart.llm.queries import QUERIES

FIXED = toxicity.Grammar(*toxicity.vocabulary({}))


def total(text):
    return sum(w for _, _, w in FIXED.clauses(text))


def test_grammar_weighs_clauses():
    plain, aimed = total("what an idiot."), total("you are an idiot.")
    assert 0 < plain < aimed
    assert total("you are not an idiot.") < plain
    assert total("they said that idiot left.") < plain
    assert total("you said nothing. what an idiot.") == plain  # a clause ends the report
    assert total("i will kill you.") >= 2.0
    assert total("kill the lights.") == 0.0
    assert total("") == total(None) == total("a fine day, not a bad one.") == 0.0


def test_composed_table_equals_machines_side_by_side():
    start, table = toxicity.composed()
    machines = [toxicity._negation(), toxicity._report(), toxicity._target(), toxicity._threat(), toxicity._insult()]
    rng = random.Random(3)
    for _ in range(50):
        state, parts = start, [0] * 5
        for symbol in rng.choices(toxicity.SYMBOLS, k=30):
            state, factor, adds = table[state, symbol]
            given = []
            for i, m in enumerate(machines):
                parts[i], out = m[parts[i], symbol]
                given.append(out)
            neg, rep, tgt, thr, ins = given
            assert factor == ins * neg * rep * tgt and adds == thr * neg * rep


def test_spans_hold_the_clause():
    text = "Nice day. You total moron! Bye."
    [(start, end, _)] = FIXED.clauses(text)
    assert text[start:end] == "You total moron"


def test_toxicity_learns_and_generalises(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    docs, labels = [], []
    for i in range(1200):
        text = rng.choices(words, k=80)
        toxic = i % 5 == 0
        if toxic:
            for at in rng.sample(range(80), 3):
                text[at] = f"grobo{rng.choice('abcdefghij')}"
        docs.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(spark, d, lab)
    assert any("grobo".startswith(b) for b in model["beginnings"])
    got = {r.doc_id: r.predicted for r in toxicity.score_texts(d, model).collect()}
    held = [i for i in range(1200) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i] == labels[i][1] for i in held)


def test_held_out_rows_are_not_used(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(200)], "doc_id long, toxic int")
    used = {int(r.text.split()[1]) for r in toxicity.training_rows(docs, labels).collect()}
    assert used == {i for i in range(200) if zlib.crc32(str(i).encode()) % 5}
    assert toxicity.training_rows(docs, labels, max_rows=50).count() == 50


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(spark, edge_docs(spark), labels)
    out = toxicity.score_texts(edge_docs(spark), model).collect()
    assert len(out) == len(TEXTS) and all(0 <= r.score <= 1 for r in out)
    assert {r.doc_id for r in out if r.predicted} == {14}
    assert toxicity.score_texts(no_docs(spark), model).count() == 0


def test_toxicity_query(spark):
    sf = "/root/testdata/sf0.01"
    out = {r.doc_id: r for r in QUERIES["op10_toxicity"](spark, sf).collect()}
    labels = {r.doc_id: r.toxic for r in read_table(spark, sf, "labels").collect()}
    held = [(labels[i], r) for i, r in out.items() if i in labels and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in out.items())
    assert sum(r.predicted == t for t, r in held) / len(held) > 0.9
    assert sum(r.predicted for t, r in held if not t) == 0


# ---- decontamination ---------------------------------------------------------------------

def plain_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_contamination(text, items):
    words, hit, met = plain_words(text), set(), set()
    for item_id, item in items:
        iw = plain_words(item)
        n = min(13, len(iw))
        for window in {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)} if n else ():
            for i in range(len(words) - n + 1):
                if tuple(words[i:i + n]) == window:
                    hit.update(range(i, i + n))
                    if item_id is not None:
                        met.add(str(item_id))
    return len(words), sorted(hit), sorted(met)


ITEMS = [
    (1, " ".join(f"q{i}" for i in range(30))), (2, "alpha3 beta3 alpha4"), (10, "short"), (None, "äö one"), (4, None), (5, "!?"),
    (10, "short"), (11, "Q5 q6, q7-q8"), (12, " ".join(f"q{i}" for i in range(10, 60))),
]


def plain_runs(text, hit):
    """Words of each run of consecutive hit places."""
    words, out, last = plain_words(text), [], None
    for at in hit:
        if last is None or at > last + 1:
            out.append([])
        out[-1].append(words[at])
        last = at
    return out


@pytest.mark.parametrize("block_words", [dc.BLOCK_WORDS, 60, 20])
def test_contamination_equals_plain(spark, block_words):
    texts = [*TEXTS, (20, " ".join(f"Q{i}" for i in range(5, 25))), (21, "a short, short tale"), (22, "q1 q2 q3")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = dc.contamination(docs, bench, block_words=block_words).collect()
    assert len(out) == len(texts)
    want = {}
    for doc_id, text in texts:
        n, hit, met = plain_contamination(text, ITEMS)
        want.setdefault((doc_id, text), (n, len(hit), met, bool(hit) and 20 * len(hit) >= n))
    for r in out:
        assert (r.n_words, r.n_hit, r["items"], r.contaminated) == want[r.doc_id, r.text]
        assert [plain_words(r.text[s.start:s.end]) for s in r.spans] == plain_runs(r.text, plain_contamination(r.text, ITEMS)[1])


def test_contamination_edges(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = dc.contamination(edge_docs(spark), bench)
    assert set(edge_docs(spark).columns) - {"hit"} <= set(out.columns) and out.count() == len(TEXTS)
    assert dc.contamination(no_docs(spark), bench).count() == 0
    empty = dc.contamination(edge_docs(spark), bench.where("false")).collect()
    assert len(empty) == len(TEXTS) and not any(r.contaminated for r in empty)


# ---- URLs --------------------------------------------------------------------------------

def test_url_parts_rules_and_terms(spark):
    cases = {
        "http://A.Example.NET/en/x?y#z": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "http://a.example.net/fr/x": ("a.example.net", "/fr/x", "net/", "block"),
        "https://example.com/de/": ("example.com", "/de/", "example.com/de/", "block"),
        "https://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
        "x://b.org/fr/1": ("b.org", "/fr/1", "org/fr/", "allow"),
        "http://h.net": ("h.net", "", None, "allow"),
        "http://h.com?a/b://c": ("h.com", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "http://casino.com/": ("casino.com", "/", None, "block"),
        "http://casinoroyale.com/": ("casinoroyale.com", "/", None, "allow"),
        "http://free.com/free/free": ("free.com", "/free/free", None, "allow"),
        "http://free-bets.com/": ("free-bets.com", "/", None, "block"),
        None: ("", "", None, "allow"), "": ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(cases)], "page_id long, url string, verdict string")
    out = {r.url: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judged(pages).collect()}
    assert out == cases
    assert url_filter.judged(pages.where("false")).count() == 0


# ---- licenses ----------------------------------------------------------------------------

def plain_shingles(text):
    words = [w for w in re.sub("[^a-z0-9]+", " ", (text or "").lower()).split(" ") if w]
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def plain_short(texts, templates):
    out = set()
    for doc_id, text in texts:
        have = [w for w in re.sub("[^a-z0-9]+", " ", (text or "").lower()).split(" ") if w]
        for name, wording in templates:
            want = [w for w in re.sub("[^a-z0-9]+", " ", wording.lower()).split(" ") if w]
            if any(have[i:i + len(want)] == want for i in range(len(have))):
                out.add((doc_id, name))
    return out


def plain_licenses(texts):
    out = {}
    for doc_id, text in texts:
        have = plain_shingles(text)
        for name, wording in licenses.TEMPLATES:
            want = plain_shingles(wording)
            share = len(want & have) / len(want)
            if share >= licenses.LEAST:
                out[doc_id, name] = max(share, out.get((doc_id, name), 0))
    return out | dict.fromkeys(plain_short(texts, licenses.NOTICES), 1.0)


def test_licenses_equal_plain(spark):
    mit = licenses.TEMPLATES[2][1]
    words = mit.split()
    texts = [
        *TEXTS, (30, f"intro {mit} outro"), (31, BASE + " " + " ".join(words[:-4])), (32, " ".join(words[: len(words) // 2])),
        (33, "see here: LICENSED under the apache license -- version 2.0! thanks"), (34, licenses.TEMPLATES[5][1]),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {(r.doc_id, r.license): r.containment for r in licenses.license_matches(docs).collect()}
    assert got == pytest.approx(plain_licenses(texts)) and len(got) > 4
    assert licenses.license_matches(docs.where("false")).count() == 0


def test_license_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in read_table(spark, sf_dir, "documents").collect()]
    got = {(r.doc_id, r.license): r.containment for r in QUERIES["op2_license_scan"](spark, sf_dir).collect()}
    assert got == pytest.approx(plain_licenses(rows)) and any(name == "all-rights-reserved" for _, name in got)


def test_short_templates_are_found(spark, sf_dir):
    templates = (("one", "Proprietary."), ("two", "Public domain"), ("three", "All rights reserved."), ("four", "no license, no warranty"))
    texts = [
        *TEXTS, (40, "ALL RIGHTS -- reserved"), (41, "all rights are reserved"), (42, "proprietary"), (43, "in the public domain, not public"),
        (44, "No license no warranty. All rights reserved. all rights reserved"), (45, "no license, no"),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = licenses.license_matches(docs, templates).collect()
    assert sorted((r.doc_id, r.license) for r in rows) == sorted(plain_short(texts, templates)) and {r.containment for r in rows} == {1.0}
    assert {(r.doc_id, r.license): r.first_word for r in rows}[44, "three"] == 4
    known = licenses.TEMPLATES + licenses.NOTICES + templates
    both = {(r.doc_id, r.license): r.containment for r in licenses.license_matches(docs, known).collect()}
    assert both == pytest.approx(plain_licenses(texts) | dict.fromkeys(plain_short(texts, templates), 1.0))
    for empty in ("", " .!", None):
        with pytest.raises(ValueError, match="without a word"):
            licenses.license_matches(docs, (*templates, ("none", empty)))



def test_templates_are_scanned_in_parts(spark, monkeypatch):
    texts = [(i, f"intro {wording} outro " * 2) for i, (_, wording) in enumerate(licenses.TEMPLATES + licenses.NOTICES)]
    docs = spark.createDataFrame([*texts, *TEXTS], "doc_id long, text string")
    want = sorted(map(tuple, licenses.license_matches(docs).collect()), key=repr)
    monkeypatch.setattr(licenses, "MAX_TEMPLATE_WORDS", 50)
    parts = licenses.parts_of(licenses.TEMPLATES)
    assert len(parts) > 4 and sum(parts, ()) == licenses.TEMPLATES
    assert sorted(map(tuple, licenses.license_matches(docs).collect()), key=repr) == want


def test_license_plan_has_no_python(spark, sf_dir):
    plan = QUERIES["op2_license_scan"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_item_digest(spark, sf_dir):
    rows = QUERIES["op3_decontamination"](spark, sf_dir).collect()
    assert {r.items_sha256 for r in rows if not r.n_items} == {hashlib.sha256(b"").hexdigest()}

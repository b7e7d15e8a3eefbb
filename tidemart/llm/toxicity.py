"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses.  Every token of a clause becomes one symbol, and five small transducers read the symbols side
by side: insults (weights out), threats (a threat verb followed by a target), targets (a person is addressed), negation
(a scope of three tokens) and reported speech (to the end of the clause).  :func:`composed` multiplies them out into one
transition table, so a token costs one lookup.  A clause scores by the insults and threats it holds, as changed by
target, negation and report; a document by the sum over its clauses.

The insult vocabulary is the fixed list below plus words and word beginnings that the labels single out
(:func:`fit`).  Labels choose vocabulary and calibration only; language, source, labels and doc_id are never inputs of a
score.

Null and empty texts have no clause and get the base score.  Repeated rows get equal scores.  A text of any length is read once,
clause by clause; an empty table gives no rows.  Without usable labels the
fixed list and the default calibration hold.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, staged

# Fixed word lists of the grammar.
INSULTS = (
    "asshole", "bastard", "bitch", "clown", "coward", "creep", "cretin", "degenerate", "disgusting", "dumb", "dumbass",
    "filth", "fool", "freak", "garbage", "hypocrite", "idiot", "idiotic", "imbecile", "jerk", "liar", "loser", "maggot",
    "moron", "moronic", "parasite", "pathetic", "pig", "rat", "scum", "scumbag", "shithead", "stupid", "thug", "trash",
    "ugly", "vermin", "worthless", "idioten", "idiota", "imbécil", "imbécile", "estúpido", "stupide", "dumm", "arschloch",
    "connard", "cabrón",
)
THREATS = ("beat", "burn", "crush", "destroy", "hang", "hurt", "kill", "murder", "punch", "shoot", "stab", "strangle")
TARGETS = (
    "you", "your", "you're", "u", "him", "her", "them", "they", "he", "she", "these", "those", "du", "dich", "ihr", "sie",
    "tu", "toi", "vous", "tú", "te", "usted",
)
NEGATIONS = ("not", "never", "no", "isn't", "aren't", "wasn't", "don't", "nicht", "kein", "nie", "pas", "jamais", "nunca")
REPORTS = ("said", "says", "told", "called", "wrote", "quoted", "reported", "claimed", "sagte", "dit", "dijo")

MAX_TRAINING_ROWS = 20_000  # bound of the labelled sample that the classifier is fitted on
BEGINNINGS = (4, 5, 6)  # lengths of word beginnings that may be learned
EVIDENCE = 16.0  # least n * KL(share among its documents || overall share), in nats
FULL_EVIDENCE = 40.0  # with less, a word weighs less
PRECISION = 0.8  # least share of toxic documents among those with the word
FIXED_WEIGHT = 1.0
DEFAULT_FIT = (-3.0, 3.0)

LISTED = frozenset((*INSULTS, *THREATS, *TARGETS, *NEGATIONS, *REPORTS))
TOKEN = re.compile(r"[\w']+|[.!?;:\n]")
ENDS = frozenset(".!?;:\n")

# Symbols: W other word, I insult, V threat verb, T target, N negation, R report, E end of clause.
SYMBOLS = "WIVTNRE"


def _negation() -> dict:
    """State: tokens left in the scope."""
    table = {}
    for left, symbol in product(range(4), SYMBOLS):
        table[left, symbol] = (3 if symbol == "N" else 0 if symbol == "E" else max(0, left - 1), 0.25 if left else 1.0)
    return table


def _report() -> dict:
    """State: 1 after a verb of saying, to the end of the clause."""
    return {
        (on, s): (1 if s == "R" else 0 if s == "E" else on, 0.5 if on else 1.0) for on, s in product(range(2), SYMBOLS)
    }


def _target() -> dict:
    """State: 1 after a target, to the end of the clause."""
    return {
        (on, s): (1 if s == "T" else 0 if s == "E" else on, 1.5 if on else 1.0) for on, s in product(range(2), SYMBOLS)
    }


def _threat() -> dict:
    """State: tokens left in which a target completes the threat; gives what the threat adds."""
    table = {}
    for left, symbol in product(range(4), SYMBOLS):
        after = 3 if symbol == "V" else 0 if symbol in "TE" else max(0, left - 1)
        table[left, symbol] = (after, 2.0 if symbol == "T" and left else 0.0)
    return table


def _insult() -> dict:
    """One state: an insult passes its word's weight."""
    return {(0, s): (0, 1.0 if s == "I" else 0.0) for s in SYMBOLS}


def composed() -> tuple[int, dict]:
    """Start state and table: (state, symbol) -> (state, factor of the word's weight, weight added).

    The product of the five transducers, numbered over the states reached from the start.
    """
    neg, rep, tgt, thr, ins = _negation(), _report(), _target(), _threat(), _insult()
    numbers, table, todo = {(0, 0, 0, 0, 0): 0}, {}, [(0, 0, 0, 0, 0)]
    while todo:
        state = todo.pop()
        for s in SYMBOLS:
            (a, by_neg), (b, by_rep), (c, by_tgt), (d, adds), (e, passes) = (
                machine[part, s] for machine, part in zip((neg, rep, tgt, thr, ins), state)
            )
            after = (a, b, c, d, e)
            if after not in numbers:
                numbers[after] = len(numbers)
                todo.append(after)
            table[numbers[state], s] = (numbers[after], passes * by_neg * by_rep * by_tgt, adds * by_neg * by_rep)
    return 0, table


class Grammar:
    """Scores texts with a vocabulary of weighted words and word beginnings."""

    def __init__(self, words: dict[str, float], beginnings: dict[str, float]):
        self.words, self.beginnings = words, beginnings
        self.lengths = sorted({len(b) for b in beginnings}, reverse=True)
        self.start, self.table = composed()
        self.symbols = {w: s for ws, s in ((REPORTS, "R"), (NEGATIONS, "N"), (TARGETS, "T"), (THREATS, "V")) for w in ws}
        self.known: dict[str, float] = {}

    def weight(self, word: str) -> float:
        """The word's own weight, else that of its longest known beginning, else 0.  Looked up once per word."""
        found = self.known.get(word)
        if found is None:
            found = self.words.get(word, 0.0)
            if not found:
                found = next((self.beginnings[word[:n]] for n in self.lengths if word[:n] in self.beginnings and len(word) > n), 0.0)
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[word] = found
        return found

    def clauses(self, text: str | None) -> list[tuple[int, int, float]]:
        """(start, end, score) of every clause that scores, offsets into ``text``."""
        if not text:
            return []
        words = set(re.findall(r"[\w']+", low := text.lower()))
        if not any(map(self.weight, words)) and words.isdisjoint(THREATS):
            return []
        # lower() may change lengths of a few letters; offsets then follow the lower-cased text.
        out, state, begin, score = [], self.start, None, 0.0
        for m in TOKEN.finditer(low):
            token = m.group()
            if token in ENDS:
                if score:
                    out.append((begin, m.start(), score))
                state, begin, score = self.start, None, 0.0
                continue
            begin = m.start() if begin is None else begin
            weight = self.weight(token)
            state, factor, adds = self.table[state, "I" if weight else self.symbols.get(token, "W")]
            score += factor * weight + adds
        if score:
            out.append((begin, len(low), score))
        return out

    def raw(self, text: str | None) -> tuple[float, int]:
        found = self.clauses(text)
        return math.log1p(sum(s for _, _, s in found)), len(found)


# ---- fitting ---------------------------------------------------------------------------

def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """(text, toxic) of at most ``max_rows`` labelled documents, spread by hash; the held-out fifth is never taken."""
    chosen = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    texts = docs.where("text IS NOT NULL").select("doc_id", "text")
    return (
        texts.join(F.broadcast(chosen), "doc_id")  # at most max_rows rows of two numbers
        .groupBy("text").agg(F.max("toxic").alias("toxic"))  # copies count once
    )


def _features(text: str) -> Iterator[str]:
    """Words that the fixed lists do not have, so that listed ones keep their role, and their beginnings."""
    words = set(re.findall(r"[\w']+", text.lower())).difference(LISTED)
    yield from words
    yield from {f"{w[:n]}*" for w in words for n in BEGINNINGS if len(w) > n}


def _counts(column: str, among: set[str] | None):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found = _features(text)
                seen.update(found if among is None else among.intersection(found))
        yield pa.RecordBatch.from_pydict({"feature": list(seen), column: list(seen.values())})

    return count


def learned(spark: SparkSession, rows: DataFrame) -> dict[str, float]:
    """Words, and word beginnings marked by ``*``, that single out toxic rows, with weights of 0 to 2."""
    toxic, clean = (c["n"] for c in rows.groupBy().agg(
        F.array(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0))).alias("n")
    ).selectExpr("explode(n) AS n").collect())
    if not toxic or not clean:
        return {}
    share = toxic / (toxic + clean)
    least = math.ceil(EVIDENCE / -math.log(share))
    pos = (
        rows.where("toxic = 1").mapInArrow(_counts("pos", None), "feature string, pos long")
        .groupBy("feature").agg(F.sum("pos").alias("pos")).where(F.col("pos") >= least).collect()
    )  # bounded: a sample of max_rows documents
    among = {r.feature for r in pos}
    neg = Counter({
        r.feature: r.neg for r in rows.where("toxic = 0").mapInArrow(_counts("neg", among), "feature string, neg long")
        .groupBy("feature").agg(F.sum("neg").alias("neg")).collect()
    })
    scored = []
    for feature, p in ((r.feature, r.pos) for r in pos):
        n = p + neg[feature]
        at = p / n
        if at < PRECISION:
            continue
        gain = n * (at * math.log(at / share) + ((1 - at) * math.log((1 - at) / (1 - share)) if at < 1 else 0.0))
        if gain >= EVIDENCE:
            odds = math.log(((p + 0.5) / (toxic + 1)) / ((neg[feature] + 0.5) / (clean + 1)))
            scored.append((gain, feature, min(2.0, odds / 4) * min(1.0, gain / FULL_EVIDENCE)))
    return {f: w for _, f, w in scored}  # as many as the evidence in max_rows documents supports


def vocabulary(weights: dict[str, float]) -> tuple[dict[str, float], dict[str, float]]:
    words = dict.fromkeys(INSULTS, FIXED_WEIGHT)
    words |= {f: w for f, w in weights.items() if not f.endswith("*")}
    return words, {f[:-1]: w for f, w in weights.items() if f.endswith("*")}


def logistic(bins: list[tuple[float, int, int]], start: tuple[float, float] = DEFAULT_FIT) -> tuple[float, float]:
    """Intercept and slope by Newton steps over (raw score, clean, toxic) bins, pulled towards ``start``."""
    a, b = start
    for _ in range(50):
        ga, gb, haa, hab, hbb = 0.2 * (start[0] - a), 0.2 * (start[1] - b), 0.2, 0.0, 0.2
        for x, clean, toxic in bins:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * x))))
            n = clean + toxic
            ga, gb = ga + toxic - n * p, gb + (toxic - n * p) * x
            v = n * p * (1 - p)
            haa, hab, hbb = haa + v, hab + v * x, hbb + v * x * x
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a + max(-2, min(2, da)), b + max(-2, min(2, db))
        if abs(da) + abs(db) < 1e-9:
            break
    return a, max(b, 0.1)


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> dict:
    """Vocabulary and calibration from at most ``max_rows`` labelled rows outside the held-out fifth."""
    small_batches(spark)
    rows = staged(spark, training_rows(docs, labels, max_rows), "toxic-sample")
    words, beginnings = vocabulary(learned(spark, rows))

    def raws(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(words, beginnings)
        for batch in batches:
            raw = [round(grammar.raw(t)[0], 1) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.float64()), batch.column("toxic")], ["raw", "toxic"])

    bins = (
        rows.mapInArrow(raws, "raw double, toxic int").groupBy("raw")
        .agg(F.sum(1 - F.col("toxic")).alias("clean"), F.sum("toxic").alias("toxic")).orderBy("raw").collect()
    )
    return {"words": words, "beginnings": beginnings, "fit": logistic([tuple(r) for r in bins])}


# ---- scoring ---------------------------------------------------------------------------

CLAUSE = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("weight", T.DoubleType()),
]))


def score_texts(docs: DataFrame, model: dict, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all, if None) plus ``score``, ``predicted`` and ``clauses`` (start, end, weight).

    Columns of these names in ``docs`` are replaced.
    """
    small_batches(docs.sparkSession)
    names = [c for c in (keep if keep is not None else docs.columns) if c not in ("score", "predicted", "clauses")]
    asked = names if "text" in names else [*names, "text"]
    schema = T.StructType([docs.schema[c] for c in names] + [
        T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("clauses", CLAUSE),
    ])
    words, beginnings, (a, b) = model["words"], model["beginnings"], model["fit"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(words, beginnings)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("weight", pa.float64())]))
        for batch in batches:
            found = [grammar.clauses(t) for t in batch.column("text").to_pylist()]
            scores = [1 / (1 + math.exp(-(a + b * math.log1p(sum(w for _, _, w in f))))) for f in found]
            clauses = pa.array([[{"start": s, "end": e, "weight": w} for s, e, w in f] for f in found], kind)
            yield pa.RecordBatch.from_arrays([
                *(batch.column(n) for n in names), pa.array(scores, pa.float64()),
                pa.array([int(s >= 0.5) for s in scores], pa.int32()), clauses,
            ], [*names, "score", "predicted", "clauses"])

    return docs.select(*[f"`{c}`" for c in asked]).mapInArrow(score, schema)

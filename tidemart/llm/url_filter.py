"""URL filter: explicit host and path rules first, then a weighted vocabulary.

The longest rule that fits decides.  Without one, an Aho-Corasick automaton finds the vocabulary's terms in the URL; a term
counts where no ASCII letter or digit touches it.  One strict term rejects, as do ``SOFT_TERMS`` distinct soft terms: in
weights, a strict term weighs as much as that many soft ones.

Null URLs, and those without ``://``, have an empty host and path; the vocabulary still reads what there is.
Repeated rows are judged alike; extra columns ride along.  A URL of any length is read once; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lower_ascii

# Rules: (verdict, host, path).
RULES = (
    ("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
)
# Vocabulary of the method.
STRICT = (
    "camgirls", "casino", "casinos", "cialis", "escorts", "hentai", "jackpot", "milf", "nsfw", "porn", "porno", "sexcam",
    "spam", "sportsbook", "viagra", "warez", "xxx",
)
SOFT = (
    "ad", "ads", "adult", "bet", "bets", "betting", "cheap", "click", "crack", "dating", "farm", "free", "hot", "keygen",
    "loan", "loans", "lottery", "nude", "pills", "poker", "prize", "sex", "sexy", "slots", "torrent", "track", "tracker",
    "win", "winner", "x",
)
SOFT_TERMS = 2


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there to ``?`` or ``#``."""
    known = F.coalesce(url, F.lit(""))
    return (
        lower_ascii(F.regexp_extract(known, r"(?s)^.*?://([^/?#]*)", 1)),
        F.regexp_extract(known, r"(?s)^.*?://[^/?#]*([^?#]*)", 1),
    )


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits host, its subdomains and the path's beginning; null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for judge, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):  # the longest comes last, outermost
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(judge)).otherwise(verdict)
    return name, verdict


def vocabulary(strict=STRICT, soft=SOFT, soft_terms: int = SOFT_TERMS) -> ahocorasick.Automaton:
    """Values: (term, weight); a text is rejected at a weight of ``soft_terms``."""
    machine = ahocorasick.Automaton()
    for weight, terms in ((1, soft), (soft_terms, strict)):
        for term in terms:
            machine.add_word(term, (term, weight))
    machine.make_automaton()
    return machine


def terms_in(machine: ahocorasick.Automaton, text: str) -> dict[str, int]:
    """Distinct terms with free boundaries, and their weights.  ``text`` is lower-cased."""
    def free(at: int) -> bool:
        return not (0 <= at < len(text) and text[at].isascii() and text[at].isalnum())

    return {t: w for end, (t, w) in machine.iter(text) if free(end + 1) and free(end - len(t))}


def judged(pages: DataFrame, keep: list[str] | None = None, rules=RULES, strict=STRICT, soft=SOFT,
           soft_terms: int = SOFT_TERMS) -> DataFrame:
    """``keep`` columns (all, if None) plus host, path, rule, verdict, terms (those that counted; null where a rule decides).

    Columns of these names are replaced.
    """
    made = ("host", "path", "rule", "verdict", "terms")
    names = [c for c in (keep if keep is not None else pages.columns) if c not in made]
    url = "url_"
    while url in pages.columns:
        url += "_"
    host, path = host_and_path(F.col("url"))
    parsed = pages.select(*[f"`{c}`" for c in names], host.alias("host"), path.alias("path"), lower_ascii(F.col("url")).alias(url))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = parsed.withColumn("rule", rule).withColumn("verdict", verdict)
    schema = T.StructType([pages.schema[c] for c in names] + [
        *(T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict")),
        T.StructField("terms", T.ArrayType(T.StringType())),
    ])
    given = [*names, "host", "path", "rule"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = vocabulary(strict, soft, soft_terms)
        for batch in batches:
            verdicts, terms = [], []
            for known, text in zip(batch.column("verdict").to_pylist(), batch.column(url).to_pylist(), strict=True):
                if known is None:
                    found = terms_in(machine, text)
                    verdicts.append("block" if sum(found.values()) >= soft_terms else "allow")
                    terms.append(sorted(found))
                else:
                    verdicts.append(known)
                    terms.append(None)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in given), pa.array(verdicts, pa.string()), pa.array(terms, pa.list_(pa.string()))],
                [*given, "verdict", "terms"])

    return ruled.mapInArrow(run, schema)

"""Personal data by a semi-Markov conditional random field over fixed base rules.

Base rules name e-mail addresses, IP addresses, card and phone numbers by pattern and validity.  They always stay.  The field
adds what the rules leave: forms they do not know (``name [at] host [dot] net``, ``10[.]0[.]0[.]7``, cards parted by dots, phone
numbers without a plus) and numbers that were lost because a neighbour ran into them.

The stretches of a text around digits, at signs and spelled-out dots are read.  Every segment there that could be an entity, of
at most ``MOST_LETTERS`` code points, is scored as a whole: its validity, digit groups, separators, whether the number goes on to its
left or right, and words beside it.  A segmentation scores the sum over its entities, other text scores zero.  Bounded-entity
dynamic programming finds the best segmentation, so boundaries and types are chosen together, with base spans held fixed.

Weights maximise the conditional likelihood of segmentations (:func:`fit`): stretches around base spans of at most
``MAX_SAMPLE`` documents, as they stand, rewritten into forms that the rules do not know, and spoiled into numbers that mean nothing;
and a fixed set of generated ones, so that a model exists without any sample.

Offsets are code points, ends exclusive.  Null texts are empty and have no spans.  Repeated rows get equal results.  All patterns take
time in proportion to the text, a text of one unbroken word or number too.  An empty table gives no rows; columns that the result
names itself are replaced, other extra columns ride along.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, staged

KINDS = ("email", "ip", "card", "phone")
MAX_SAMPLE = 400  # bound of the documents the field is fitted on
MOST_LETTERS = 80  # of an added entity
CONTEXT = 40  # code points read on both sides of a trigger
ROUNDS, RATE, DECAY = 40, 0.5, 0.003

Span = tuple[int, int, str]

# ---- base rules ------------------------------------------------------------------------
# Possessive repeats and starts at the first digit of a run match what the plain patterns do, without going back.

LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else 2 * n - 9 * (n > 4)
    return total % 10 == 0


def octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-20:]) <= 255 for p in parts)


def digits_of(text: str) -> str:
    return "".join(DIGIT.findall(text))


def _emails(text: str) -> Iterator[Span]:
    begin, at = 0, text.find("@")
    while at >= 0:
        head = text[begin:at]
        local = len(head) - len(head.rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if local else None
        if m:
            yield at - local, m.end(), "email"
        begin = m.end() if m else at + 1
        at = text.find("@", begin)


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) by the fixed rules, by start, then kind."""
    out = list(_emails(text))
    out += [(*m.span(), "ip") for m in IP.finditer(text) if octets(m.group().split("."))]
    for m in CARD.finditer(text):
        if 12 <= m.end() - m.start() <= 37 and 12 <= len(d := digits_of(m.group())) <= 19 and luhn(d):
            out.append((*m.span(), "card"))
    out += [(*m.span(), "phone") for m in PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return in_order(out)


def in_order(spans) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


# ---- segments that could be entities ---------------------------------------------------

TRIGGER = re.compile(r"[0-9@]|(?i:\bdot\b)")
AT = r"(?:\s?[\[({]\s?(?:at|@)\s?[\])}]\s?|\sat\s|\s?@\s?)"
DOT = r"(?:\s?[\[({]\s?(?:dot|\.)\s?[\])}]\s?|\sdot\s|\.)"
ADDRESS = re.compile(
    rf"(?i:(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{{0,40}}+(?P<at>{AT})[A-Za-z0-9-]{{1,30}}+(?P<rest>(?:{DOT}[A-Za-z0-9-]{{1,30}}+){{1,5}}))")
LABEL = re.compile(rf"(?i:(?P<dot>{DOT})[A-Za-z0-9-]{{1,30}}+)")
QUAD = re.compile(r"([0-9]{1,3})(\.|\[\.\]|\(\.\)|\s\.\s)([0-9]{1,3})\2([0-9]{1,3})\2([0-9]{1,3})")
BETWEEN = re.compile("[ ().\u00a0_/-]{1,3}")
PIECE = re.compile(r"[0-9]+")
CUES = {
    "email": ("mail", "email", "contact", "write", "correo", "adresse"),
    "ip": ("ip", "host", "server", "address", "addr", "router"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "karte", "kreditkarte", "tarjeta", "carte"),
    "phone": ("phone", "tel", "telephone", "call", "mobile", "fax", "telefon", "teléfono", "móvil", "téléphone"),
}
WORD = re.compile(r"\w+")
Segment = tuple[int, int, str, tuple[str, ...]]


def _cue(text: str, start: int, kind: str) -> list[str]:
    near = WORD.findall(text[max(0, start - 24):start].lower())[-3:]
    return [f"{kind}|cue"] if any(w in CUES[kind] for w in near) else []


def _goes_on(text: str, start: int, end: int) -> list[str]:
    """Whether digits stand beside the segment, one separator away."""
    left, right = text[max(0, start - 2):start], text[end:end + 2]
    return [n for n, on in (("left", len(left) == 2 and "0" <= left[0] <= "9"), ("right", len(right) == 2 and "0" <= right[1] <= "9")) if on]


def _number(text: str, start: int, end: int, groups: list[int], between: list[str]) -> Iterator[Segment]:
    """The readings of one digit sequence as a card and as a phone number."""
    n, written = sum(groups), text[start:end]
    seps = "".join(sorted(set("".join(between)) - set("()"))) or "none"
    on = _goes_on(text, start, end)
    if 12 <= n <= 19 and written[0] not in "+(" and "(" not in written:
        even = all(g == 4 for g in groups[:-1]) and groups[-1] <= 7 if len(groups) > 1 else True
        yield start, end, "card", tuple([
            "card|bias", f"card|luhn={luhn(digits_of(written))}", f"card|n={n}", f"card|even={even}", f"card|lead={written[0] in '3456'}",
            f"card|mixed={len(seps) > 1 and seps != 'none'}", *(f"card|on-{o}" for o in on), *_cue(text, start, "card")])
    if 7 <= n <= 15:
        plus = "plus" if written[0] == "+" else "00" if written.startswith("00") else "paren" if written[0] == "(" else "bare"
        yield start, end, "phone", tuple([
            "phone|bias", f"phone|n={n}", f"phone|lead={plus}", f"phone|seps={seps}", f"phone|groups={len(groups)}",
            f"phone|last={groups[-1]}", f"phone|first={groups[0]}", *(f"phone|on-{o}" for o in on), *_cue(text, start, "phone")])


def segments(text: str, lo: int, hi: int) -> Iterator[Segment]:
    """(start, end, kind, features) of all segments in ``text[lo:hi]`` that could be an entity."""
    free = lambda at: not (lo <= at < hi) or not text[at].isalnum()
    for m in ADDRESS.finditer(text, lo, hi):
        start, at, end = m.start(), m.group("at"), m.start("rest")
        for label in LABEL.finditer(text, end, m.end()):
            end = label.end()
            if end - start > MOST_LETTERS or not free(end):
                continue
            how = "word" if "at" in at.lower() and not at.strip()[:1] in "[({" else "brackets" if at.strip()[:1] in "[({" else "spaced" if at != "@" else "sign"
            spelled = "spelled" if len(label.group("dot")) > 1 else "dot"
            name = re.search(r"[A-Za-z]*$", text[start:end]).group()
            yield start, end, "email", tuple([
                "email|bias", f"email|at={how}", f"email|{how}-{spelled}", f"email|tld={2 <= len(name) <= 6}",
                f"email|more={LABEL.match(text, end, m.end()) is not None}", *_cue(text, start, "email")])
    for m in QUAD.finditer(text, lo, hi):
        start, end = m.span()
        if free(start - 1) and free(end):
            on = _goes_on(text, start, end)
            yield start, end, "ip", tuple([
                "ip|bias", f"ip|valid={octets([m.group(i) for i in (1, 3, 4, 5)])}", f"ip|sep={m.group(2)}", *(f"ip|on-{o}" for o in on),
                *_cue(text, start, "ip")])
    runs = [m.span() for m in PIECE.finditer(text, lo, hi)]
    for first, (begin, _) in enumerate(runs):
        start = begin - 1 if begin > lo and text[begin - 1] in "+(" else begin
        if start - 1 >= lo and text[start] == "(" and text[start - 1] == "+":
            start -= 1
        if not free(start - 1):
            continue
        groups, between = [], []
        for a, b in runs[first:first + 19]:  # 19 digits at the most
            if groups:
                gap = text[last:a]
                if not BETWEEN.fullmatch(gap):
                    break
                between.append(gap)
            groups.append(b - a)
            last = b
            if sum(groups) > 19 or b - start > MOST_LETTERS:
                break
            if free(b):
                yield from _number(text, start, b, groups, between)


def stretches(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) around the triggers, those that touch as one."""
    lo = hi = -1
    for m in TRIGGER.finditer(text):
        if m.start() - CONTEXT > hi:
            if hi >= 0:
                yield lo, min(hi, len(text))
            lo = max(0, m.start() - CONTEXT)
        hi = m.end() + CONTEXT
    if hi >= 0:
        yield lo, min(hi, len(text))


# ---- the field -------------------------------------------------------------------------

def places(found: list[Segment]) -> list[int]:
    """All starts and ends.  Between them nothing begins or ends, so they are the steps of the dynamic programme."""
    return sorted({p for s in found for p in s[:2]})


def best_segments(found: list[Segment] | list[Span], scores: list[float]) -> list[Span]:
    """The segments of the best segmentation; of equal ones that with fewer and later entities."""
    at = places(found)
    ending = defaultdict(list)
    for (start, end, kind, *_), score in zip(found, scores, strict=True):
        if score > 0:  # others never improve a sum
            ending[end].append((score, start, kind))
    value, chosen = [0.0] * len(at), [None] * len(at)
    for i, place in enumerate(at):
        value[i] = value[i - 1] if i else 0.0
        for score, start, kind in sorted(ending[place]):
            before = bisect_left(at, start)
            if value[before] + score > value[i]:
                value[i], chosen[i] = value[before] + score, (start, place, kind)
    out, i = [], len(at) - 1
    while i >= 0:
        if chosen[i]:
            out.append(chosen[i])
            i = bisect_left(at, chosen[i][0])
        else:
            i -= 1
    return out[::-1]


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def marginals(found: list[Segment], scores: list[float]) -> tuple[float, list[float]]:
    """Logarithm of the sum over all segmentations, and each segment's probability, by forward and backward sums."""
    at = places(found)
    index = {p: i for i, p in enumerate(at)}
    ends, starts = defaultdict(list), defaultdict(list)
    for (start, end, _, _), score in zip(found, scores, strict=True):
        ends[index[end]].append((index[start], score))
        starts[index[start]].append((index[end], score))
    forward, backward = [0.0] * len(at), [0.0] * len(at)
    for i in range(len(at)):
        forward[i] = _log_sum([forward[i - 1] if i else 0.0, *(forward[s] + score for s, score in ends[i])])
    for i in reversed(range(len(at))):
        backward[i] = _log_sum([backward[i + 1] if i + 1 < len(at) else 0.0, *(backward[e] + score for e, score in starts[i])])
    whole = forward[-1] if at else 0.0
    return whole, [
        math.exp(forward[index[s]] + score + backward[index[e]] - whole) for (s, e, _, _), score in zip(found, scores, strict=True)]


def scored(found: list[Segment], weights: dict[str, float]) -> list[float]:
    return [sum(weights.get(f, 0.0) for f in features) for *_, features in found]


def spans_of(text: str | None, weights: dict[str, float]) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans: base ones and what the field adds where no base span lies."""
    if not text:
        return [], []
    base = base_spans(text)
    begins, ends = [b[0] for b in base], list(accumulate((b[1] for b in base), max))
    found, scores = [], []
    for lo, hi in stretches(text):
        for s in segments(text, lo, hi):
            score = sum(weights.get(f, 0.0) for f in s[3])
            before = bisect_left(begins, s[1])  # base spans that begin before it ends
            if score > 0 and not (before and ends[before - 1] > s[0]):
                found.append(s[:3])
                scores.append(score)
    return base, in_order([*base, *best_segments(found, scores)]) if found else base


# ---- fitting ---------------------------------------------------------------------------

def _card(rng: random.Random) -> str:
    digits = rng.choice("3456") + "".join(rng.choices("0123456789", k=14))
    return next(digits + c for c in "0123456789" if luhn(digits + c))


def _fours(digits: str, sep: str) -> str:
    return sep.join(digits[i:i + 4] for i in range(0, len(digits), 4))


def _rewritten(kind: str, span: str, rng: random.Random) -> str:
    """An entity in a form that the base rules do not know."""
    if kind == "email":
        local, _, host = span.partition("@")
        at, dot = rng.choice(((" [at] ", " [dot] "), ("(at)", "(dot)"), (" at ", " dot "), (" @ ", "."), ("[at]", "."), ("{at}", "{dot}")))
        return local + at + host.replace(".", dot)
    if kind == "ip":
        return span.replace(".", rng.choice(("[.]", "(.)", "[.]", " . ")))
    if kind == "card":
        return _fours(digits_of(span), rng.choice(("\u00a0", ".", "_", "/", " - ")))
    d = digits_of(span)
    d = d[-10:] if len(d) >= 10 else d
    head, mid, tail = d[:-7], d[-7:-4], d[-4:]
    return rng.choice((f"({head}) {mid}-{tail}", f"{head}-{mid}-{tail}", f"{head}.{mid}.{tail}", f"001 {head} {mid} {tail}", f"00{d[:2]} {d[2:5]} {d[5:]}"))


def _spoiled(kind: str, rng: random.Random) -> str:
    """A piece of text that looks like an entity and is none."""
    n = lambda k: "".join(rng.choices("0123456789", k=k))
    if kind == "email":
        return rng.choice((f"met at {n(2)} . then", "look at home. then", f"@name {n(2)}", "a dot on the map", "at noon. dot"))
    if kind == "ip":
        return rng.choice((f"{n(1)}.{n(1)}.{n(2)}", f"{256 + int(n(2))}[.]{n(2)}[.]1[.]{300 + int(n(2))}", f"{300 + int(n(2))}.{n(2)}.1.{400 + int(n(2))}", f"{n(2)}.{n(2)}.{n(2)}.{n(2)}.{n(2)}.{n(1)}"))
    if kind == "card":
        good = _card(rng)
        bad = good[:-1] + str((int(good[-1]) + rng.randint(1, 9)) % 10)
        return rng.choice((bad, _fours(bad, " "), _fours(bad, "."), _fours(bad, "-"), "9" + bad[:11]))
    return rng.choice((
        f"20{n(2)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", f"{rng.randint(10, 28)}.{rng.randint(10, 12)}.19{n(2)}", n(7), n(9), n(10), n(12),
        f"{n(3)}.{n(3)}.{n(3)}", f"{n(2)} {n(2)} {n(2)} {n(2)}", f"{n(4)}-{n(4)}", f"{n(3)} {n(5)}", f"978-{n(1)}-{n(3)}-{n(5)}-{n(1)}",
        f"19{n(2)}-20{n(2)}", f"{n(2)}/{n(2)}/{n(4)}", f"{n(4)} {n(4)}", f"{n(5)}.{n(2)} {n(3)}.{n(2)}", f"20{n(2)}-{rng.randint(10, 12)}-{rng.randint(10, 28)} {n(2)}"))


Example = tuple[str, list[Span]]


def _placed(left: str, entity: str, right: str, kind: str | None) -> Example:
    return left + entity + right, [(len(left), len(left) + len(entity), kind)] if kind else []


def generated(seed: int = 11, each: int = 60) -> list[Example]:
    """The fixed part of the examples: generated entities among plain words."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abdeilmnorstu", k=rng.randint(2, 8)))
    number = lambda k: "".join(rng.choices("0123456789", k=k))
    out = []
    for kind in KINDS:
        for i in range(each):
            entity = {
                "email": lambda: f"{word()}.{word()}{number(2)}@{word()}.{rng.choice(('com', 'org', 'net', 'example.com'))}",
                "ip": lambda: ".".join(str(rng.randint(1, 255)) for _ in range(4)),
                "card": lambda: _fours(_card(rng), rng.choice(("", " ", "-"))),
                "phone": lambda: f"+{rng.randint(1, 49)} ({number(3)}) {rng.randint(200, 999)}-{number(4)}",
            }[kind]()
            cue = f"{rng.choice(CUES[kind])} " if rng.random() < 0.3 else ""
            left, right = f"{word()} {word()} {cue}", f" {word()} {word()}"
            stray = f"{rng.randint(1, 99)} " if rng.random() < 0.2 and kind in ("card", "phone") else ""
            out.append(_placed(left + stray, entity, right, kind))
            out.append(_placed(left, _rewritten(kind, entity, rng), right, kind))
            out.append(_placed(left, _spoiled(kind, rng), right, None))
    return out


def sampled(rows: list[tuple[str, list[Span]]], seed: int = 13) -> list[Example]:
    """Stretches of sample texts around one base span: as it is, rewritten, and spoiled."""
    rng = random.Random(seed)
    out = []
    for text, (start, end, kind) in ((t, s) for t, spans in rows for s in spans):
        left, right = text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
        if DIGIT.search(left) or DIGIT.search(right) or "@" in left + right:
            continue
        out.append(_placed(left, text[start:end], right, kind))
        out.append(_placed(left, _rewritten(kind, text[start:end], rng), right, kind))
        out.append(_placed(left, _spoiled(kind, rng), right, None))
    return out


def trained(examples: list[Example]) -> dict[str, float]:
    """Weights of greatest penalised conditional likelihood, by gradient steps scaled per feature."""
    held = []
    for text, gold in examples:
        found = list(segments(text, 0, len(text)))
        real = [any(s[:3] == g for g in gold) for s in found]
        if found and sum(real) == len(gold):  # an entity that is no segment teaches nothing
            held.append((found, real))
    weights: dict[str, float] = defaultdict(float)
    squares: dict[str, float] = defaultdict(float)
    for _ in range(ROUNDS):
        gradient: dict[str, float] = defaultdict(float)
        for found, real in held:
            _, chance = marginals(found, scored(found, weights))
            for (*_, features), is_real, p in zip(found, real, chance, strict=True):
                for f in features:
                    gradient[f] += is_real - p
        for f in sorted(gradient):
            g = gradient[f] / len(held) - DECAY * weights[f]
            squares[f] += g * g
            weights[f] += RATE * g / (math.sqrt(squares[f]) + 1e-6)
    return {f: round(w, 6) for f, w in weights.items()}


def fit(spark: SparkSession, docs: DataFrame, max_sample: int = MAX_SAMPLE) -> dict[str, float]:
    """Weights from at most ``max_sample`` documents with base spans, spread by hash, and the generated examples."""
    small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts around base spans only, so that what is collected is small whatever the length of a text."""
        for batch in batches:
            near, start, end, kind = [], [], [], []
            for text in batch.column(0).to_pylist():
                for s, e, k in base_spans(text)[:8]:
                    if e - s <= MOST_LETTERS:
                        near.append(text[max(0, s - CONTEXT):e + CONTEXT])
                        start.append(s - max(0, s - CONTEXT))
                        end.append(e - max(0, s - CONTEXT))
                        kind.append(k)
            yield pa.RecordBatch.from_arrays([
                pa.array(near, pa.string()), pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(kind, pa.string())],
                ["text", "start", "end", "kind"])

    marked = docs.where(r"text IS NOT NULL AND text RLIKE '[0-9@]'").select("text")
    pieces = staged(spark, marked.mapInArrow(run, "text string, start int, end int, kind string").distinct(), "pii-sample")
    rows = pieces.orderBy(F.xxhash64("text", "start", "kind"), "text", "start", "kind").limit(max_sample).collect()
    return trained([*generated(), *sampled([(r.text, [(r.start, r.end, r.kind)]) for r in rows])])


# ---- results ---------------------------------------------------------------------------

SPANS = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType()),
    T.StructField("base", T.BooleanType()),
]))


def find_spans(docs: DataFrame, weights: dict[str, float], keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all, if None) plus ``pii``: start, end, kind, base of every span in order."""
    small_batches(docs.sparkSession)
    names = [c for c in (keep if keep is not None else docs.columns) if c != "pii"]
    asked = names if "text" in names else [*names, "text"]
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField("pii", SPANS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("base", pa.bool_())]))
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                base, spans = spans_of(text, weights)
                fixed = set(base)
                rows.append([{"start": s, "end": e, "kind": k, "base": (s, e, k) in fixed} for s, e, k in spans])
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(rows, kind)], [*names, "pii"])

    return docs.select(*[f"`{c}`" for c in asked]).mapInArrow(run, schema)


def masked(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets; overlapping spans as one, named by the first."""
    @F.pandas_udf("string")
    def mask(texts):
        def one(text):
            if text is None:
                return None
            out, at = [], 0
            for start, end, kind in spans_of(text, weights)[1]:
                if start >= at:
                    out.append(f"{text[at:start]}<{kind.upper()}>")
                at = max(at, end)
            return "".join(out) + text[at:]

        return texts.map(one)

    small_batches(docs.sparkSession)
    return docs.withColumn("text", mask("text"))


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def digests(found: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` plus n_email, n_ip, n_card, n_phone and base_sha256 of the base spans, and ``spans``, all spans as text."""
    base = F.filter("pii", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("pii", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    as_text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        *keep, *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(as_text(base), 256).alias("base_sha256"), as_text(F.col("pii")).alias("spans"))


def plain_sha256(spans: list[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()

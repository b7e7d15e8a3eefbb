"""SQL for DuckDB that gives the same rows as the queries, where SQL can express them."""

from __future__ import annotations

from . import url_filter

ABC, abc = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{ABC}', '{abc}')"


def _exact() -> str:
    return f"""
WITH d AS (SELECT doc_id, sha256({lower('text')}) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY h ORDER BY doc_id DESC) = 1 AS kept, h AS text_sha256
FROM d WINDOW g AS (PARTITION BY h)"""


def _decontamination() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all({lower('text')}, '{word}') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all({lower('text')}, '{word}') AS w FROM benchmark),
win AS (
  SELECT item_id, least(13, len(w)) AS k, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM bw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM win),
grams AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, sizes WHERE len(w) >= k)),
met AS (SELECT grams.doc_id, grams.i, grams.k, win.item_id FROM grams JOIN win USING (k, g)),
hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS place FROM (SELECT DISTINCT doc_id, i, k FROM met)) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item COLLATE "C") AS joined
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""


def _archives() -> str:
    return """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS best FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN CAST(best AS DOUBLE) END AS refers_to
FROM g"""


def _urls() -> str:
    rules = sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for v, h, p in rules]
    rule = " ".join(f"WHEN {f} THEN '{name}'" for f, name, _ in fits)
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in fits)

    def counts(terms) -> str:
        return " + ".join(f"CAST(regexp_matches(u, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') AS INT)" for t in terms)

    return rf"""
WITH p AS (
  SELECT page_id, {lower('url')} AS u,
         {lower(r"regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages)
SELECT page_id, host, path, CASE {rule} END AS rule,
       CASE {verdict} WHEN {counts(url_filter.STRICT)} > 0 OR {counts(url_filter.SOFT)} >= {url_filter.SOFT_TERMS}
            THEN 'block' ELSE 'allow' END AS verdict
FROM p"""


def _ranked() -> str:
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({lower('text')}, '{term}') AS w FROM documents),
b AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all({lower('text')}, '{term}') AS w FROM benchmark),
asked AS (SELECT DISTINCT item, item_id, term FROM (SELECT item, item_id, unnest(w) AS term FROM b)),
stats AS (SELECT count(*) AS total, CAST(sum(len(w)) AS BIGINT) AS length FROM d WHERE len(w) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) SEMI JOIN (SELECT DISTINCT term FROM asked) USING (term) GROUP BY r, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * total + 2) / (2 * df + 1))) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), stats),
impacts AS (
  SELECT r, doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * CAST(len(w) AS BIGINT) * total) // length))) AS gain
  FROM tf JOIN d USING (r) JOIN weights USING (term), stats),
scores AS (SELECT item, item_id, r, doc_id, CAST(sum(gain) AS BIGINT) AS score FROM asked JOIN impacts USING (term) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10"""


ORACLES = {
    "op3_decontamination": _decontamination(),
    "op4_arc_to_warc": _archives(),
    "op6_url_filter": _urls(),
    "op9_exact_dedup": _exact(),
    "op13_ranked_search": _ranked(),
}

"""DuckDB SQL for the queries whose results SQL can express."""

from __future__ import annotations

from itertools import permutations

from reviewlab.llm.url_filters import BLOCKED_PATTERNS, HOST_RULES

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UP}', '{_LOW}') AS k
  FROM lines
), repeated AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT keyed.*, keeper IS NOT NULL AND doc_id <> keeper AS gone FROM keyed LEFT JOIN repeated USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def _url_filters() -> str:
    fits = [
        (len(host + path), f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')",
         host + path, verdict)
        for host, path, verdict in HOST_RULES
    ]
    fits.sort(key=lambda f: -f[0])
    rule = " ".join(f"WHEN {cond} THEN '{name}'" for _, cond, name, _ in fits)
    verdict = " ".join(f"WHEN {cond} THEN '{v}'" for _, cond, _, v in fits)
    tests = " OR ".join(_pattern_test(p) for p in BLOCKED_PATTERNS)
    return f"""
WITH parsed AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UP}', '{_LOW}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*(.*)$', 1) AS rest FROM pages
)
SELECT page_id, host, path, CASE {rule} END AS rule,
       CASE {verdict} WHEN {tests} THEN 'block' ELSE 'allow' END AS verdict
FROM parsed
"""


def _pattern_test(pattern: str) -> str:
    """`||`, `*` and `^` of the patterns above, spelled as one regular expression over the address."""
    import re

    body = re.escape(pattern.removeprefix("||")).replace(r"\*", ".*").replace(r"\^", "(?:[^A-Za-z0-9._%-]|$)")
    start = r"^(?:[^/?#]*\.)?" if pattern.startswith("||") else ""
    return f"regexp_matches(host || rest, '(?s){start}{body}')"


_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATION = f"""
WITH doc AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '{_BREAKS}') IF x <> ''] AS w FROM documents
), item AS (
  SELECT item_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '{_BREAKS}') IF x <> ''] AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size,
         array_to_string(list_slice(w, s, s + least(len(w), 10) - 1), ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM item WHERE len(w) > 0)
), place AS (
  SELECT doc_id, size, s, array_to_string(list_slice(w, s, s + size - 1), ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s
        FROM doc, (SELECT DISTINCT size FROM win) sizes)
), hit AS (
  SELECT doc_id, item_id, s, place.size AS size FROM place JOIN win ON place.win = win.win AND place.size = win.size
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hit) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_BLANKS = r"[\x20\x09-\x0D]+"
_ORDERS = ", ".join("('" + "".join(order) + "')" for order in permutations("ABCDE"))

FILTER_AUDIT = f"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         [x FOR x IN regexp_split_to_array(coalesce(text, ''), '{_BLANKS}') IF x <> ''] AS w FROM documents
), failing AS (
  SELECT doc_id, part, CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN min(doc_id) OVER (PARTITION BY t) < doc_id THEN 'E' ELSE '' END AS failed
  FROM texts
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), masks AS (
  SELECT part, failed, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM failing LEFT JOIN marks USING (doc_id) GROUP BY part, failed
), orders (filter_order) AS (VALUES {_ORDERS}), steps AS (
  SELECT filter_order, step, filter_order[step] AS letter, filter_order[1:step - 1] AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), cells AS (
  SELECT part, filter_order, step, letter, n, good, toxic,
         translate(failed, before, '') = failed AS still, contains(failed, letter) AS fails, failed = letter AS alone
  FROM masks, steps
), sums AS (
  SELECT part, filter_order, step, any_value(letter) AS letter,
         sum(CASE WHEN still AND NOT fails THEN n ELSE 0 END) AS kept, sum(CASE WHEN still AND fails THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN NOT still AND fails THEN n ELSE 0 END) AS redundant, sum(CASE WHEN alone THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN still AND fails THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN still AND fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells GROUP BY part, filter_order, step
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM sums
"""

ORACLE = {
    "op2_line_dedup": LINE_DEDUP,
    "op4_url_filters": _url_filters(),
    "op9_benchmark_decontamination": DECONTAMINATION,
    "op11_filter_audit": FILTER_AUDIT,
}

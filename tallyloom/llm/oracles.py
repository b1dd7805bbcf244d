"""SQL counterparts, for DuckDB, of the operators that SQL can express."""

from __future__ import annotations

_BENCHMARK_WORDS = r"[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{pattern}')"


CHAT = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), escaped AS (
  SELECT *, length(replace(replace(replace(role, '\', '\\'), '<', '\<'), '>', '\>')) AS role_chars,
    length(replace(replace(replace(text, '\', '\\'), '<', '\<'), '>', '\>')) AS text_chars
  FROM given
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<turn ') + role_chars + 2 + text_chars + length('</turn>') + 1) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""

DECONTAMINATION = f"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, {_words('text', _BENCHMARK_WORDS)} AS w FROM benchmark
), windows AS (
  SELECT item_id, least(len(w), 13) AS size, unnest(list_transform(
    range(1, greatest(len(w) - 13, 0) + 2), lambda i: array_to_string(w[i:i + 12], ' '))) AS win
  FROM item_words WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM windows),
docs AS (SELECT doc_id, {_words('text', _BENCHMARK_WORDS)} AS w FROM documents),
places AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS i, w FROM docs, sizes WHERE len(w) >= size
), doc_windows AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS win FROM places),
hits AS (SELECT DISTINCT doc_id, d.size, i, item_id FROM doc_windows d JOIN windows b ON d.win = b.win AND d.size = b.size),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS listed
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_SPLIT = r"[^\x{20}\x{09}-\x{0D}]+"

NEAR_DEDUP = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_words('text', _SPLIT)} AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM docs
), shingles AS (SELECT doc_id, len(s) AS size, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b USING (shingle)
  WHERE a.doc_id <> b.doc_id AND 100 * least(a.size, b.size) >= 75 * greatest(a.size, b.size)
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 75 * (any_value(a.size) + any_value(b.size) - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM docs
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least_id AS component_id, doc_id = least_id AS kept
FROM sets JOIN (SELECT a AS doc_id, min(b) AS least_id FROM reach GROUP BY a) USING (doc_id)
"""

_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["'']?\x{20}*[:=]\x{20}*["'']?([A-Za-z0-9+/_.=-]+)"""


def _matches(kind: int, pattern: str) -> str:
    """(doc_id, start, kind, stop, value) of one pattern: pieces between matches add up."""
    value = f"regexp_extract(m[i], '{pattern}', 2)" if kind == 0 else "m[i]"
    return f"""
  SELECT doc_id, source, lang, start, {kind} AS kind, start + length(m[i]) AS stop, {value} AS value FROM (
    SELECT doc_id, source, lang, m, i, CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start
    FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT doc_id, source, lang, regexp_extract_all(coalesce(text, ''), '{pattern}') AS m,
        string_split_regex(coalesce(text, ''), '{pattern}') AS gaps FROM documents) WHERE len(m) > 0))
"""


SECRETS = f"""
WITH base AS (
  SELECT * FROM ({_matches(0, _ASSIGN)}) WHERE length(value) >= 8
  UNION ALL {_matches(1, 'AKIA[A-Z0-9]{12,}')}
  UNION ALL {_matches(2, '[0-9a-f]{32,}')}
), tokens AS (
  SELECT * FROM ({_matches(3, '[A-Za-z0-9+/_-]{20,}')}) t
  WHERE regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = t.doc_id AND b.start < t.stop AND t.start < b.stop)
), every AS (SELECT * FROM base UNION ALL SELECT * FROM tokens),
owned AS (
  SELECT value, count(DISTINCT coalesce(source, '')) AS owners, count(*) AS repositories FROM (SELECT DISTINCT value, source, lang FROM every) GROUP BY value
), judged AS (
  SELECT e.*, owners <= 1 AND repositories <= 2 AS live, ['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || start || ':' || stop AS named
  FROM every e JOIN owned USING (value)
), per_doc AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
    count(*) FILTER (kind = 2) AS n_hex,
    string_agg(named, ',' ORDER BY start, kind, stop) FILTER (kind < 3) AS base_spans,
    string_agg(named, ',' ORDER BY start, kind, stop) FILTER (kind < 3 OR live) AS spans,
    count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live AND kind < 3) AS n_example
  FROM judged GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
  coalesce(n_example, 0) AS n_example
FROM documents LEFT JOIN per_doc USING (doc_id)
"""


FILL_IN_MIDDLE = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), numbers AS (
  SELECT doc_id, t, n, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS y,
    CAST('0x' || h[17:24] AS BIGINT) % 100 AS share, CAST('0x' || h[25:32] AS BIGINT) % 100 AS turned FROM drawn
), parts AS (
  SELECT doc_id, t, n, least(x, y) AS a, greatest(x, y) AS b,
    CASE WHEN n = 0 OR share >= 90 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
      WHEN turned < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t
    WHEN 'psm' THEN '<P>' || t[1:a] || '<S>' || t[b + 1:] || '<M>' || t[a + 1:b]
    ELSE '<S>' || t[b + 1:] || '<P>' || t[1:a] || '<M>' || t[a + 1:b] END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op6_chat_formatting": CHAT,
        "op7_benchmark_decontamination": DECONTAMINATION,
        "op8_minhash_near_dedup": NEAR_DEDUP,
        "op9_secret_scan": SECRETS,
        "op12_fill_in_middle": FILL_IN_MIDDLE,
    }

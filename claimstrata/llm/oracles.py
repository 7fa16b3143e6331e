"""The results of the operators that SQL can express, in DuckDB's SQL."""

from __future__ import annotations

from claimstrata.llm.divergence import LEAST_DOCUMENTS, MOST_TERMS, SMOOTHING, UNIT


def _share(count: str, total: str) -> str:
    return f"1 + ({UNIT}::HUGEINT * ({count} + {SMOOTHING})) // ({total} + {SMOOTHING} * v)"


_DIVERGENCE = f"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text,
         row_number() OVER () AS doc
  FROM documents),
words AS (
  SELECT lang, source, doc, unnest(regexp_extract_all(text, '[a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS term
  FROM texts),
counts AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT doc) AS docs FROM words GROUP BY ALL),
kept AS (
  SELECT lang, term, CAST(sum(n) AS BIGINT) AS lang_n
  FROM counts GROUP BY lang, term HAVING sum(docs) >= {LEAST_DOCUMENTS}),
langs AS (SELECT lang, sum(lang_n) AS lang_total, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM texts),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.lang_n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
shares AS (
  SELECT c.*, {_share("n", "sum(n) OVER (PARTITION BY lang, source)")} AS p,
         {_share("lang_n", "lang_total")} AS q
  FROM cells c JOIN langs USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL),
parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
         CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM parts)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {MOST_TERMS}"""

_EXACT = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


def _shown(turns: str) -> str:
    """Turns as one text."""
    turn = "'<|' || coalesce(t.role, '') || '|>' || chr(10) || coalesce(t.text, '') || '<|end|>' || chr(10)"
    return f"coalesce(list_aggregate(list_transform({turns}, lambda t: {turn}), 'string_agg', ''), '')"


def _trained(turns: str) -> str:
    """What of the turns is trained on."""
    turn = "CASE WHEN t.role = 'assistant' THEN coalesce(t.text, '') || '<|end|>' || chr(10) ELSE '' END"
    return f"coalesce(list_aggregate(list_transform({turns}, lambda t: {turn}), 'string_agg', ''), '')"


_PREFERENCES = f"""
WITH held AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
ends AS (
  SELECT *, coalesce(list_max(list_filter(range(1, len(turns) + 1), lambda i: turns[i].role = 'assistant')),
                     len(turns) + 1) AS last
  FROM held),
replies AS (
  SELECT conv_id AS partner_id, conv_id // 2 AS pair, last <= len(turns) AS speaks, turns[last] AS reply FROM ends),
pairs AS (
  SELECT e.conv_id, r.partner_id, e.turns AS chosen,
         CASE WHEN r.speaks THEN list_append(e.turns[1:e.last - 1], r.reply) ELSE e.turns[1:e.last - 1] END AS rejected
  FROM ends e LEFT JOIN replies r ON r.pair = e.conv_id // 2 AND r.partner_id <> e.conv_id),
sizes AS (SELECT *, least(len(chosen), len(rejected)) AS shared FROM pairs),
cuts AS (
  SELECT *, coalesce(list_min(list_filter(range(1, shared + 1), lambda i: chosen[i] IS DISTINCT FROM rejected[i])) - 1,
                     shared) AS common
  FROM sizes)
SELECT conv_id, partner_id, CAST(common AS INTEGER) AS prompt_turns, {_shown("chosen[1:common]")} AS prompt,
       {_shown("chosen[common + 1:]")} AS chosen, {_shown("rejected[common + 1:]")} AS rejected,
       {_trained("chosen[common + 1:]")} AS chosen_trained, {_trained("rejected[common + 1:]")} AS rejected_trained
FROM cuts"""

ORACLES: dict[str, str] = {
    "op7_preference_chats": _PREFERENCES,
    "op11_divergence": _DIVERGENCE,
    "op13_exact_dedup": _EXACT,
}

"""Check SQL of the longer queries."""

from __future__ import annotations

from florametrics.llm.hosttrust import UNIT

#: The rules that pages are judged by.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _leaf(text: str) -> str:
    values = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
    return "sha256(" + " || ".join(f"coalesce(CAST(octet_length(encode({v})) AS VARCHAR) || ':' || {v}, '-')" for v in values) + ")"


def _levels(name: str, start: str) -> str:
    """Nodes (level, g, pos, n, d) of a tree for each g over the leaves ``start`` (g, pos, n, d)."""
    return f"""{name}(level, g, pos, n, d) AS (
SELECT 0, g, pos, n, d FROM {start} UNION ALL
SELECT level + 1, g, pos // 8, (n + 7) // 8, sha256(string_agg(d, '' ORDER BY pos)) FROM {name} WHERE n > 1 GROUP BY level, g, pos // 8, n)"""


#: crc32 of the id's decimal digits, eight shifts a byte.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
      lambda a, b: list_reduce([xor(a, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda x, one: CASE WHEN x & one = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""

#: Every leaf meets the other nodes of its run on each level: of its language's tree, then of the tree of the languages' roots.
MERKLE = f"""
WITH RECURSIVE doc AS (
  SELECT row_number() OVER () AS k, doc_id, lang, {_leaf('text')} AS leaf,
    {_CRC32} AS crc,
    {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} AS lowered FROM documents),
leaves AS (SELECT *, coalesce('=' || lang, '') AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, k) - 1 AS pos,
  count(*) OVER (PARTITION BY lang) AS n, leaf AS d FROM doc),
{_levels("tree", "leaves")},
subroots AS (SELECT 'all' AS g, g AS lang, row_number() OVER (ORDER BY encode(g)) - 1 AS pos, count(*) OVER () AS n, d FROM tree WHERE n = 1),
{_levels("top", "subroots")},
nodes AS (
  SELECT 0 AS part, * FROM tree UNION ALL SELECT 1, * FROM top),
ways AS (
  SELECT l.k, 0 AS part, t.level, l.pos // CAST(8 ** t.level AS BIGINT) AS pos, l.g FROM leaves l JOIN (SELECT DISTINCT g, level FROM tree WHERE n > 1) t USING (g)
  UNION ALL
  SELECT l.k, 1, t.level, s.pos // CAST(8 ** t.level AS BIGINT), 'all' FROM leaves l JOIN subroots s ON s.lang = l.g, (SELECT DISTINCT level FROM top WHERE n > 1) t),
steps AS (
  SELECT w.k, w.part, w.level, coalesce(string_agg(o.d, '' ORDER BY o.pos) FILTER (o.pos < w.pos), '') AS before,
    coalesce(string_agg(o.d, '' ORDER BY o.pos) FILTER (o.pos > w.pos), '') AS after,
    row_number() OVER (PARTITION BY w.k ORDER BY w.part, w.level) AS step
  FROM ways w JOIN nodes o ON o.part = w.part AND o.level = w.level AND o.g = w.g AND o.pos // 8 = w.pos // 8 GROUP BY w.k, w.part, w.level, w.pos),
proofs AS (SELECT k, sha256(string_agg(before || after, '' ORDER BY step)) AS proof_sha256 FROM steps GROUP BY k),
folds(k, step, d) AS (
  SELECT k, 0, CASE WHEN doc_id IS NOT NULL AND crc % 3 = 0 THEN lowered ELSE leaf END FROM doc UNION ALL
  SELECT f.k, f.step + 1, sha256(s.before || f.d || s.after) FROM folds f JOIN steps s ON s.k = f.k AND s.step = f.step + 1),
folded AS (SELECT k, arg_max(d, step) AS d FROM folds GROUP BY k)
SELECT l.doc_id, l.leaf, s.d AS subroot, r.d AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.d AS folded_root, f.d = r.d AS verified
FROM leaves l JOIN subroots s ON s.lang = l.g JOIN folded f ON f.k = l.k LEFT JOIN proofs p ON p.k = l.k, (SELECT d FROM top WHERE n = 1) r
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}')"


SEARCH = f"""
WITH doc AS (SELECT row_number() OVER () AS k, doc_id, {_terms('text')} AS words FROM documents WHERE doc_id IS NOT NULL),
whole AS (SELECT count(*) AS docs, CAST(sum(len(words)) AS BIGINT) AS total FROM doc WHERE len(words) > 0),
item AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_terms('text')}) AS term FROM benchmark WHERE item_id IS NOT NULL) GROUP BY ALL),
held AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(words) AS term FROM doc) GROUP BY ALL),
weight AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM held, whole GROUP BY term, docs),
score AS (SELECT item_id, k, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(words) * docs) // total)))) AS BIGINT) AS score
  FROM item JOIN held USING (term) JOIN weight USING (term) JOIN doc USING (k), whole GROUP BY item_id, k),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM score JOIN doc USING (k) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script|\z)|<style\b.*?(?:</style|\z)"
_LINK = r"""(?i)<a\s(?:[^<>]*?\s)?href\s*=\s*["'']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\s"''<>]+)"""
_RULES = ", ".join(f"('{action}', '{rule}', '{rule.partition('/')[0]}', '/{rule.partition('/')[2]}')" for action, rule in URL_RULES)

HOSTS = f"""
WITH RECURSIVE page AS (
  SELECT row_number() OVER () AS k, page_id, html,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(action, rule, of, under) AS (VALUES {_RULES}),
judged AS (SELECT k, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
  FROM page JOIN rules ON (host = of OR ends_with(host, '.' || of)) AND starts_with(path, under) GROUP BY k),
links AS (SELECT host AS source, target, count(*) AS weight FROM (
    SELECT k, host, unnest(list_distinct([translate(t, '{_UPPER}', '{_LOWER}') FOR t IN
      regexp_extract_all(regexp_replace(html, '{_HIDDEN}', ' ', 'g'), '{_LINK}', 1)])) AS target FROM page)
  WHERE host <> '' AND target <> host GROUP BY ALL),
arcs AS (SELECT 0 AS side, source AS host, target AS next, weight, sum(weight) OVER (PARTITION BY source) AS whole FROM links
  UNION ALL SELECT 1, target, source, weight, sum(weight) OVER (PARTITION BY target) FROM links),
walks(step, side, host, mass) AS (
  SELECT 0, CASE WHEN action = 'block' THEN 1 ELSE 0 END, host, count(*) * {UNIT} FROM judged JOIN page USING (k) GROUP BY ALL
  UNION ALL
  SELECT step + 1, w.side, next, CAST(sum((CAST(mass AS HUGEINT) * (weight * 85)) // CAST(whole * 100 AS HUGEINT)) AS BIGINT)
  FROM walks w JOIN arcs a ON a.side = w.side AND a.host = w.host WHERE step < 20 AND mass > 0 GROUP BY step, w.side, next),
masses AS (SELECT host, CAST(coalesce(sum(mass) FILTER (side = 0), 0) AS BIGINT) AS trust, CAST(coalesce(sum(mass) FILTER (side = 1), 0) AS BIGINT) AS distrust
  FROM walks GROUP BY host)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN distrust > trust THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust
FROM page LEFT JOIN judged USING (k) LEFT JOIN masses USING (host)
"""

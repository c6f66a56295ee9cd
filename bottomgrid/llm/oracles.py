"""DuckDB SQL for the operators whose rules SQL can express."""

from __future__ import annotations

from . import line_rules as lr
from .licenses import MARKERS, PARAGRAPH, SENTENCE_END, TEMPLATES, THRESHOLD, template_grams

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WHITE = r"[^\x20\x09-\x0D]+"
NOTHING = "[^\\x00-\\x{10FFFF}]"  # matches no text
_ITEM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

NGRAM_JACCARD = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(coalesce({LOWER}, ''), '{_WHITE}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS t
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT o.a, o.b FROM o JOIN n x ON o.a = x.doc_id JOIN n y ON o.b = y.doc_id
  WHERE 100 * o.o >= 80 * (x.n + y.n - o.o)),
r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id
FROM d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY 1"""

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce({LOWER}, ''), '{_ITEM}') AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), 13) AS n FROM (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(coalesce({LOWER}, ''), '{_ITEM}') AS w FROM benchmark)
  WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT *, unnest(generate_series(1, len(w) - n + 1)) AS i FROM b)),
pos AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM (
  SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
  FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
h AS (SELECT doc_id, i, n, item_id FROM pos JOIN win USING (n, t)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM h)) GROUP BY 1),
it AS (SELECT doc_id, list_sort(list(DISTINCT item_id)) AS items FROM h GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  CAST(coalesce(len(items), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN it USING (doc_id)"""


def _q(s: str) -> str:
    return s.replace("'", "''")


_NOTICE = (f"regexp_matches(line, '{_q(lr.RIGHTS)}') OR "
           + " + ".join(f"CAST(regexp_matches(line, '{_q(c)}') AS INT)" for c in lr.CUES) + " > 1")

QUALITY_RULES = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '{_WHITE}') AS w FROM documents),
l AS (SELECT doc_id, line, regexp_extract_all(line, '{_WHITE}') AS lw
  FROM (SELECT doc_id, unnest(string_split(x, chr(10))) AS line FROM d)),
v AS (SELECT doc_id, line, len(lw) AS n, length(array_to_string(lw, '')) AS chars,
  len(lw) > 0 AND (regexp_matches(line, '{_q(lr.SEPARATORS)}')
    OR len(regexp_extract_all(line, '{lr.SYMBOLS}')) > len(lw) * {lr.MAX_SYMBOLS_PER_WORD}
    OR (len(lw) < 25 AND ({_NOTICE}))
    OR regexp_matches(line, '{_q(lr.SHOUT)}')
    OR (len(lw) < {lr.MIN_LINE_WORDS} AND NOT regexp_matches(line, '{_q(lr.END_MARK)}'))) AS fails FROM l),
per AS (SELECT doc_id, sum(CASE WHEN fails THEN chars ELSE 0 END) AS lost,
  count(*) FILTER (WHERE n > 0) - count(DISTINCT line) FILTER (WHERE n > 0) AS dup FROM v GROUP BY 1),
t AS (SELECT doc_id, i, w[i:i + 2] AS t FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d WHERE len(w) > 2)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
  SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, t) AS k FROM t) WHERE k > 1)
  GROUP BY 1),
r AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(x, '{lr.SYMBOLS}')) AS BIGINT) AS n_symbols, CAST(per.dup AS BIGINT) AS n_dup_lines,
  CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, per.lost
  FROM d JOIN per USING (doc_id) LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND lost * 100 <= word_chars * {lr.MAX_LOST_PERCENT} AS kept FROM f"""

def _texts(xs) -> str:
    return "[" + ", ".join(f"'{_q(x)}'" for x in xs) + "]::VARCHAR[]"


_LICENSE_ROWS = ", ".join(
    f"({k}, '{_q(name)}', {_texts(template_grams(text))}, {_texts(MARKERS.get(name, ((), None))[0])}, "
    f"'{_q(MARKERS.get(name, ((), None))[1] or NOTHING)}')" for k, (name, text) in enumerate(TEMPLATES))

LICENSES = rf"""
WITH tpl(k, name, g, must, never) AS (VALUES {_LICENSE_ROWS}),
p AS (SELECT doc_id, coalesce(text, '') AS x, unnest(regexp_split_to_array(coalesce(text, ''), '{PARAGRAPH}')) AS para FROM documents),
s AS (SELECT doc_id, para, string_split(regexp_replace(para, '{SENTENCE_END}', '\1' || chr(1), 'g'), chr(1)) AS s FROM p),
u AS (SELECT DISTINCT doc_id, trim(regexp_replace(lower(unit), '[^a-z0-9]+', ' ', 'g')) AS unit FROM (
  SELECT doc_id, unnest(string_split(x, chr(10))) AS unit FROM p
  UNION ALL SELECT doc_id, unnest(list_concat([para], s, list_transform(generate_series(1, len(s) - 1), lambda i: s[i] || ' ' || s[i + 1]))) FROM s)),
w AS (SELECT row_number() OVER () AS u, doc_id, string_split(unit, ' ') AS w FROM u WHERE unit <> ''),
g AS (SELECT u, doc_id, CASE WHEN len(w) = 1 THEN w ELSE list_distinct(list_transform(generate_series(1, len(w) - 1),
  lambda i: w[i] || ' ' || w[i + 1])) END AS g FROM w),
hit AS (SELECT DISTINCT g.u, k FROM (SELECT u, unnest(g) AS x FROM g) g JOIN (SELECT k, unnest(g) AS x FROM tpl) t ON g.x = t.x),
m AS (SELECT g.u, doc_id, k, name, 2e0 * len(list_intersect(g.g, tpl.g)) / (len(g.g) + len(tpl.g)) AS dice,
  array_to_string(g.g, ' | ') AS j, must, never FROM hit JOIN g USING (u) JOIN tpl USING (k)),
ok AS (SELECT * FROM m WHERE dice >= {THRESHOLD} AND NOT regexp_matches(j, never)
  AND len(list_filter(must, lambda x: NOT regexp_matches(j, x))) = 0),
best AS (SELECT * FROM ok QUALIFY row_number() OVER (PARTITION BY u ORDER BY dice DESC, k) = 1),
per AS (SELECT doc_id, first(name ORDER BY dice DESC, k) AS license, max(dice) AS dice, count(*) AS n,
  array_to_string(list_sort(list(DISTINCT name)), ',') AS licenses FROM best GROUP BY 1)
SELECT doc_id, license, round(per.dice, 6) AS dice, coalesce(n, 0) AS n_matches, coalesce(licenses, '') AS licenses
FROM documents LEFT JOIN per USING (doc_id)"""

_CRC = ("xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), "
        "lambda c, b: list_reduce(list_prepend(xor(c, b), CAST(generate_series(1, 8) AS BIGINT[])), "
        "lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)")


def _leaf(text: str) -> str:
    parts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
             for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


def _fold(name: str, start: str, up: str) -> str:
    """Folds h along the levels of ``up``; collects the siblings."""
    same = "{0}.lev = f.lev AND {0}.source IS NOT DISTINCT FROM f.source AND {0}.idx = f.idx // 3 * 3 + {1}"
    joins = " ".join(f"LEFT JOIN {up} x{k} ON {same.format(f'x{k}', k)}" for k in range(3))
    node = " || ".join(f"CASE WHEN f.idx % 3 = {k} THEN f.h ELSE coalesce(x{k}.h, '') END" for k in range(3))
    rest = " || ".join(f"CASE WHEN f.idx % 3 = {k} THEN '' ELSE coalesce(x{k}.h, '') END" for k in range(3))
    return (f"{name}(row, lev, source, idx, n, h, proof) AS ({start} UNION ALL "
            f"SELECT f.row, f.lev + 1, f.source, f.idx // 3, (f.n + 2) // 3, sha256({node}), f.proof || {rest} "
            f"FROM {name} f {joins} WHERE f.n > 1)")


def _up(name: str, start: str) -> str:
    return (f"{name}(lev, source, idx, h, n) AS ({start} UNION ALL SELECT lev + 1, source, idx // 3, "
            f"sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM {name} WHERE n > 1 GROUP BY lev, source, idx // 3, n)")


MERKLE = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, {_leaf('text')} AS leaf,
  CASE WHEN {_CRC} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS copy FROM documents),
l AS (SELECT *, row_number() OVER () AS row, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
  count(*) OVER (PARTITION BY source) AS n FROM d),
{_up('up', 'SELECT 0, source, idx, leaf, n FROM l')},
s AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM up WHERE n = 1),
{_up('top', "SELECT 0, '', idx, h, n FROM s")},
{_fold('f', "SELECT row, 0, source, idx, n, copy, '' FROM l", 'up')},
g AS (SELECT f.row, s.idx, s.n, f.h, f.proof, s.h AS subroot FROM f JOIN s ON f.source IS NOT DISTINCT FROM s.source WHERE f.n = 1),
{_fold('t', "SELECT row, 0, '', idx, n, h, proof FROM g", 'top')}
SELECT l.doc_id, l.leaf, g.subroot, r.h AS root, sha256(t.proof) AS proof_sha256, t.h AS folded_root, t.h = r.h AS verified
FROM l JOIN g USING (row) JOIN (SELECT * FROM t WHERE n = 1) t USING (row) CROSS JOIN (SELECT h FROM top WHERE n = 1) r"""

ORACLES = {
    "op11_merkle_manifest": MERKLE,
    "op2_ngram_jaccard": NGRAM_JACCARD,
    "op3_decontamination": DECONTAMINATION,
    "op7_quality_rules": QUALITY_RULES,
    "op10_licenses": LICENSES,
}

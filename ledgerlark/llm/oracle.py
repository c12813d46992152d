"""DuckDB SQL for the operators that SQL can express.

op3 to op7, op9 and op10 learn models, run tokenizers, hash with XXH64 or read
markup, which DuckDB's SQL can't; tests/llm holds them against brute force."""

from __future__ import annotations

from .licenses import KNOWN, SPELLINGS

_WORD = r"[^\x20\x09-\x0D]"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    """Licence form of a text expression, line breaks kept."""
    sql = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    sql = (f"regexp_replace(chr(10) || {sql}, '\\n[ \\t\\r>*#/;.-]*(?:copyright[ \\t]*(?:\\(c\\)|©|[0-9]|by |holder:|owner:)"
           "|\\(c\\)[ \\t]|©|all rights reserved)[^\\n]*', '', 'g')")
    sql = (f"regexp_replace({sql}, '[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x60\\x7B-\\x7F\\x{{00A0}}\\x{{00AB}}\\x{{00BB}}"
           "\\x{2010}-\\x{2015}\\x{2018}-\\x{201F}\\x{2022}\\x{3000}]+', ' ', 'g')")
    for a, b in SPELLINGS:
        sql = f"replace({sql}, {_literal(a)}, {_literal(b)})"
    return sql


_OP1 = f"""
WITH known AS (
  SELECT DISTINCT license_id, trim(regexp_replace(replace({_canonical('body')}, chr(10), ' '), ' +', ' ', 'g')) AS form
  FROM (VALUES {', '.join(f'({_literal(i)}, {_literal(t)})' for i, t in KNOWN)}) AS k(license_id, body)),
forms AS (SELECT doc_id, {_canonical("coalesce(text, '')")} AS form FROM documents),
units AS (
  SELECT doc_id, 'text' AS scope, replace(form, chr(10), ' ') AS unit FROM forms
  UNION ALL
  SELECT doc_id, 'line' AS scope, unnest(string_split(form, chr(10))) AS unit FROM forms)
SELECT doc_id, scope, license_id, count(*) AS n_matches
FROM units JOIN known ON trim(regexp_replace(unit, ' +', ' ', 'g')) = known.form
WHERE known.form <> ''
GROUP BY ALL
"""

_OP2 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, x.vec_id AS vec_id, list_inner_product(q.v, x.v)::BIGINT AS score
  FROM v q JOIN v x ON x.vec_id <> q.vec_id AND len(x.v) = len(q.v)
  WHERE q.vec_id % 50 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

_OP8 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
cut AS (
  SELECT doc_id, text, regexp_extract_all(text, '{_WORD}+') AS ws,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls
  FROM d),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM cut WHERE len(ws) >= 8)),
twice AS (SELECT doc_id, list(i) AS starts FROM windows GROUP BY doc_id, win HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM (SELECT doc_id, unnest(starts) AS i FROM twice), (SELECT unnest(range(0, 8)) AS k)
  GROUP BY doc_id),
measured AS (
  SELECT c.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls)::BIGINT AS n_lines,
         coalesce(v.n, 0)::BIGINT AS n_repeat_words
  FROM cut c LEFT JOIN covered v USING (doc_id)),
judged AS (
  SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END
    + CASE WHEN word_chars > 15 * n_words THEN 16 ELSE 0 END
    + CASE WHEN n_lines >= 4 AND 10 * n_dup_lines > 4 * n_lines THEN 32 ELSE 0 END)::BIGINT AS failure_bits
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failure_bits & 3) <> 0 AS base_failed,
       failure_bits = 0 AS kept, failure_bits, 3::INTEGER AS policy_version
FROM judged
"""

# climbs every leaf of a table "levels" (tree, lvl, idx, hash, n); {start} are its leaves (row_id, tree, idx, proof, folded)
_CLIMB = """
  SELECT row_id, tree, idx, 0 AS lvl, proof, folded FROM {start}
  UNION ALL
  SELECT c.row_id, c.tree, c.idx // 3, c.lvl + 1, c.proof || s.lefts || s.rights, sha256(s.lefts || c.folded || s.rights)
  FROM {name} c JOIN {sides} s ON s.tree = c.tree AND s.lvl = c.lvl AND s.idx = c.idx"""
_SIDES = """
  SELECT a.tree, a.lvl, a.idx, coalesce(string_agg(b.hash, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS lefts,
         coalesce(string_agg(b.hash, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS rights
  FROM {levels} a JOIN {levels} b ON b.tree = a.tree AND b.lvl = a.lvl AND b.idx // 3 = a.idx // 3
  WHERE a.n > 1
  GROUP BY ALL"""
_LEVELS = """
  SELECT tree, 0 AS lvl, idx, hash, n FROM {start}
  UNION ALL
  SELECT tree, any_value(lvl) + 1, idx // 3, sha256(string_agg(hash, '' ORDER BY idx)), any_value(n + 2) // 3
  FROM {name} WHERE n > 1 GROUP BY tree, idx // 3"""


def _leaf(*fields: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')" for f in fields) + ")"


def _crc_table(bits: int) -> str:
    """The 256 entries of the CRC-32 table (polynomial fixed by its standard)."""
    if not bits:
        return "(SELECT i, i AS x FROM (SELECT unnest(range(256)) AS i))"
    return (f"(SELECT i, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END AS x FROM {_crc_table(bits - 1)})")


_OP13 = f"""
WITH RECURSIVE t AS (
  SELECT list(x ORDER BY i) AS t FROM {_crc_table(8)}),
crc AS (
  SELECT doc_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), t),
hashed AS (
  SELECT doc_id, source, {_leaf('doc_id', 'source', 'lang', 'n_chars', 'text')} AS leaf,
         CASE WHEN crc % 2 = 0 THEN {_leaf('doc_id', 'source', 'lang', 'n_chars', "replace(text, chr(10), '')")}
              ELSE {_leaf('doc_id', 'source', 'lang', 'n_chars', 'text')} END AS tampered
  FROM documents LEFT JOIN crc USING (doc_id)),
leaves AS (
  SELECT row_number() OVER () AS row_id, coalesce('s' || source, '-') AS tree, doc_id, leaf AS hash, tampered,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n
  FROM hashed),
levels AS ({_LEVELS.format(start='leaves', name='levels')}),
tops AS (
  SELECT 0 AS tree, tree AS source, hash, row_number() OVER (ORDER BY encode(tree)) - 1 AS idx, count(*) OVER () AS n
  FROM levels WHERE n = 1),
over AS ({_LEVELS.format(start='tops', name='over')}),
sides AS ({_SIDES.format(levels='levels')}),
over_sides AS ({_SIDES.format(levels='over')}),
start AS (SELECT row_id, tree, idx, '' AS proof, tampered AS folded FROM leaves),
climb AS ({_CLIMB.format(start='start', name='climb', sides='sides')}),
half AS (
  SELECT c.row_id, 0 AS tree, tops.idx, c.proof, c.folded
  FROM climb c JOIN levels l ON l.tree = c.tree AND l.lvl = c.lvl AND l.idx = c.idx AND l.n = 1 JOIN tops ON tops.source = c.tree),
climb_over AS ({_CLIMB.format(start='half', name='climb_over', sides='over_sides')}),
root AS (SELECT lvl, hash FROM over WHERE n = 1)
SELECT l.doc_id, l.hash AS leaf, tops.hash AS subroot, root.hash AS root, sha256(c.proof) AS proof_sha256,
       c.folded AS folded_root, c.folded = root.hash AS verified
FROM climb_over c JOIN root ON c.lvl = root.lvl JOIN leaves l ON l.row_id = c.row_id JOIN tops ON tops.source = l.tree
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP11 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (
  SELECT item_id, ws, least(len(ws), 10) AS n
  FROM (SELECT item_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark)
  WHERE len(ws) > 0),
theirs AS (
  SELECT DISTINCT item_id, n, list_slice(ws, k, k + n - 1) AS win
  FROM (SELECT item_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS k FROM i)),
ours AS (
  SELECT doc_id, k, n, list_slice(ws, k, k + n - 1) AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS k
        FROM d JOIN (SELECT DISTINCT n FROM i) AS sizes ON len(ws) >= n)),
hit AS (SELECT doc_id, item_id, k, n FROM ours JOIN theirs USING (n, win)),
covered AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS w FROM hit) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY encode(item_id)) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_OP12 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
totals AS (SELECT count(*) AS nn, sum(len(ws))::BIGINT AS ll FROM d WHERE len(ws) > 0),
i AS (
  SELECT DISTINCT item_id, unnest(list_distinct(regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))) AS term
  FROM benchmark),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(ws) AS n, unnest(ws) AS term FROM d) GROUP BY ALL),
w AS (
  SELECT term, floor(1000 * ln((2 * any_value(nn) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, totals GROUP BY term),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll))))::BIGINT AS score
  FROM i JOIN w USING (term) JOIN tf USING (term), totals
  GROUP BY item_id, doc_id)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": _OP1, "op2_pivot_top_k": _OP2, "op8_rule_ledger": _OP8,
            "op11_winnowing": _OP11, "op12_presence_masks": _OP12, "op13_merkle_climb": _OP13}

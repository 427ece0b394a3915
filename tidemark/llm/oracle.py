"""DuckDB SQL equal to the registered queries of this subpackage, where SQL
can express them; the others are tested against brute force."""

from .merkle import FIELDS
from .quality_rules import ALPHA, DELTA, MAX_REPEAT_PERCENT, MIN_WORDS, RULES
from .spelling import MIN_COUNT, MIN_LETTERS, ONE_IN

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP3 = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS run
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS run
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw USING (n, run)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_GRID = ", ".join(f"('{r.name}', {i}, {c}::DOUBLE)" for r in RULES for i, c in enumerate(r.cutoffs))
_VALUES = " UNION ALL ".join(
    f"SELECT doc_id, stratum, text, base_failed, '{r.name}' AS rule, {r.value} AS value FROM f WHERE n_words > 0 AND n_lines > 0"
    for r in RULES)

OP1 = f"""
WITH t AS (SELECT doc_id, coalesce(lang, 'none') AS stratum, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, stratum, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM t),
runs AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, run) AS times
  FROM (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS run
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8))),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM runs WHERE times > 1) GROUP BY 1),
f0 AS (
  SELECT w.doc_id, stratum, text, len(w)::BIGINT AS n_words, len(lines) AS n_lines,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(text, '[^\\p{{Lu}}]+', '', 'g'))::BIGINT AS n_upper,
         length(regexp_replace(text, '[^!?]+', '', 'g'))::BIGINT AS n_marks,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT} AS base_failed FROM f0),
vals AS ({_VALUES}),
grid AS (SELECT * FROM (VALUES {_GRID}) AS g(rule, step, cutoff)),
good AS (SELECT doc_id, max(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY 1),
lab AS (SELECT stratum, text, rule, value, max(quality) = 1 AS good FROM vals JOIN good USING (doc_id) WHERE NOT base_failed GROUP BY ALL),
tallies AS (
  SELECT stratum, rule, step, cutoff, count(*) FILTER (good) AS n, count(*) FILTER (NOT good) AS n_bad,
         count(*) FILTER (good AND value > cutoff) AS k, count(*) FILTER (NOT good AND value > cutoff) AS k_bad
  FROM lab JOIN grid USING (rule) GROUP BY ALL),
tested AS (
  SELECT *, CASE WHEN k >= n * {ALPHA / len(RULES)!r} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
           exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({ALPHA / len(RULES)!r}) + (n - i) * ln(1 - {ALPHA / len(RULES)!r})))) END
           AS p_value FROM tallies),
proven AS (
  SELECT *, min(p_value <= {DELTA!r} / ((SELECT count(DISTINCT stratum) FROM tallies) * {len(RULES)}))
              OVER (PARTITION BY stratum, rule ORDER BY step ROWS UNBOUNDED PRECEDING) AS proven,
         CASE WHEN n_bad > 0 THEN k_bad / n_bad ELSE 0 END - k / greatest(n, 1) AS gain FROM tested),
best AS (
  SELECT stratum, rule, cutoff FROM proven WHERE proven AND gain > 0
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, step) = 1),
bad AS (SELECT DISTINCT doc_id FROM vals JOIN best USING (stratum, rule) WHERE value > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept FROM f
"""



def _crc_table() -> list[int]:
    """CRC-32 of each half byte, by its polynomial."""
    out = []
    for x in range(16):
        for _ in range(4):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        out.append(x)
    return out


def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a text: half bytes of its hex form, lower
    half of each byte first."""
    digits = f"hex(encode({text}))"
    halves = (f"list_transform(range(0, length({digits})), lambda i: "
              f"strpos('0123456789ABCDEF', substr({digits}, i - i % 2 + 2 - i % 2, 1)) - 1)")
    return (f"xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, ({halves})::BIGINT[]), "
            f"lambda a, x: xor(a >> 4, ({_crc_table()}::BIGINT[])[(xor(a, x) & 15) + 1])))")


OP11 = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[a-z\u00c0-\u00ff]{{{MIN_LETTERS},}}')) AS run
    FROM documents) GROUP BY ALL),
hashed AS (SELECT run, times, {_crc32("id || ':' || run")} AS h FROM runs),
words AS MATERIALIZED (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT CASE WHEN h % {ONE_IN} = 0 THEN substring(run, 1, (h % length(run))::INT) || substring(run, (h % length(run))::INT + 2)
                ELSE run END AS word, times FROM hashed)
  WHERE length(word) >= {MIN_LETTERS} GROUP BY 1 HAVING sum(times) >= {MIN_COUNT}),
gaps AS MATERIALIZED (
  SELECT word, p, substring(word, 1, p::INT) || substring(word, p::INT + 2) AS rest
  FROM (SELECT word, unnest(range(0, length(word))) AS p FROM words)),
one_more AS (SELECT DISTINCT g.word AS a, w.word AS b FROM gaps g JOIN words w ON w.word = g.rest),
near AS (
  SELECT a.word AS word, b.word AS other FROM gaps a JOIN gaps b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT a, b FROM one_more UNION ALL SELECT b, a FROM one_more),
ranked AS (
  SELECT near.word, other, w.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
         row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, other) AS place
  FROM near JOIN words w ON w.word = other),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form,
         CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN (SELECT * FROM ranked WHERE place = 1) r ON r.word = w.word),
way AS (
  SELECT word, word AS stop FROM forms
  UNION ALL SELECT way.word, f.form FROM way JOIN forms f ON f.word = way.stop WHERE f.form IS NOT NULL),
ends AS (SELECT way.word, stop AS root FROM way JOIN forms f ON f.word = stop WHERE f.form IS NULL)
SELECT forms.word, form, root, n, n_near, form_n FROM forms JOIN ends ON ends.word = forms.word
"""


def _field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"


def _tree(name: str, leaves: str, levels: int) -> str:
    """CTEs for the levels above ``leaves`` (tree, i, h, n): ``<name>_top``
    (tree, h) and, for every level, what stands beside a node in its run."""
    out = [f"{name}_0 AS MATERIALIZED ({leaves})"]
    for k in range(levels):
        out.append(f"{name}_{k + 1} AS MATERIALIZED (SELECT tree, i // 3 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h, (n + 2) // 3 AS n "
                   f"FROM {name}_{k} WHERE n > 1 GROUP BY tree, i // 3, n)")
        run = "OVER (PARTITION BY tree, i // 3 ORDER BY i)"
        out.append(f"{name}_beside_{k} AS MATERIALIZED (SELECT tree, i, coalesce(lag(h, 2) {run}, '') || coalesce(lag(h) {run}, '') AS a, "
                   f"coalesce(lead(h) {run}, '') || coalesce(lead(h, 2) {run}, '') AS b FROM {name}_{k} WHERE n > 1)")
    out.append(f"{name}_top AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT tree, h FROM {name}_{k} WHERE n = 1" for k in range(levels + 1)) + ")")
    return ",\n".join(out)


def _walk(name: str, start: str, tree: str, levels: int) -> str:
    """CTEs that take rows with ``tree, i, h, proof`` up a tree."""
    out = [f"{name}_0 AS MATERIALIZED ({start})"]
    for k in range(levels):
        out.append(f"{name}_{k + 1} AS MATERIALIZED (SELECT w.* REPLACE (w.i // 3 AS i, CASE WHEN s.i IS NULL THEN w.h ELSE sha256(s.a || w.h || s.b) END AS h, "
                   f"w.proof || coalesce(s.a || s.b, '') AS proof) FROM {name}_{k} w LEFT JOIN {tree}_beside_{k} s ON s.tree = w.tree AND s.i = w.i)")
    return ",\n".join(out)


#: Levels that the SQL goes up: enough for 3 ** _LEVELS rows in a source, or sources.
_LEVELS = 14
OP12 = f"""
WITH d AS (
  SELECT *, CASE WHEN {_crc32("doc_id::VARCHAR")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS retext FROM documents),
leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, sha256({" || ".join(_field(c) for c in FIELDS)}) AS leaf,
         sha256({" || ".join(_field("retext" if c == "text" else c) for c in FIELDS)}) AS other FROM d),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
{_tree("t", "SELECT tree, i, leaf AS h, n FROM placed", _LEVELS)},
{_tree("u", "SELECT 0 AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, h, count(*) OVER () AS n FROM t_top", _LEVELS)},
{_walk("v", "SELECT tree, i, other AS h, '' AS proof, doc_id, leaf FROM placed", "t", _LEVELS)},
{_walk("w", f"SELECT 0 AS tree, p.i, v.h, v.proof, doc_id, leaf, p.h AS subroot FROM v_{_LEVELS} v "
            "JOIN (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS i FROM t_top) p ON p.tree = v.tree", "u", _LEVELS)}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, w.h AS folded_root, w.h = root AS verified
FROM w_{_LEVELS} w, (SELECT h AS root FROM u_top) r
"""

ORACLE = {
    "op1_quality_rules": OP1,
    "op3_decontaminate": OP3,
    "op11_spelling": OP11,
    "op12_merkle": OP12,
}

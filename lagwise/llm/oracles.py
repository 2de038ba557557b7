"""DuckDB SQL for the queries that SQL can express."""
from __future__ import annotations

EXACT = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
"""

LINES = r"""
WITH all_lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
worded AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p FROM all_lines
           WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
triples AS (SELECT doc_id, p, line AS a, lead(line) OVER w AS b, lead(line, 2) OVER w AS c
            FROM worded WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
ranked AS (SELECT doc_id, p, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, p) AS k
           FROM triples WHERE c IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, p + unnest([0, 1, 2]) AS p FROM ranked WHERE k > 1),
marked AS (SELECT l.doc_id, l.i, l.line, w.p, g.p IS NOT NULL AS out FROM all_lines l
           LEFT JOIN worded w USING (doc_id, i) LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.p = w.p)
SELECT doc_id, count(p) AS n_lines, count(*) FILTER (out) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT out), '')) AS text_sha256
FROM marked GROUP BY doc_id
"""


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_ASSIGN = ("(" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
           + r""")["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""")
#: kind, pattern, group, least length of the group, as the operator has them.
_RULES = (
    ("assign", _ASSIGN, 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("google", "AIza[A-Za-z0-9_-]{35}", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 0),
)


def _secrets() -> str:
    parts = [f"""
    SELECT doc_id, {rank} AS rank, '{kind}' AS kind,
           unnest(regexp_extract_all(text, '{pattern}', 0)) AS hit,
           unnest(regexp_extract_all(text, '{pattern}', {group})) AS part,
           unnest(string_split_regex(text, '{pattern}')[:-2]) AS gap,
           generate_subscripts(regexp_extract_all(text, '{pattern}', 0), 1) AS i,
           {least} AS least
    FROM d""" for rank, (kind, pattern, group, least) in enumerate(_RULES)]
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
hits AS ({" UNION ALL ".join(parts)}),
ends AS (SELECT *, sum(length(gap) + length(hit)) OVER (
             PARTITION BY doc_id, rank ORDER BY i)::BIGINT AS stop FROM hits),
spans AS (SELECT doc_id, rank, kind, stop - length(hit) AS start,
                 kind || ':' || (stop - length(hit)) || ':' || stop AS span
          FROM ends WHERE length(part) >= least),
told AS (SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign,
                count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
                string_agg(span, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
                string_agg(span, ',' ORDER BY start, rank) AS spans
         FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM d LEFT JOIN told USING (doc_id)
"""


def _part(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_part, ("doc_id", "source", "lang", "n_chars", text))) + ")"


#: CRC-32 of the decimal id, bit by bit (fixed value: the reversed polynomial).
_CRC = """xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda c: ord(c)::UBIGINT),
        lambda a, b: list_reduce([xor(a, b)] || [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0],
                              lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))),
    4294967295::UBIGINT)"""


def _levels(name: str, base: str) -> str:
    """A recursive table of all nodes (grp, level, pos, size, node) over ``base`` (grp, pos, size, node)."""
    return f"""
{name} AS (
    SELECT grp, 0 AS level, pos, size, node FROM {base}
    UNION ALL
    SELECT grp, level + 1, pos // 3, (size + 2) // 3, sha256(string_agg(node, '' ORDER BY pos))
    FROM {name} WHERE size > 1 GROUP BY grp, level, pos // 3, size)"""


def _steps(name: str, nodes: str) -> str:
    """Per node of a level (grp, level, pos): what its run holds before and after it."""
    return f"""
{name} AS (
    SELECT a.grp, a.level, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
           coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after
    FROM {nodes} a JOIN {nodes} b ON a.grp IS NOT DISTINCT FROM b.grp AND a.level = b.level AND a.pos // 3 = b.pos // 3
    WHERE a.size > 1 GROUP BY a.grp, a.level, a.pos)"""


MERKLE = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, source AS grp, {_leaf("text")} AS node,
           CASE WHEN {_CRC} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS seen
    FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id) - 1 AS pos,
                  count(*) OVER (PARTITION BY grp) AS size FROM d),
{_levels("nodes", "leaves")},
tops AS (SELECT grp AS source, node, 0 AS grp, row_number() OVER (ORDER BY encode(grp) NULLS FIRST) - 1 AS pos,
                count(*) OVER () AS size FROM nodes WHERE size = 1),
{_levels("over", "tops")},
{_steps("low", "nodes")},
{_steps("high", "over")},
way AS (
    SELECT l.doc_id, s.level, s.before, s.after FROM leaves l JOIN low s
    ON s.grp IS NOT DISTINCT FROM l.grp AND s.pos = l.pos // CAST(pow(3, s.level) AS BIGINT)
    UNION ALL
    SELECT l.doc_id, 100 + s.level, s.before, s.after FROM leaves l
    JOIN tops t ON t.source IS NOT DISTINCT FROM l.grp
    JOIN high s ON s.pos = t.pos // CAST(pow(3, s.level) AS BIGINT)),
ways AS (SELECT doc_id, list({{'before': before, 'after': after}} ORDER BY level) AS path,
                sha256(string_agg(before || after, '' ORDER BY level)) AS proof FROM way GROUP BY doc_id),
fold AS (
    SELECT l.doc_id, 1 AS i, l.seen AS h FROM leaves l
    UNION ALL
    SELECT f.doc_id, f.i + 1, sha256(w.path[f.i].before || f.h || w.path[f.i].after)
    FROM fold f JOIN ways w USING (doc_id) WHERE f.i <= len(w.path)),
ends AS (SELECT doc_id, max_by(h, i) AS folded_root FROM fold GROUP BY doc_id)
SELECT l.doc_id, l.node AS leaf, t.node AS subroot, r.node AS root,
       coalesce(w.proof, sha256('')) AS proof_sha256, e.folded_root, e.folded_root = r.node AS verified
FROM leaves l JOIN tops t ON t.source IS NOT DISTINCT FROM l.grp
JOIN (SELECT node FROM over WHERE size = 1) r ON true
JOIN ends e USING (doc_id) LEFT JOIN ways w USING (doc_id)
"""


NEGATIVES = """
WITH x AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
             CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM x a JOIN x b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_secrets": _secrets(), "op5_line_dedup": LINES,
            "op7_exact_dedup": EXACT, "op11_hard_negatives": NEGATIVES,
            "op13_merkle": MERKLE}

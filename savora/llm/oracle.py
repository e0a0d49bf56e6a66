"""DuckDB SQL for the rows of those queries that SQL can express."""

from __future__ import annotations

from savora.llm.licenses import TEMPLATES

# A-Z lower-cased; what is below U+0080 and no digit or letter parts words.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p : p + least(10, len(w)) - 1], ' ') AS s
    FROM i, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS t(p) WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
    SELECT doc_id, p, n, array_to_string(w[p : p + n - 1], ' ') AS s
    FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(p)
),
hits AS (SELECT doc_id, p, n, item_id FROM places JOIN windows USING (n, s)),
covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM hits, unnest(range(p, p + n)) AS t(q) GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP5 = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
    FROM documents
)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY norm) AS group_size,
    doc_id = first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) AS kept,
    sha256(norm) AS text_sha256
FROM d
"""

_TEMPLATES = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(TEMPLATES))


def _bigrams(words: str) -> str:
    pairs = f"list_transform(range(1, len({words})), lambda i: {words}[i] || ' ' || {words}[i + 1])"
    return f"list_distinct(CASE WHEN len({words}) = 1 THEN {words} ELSE {pairs} END)"


OP8 = rf"""
WITH t AS (
    SELECT id, license, {_bigrams('w')} AS b FROM (
        SELECT id, license, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM (VALUES {_TEMPLATES}) AS v(id, license, text)
    )
),
l AS (
    SELECT doc_id, line, unit, trim(unit) = '' AS blank FROM (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS unit,
            unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS line
        FROM documents
    )
),
p AS (
    SELECT doc_id, min(line) AS line, string_agg(unit, ' ' ORDER BY line) AS unit FROM (
        SELECT *, count(*) FILTER (blank) OVER (PARTITION BY doc_id ORDER BY line) AS part FROM l
    ) WHERE NOT blank GROUP BY doc_id, part
),
u AS (
    SELECT doc_id, line, {_bigrams('w')} AS b FROM (
        SELECT doc_id, line, regexp_extract_all(
            translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+') AS w
        FROM (SELECT doc_id, line, unit FROM l UNION ALL SELECT doc_id, line, unit FROM p)
    ) WHERE len(w) > 0
),
c AS (
    SELECT doc_id, line, license, round(2.0 * len(list_intersect(u.b, t.b)) / (len(u.b) + len(t.b)), 6)::DOUBLE AS dice
    FROM u JOIN t ON len(u.b) BETWEEN len(t.b) * 0.6 AND len(t.b) * 1.6
)
SELECT doc_id, line::BIGINT AS line, license, dice FROM c WHERE dice >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, license) = 1
"""

ORACLE = {"op3_decontaminate": OP3, "op5_exact_dedup": OP5, "op8_licenses": OP8}

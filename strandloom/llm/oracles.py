"""SQL of the training-data operators that SQL can express, in DuckDB's words; each goes another way than its operator."""

from __future__ import annotations

#: CRC-32 of a text of decimal digits, bit by bit.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}, ''), lambda ch: list_transform(range(8), lambda b: (ascii(ch) >> b::INTEGER)::BIGINT & 1)))), lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295)"""
_WORD = r"[^\x20\x09-\x0D]+"

#: Every prefix is spelled out, and subtrees are counted by pairs of a node and what lies below it.
OP11 = rf"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - ((conv_id % 20) + 20) % 20 AS base, {_CRC32.format("conv_id::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, 0 AS k, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.base WHERE t.pos < c.h
  UNION ALL SELECT c.conv_id, 1, t.pos, t.role, t.text FROM c JOIN t USING (conv_id) WHERE t.pos >= c.h
), d AS MATERIALIZED (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY k, pos) AS depth,
         string_agg(length(role) || ':' || length(text) || ':' || role || text, '') OVER (PARTITION BY conv_id ORDER BY k, pos ROWS UNBOUNDED PRECEDING) AS prefix,
         length(regexp_extract_all(text, '{_WORD}')) AS words, count(*) OVER (PARTITION BY conv_id) AS length
  FROM r
), p AS MATERIALIZED (
  SELECT conv_id, depth, prefix, coalesce(lag(prefix) OVER (PARTITION BY conv_id ORDER BY depth), '') AS parent, words, length FROM d
  UNION ALL SELECT c.conv_id, 0, '', NULL, 0, (SELECT count(*) FROM r WHERE r.conv_id = c.conv_id) FROM c
), n AS MATERIALIZED (
  SELECT prefix, any_value(depth) AS depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS own,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = length), '')) AS ends_sha256
  FROM p GROUP BY prefix
), k AS (SELECT parent AS prefix, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent
), s AS (
  SELECT p.prefix, sum(CASE WHEN k.prefix IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum(u.own) AS saved_tokens
  FROM n u JOIN p ON p.conv_id = u.conv_id AND p.depth <= u.depth LEFT JOIN k ON k.prefix = u.prefix GROUP BY p.prefix
)
SELECT n.conv_id, n.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0)::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN s USING (prefix) LEFT JOIN k USING (prefix) LEFT JOIN n q ON q.prefix = n.parent
"""


def vector_codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """Lloyd's rounds by comparing every part with every entry."""
    steps = [
        f"""v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"p AS MATERIALIZED (SELECT vec_id, label, part, e[part * len(e) // {parts} + 1 : (part + 1) * len(e) // {parts}] AS x FROM v, range({parts}) AS t(part))",
        f"b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS c FROM p WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT {entries}))",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (SELECT vec_id, any_value(label) AS label, part, any_value(x) AS x, arg_min(entry, d * {entries} + entry) AS entry, min(d) AS d
  FROM (SELECT p.*, entry, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM p JOIN b{i} USING (part)) GROUP BY vec_id, part)"""
        )
        if i < rounds:
            steps.append(
                f"""b{i + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(u.c, b.c) AS c FROM b{i} b LEFT JOIN (
  SELECT part, entry, list(floor(s::DOUBLE / n)::BIGINT ORDER BY i) AS c FROM (
    SELECT part, entry, i, sum(x[i]) AS s, count(*) AS n FROM a{i}, range(1, (SELECT max(len(x)) FROM p) + 1) AS t(i) GROUP BY part, entry, i) GROUP BY part, entry) u USING (part, entry))"""
            )
    steps.append(f"o AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id)")
    steps.append(f"h AS (SELECT sha256(string_agg(list_aggregate(c, 'string_agg', ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})")
    return "WITH " + ",\n".join(steps) + "\nSELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM o, h"


OP13 = vector_codes_sql()

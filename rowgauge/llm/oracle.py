"""SQL of the queries that SQL can express."""

from __future__ import annotations

OP8 = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
    FROM lines
), common AS (
    SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(common.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE common.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common USING (key)
GROUP BY doc_id
"""

OP2 = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
    SELECT *, length(role) + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + 18 AS chars FROM said
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

OP11 = r"""
WITH said AS (
    SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
           strlen(coalesce(text, '')) AS size,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS nth
    FROM conversations WHERE conv_id IS NOT NULL
), counted AS (
    SELECT conv_id, conv_id - conv_id % 5 AS source, count(*) AS own,
           list_reduce(  -- crc32, bit by bit
               list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
               lambda crc, c: list_reduce(list_prepend(xor(crc, c), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                   lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc
    FROM said GROUP BY conv_id
), sized AS (
    SELECT conv_id, source, own, xor(crc, 4294967295) % 9 AS h FROM counted
), convs AS (
    SELECT c.*, least(c.h, coalesce(s.own, 0)) AS given FROM sized c LEFT JOIN sized s ON s.conv_id = c.source
), built AS (
    SELECT c.conv_id, s.nth AS depth, s.id, s.size FROM convs c JOIN said s ON s.conv_id = c.source AND s.nth <= c.h
    UNION ALL
    SELECT c.conv_id, s.nth - c.h + c.given, s.id, s.size FROM convs c JOIN said s ON s.conv_id = c.conv_id AND s.nth > c.h
), path AS (
    SELECT conv_id, depth, size, string_agg(id, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM built
    UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), node AS (
    SELECT path, max(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size FROM path GROUP BY path
), children AS (
    SELECT left(path, -32) AS path, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1
), above AS (
    SELECT left(path, 32 * unnest(range(depth + 1))) AS path, (n_convs - 1) * size AS saving,
           (path NOT IN (SELECT path FROM children))::INT AS leaf
    FROM node
), subtree AS (
    SELECT path, sum(leaf)::BIGINT AS n_leaves, sum(saving)::BIGINT AS saved_tokens FROM above GROUP BY path
), ends AS (
    SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
    FROM (SELECT conv_id, arg_max(path, depth) AS path FROM path GROUP BY conv_id) GROUP BY path
)
SELECT node.conv_id, node.depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM node JOIN subtree USING (path) LEFT JOIN children USING (path) LEFT JOIN ends USING (path)
LEFT JOIN node up ON node.depth > 0 AND up.path = left(node.path, -32)
"""

_NEAREST = """
{name} AS (
    SELECT vec_id, part, min(e.entry) AS entry, any_value(least) AS dist
    FROM (SELECT p.vec_id, p.part, e.entry, list_sum(list_transform(list_zip(p.v, e.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS dist,
                 min(dist) OVER (PARTITION BY p.vec_id, p.part) AS least
          FROM parts p JOIN {books} e USING (part)) e
    WHERE dist = least GROUP BY vec_id, part
)"""

_MEANS = """
{name} AS (
    SELECT b.part, b.entry, coalesce(m.v, b.v) AS v
    FROM {books} b LEFT JOIN (
        SELECT part, entry, list(mean ORDER BY place) AS v
        FROM (SELECT part, entry, place, floor(sum(x)::DECIMAL(38, 0) / count(*))::BIGINT AS mean
              FROM (SELECT a.part, a.entry, unnest(range(len(p.v))) AS place, unnest(p.v) AS x
                    FROM {near} a JOIN parts p USING (vec_id, part))
              GROUP BY part, entry, place)
        GROUP BY part, entry) m USING (part, entry)
)"""

#: For distinct ids and vectors whose width 16 divides.
OP13 = (
    r"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
    SELECT vec_id, part, v[(part * len(v)) // 16 + 1 : ((part + 1) * len(v)) // 16] AS v
    FROM kept, (SELECT unnest(range(16)) AS part)
), books0 AS (
    SELECT part, entry, v FROM parts JOIN (
        SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 64) USING (vec_id)
),"""
    + _NEAREST.format(name="near0", books="books0")
    + ","
    + _MEANS.format(name="books1", books="books0", near="near0")
    + ","
    + _NEAREST.format(name="near1", books="books1")
    + ","
    + _MEANS.format(name="books2", books="books1", near="near1")
    + ","
    + _NEAREST.format(name="near2", books="books2")
    + r""", coded AS (
    SELECT vec_id, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error
    FROM near2 GROUP BY vec_id
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM books2) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""
)

ORACLE = {"op2_chat_parts": OP2, "op8_line_dedup": OP8, "op11_prefix_trie": OP11, "op13_vector_codes": OP13}

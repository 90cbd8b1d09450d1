"""SQL of the queries whose contracts draw by CRC-32, which the checking engine does not have."""

from __future__ import annotations

#: The 256 remainders of CRC-32 (reflected polynomial 0xEDB88320), as one row with a list.
_TABLE = """
    crc_bits(i, k, v) AS (
        SELECT i, 0, i FROM range(256) AS r(i)
        UNION ALL
        SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END
        FROM crc_bits WHERE k < 8
    ), crc_table AS (SELECT list(v ORDER BY i) AS t FROM crc_bits WHERE k = 8)
"""


def _crc(codes: str) -> str:
    """CRC-32 of a list of byte values, with ``t`` in scope."""
    return f"""xor(list_reduce(list_prepend(4294967295, {codes}),
                 lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)"""


OP11 = f"""
    WITH RECURSIVE {_TABLE}, turns AS (
        SELECT conv_id, turn, length(text) AS n, role, text,
               dense_rank() OVER (ORDER BY role, text) AS id
        FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
              FROM conversations WHERE conv_id IS NOT NULL)
    ), own AS (
        SELECT conv_id, list({{'id': id, 'n': n}} ORDER BY turn NULLS FIRST,
                             sha256(length(role) || ':' || role || text)) AS path
        FROM turns GROUP BY conv_id
    ), drawn AS (
        SELECT conv_id, path, conv_id - conv_id % 100 AS base,
               {_crc("list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))")} % 6 AS h
        FROM own, crc_table
    ), rebuilt AS (
        SELECT d.conv_id, list_concat(list_slice(coalesce(b.path, []), 1, h),
                                      list_slice(d.path, h + 1, len(d.path))) AS path
        FROM drawn d LEFT JOIN own b ON b.conv_id = d.base
    ), prefixes AS (
        SELECT conv_id, len(path) AS size, depth, list_slice(path, 1, depth) AS prefix
        FROM (SELECT conv_id, path, unnest(range(len(path) + 1)) AS depth FROM rebuilt)
    ), nodes AS (
        SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
               CASE WHEN depth = 0 THEN 0 ELSE prefix[depth].n END AS n,
               coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                        FILTER (WHERE size = depth), '') AS ends
        FROM prefixes GROUP BY prefix, depth
    ), above AS (
        SELECT list_slice(prefix, 1, depth - 1) AS prefix, count(*) AS n_children
        FROM nodes WHERE depth > 0 GROUP BY 1
    ), known AS (
        SELECT nodes.*, coalesce(n_children, 0) AS n_children
        FROM nodes LEFT JOIN above USING (prefix)
    ), sums AS (
        SELECT list_slice(prefix, 1, d) AS prefix, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
               sum((n_convs - 1) * n) AS saved_tokens
        FROM (SELECT *, unnest(range(depth + 1)) AS d FROM known) GROUP BY 1
    )
    SELECT k.conv_id, CAST(k.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id,
           CAST(k.n_convs AS BIGINT) AS n_convs, CAST(k.n_children AS BIGINT) AS n_children,
           CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
           sha256(k.ends) AS ends_sha256
    FROM known k JOIN sums s USING (prefix)
    LEFT JOIN nodes p ON k.depth > 0 AND p.prefix = list_slice(k.prefix, 1, k.depth - 1)
"""

#: Near words share what is left when one code point is marked or left out.
OP12 = rf"""
    WITH RECURSIVE {_TABLE}, runs AS (
        SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
        FROM documents
    ), kinds AS (
        SELECT run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS named, count(*) AS n
        FROM runs WHERE length(run) >= 7 GROUP BY ALL
    ), coded AS (
        SELECT run, n, hex(encode(named)) AS h FROM kinds
    ), drawn AS (
        SELECT run, n, {_crc("list_transform(range(len(h) // 2), lambda i: CAST('0x' || substring(h, 2 * i + 1, 2) AS BIGINT))")} AS c
        FROM coded, crc_table
    ), words AS (
        SELECT CASE WHEN c % 31 = 0 THEN left(run, c % length(run)) || substring(run, c % length(run) + 2)
                    ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
        FROM drawn GROUP BY 1 HAVING length(word) >= 7 AND sum(n) >= 2
    ), holes AS (
        SELECT word, n, i, left(word, i) || '_' || substring(word, i + 2) AS marked,
               left(word, i) || substring(word, i + 2) AS short
        FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
    ), near AS (
        SELECT a.word, b.word AS other, b.n FROM holes a JOIN holes b ON a.marked = b.marked AND a.word <> b.word
        UNION
        SELECT a.word, b.word, b.n FROM holes a JOIN words b ON a.short = b.word
        UNION
        SELECT b.word, a.word, a.n FROM holes a JOIN words b ON a.short = b.word
    ), best AS (
        SELECT word, count(*) AS n_near, max(n) AS top_n,
               min(encode(other)) FILTER (WHERE n = top) AS top
        FROM (SELECT *, max(n) OVER (PARTITION BY word) AS top FROM near) GROUP BY word
    ), forms AS (
        SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
               CASE WHEN top_n >= 10 * w.n THEN decode(top) END AS form,
               CASE WHEN top_n >= 10 * w.n THEN top_n END AS form_n
        FROM words w LEFT JOIN best USING (word)
    ), steps(word, place, k) AS (
        SELECT word, word, 0 FROM forms
        UNION ALL
        SELECT s.word, f.form, k + 1 FROM steps s JOIN forms f ON s.place = f.word WHERE f.form IS NOT NULL
    ), roots AS (SELECT word, arg_max(place, k) AS root FROM steps GROUP BY word)
    SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n
    FROM forms JOIN roots USING (word)
"""

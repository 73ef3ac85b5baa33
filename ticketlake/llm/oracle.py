"""SQL of the operators that DuckDB can express, over the same tables."""

from __future__ import annotations

#: Unsigned CRC-32 of the ASCII text ``{x}``: bytes and their eight shifts, folded in order.
CRC32 = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({x}, ''), lambda c: list_prepend(
        ord(c)::BIGINT, list_transform(range(8), lambda i: -1::BIGINT))))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END
), 4294967295::BIGINT)"""

CONVERSATION_TRIE = f"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce("text", '') AS body,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, "text") AS place
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS head, {CRC32.format(x="CAST(conv_id AS VARCHAR)")} % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
    SELECT c.conv_id, t.place AS pos, t.role, t.body FROM convs c
    JOIN turns t ON t.conv_id = c.head AND t.place <= c.h
    UNION ALL
    SELECT c.conv_id, c.h + t.place, t.role, t.body FROM convs c
    JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h),
tagged AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS depth,
           sha256(role) || sha256(body) AS tag, len(regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+')) AS words
    FROM rebuilt),
prefixes AS (
    SELECT conv_id, depth, words,
           sha256(string_agg(tag, '' ORDER BY depth) OVER (
               PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING)) AS k FROM tagged
    UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
linked AS (
    SELECT *, lag(k) OVER w AS up, lead(k) OVER w IS NULL AS ends FROM prefixes
    WINDOW w AS (PARTITION BY conv_id ORDER BY depth)),
nodes AS (
    SELECT k, depth, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
    FROM linked GROUP BY k, depth),
kids AS (SELECT up AS k, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up),
below AS (
    SELECT DISTINCT a.k, b.k AS under FROM prefixes a JOIN prefixes b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
sums AS (
    SELECT b.k, count(*) FILTER (WHERE c.k IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
    FROM below b JOIN nodes n ON n.k = b.under LEFT JOIN kids c ON c.k = b.under GROUP BY b.k)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
       s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.k = n.up LEFT JOIN kids c ON c.k = n.k JOIN sums s ON s.k = n.k
"""

WARC_ARCHIVE = """
WITH hashed AS (
    SELECT page_id, url, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages),
ranked AS (
    SELECT *, row_number() OVER w AS n, first_value(page_id) OVER w AS first_id FROM hashed
    WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id NULLS LAST, url NULLS LAST))
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND n > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND n > 1 THEN first_id END AS refers_to
FROM ranked
"""

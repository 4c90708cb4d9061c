"""The operators' queries as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

WARC = r"""
WITH paid AS (
    SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
           upper(sha1(coalesce(html, ''))) AS hexed
    FROM pages
), bits AS (
    SELECT page_id, payload_bytes, hexed,
           array_to_string(list_transform(generate_series(1, 40),
               lambda i: right('0000' || bin(strpos('0123456789ABCDEF', substr(hexed, i, 1)) - 1), 4)), '') AS b
    FROM paid
), texts AS (
    SELECT page_id, payload_bytes, hexed,
           array_to_string(list_transform(generate_series(0, 31),
               lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   list_sum(list_transform(generate_series(1, 5),
                       lambda j: CASE WHEN substr(b, i * 5 + j, 1) = '1' THEN 1 << (5 - j) ELSE 0 END))::INT + 1, 1)), '')
               AS payload_digest
    FROM bits
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY hexed) AS first FROM texts
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""

LINE_DEDUP = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT doc_id, pos, line,
           translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM lines
), shared AS (
    SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= 10
    GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), judged AS (
    SELECT x.doc_id, x.pos, x.line, s.k IS NOT NULL AND x.doc_id <> s.keeper AS gone
    FROM keyed x LEFT JOIN shared s ON x.k = s.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

MIXING = r"""
WITH sized AS (
    SELECT doc_id, source,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           md5(doc_id::VARCHAR) AS place
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
    SELECT source, source_size,
           row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r,
           3.0::DOUBLE * source_size AS cap,
           (sum(source_size) OVER ())::DOUBLE AS total
    FROM sources
), weighed AS (
    SELECT *, (r % 3 + 1)::DOUBLE AS weight FROM ranked
), flagged AS (
    SELECT *, cap * sum(weight) OVER rest
              < weight * (total - coalesce(sum(cap) OVER before, 0.0)) AS capped
    FROM weighed
    WINDOW before AS (ORDER BY cap / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           rest AS (ORDER BY cap / weight, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), units AS (
    SELECT *, (total - sum(CASE WHEN capped THEN cap ELSE 0.0 END) OVER ())
              / nullif(sum(CASE WHEN capped THEN 0.0 ELSE weight END) OVER (), 0) AS unit
    FROM flagged
), targets AS (
    SELECT source, source_size, r,
           CASE WHEN capped THEN cap ELSE least(cap, coalesce(weight * unit, 0.0)) END AS target
    FROM units
), placed AS (
    SELECT d.doc_id, d.size, t.source_size, t.target, t.r,
           floor(t.target)::BIGINT AS goal,
           CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS passes,
           coalesce(sum(d.size) OVER (
               PARTITION BY d.source ORDER BY d.place, d.doc_id, d.size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first
    FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), takes AS (
    SELECT *, least(size, greatest(0, goal - passes * source_size - first)) AS cut FROM placed
), shares AS (
    SELECT *, passes * size + cut AS taken,
           (first + (CASE WHEN passes > 0 THEN size ELSE cut END) / 2.0::DOUBLE) / nullif(goal, 0) AS share
    FROM takes
), moments AS (
    SELECT *, CASE r % 3 WHEN 0 THEN 1.5 WHEN 1 THEN 1.0 ELSE 2.0 / 3 END::DOUBLE AS w0,
           CASE r % 3 WHEN 0 THEN -1.0 WHEN 1 THEN 0.0 ELSE 2.0 / 3 END::DOUBLE AS slope
    FROM shares
)
SELECT doc_id, size, source_size, target, taken,
       CASE WHEN taken > 0 THEN round(least(1.0, 2 * share / (w0 + sqrt(w0 * w0 + 2 * slope * share))), 6) END AS position
FROM moments
"""

URL_FILTER = r"""
WITH split AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), ruled AS (
    SELECT page_id, host, path,
           CASE WHEN ('.' || host) LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
                WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
                WHEN ('.' || host) LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
                WHEN ('.' || host) LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
                WHEN ('.' || host) LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule
    FROM split
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

RANKED_SEARCH = r"""
WITH doc_terms AS (
    SELECT rowid AS row, doc_id, unnest(regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT *, row_number() OVER () AS rowid FROM documents)
), tfs AS (
    SELECT row, doc_id, term, count(*)::BIGINT AS tf FROM doc_terms GROUP BY ALL
), sizes AS (
    SELECT row, sum(tf)::BIGINT AS n FROM tfs GROUP BY row
), facts AS (
    SELECT count(*)::BIGINT AS N_docs, sum(n)::BIGINT AS L FROM sizes
), dfs AS (
    SELECT term, count(*)::BIGINT AS df FROM tfs GROUP BY term
), weights AS (
    SELECT term, floor(1000 * ln((2 * N_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM dfs, facts
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), scored AS (
    SELECT a.item_id, t.row, t.doc_id,
           sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (10 + (90 * s.n * f.N_docs) // f.L))))::BIGINT AS score
    FROM asked a JOIN weights w USING (term) JOIN tfs t USING (term) JOIN sizes s USING (row), facts f
    GROUP BY a.item_id, t.row, t.doc_id
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

PREFIX_TRIE = r"""
WITH RECURSIVE ids AS (
    SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL
), steps AS (
    SELECT conv_id, encode(conv_id::VARCHAR) AS bytes, 0 AS i, 4294967295::BIGINT AS c FROM ids
    UNION ALL
    SELECT conv_id, bytes, i + 1, list_reduce(
               list_prepend(xor(c, ascii(substr(conv_id::VARCHAR, i + 1, 1))::BIGINT), range(1, 9)),
               lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)
    FROM steps WHERE i < length(conv_id::VARCHAR)
), heads AS (
    SELECT conv_id, xor(c, 4294967295::BIGINT) % 4 AS h FROM steps WHERE i = length(conv_id::VARCHAR)
), turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p,
           {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS t
    FROM conversations WHERE conv_id IS NOT NULL
), lists AS (
    SELECT conv_id, list(t ORDER BY p) AS l FROM turns GROUP BY conv_id
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.l[:h], []), c.l[h + 1:]) AS l
    FROM lists c JOIN heads USING (conv_id) LEFT JOIN lists b ON b.conv_id = c.conv_id - c.conv_id % 20
), prefixes AS (
    SELECT conv_id, d AS depth, l[:d] AS prefix, len(l) AS n FROM rebuilt, unnest(range(0, len(l) + 1)) AS u(d)
), nodes AS (
    SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256,
           CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(prefix[depth].text, '[^\x20\x09-\x0D]+')) END AS words
    FROM prefixes GROUP BY depth, prefix
), below AS (
    SELECT p.depth, p.prefix, count(*) AS n FROM nodes c JOIN nodes p ON c.depth = p.depth + 1 AND c.prefix[:p.depth] = p.prefix
    GROUP BY ALL
), counted AS (
    SELECT nodes.*, coalesce(below.n, 0) AS n_children FROM nodes LEFT JOIN below USING (depth, prefix)
), subtrees AS (
    SELECT d AS depth, prefix[:d] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves,
           sum((n_convs - 1) * words)::BIGINT AS saved_tokens
    FROM counted, unnest(range(0, depth + 1)) AS u(d) GROUP BY ALL
)
SELECT c.conv_id, c.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children,
       s.n_leaves, s.saved_tokens, c.ends_sha256
FROM counted c JOIN subtrees s USING (depth, prefix)
LEFT JOIN nodes p ON p.depth = c.depth - 1 AND p.prefix = c.prefix[:c.depth - 1]
"""


def llm_sql() -> dict[str, str]:
    return {
        "op2_warc": WARC,
        "op3_line_dedup": LINE_DEDUP,
        "op7_mixing": MIXING,
        "op10_url_filter": URL_FILTER,
        "op11_prefix_trie": PREFIX_TRIE,
        "op13_ranked_search": RANKED_SEARCH,
    }

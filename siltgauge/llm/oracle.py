"""SQL of an independent engine for the queries that SQL can express."""

OP5 = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 2), ' ') AS sh
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), p AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b USING (sh) WHERE a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
    SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * o >= 90 * (nx.n + ny.n - o)
), both_ways AS (
    SELECT x, y FROM l UNION ALL SELECT y, x FROM l
), reach(a, b) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT a, y FROM reach JOIN both_ways ON x = b
), least AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM least LEFT JOIN n USING (doc_id)
"""

OP6 = r"""
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), q AS (
    SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM p
), r AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS least FROM q
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM least THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM least THEN least END AS refers_to
FROM r
"""

OP7 = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
    FROM documents
), windows AS (
    SELECT rid, i, list_slice(ws, i, i + 4) AS w
    FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM d)
), again AS (
    SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS n FROM windows
), repeated AS (
    SELECT rid, count(DISTINCT p) AS n
    FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM again WHERE n > 1) GROUP BY rid
), f AS (
    SELECT d.rid, doc_id, source, len(ws) AS n_words,
        coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(ls) - len(list_distinct(ls)) AS n_dup_lines,
        coalesce(r.n, 0) AS n_repeat_words, len(ls) AS n_lines
    FROM d LEFT JOIN repeated r ON r.rid = d.rid
), g AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f
), h AS (
    SELECT *, base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines
        OR word_chars < 3 * n_words OR word_chars > 10 * n_words AS failed
    FROM g
), hosts AS (
    SELECT source, count(*) AS n, count(*) FILTER (failed) AS k, count(*) FILTER (failed) / count(*) AS rate FROM h GROUP BY source
), prior AS (
    SELECT avg(rate) AS m,
        CASE WHEN var_samp(rate) > 0 THEN greatest(avg(rate) * (1 - avg(rate)) / var_samp(rate) - 1, 1.0) ELSE 1.0 END AS w
    FROM hosts
), verdict AS (
    SELECT source, (k + m * w) / (n + w) >= 0.5 AS rejected FROM hosts, prior
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, n_lines::BIGINT AS n_lines,
    base_failed, NOT base_failed AND NOT (rejected AND failed) AS kept
FROM h JOIN verdict v ON v.source IS NOT DISTINCT FROM h.source
"""

OP13 = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws
    FROM documents
), totals AS (
    SELECT count(*) AS n_all, sum(len(ws))::BIGINT AS n_terms FROM d WHERE len(ws) > 0
), p AS (
    SELECT rid, doc_id, n, term, count(*) AS tf
    FROM (SELECT rid, doc_id, len(ws) AS n, unnest(ws) AS term FROM d) GROUP BY rid, doc_id, n, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * n_all + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, totals GROUP BY term, n_all
), q AS (
    SELECT iid, item_id, term, count(*) AS times
    FROM (
        SELECT iid, item_id, unnest(regexp_extract_all(
            translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT row_number() OVER () AS iid, item_id, coalesce(text, '') AS t FROM benchmark)
    ) GROUP BY iid, item_id, term
), scores AS (
    SELECT iid, item_id, rid, doc_id,
        sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_all) // n_terms))))::BIGINT AS score
    FROM q JOIN p USING (term) JOIN weights USING (term), totals GROUP BY iid, item_id, rid, doc_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0
)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= 20
"""

"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "op1_warc_records": """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 1 ELSE greatest(1, (payload_bytes + 1048575) // 1048576) END::BIGINT AS n_chunks
FROM f
""",
    "op3_nra_topk": """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda c: floor(c::DOUBLE * 64)) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 20
""",
    "op4_decontaminate": r"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), bw AS (
    SELECT DISTINCT item_id, least(10, len(words)) AS size, array_to_string(words[i : i + least(10, len(words)) - 1], ' ') AS win
    FROM (SELECT item_id, words, unnest(generate_series(1, greatest(1, len(words) - 9))) AS i FROM b WHERE len(words) > 0)
), sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
    SELECT doc_id, size, i, array_to_string(words[i : i + size - 1], ' ') AS win
    FROM (SELECT doc_id, words, size, unnest(generate_series(1, len(words) - size + 1)) AS i FROM w, sizes WHERE len(words) >= size)
), hit AS (SELECT dw.doc_id, dw.i, dw.size, bw.item_id FROM dw JOIN bw ON dw.size = bw.size AND dw.win = bw.win),
covered AS (SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n_hit FROM (SELECT doc_id, i, unnest(generate_series(0, size - 1)) AS k FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op5_jaccard_components": r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, array_to_string(words[i : i + least(4, len(words)) - 1], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(1, len(words) - 3))) AS i FROM w WHERE len(words) > 0)
), n AS (SELECT doc_id, count(*)::BIGINT AS n FROM s GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM pairs JOIN n p ON x = p.doc_id JOIN n q ON y = q.doc_id WHERE 100 * shared >= 85 * (p.n + q.n - shared)
), reach(doc_id, root) AS (
    SELECT doc_id, doc_id FROM w
    UNION
    SELECT links.y, reach.root FROM reach JOIN links ON links.x = reach.doc_id
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)
""",
    "op6_url_filter": r"""
WITH u AS (
    SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), h AS (
    SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(rest, ''), '^([^/?#]*)([^?#]*)', 2) AS path
    FROM u
), rules(rule_host, rule_path, listed) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), best AS (
    SELECT h.page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule, max_by(listed, length(rule_host || rule_path)) AS listed
    FROM h JOIN rules ON (host = rule_host OR suffix(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY h.page_id
)
SELECT h.page_id, host, path, rule, coalesce(listed, 'allow') AS verdict FROM h LEFT JOIN best USING (page_id)
""",
}

"""DuckDB SQL of the queries that SQL can express over whole tables."""

OP2 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL
    SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), written AS (
    SELECT *,
        length('<turn:') + length('>' || chr(10)) + length('</turn>' || chr(10))
        + length(text) + length(text) - length(replace(text, '\', '')) + length(text) - length(replace(text, '<', ''))
        + length(role) + length(role) - length(replace(replace(replace(replace(role, '\', ''), '<', ''), '>', ''), chr(10), ''))
        AS chars
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM written GROUP BY conv_id
"""

OP6 = r"""
WITH parsed AS (
    SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '') AS raw,
        coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
    FROM pages
), split AS (
    SELECT page_id, path, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM parsed
), named AS (
    SELECT *, string_split(host, '.') AS parts,
        array_to_string(string_split(host, '.')[-2:], '.') IN ('co.uk', 'org.uk', 'ac.uk', 'gov.uk', 'com.au',
            'net.au', 'org.au', 'co.jp', 'com.br', 'co.nz', 'co.in', 'com.cn', 'co.kr', 'co.za') AS two
    FROM split
), votes AS (
    SELECT doc_id AS page_id, max(CAST(quality = 0 OR toxic = 1 AS INT)) AS bad FROM labels GROUP BY doc_id
), hosts AS (
    SELECT host, any_value(array_to_string(CASE WHEN two THEN parts[-3:] ELSE parts[-2:] END, '.')) AS domain,
        any_value(array_to_string(CASE WHEN two THEN parts[-2:] ELSE parts[-1:] END, '.')) AS suffix,
        CAST(count(bad) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS bad
    FROM named LEFT JOIN votes USING (page_id) GROUP BY host
), rate AS (
    SELECT CASE WHEN sum(n) > 0 THEN (sum(bad) + 1) / (sum(n) + 2) ELSE 0.5 END AS rate FROM hosts
), suffixes AS (
    SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(rate) AS prior FROM hosts, rate GROUP BY suffix
), suffix_spread AS (
    SELECT sum(CAST(floor((n * (bad / n - prior) * (bad / n - prior) - prior * (1 - prior)) * 1000000) AS DECIMAL(38, 0))) AS over,
        sum(CAST(floor(prior * (1 - prior) * (n - 1) * 1000000) AS DECIMAL(38, 0))) AS room
    FROM suffixes WHERE n > 1
), suffix_weight AS (
    SELECT CASE WHEN over > 0 AND room <> 0 THEN least(1000.0, greatest(1.0, CAST(room AS DOUBLE) / CAST(over AS DOUBLE) - 1)) ELSE 1000.0 END AS w FROM suffix_spread
), domains AS (
    SELECT h.suffix, h.domain, sum(h.n) AS n, sum(h.bad) AS bad, any_value((s.bad + s.prior * w) / (s.n + w)) AS prior
    FROM hosts h JOIN suffixes s USING (suffix), suffix_weight GROUP BY h.suffix, h.domain
), domain_spread AS (
    SELECT sum(CAST(floor((n * (bad / n - prior) * (bad / n - prior) - prior * (1 - prior)) * 1000000) AS DECIMAL(38, 0))) AS over,
        sum(CAST(floor(prior * (1 - prior) * (n - 1) * 1000000) AS DECIMAL(38, 0))) AS room
    FROM domains WHERE n > 1
), domain_weight AS (
    SELECT CASE WHEN over > 0 AND room <> 0 THEN least(1000.0, greatest(1.0, CAST(room AS DOUBLE) / CAST(over AS DOUBLE) - 1)) ELSE 1000.0 END AS w FROM domain_spread
), shrunk AS (
    SELECT h.host, h.n, h.bad, (d.bad + d.prior * w) / (d.n + w) AS prior
    FROM hosts h JOIN domains d USING (domain), domain_weight
), host_spread AS (
    SELECT sum(CAST(floor((n * (bad / n - prior) * (bad / n - prior) - prior * (1 - prior)) * 1000000) AS DECIMAL(38, 0))) AS over,
        sum(CAST(floor(prior * (1 - prior) * (n - 1) * 1000000) AS DECIMAL(38, 0))) AS room
    FROM shrunk WHERE n > 1
), host_weight AS (
    SELECT CASE WHEN over > 0 AND room <> 0 THEN least(1000.0, greatest(1.0, CAST(room AS DOUBLE) / CAST(over AS DOUBLE) - 1)) ELSE 1000.0 END AS w FROM host_spread
), bounds AS (
    SELECT host, m - 1.645 * sqrt(m * (1 - m) / (n + w + 1)) AS lower
    FROM (SELECT host, n, w, (bad + prior * w) / (n + w) AS m FROM shrunk, host_weight)
), rules(rule_host, rule_path, rule_verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), ruled AS (
    SELECT s.page_id, s.host, s.path,
        max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
        max_by(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
    FROM (SELECT *, row_number() OVER () AS r FROM split) s
    LEFT JOIN rules ON (s.host = rule_host OR s.host LIKE '%.' || rule_host) AND starts_with(s.path, rule_path)
    GROUP BY s.r, s.page_id, s.host, s.path
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN lower > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled JOIN bounds USING (host)
"""

OP7 = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), items AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), windows AS (
    SELECT DISTINCT item, least(10, len(words)) AS size,
        array_to_string(words[place : place + least(10, len(words)) - 1], ' ') AS gram
    FROM (SELECT item, words, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS place FROM items WHERE len(words) > 0)
), sizes AS (SELECT DISTINCT size FROM windows),
places AS (
    SELECT doc_id, size, place, array_to_string(words[place : place + size - 1], ' ') AS gram
    FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS place FROM docs, sizes)
), hits AS (
    SELECT doc_id, p.place, p.size, item FROM places p JOIN windows w ON p.size = w.size AND p.gram = w.gram
), covered AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT doc_id, unnest(range(place, place + size)) AS word FROM hits) GROUP BY doc_id
), found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

OP13 = r"""
WITH doc_terms AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), item_terms AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), lengths AS (
    SELECT doc_id, count(*) AS n FROM doc_terms GROUP BY doc_id
), corpus AS (
    SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths
), times AS (
    SELECT doc_id, term, count(*) AS tf FROM doc_terms GROUP BY doc_id, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM times, corpus GROUP BY term
), scored AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM item_terms JOIN times USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), corpus
    GROUP BY item_id, doc_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

ORACLE = {"op2_chat_masks": OP2, "op6_url_reputation": OP6, "op7_benchmark_windows": OP7, "op13_ranked_search": OP13}

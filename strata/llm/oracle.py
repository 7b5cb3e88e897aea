"""DuckDB SQL of the queries that SQL can express, written from their contracts."""

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op1_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1),
         lambda x: w[x] || chr(10) || w[x + 1] || chr(10) || w[x + 2])) AS gram
  FROM d WHERE len(w) >= 3),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(3) AS r(k) GROUP BY doc_id),
base AS (
  SELECT d.doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN covered c ON c.doc_id = d.doc_id),
judged AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM base),
metric AS (
  SELECT doc_id, lang, source, base_failed, metric, value, value - value % (1::BIGINT << greatest(length(bin(value)) - 6, 0)) AS bucket
  FROM (
    SELECT *, 'symbols' AS metric, 1000 * n_symbols // greatest(n_words, 1) AS value FROM judged UNION ALL
    SELECT *, 'dup_lines', 1000 * n_dup_lines // greatest(n_lines, 1) FROM judged UNION ALL
    SELECT *, 'repeats', 1000 * n_repeat_words // greatest(n_words, 1) FROM judged UNION ALL
    SELECT *, 'word_length', 100 * word_chars // greatest(n_words, 1) FROM judged)),
good AS (SELECT * FROM metric WHERE NOT base_failed),
own AS (SELECT lang, source, metric, count(*) AS docs, quantile_disc(bucket, 0.25) AS q25, quantile_disc(bucket, 0.75) AS q75
        FROM good GROUP BY ALL),
by_lang AS (SELECT lang, metric, count(*) AS docs, quantile_disc(bucket, 0.25) AS q25, quantile_disc(bucket, 0.75) AS q75
            FROM good GROUP BY ALL),
corpus AS (SELECT metric, quantile_disc(bucket, 0.25) AS q25, quantile_disc(bucket, 0.75) AS q75 FROM good GROUP BY ALL),
chosen AS (
  SELECT o.lang, o.source, o.metric,
         CASE WHEN o.docs >= 100 THEN o.q25 WHEN b.docs >= 100 THEN b.q25 ELSE c.q25 END AS q25,
         CASE WHEN o.docs >= 100 THEN o.q75 WHEN b.docs >= 100 THEN b.q75 ELSE c.q75 END AS q75,
         CASE o.metric WHEN 'symbols' THEN 50 WHEN 'dup_lines' THEN 150 WHEN 'repeats' THEN 100 ELSE 100 END AS floor
  FROM own o JOIN by_lang b ON b.lang IS NOT DISTINCT FROM o.lang AND b.metric = o.metric JOIN corpus c ON c.metric = o.metric),
beyond AS (
  SELECT m.doc_id, string_agg(m.metric, ',' ORDER BY list_position(['symbols', 'dup_lines', 'repeats', 'word_length'], m.metric)) AS failed
  FROM metric m JOIN chosen c ON c.lang IS NOT DISTINCT FROM m.lang AND c.source IS NOT DISTINCT FROM m.source AND c.metric = m.metric
  WHERE bucket > q75 + 3 * greatest(q75 - q25, floor)
     OR (m.metric = 'word_length' AND bucket < q25 - 3 * greatest(q75 - q25, floor))
  GROUP BY m.doc_id)
SELECT j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND failed IS NULL) AS kept, coalesce(failed, '') AS failed_metrics
FROM judged j LEFT JOIN beyond b ON b.doc_id = j.doc_id
"""

ORACLE_SQL["op4_url_filter"] = r"""
WITH u AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
r(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                            ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fit AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id),
listed AS (
  SELECT DISTINCT host || path AS key FROM u
  WHERE regexp_matches(host, '(^|\.)(spam-farm|cheap-pills|casino-win|ads-track|free-bets|adult-x)(\.|$)'))
SELECT u.page_id, host, path, rule, coalesce(verdict, CASE WHEN key IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       key IS NOT NULL AS listed
FROM u LEFT JOIN fit ON fit.page_id = u.page_id LEFT JOIN listed ON listed.key = host || path
"""

ORACLE_SQL["op7_line_dedup"] = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (
  SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS i FROM d)),
shared AS (SELECT k, max(doc_id) AS last FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM (SELECT l.*, coalesce(doc_id < last, FALSE) AS gone FROM l LEFT JOIN shared ON shared.k = l.k)
GROUP BY doc_id
"""

ORACLE_SQL["op3_warc"] = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
q AS (
  SELECT page_id, payload_bytes, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first,
         translate(to_base(('0x' || hex[1:10])::BIGINT, 32, 8) || to_base(('0x' || hex[11:20])::BIGINT, 32, 8)
                   || to_base(('0x' || hex[21:30])::BIGINT, 32, 8) || to_base(('0x' || hex[31:40])::BIGINT, 32, 8),
                   '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest
  FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM q
"""

ORACLE_SQL["op10_chat_formatting"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(24 + length(role) + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""

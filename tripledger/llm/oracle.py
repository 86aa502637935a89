"""DuckDB SQL for the queries of this subpackage that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op4_exact_dedup"] = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""

ORACLE["op9_source_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         (('0x' || substr(sha256('20:' || doc_id), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
p AS (SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE
      AS w, source_size * 2.0::DOUBLE AS room FROM s),
l AS (SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE
             - coalesce(sum(room) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
      FROM p WINDOW b AS (ORDER BY room / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT *, CASE WHEN lv IS NULL THEN room ELSE least(room, lv * w) END AS target
      FROM (SELECT *, (SELECT arg_min(level, room / w) FROM l WHERE room > level * w) AS lv FROM l)),
a AS (SELECT source, source_size, target,
             CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole
      FROM t),
r AS (SELECT d.doc_id, d.size, a.source_size, a.target, a.whole,
             a.target - a.whole * a.source_size AS rest,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.u, d.doc_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
      FROM d JOIN a ON d.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (whole + CASE WHEN ahead + size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""

ORACLE["op7_url_filter"] = r"""
WITH p AS (
  SELECT page_id, url,
         coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
q AS (SELECT *, lower(regexp_extract(url, '^((?s).*?)://', 1)) AS scheme,
             array_to_string(list_sort(list_filter(string_split(
               regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'),
               lambda x: x <> '' AND NOT starts_with(x, 'utm_'))), '&') AS query FROM p),
c AS (SELECT *, CASE WHEN contains(url, '://') THEN scheme || '://' ||
        CASE WHEN scheme = 'http' THEN regexp_replace(host, ':80$', '')
             WHEN scheme = 'https' THEN regexp_replace(host, ':443$', '')
             WHEN scheme = 'ftp' THEN regexp_replace(host, ':21$', '') ELSE host END
        || CASE WHEN path = '' THEN '/' ELSE path END
        || CASE WHEN query = '' THEN '' ELSE '?' || query END END AS canonical FROM q),
r(host, path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                           ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
f AS (SELECT c.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
             arg_max(r.verdict, length(r.host || r.path)) AS verdict
      FROM c JOIN r ON (c.host = r.host OR ends_with(c.host, '.' || r.host))
                   AND starts_with(c.path, r.path) GROUP BY c.page_id)
SELECT c.page_id, c.host, c.path, f.rule,
       coalesce(f.verdict, CASE WHEN substr(md5(canonical), 1, 1) = '0' THEN 'block' ELSE 'allow' END)
       AS verdict
FROM c LEFT JOIN f USING (page_id)
"""

ORACLE["op1_warc"] = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""

ORACLE["op11_importance_resampling"] = r"""
WITH w AS (
  SELECT 0 AS side, doc_id AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
  UNION ALL
  SELECT 1, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
v AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM w)),
steps AS (SELECT word, list_transform(range(length(h) // 2),
          lambda k: ('0x' || substr(h, 2 * k + 1, 2))::BIGINT) AS bytes FROM v),
crc AS (SELECT word, xor(4294967295, list_reduce(bytes, lambda c, x: list_reduce(range(8),
          lambda d, i: CASE WHEN d % 2 = 1 THEN xor(d // 2, 3988292384) ELSE d // 2 END, xor(c, x)),
          4294967295)) % 10000 AS bucket FROM steps),
n AS (SELECT side, id, bucket, count(*) AS n FROM w JOIN crc USING (word) GROUP BY ALL),
b AS (SELECT range AS bucket, coalesce(s, 0) AS s, coalesce(t, 0) AS t FROM range(10000) LEFT JOIN (
        SELECT bucket, sum(n) FILTER (side = 0) AS s, sum(n) FILTER (side = 1) AS t FROM n GROUP BY bucket)
      ON range = bucket),
g AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
        / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM b),
d AS (SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
      FROM n JOIN g USING (bucket) WHERE side = 0 GROUP BY id),
r AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT
          + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
      FROM documents LEFT JOIN d ON id = doc_id),
k AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (
        PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place,
        count(*) FILTER (n_features >= 20) OVER () AS all_ FROM r)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= all_ * 10 // 100 THEN place END AS rank FROM k
"""

# Exact answers; those of the graph agree with them on tables of one shard.
ORACLE["op12_nearest_neighbours"] = """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
           WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (SELECT q.vec_id AS query_id, e.vec_id, list_distance(q.v, e.v) AS score
      FROM e AS q JOIN e ON q.vec_id % 100 = 0 AND q.vec_id <> e.vec_id AND len(q.v) = len(e.v))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INT AS rank, vec_id, score
FROM d QUALIFY rank <= 10
"""

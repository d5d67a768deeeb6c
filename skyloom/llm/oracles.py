"""DuckDB SQL of the contracts that SQL can express, by plain comparison of windows."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DECONTAMINATE = rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS key
        FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM win),
dwin AS (SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS key
         FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM dw, sizes WHERE len(w) >= k)),
met AS (SELECT doc_id, dwin.k, p, item_id FROM dwin JOIN win USING (k, key)),
words AS (SELECT doc_id, count(DISTINCT p + o) AS n_hit FROM met, LATERAL (SELECT unnest(range(0, k)) AS o) GROUP BY doc_id),
items AS (SELECT doc_id, count(i) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM met) GROUP BY doc_id)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN words ON dw.doc_id = words.doc_id LEFT JOIN items ON dw.doc_id = items.doc_id"""

SUFFIX_TREES = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS key FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM dw WHERE len(w) >= 13)),
late AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY key) AS first FROM win) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, p + o AS i FROM late, range(0, 13) t(o)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS s FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM dw) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM dw LEFT JOIN kept ON dw.doc_id = kept.doc_id LEFT JOIN n ON dw.doc_id = n.doc_id"""

SUFFIX_ARRAYS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS key FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS p FROM d WHERE len(h) >= 200)),
late AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY key ORDER BY doc_id, p) AS n FROM win) WHERE n > 1),
edges AS (SELECT doc_id, p, coalesce(p > 100 + lag(p) OVER w, true) AS opens FROM late WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
runs AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM (SELECT *, sum(opens::INTEGER) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM edges) GROUP BY doc_id, run),
gaps AS (SELECT doc_id, coalesce(lag(b) OVER w, 0) AS a, a AS b FROM runs WINDOW w AS (PARTITION BY doc_id ORDER BY a)
         UNION ALL SELECT doc_id, max(b), NULL FROM runs GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, CASE WHEN b IS NULL THEN len(h) ELSE 2 * (b - a) END), '' ORDER BY a) AS s FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
n AS (SELECT doc_id, sum(b - a) AS n, count(*) AS k FROM runs GROUP BY doc_id)
SELECT d.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(k, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(s, h))) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id LEFT JOIN n ON d.doc_id = n.doc_id"""

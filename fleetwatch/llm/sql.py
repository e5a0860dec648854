"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

OP9 = r"""
WITH texts AS (
  SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), d AS (
  SELECT doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), sized AS (
  SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0
), pattern AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS p
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)
), lengths AS (
  SELECT DISTINCT n FROM pattern
), window_of AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)
), hit AS (
  SELECT DISTINCT doc_id, item_id, i, n FROM window_of JOIN pattern USING (n, p)
), words AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP6 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sized AS (
  SELECT doc_id, w, least(len(w), 5) AS n FROM words WHERE len(w) > 0
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y
)
SELECT d.doc_id, CAST(coalesce(max(s.n), 0) AS BIGINT) AS n_shingles, min(r.y) AS component_id
FROM documents d JOIN reach r ON r.x = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""

OP10 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
), firsts AS (
  SELECT h, min(doc_id) AS owner FROM windows GROUP BY h
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos FROM windows JOIN firsts USING (h) WHERE owner < doc_id
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(len(w), 0) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


#: DuckDB has no CRC, so it is computed byte by byte; 3988292384 is the reversed polynomial 0xEDB88320.
OP11 = r"""
WITH crc AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS step
  FROM (SELECT unnest(range(256)) AS i)
), d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), grams AS (
  SELECT doc_id, f, count(*) AS c FROM (
    SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM d
  ) GROUP BY doc_id, f
), wanted AS (
  SELECT f, count(*) AS c FROM (
    SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM b
  ) GROUP BY f
), hexed AS (
  SELECT f, lower(hex(encode(f))) AS h FROM (SELECT f FROM grams UNION SELECT f FROM wanted)
), bucketed AS (
  SELECT f, xor(list_reduce(
    list_transform(range(1, len(h), 2), lambda i: (instr('0123456789abcdef', h[i]) - 1) * 16 + instr('0123456789abcdef', h[i + 1]) - 1),
    lambda c, x: xor(c >> 8, step[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM hexed, crc
), source AS (
  SELECT bucket, sum(c) AS s FROM grams JOIN bucketed USING (f) GROUP BY bucket
), target AS (
  SELECT bucket, sum(c) AS t FROM wanted JOIN bucketed USING (f) GROUP BY bucket
), sums AS (
  SELECT coalesce((SELECT sum(s) FROM source), 0) + 10000 AS all_s, coalesce((SELECT sum(t) FROM target), 0) + 10000 AS all_t
), gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * all_s::DOUBLE / ((s + 1)::DOUBLE * all_t::DOUBLE)))::BIGINT AS gain
  FROM source LEFT JOIN target USING (bucket), sums
), weights AS (
  SELECT doc_id, sum(c)::BIGINT AS n_features, sum(c * gain)::BIGINT AS total
  FROM grams JOIN bucketed USING (f) JOIN gains USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT doc_id, coalesce(len(w), 0) >= 20 AS eligible, coalesce(n_features, 0) AS n_features,
    coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS weight,
    list_reduce(string_split(substr(sha256('7:' || doc_id), 1, 8), ''), lambda a, x: a * 16 + instr('0123456789abcdef', x) - 1, 0::BIGINT) AS h
  FROM d LEFT JOIN weights USING (doc_id)
), final AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM scored
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM final WHERE eligible
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= 25 * (SELECT count(*) FROM ranked) // 100 THEN place END AS rank
FROM final LEFT JOIN ranked USING (doc_id)
"""

OP12 = r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), b AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), sizes AS (
  SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id
), whole AS (
  SELECT count(*) AS all_docs, sum(n)::BIGINT AS all_terms FROM sizes
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, whole GROUP BY term, all_docs
), adds AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * all_docs) // all_terms))) AS add
  FROM tf JOIN sizes USING (doc_id) JOIN weights USING (term), whole
), scored AS (
  SELECT item_id, doc_id, sum(add)::BIGINT AS score FROM b JOIN adds USING (term) GROUP BY item_id, doc_id HAVING sum(add) > 0
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scored QUALIFY rank <= 50
"""

#: Mining by enumeration: every combination of up to three of the eight tokens kept of a labelled url is counted.
OP13 = r"""
WITH rules(host, path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), parsed AS (
  SELECT DISTINCT url, translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path
  FROM (SELECT url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages)
), judged AS (
  SELECT p.url, p.host, p.path, max_by(r.host || r.path, length(r.host || r.path)) AS rule, max_by(r.verdict, length(r.host || r.path)) AS verdict
  FROM parsed p LEFT JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.url, p.host, p.path
), token AS (
  SELECT DISTINCT url, verdict, unnest(list_concat(
    list_transform(regexp_extract_all(host, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: 'h/' || x),
    list_transform(regexp_extract_all(translate(path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: 'p/' || x))) AS token
  FROM judged
), sums AS (
  SELECT count(*) AS n, greatest(2, -(-count(*) // 100)) AS least, count_if(verdict = 'block') / count(*) AS share FROM judged WHERE verdict IS NOT NULL
), telling AS (
  SELECT token, row_number() OVER (ORDER BY abs(count_if(verdict = 'block') / count(*) - any_value(share)) DESC, token) AS place
  FROM token, sums WHERE verdict IS NOT NULL GROUP BY token HAVING count(*) >= any_value(least)
), kept AS (
  SELECT url, verdict, token FROM token JOIN telling USING (token) WHERE verdict IS NOT NULL AND place <= 1000
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY place) <= 8
), sets AS (
  SELECT url, verdict, [token] AS s FROM kept
  UNION ALL SELECT a.url, a.verdict, [a.token, b.token] FROM kept a JOIN kept b ON a.url = b.url AND a.token < b.token
  UNION ALL SELECT a.url, a.verdict, [a.token, b.token, c.token] FROM kept a JOIN kept b ON a.url = b.url AND a.token < b.token JOIN kept c ON a.url = c.url AND b.token < c.token
), counted AS (
  SELECT s, count_if(verdict = 'block') AS blocked, count_if(verdict = 'allow') AS allowed, count(*) AS n FROM sets GROUP BY s
), mined AS (
  SELECT s, 1 AS block, blocked / c.n AS confidence FROM counted c, sums WHERE blocked >= least AND blocked * 100 >= c.n * 95
  UNION ALL SELECT s, 0, allowed / c.n FROM counted c, sums WHERE allowed >= least AND allowed * 100 >= c.n * 95
), open AS (
  SELECT url, list(token) AS tokens FROM token WHERE verdict IS NULL GROUP BY url
), learned AS (
  SELECT url, max({'confidence': confidence, 'block': block}).block AS block FROM open JOIN mined ON list_has_all(tokens, s) GROUP BY url
)
SELECT p.page_id, coalesce(j.host, '') AS host, coalesce(j.path, '') AS path, rule,
  coalesce(verdict, CASE block WHEN 1 THEN 'block' WHEN 0 THEN 'allow' END, 'allow') AS verdict
FROM pages p LEFT JOIN judged j ON j.url = p.url LEFT JOIN learned l ON l.url = p.url
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_jaccard": OP6, "op9_leaks": OP9, "op10_passages": OP10, "op11_resampling": OP11, "op12_lexical": OP12, "op13_urls": OP13}

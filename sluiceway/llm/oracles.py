"""The same rows in SQL for DuckDB, for the operators that it can express.

The trees of the quality rules, the choice of a packing, random segmentations, the graph search, a
tokenizer's merges and periodic runs of whole texts are beyond it; tests compare these with brute force.
"""

from __future__ import annotations

#: The checksum is built from its polynomial, bit by bit, then byte by byte.
RENDEZVOUS_SHARDS = """
WITH digits AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b::BIGINT, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step),
sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
        lambda b: ('0x' || b)::BIGINT)), lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, digits),
draws AS (
  SELECT doc_id, size, text_crc32, s AS shard,
    -ln((('0x' || substr(md5(s || ':' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5) / 4503599627370496.0) AS draw
  FROM sized, range(41) AS shards(s)),
placed AS (
  SELECT doc_id, size, text_crc32, arg_min(shard, draw) FILTER (shard < 40) AS shard, arg_min(shard, draw) AS grown_shard
  FROM draws GROUP BY doc_id, size, text_crc32)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY shard
    ORDER BY md5(coalesce(doc_id::VARCHAR, '') || '|' || text_crc32 || '|' || size), doc_id) - 1 AS slot,
  grown_shard::INTEGER AS grown_shard
FROM placed
"""

NEAR_DUPLICATES = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT x.a, x.b FROM (
    SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS common
    FROM s p JOIN s q ON p.shingle = q.shingle AND p.doc_id <> q.doc_id GROUP BY 1, 2) x
  JOIN n na ON na.doc_id = x.a JOIN n nb ON nb.doc_id = x.b
  WHERE 100 * x.common >= 85 * (na.n + nb.n - x.common)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
found AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, found.component_id, d.doc_id = found.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN found USING (doc_id)
"""

SUBSTRINGS = """
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
  SELECT row, i, md5(array_to_string(w[i : i + 34], ' ')) AS h
  FROM (SELECT row, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
repeated AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT row, unnest(range(i, i + 35)) AS k FROM windows WHERE h IN (SELECT h FROM repeated)),
words AS (SELECT row, k, w[k] AS word FROM (SELECT row, w, unnest(range(1, len(w) + 1)) AS k FROM d)),
kept AS (
  SELECT row, string_agg(word, ' ' ORDER BY k) AS text, count(*) AS n
  FROM words ANTI JOIN gone USING (row, k) GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (row)
"""

ARCHIVES = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY html) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""

SHARED_STRINGS = """
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h,
    octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
strings AS (
  SELECT row, doc_id, i, substr(h, 2 * i - 1, 100) AS s FROM (SELECT *, unnest(range(1, n - 48)) AS i FROM d)),
late AS (
  SELECT row, i FROM strings JOIN (SELECT s, min(doc_id) AS least FROM strings GROUP BY s HAVING min(doc_id) < max(doc_id))
  USING (s) WHERE doc_id > least),
gone AS (SELECT DISTINCT row, unnest(range(i, i + 50)) AS k FROM late),
runs AS (
  SELECT row, count(*) AS n_removed, count(*) FILTER (first) AS n_spans
  FROM (SELECT row, k, coalesce(k - lag(k) OVER (PARTITION BY row ORDER BY k) > 1, true) AS first FROM gone) GROUP BY row),
kept AS (
  SELECT row, string_agg(substr(h, 2 * k - 1, 2), '' ORDER BY k) AS rest
  FROM (SELECT row, h, unnest(range(1, n + 1)) AS k FROM d WHERE row IN (SELECT row FROM runs)) ANTI JOIN gone USING (row, k)
  GROUP BY row)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN n_removed IS NULL THEN h ELSE coalesce(rest, '') END)) AS kept_sha256
FROM d LEFT JOIN runs USING (row) LEFT JOIN kept USING (row)
"""

EXACT = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
    sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER staying AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER staying = 1 AS kept, text_sha256
FROM d WINDOW staying AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
"""


def _clusters(count: int, rounds: int) -> str:
    """A pair of tables for each round: the nearest centroid of every vector, and the centroids moved."""
    nearest = """a{n} AS MATERIALIZED (
  SELECT row, arg_min(cluster, (d, cluster)) AS cluster, min(d)::BIGINT AS distance FROM (
    SELECT row, cluster, list_dot_product(v.p, v.p) - 2 * list_dot_product(v.p, c.p) + list_dot_product(c.p, c.p) AS d
    FROM v, c{n} c) GROUP BY row)"""
    moved = """c{m} AS MATERIALIZED (
  SELECT c.cluster, coalesce(s.p, c.p) AS p FROM c{n} c LEFT JOIN (
    SELECT cluster, list(x ORDER BY k) AS p FROM (
      SELECT cluster, k, floor(sum(p[k]) / count(*)) AS x
      FROM a{n} JOIN v USING (row), range(1, 65) AS places(k) GROUP BY cluster, k) GROUP BY cluster) s USING (cluster))"""
    steps = [step.format(n=n, m=n + 1) for n in range(rounds) for step in (nearest, moved)]
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS p FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS cluster, p FROM (
    SELECT sha256('2:' || vec_id) AS h, p FROM v ORDER BY h LIMIT {count})),
{", ".join([*steps, nearest.format(n=rounds)])}
SELECT vec_id, cluster::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
  sum(distance) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(list_transform(c.p, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c USING (cluster) JOIN v USING (row)
"""


ORACLES = {
    "op1_rendezvous_shards": RENDEZVOUS_SHARDS,
    "op3_minhash_near_dedup": NEAR_DUPLICATES,
    "op4_substring_dedup": SUBSTRINGS,
    "op6_warc_round_trip": ARCHIVES,
    "op8_suffix_array_dedup": SHARED_STRINGS,
    "op11_exact_dedup": EXACT,
    "op12_centroid_clustering": _clusters(40, 5),
}

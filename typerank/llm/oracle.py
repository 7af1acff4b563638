"""DuckDB SQL of the queries that SQL can express."""

SQL: dict[str, str] = {}

SQL["op2_near_duplicates"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 2], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, least(len(w), 1) + 1))) AS i FROM words)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), sets AS (
  SELECT doc_id, md5(string_agg(s, '' ORDER BY s)) AS set_id FROM shingles GROUP BY doc_id
), classes AS (
  SELECT set_id, min(doc_id) AS rep FROM sets GROUP BY set_id
), own AS (
  SELECT s.doc_id, s.s FROM shingles s JOIN classes c ON s.doc_id = c.rep
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same
  FROM own a JOIN own b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * same >= 85 * (x.n + y.n - same)
), edges AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT rep AS id, rep AS node FROM classes
  UNION
  SELECT r.id, e.b FROM reach r JOIN edges e ON r.node = e.a
), lowest AS (
  SELECT id, min(node) AS component_id FROM reach GROUP BY id
)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles,
  coalesce(l.component_id, d.doc_id) AS component_id,
  d.doc_id = coalesce(l.component_id, d.doc_id) AS kept
FROM documents d
LEFT JOIN sizes z ON z.doc_id = d.doc_id
LEFT JOIN sets s ON s.doc_id = d.doc_id
LEFT JOIN classes c ON c.set_id = s.set_id
LEFT JOIN lowest l ON l.id = c.rep
"""

# The same sets and reach, from 90 percent on.
_parts = SQL["op2_near_duplicates"].replace("85 *", "90 *").rsplit("SELECT d.doc_id", 1)
SQL["op11_ngram_join"] = _parts[0] + """
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, coalesce(l.component_id, d.doc_id) AS component_id
FROM documents d
LEFT JOIN sizes z ON z.doc_id = d.doc_id
LEFT JOIN sets s ON s.doc_id = d.doc_id
LEFT JOIN classes c ON c.set_id = s.set_id
LEFT JOIN lowest l ON l.id = c.rep
"""

SQL["op3_substring_dedup"] = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35)
), repeated AS (
  SELECT s FROM windows GROUP BY s HAVING count(*) > 1
), covered AS (
  SELECT DISTINCT doc_id, i + unnest(range(0, 35)) AS j FROM windows JOIN repeated USING (s)
), kept AS (
  SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.j) AS t, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM words) x
  LEFT JOIN covered c ON c.doc_id = x.doc_id AND c.j = x.j WHERE c.j IS NULL GROUP BY x.doc_id
)
SELECT w.doc_id, len(w.w) AS n_words, len(w.w) - coalesce(k.n, 0) AS n_removed,
  sha256(coalesce(k.t, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON k.doc_id = w.doc_id
"""

# Fixed values, as in the filter: strict and soft terms.
_STRICT = "porn xxx adult casino hentai escort camgirls warez malware phishing spam"
_SOFT = (
    "cheap pills free bets bet win bonus poker loan loans viagra cialis dating singles "
    "ads track click farm deal deals promo popup torrent crack keygen replica"
)


def _count(terms: str) -> str:
    one = "CASE WHEN regexp_matches(u, '(^|[^a-z0-9]){}([^a-z0-9]|$)') THEN 1 ELSE 0 END"
    return "(" + " + ".join(one.format(t) for t in terms.split()) + ")"


SQL["op1_url_filter"] = f"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS url,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id, translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(verdict, host, path) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), best AS (
  SELECT page_id, max_by(r.host || r.path, len(r.host || r.path)) AS rule,
    max_by(r.verdict, len(r.host || r.path)) AS verdict
  FROM split s JOIN rules r ON ('.' || s.host) LIKE ('%.' || r.host) AND starts_with(s.path, r.path)
  GROUP BY page_id
), counted AS (
  SELECT page_id, {_count(_STRICT)} AS strict_hits, {_count(_SOFT)} AS soft_hits FROM split
)
SELECT s.page_id, s.host, s.path, b.rule,
  coalesce(b.verdict, CASE WHEN c.strict_hits > 0 OR c.soft_hits >= 2 THEN 'block' ELSE 'allow' END) AS verdict,
  c.strict_hits, c.soft_hits
FROM split s JOIN counted c USING (page_id) LEFT JOIN best b USING (page_id)
"""

SQL["op7_warc_round_trip"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS d FROM pages
), firsts AS (
  SELECT d, max(page_id) AS first FROM p WHERE octet_length(b) >= 1000 GROUP BY d
)
SELECT page_id, octet_length(b) AS payload_bytes, p.d AS payload_digest,
  CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first != page_id THEN first END AS refers_to
FROM p LEFT JOIN firsts ON firsts.d = p.d
"""


def _lloyd(rounds: int = 10) -> str:
    """The rounds unrolled: assignment ``a``, then the floors of the means."""
    assign = """a{i} AS MATERIALIZED (
  SELECT vec_id, v, min_by(k, (d, k)) AS k, min(d) AS d FROM (
    SELECT x.vec_id, x.v, c.k,
      list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM x, c{i} c) GROUP BY vec_id, v
)"""
    move = """c{j} AS MATERIALIZED (
  SELECT c.k, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
    SELECT k, list(floor_mean ORDER BY i) AS v FROM (
      SELECT k, i, ((sum(e) - ((sum(e) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS floor_mean
      FROM (SELECT k, unnest(v) AS e, unnest(range(64)) AS i FROM a{i}) GROUP BY k, i) GROUP BY k
  ) m ON m.k = c.k
)"""
    steps = []
    for i in range(rounds):
        steps += [assign.format(i=i), move.format(i=i, j=i + 1)]
    return ", ".join([*steps, assign.format(i=rounds)])


SQL["op12_centroids"] = f"""
WITH x AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k, v
  FROM (SELECT * FROM x ORDER BY sha256('3:' || vec_id) LIMIT 8)
), {_lloyd()}
SELECT vec_id, k::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c10.v, ',')) AS centroid_sha256
FROM a10 JOIN c10 USING (k)
"""

_CRC_STEP = (
    "list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]), "
    "lambda r, z: xor(r >> 1, (r & 1) * 3988292384))"
)

SQL["op13_prefix_trie"] = f"""
WITH turns AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
    ORDER BY turn NULLS FIRST, role, text) AS w
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), hashed AS (
  SELECT conv_id, w, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda crc, byte: {_CRC_STEP}), 4294967295) % 9 AS h
  FROM turns
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.w, [])[1:c.h], c.w[c.h + 1:]) AS w
  FROM hashed c LEFT JOIN hashed b ON b.conv_id = c.conv_id - c.conv_id % 5
), members AS (
  SELECT conv_id, d, sha256(w[1:d]::VARCHAR || to_json(w[1:d])::VARCHAR) AS node, d = len(w) AS ends,
    CASE WHEN d > 0 THEN octet_length(encode(w[d].t)) ELSE 0 END AS bytes
  FROM (SELECT conv_id, w, unnest(range(0, len(w) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT d, node, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM members GROUP BY d, node
), above AS (
  SELECT n.d, n.node, a.d AS ad, a.node AS anode
  FROM nodes n JOIN members a ON a.conv_id = n.conv_id AND a.d <= n.d
), children AS (
  SELECT ad, anode, count(*) AS n_children FROM above WHERE ad = d - 1 GROUP BY ad, anode
), own AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children
  FROM nodes n LEFT JOIN children c ON c.ad = n.d AND c.anode = n.node
), totals AS (
  SELECT ad, anode, sum((o.n_children = 0)::INT) AS n_leaves, sum((o.n_convs - 1) * o.bytes) AS saved
  FROM above a JOIN own o ON o.d = a.d AND o.node = a.node GROUP BY ad, anode
), parents AS (
  SELECT a.d, a.node, p.conv_id AS parent_conv_id
  FROM above a JOIN nodes p ON p.d = a.ad AND p.node = a.anode WHERE a.ad = a.d - 1
)
SELECT o.conv_id, o.d AS depth, p.parent_conv_id, o.n_convs, o.n_children, t.n_leaves::BIGINT AS n_leaves,
  t.saved::BIGINT AS saved_tokens, o.ends_sha256
FROM own o JOIN totals t ON t.ad = o.d AND t.anode = o.node
LEFT JOIN parents p ON p.d = o.d AND p.node = o.node
"""

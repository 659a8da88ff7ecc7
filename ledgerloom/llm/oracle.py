"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

# Lower-cases A-Z only, as the contracts ask.
ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Exact near-duplicate components: shingle sets, all pairs that share a shingle,
# components by propagation of the smallest id.
NEAR_DUPLICATES = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE
      WHEN len(w) = 0 THEN []::VARCHAR[]
      WHEN len(w) = 1 THEN [w[1]]
      ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM words
), flat AS (SELECT doc_id, unnest(s) AS g FROM sets),
inter AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT i.a, i.b FROM inter i JOIN sets x ON x.doc_id = i.a JOIN sets y ON y.doc_id = i.b
  WHERE 100 * i.n >= 80 * (len(x.s) + len(y.s) - i.n)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a
), comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sets s JOIN comp c ON c.doc_id = s.doc_id
"""

WORDS = f"regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

CONTAMINATION = f"""
WITH items AS (SELECT item_id, {WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, list_slice(w, i, i + least(10, len(w)) - 1) AS g
  FROM items, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS u(i) WHERE len(w) > 0
), docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT k FROM windows),
grams AS (
  SELECT r, k, i, list_slice(w, i, i + k - 1) AS g
  FROM docs, sizes, unnest(range(1, len(w) - k + 2)) AS u(i)
), found AS (
  SELECT g.r, g.i, g.k, x.item_id FROM grams g JOIN windows x ON x.k = g.k AND x.g = g.g
), hit AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, i, k FROM found) f, unnest(range(i, i + k)) AS u(p)
  GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(n.names, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h USING (r) LEFT JOIN named n USING (r)
"""

SIMILAR_EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY 1),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY 1)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN comp c USING (vec_id) LEFT JOIN counts n USING (vec_id)
"""

ARCHIVED_PAGES = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), top AS (SELECT h, max(page_id) AS original FROM p WHERE n >= 1000 GROUP BY h)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, sha1(p.h) AS payload_digest,
       CASE WHEN top.original <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN top.original <> p.page_id THEN top.original END AS refers_to
FROM p LEFT JOIN top ON p.h = top.h AND p.n >= 1000
"""

# The bounded shares in closed form: in the order of bound / weight the bounded
# sources come first. Documents are taken in the order of their key, by a running
# sum over all of them.
SOURCE_MIXTURE = """
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 15) AS BIGINT) AS k
  FROM documents
), s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, 2.0::DOUBLE * source_size AS bound,
         [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM s
), p AS (
  SELECT *, 1.5::DOUBLE * (sum(source_size) OVER ()) - coalesce(sum(bound) OVER o, 0) AS free,
         (sum(w) OVER ()) - coalesce(sum(w) OVER o, 0) AS rest, row_number() OVER (ORDER BY bound / w, source NULLS LAST) AS i
  FROM w WINDOW o AS (ORDER BY bound / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), share AS (SELECT free, rest FROM p WHERE w * free / rest <= bound ORDER BY i LIMIT 1),
t AS (
  SELECT source, source_size, least(w * free / rest, bound) AS target FROM w, share
), u AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t
), g AS (
  SELECT source, k, sum(size) AS words, count(*) AS n, sum(sum(size)) OVER (PARTITION BY source ORDER BY k) AS upto
  FROM d GROUP BY source, k
), m AS (
  SELECT u.*, g.k, CASE
      WHEN upto <= target - whole * source_size THEN n
      WHEN upto - words > target - whole * source_size OR words = 0 THEN 0
      ELSE least(n, floor((target - whole * source_size - upto + words) / (words / n) + 0.5)) END AS more
  FROM g JOIN u ON u.source IS NOT DISTINCT FROM g.source
), r AS (SELECT *, row_number() OVER (PARTITION BY source, k) AS place FROM d)
SELECT r.doc_id, r.size, m.source_size, m.target,
       CAST(r.size * (m.whole + CASE WHEN r.place <= m.more THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r JOIN m ON m.source IS NOT DISTINCT FROM r.source AND m.k = r.k
"""

# A path is the concatenation of its turns' digests, 30 characters each, so a
# prefix is a left part of it. crc32 is worked out bit by bit.
PREFIX_TRIE = """
WITH turns AS (
  SELECT conv_id, turn, substr(sha256(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 30) AS t,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, list(t ORDER BY turn NULLS FIRST, t) AS ts, list(words ORDER BY turn NULLS FIRST, t) AS ws FROM turns GROUP BY conv_id
), coded AS (
  SELECT *, xor(list_reduce(flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(CAST(conv_id AS VARCHAR), '')]),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, CAST(x AS BIGINT)) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END,
      4294967295), 4294967295) % 4 AS h
  FROM convs
), rebuilt AS (
  SELECT c.conv_id, coalesce(b.ts, [])[1:c.h] || c.ts[c.h + 1:] AS ts, coalesce(b.ws, [])[1:c.h] || c.ws[c.h + 1:] AS ws
  FROM coded c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 20
), rows AS (
  SELECT conv_id, d, array_to_string(ts[1:d], '') AS p, CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS words, d = len(ts) AS ends
  FROM rebuilt, unnest(range(0, len(ts) + 1)) AS u(d)
), nodes AS (
  SELECT p, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM rows GROUP BY p
), kids AS (SELECT left(p, (d - 1) * 30) AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
own AS (SELECT n.p, n.d, (n_convs - 1) * words AS saved, CASE WHEN k.n IS NULL THEN 1 ELSE 0 END AS leaf FROM nodes n LEFT JOIN kids k USING (p)),
sums AS (
  SELECT left(p, k * 30) AS p, sum(saved) AS saved, sum(leaf) AS leaves FROM own, unnest(range(0, d + 1)) AS u(k) GROUP BY 1
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, CASE WHEN n.d > 0 THEN up.conv_id END AS parent_conv_id, n.n_convs,
       coalesce(kids.n, 0) AS n_children, CAST(sums.leaves AS BIGINT) AS n_leaves, CAST(sums.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums ON sums.p = n.p LEFT JOIN kids ON kids.p = n.p
LEFT JOIN nodes up ON n.d > 0 AND up.p = left(n.p, (n.d - 1) * 30)
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.alike
  AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5
"""

ORACLE: dict[str, str] = {
    "op12_hard_negatives": HARD_NEGATIVES,
    "op11_conversation_prefix_trie": PREFIX_TRIE,
    "op13_source_mixing": SOURCE_MIXTURE,
    "op2_minhash_near_dedup": NEAR_DUPLICATES,
    "op6_benchmark_decontamination": CONTAMINATION,
    "op5_warc_round_trip": ARCHIVED_PAGES,
    "op8_pstable_embedding_dedup": SIMILAR_EMBEDDINGS,
}

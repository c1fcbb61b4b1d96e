"""DuckDB SQL for the corpus queries that SQL can express on whole tables."""

# Vectors that take part, in double precision.
_VECTORS = """
vecs AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0)"""

OP2 = f"""
WITH RECURSIVE {_VECTORS},
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM vecs a JOIN vecs b ON a.vec_id <> b.vec_id
  WHERE list_inner_product(a.e, b.e)
        / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.9),
reach(node, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.node, l.v FROM reach r JOIN links l ON l.u = r.other),
component AS (SELECT node, MIN(other) AS component_id FROM reach GROUP BY node),
degree AS (SELECT u, COUNT(*) AS n FROM links GROUP BY u)
SELECT e.vec_id, COALESCE(d.n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN component c ON c.node = e.vec_id LEFT JOIN degree d ON d.u = e.vec_id
"""

OP4 = r"""
WITH sizes AS (
  SELECT doc_id, source,
         CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
per AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
               CAST(COUNT(*) AS DOUBLE) AS n FROM sizes GROUP BY source),
weighed AS (
  SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w,
         source_size * CAST(3 AS DOUBLE) AS cap FROM per),
filled AS (
  SELECT *, (CAST(SUM(source_size) OVER () AS DOUBLE)
             - COALESCE(SUM(cap) OVER (ORDER BY cap / w, source NULLS LAST
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / SUM(w) OVER (ORDER BY cap / w, source NULLS LAST
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
targets AS (
  SELECT source, source_size, n,
         CASE WHEN level * w > cap THEN cap
              ELSE least(COALESCE(MAX(CASE WHEN level * w <= cap THEN level END) OVER (), 0) * w, cap)
         END AS target FROM filled),
rates AS (
  SELECT s.*, t.source_size, t.target, t.n, CAST(s.size AS DOUBLE) * t.n AS own, CAST(t.source_size AS DOUBLE) AS mean,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         (CAST(('0x' || substr(md5('mix:' || COALESCE(CAST(s.doc_id AS VARCHAR), 'null')), 1, 13)) AS BIGINT)
          + CAST(0.5 AS DOUBLE)) / CAST(4503599627370496 AS DOUBLE) AS u
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
drawn AS (  -- random odds divided by inclusion odds, those of the source left out
  SELECT *, (u / (CAST(1 AS DOUBLE) - u))
            / CASE WHEN mean > 0 THEN (own * CAST(2 AS DOUBLE) + mean) / (own + mean * CAST(2 AS DOUBLE))
                   ELSE CAST(1 AS DOUBLE) END AS quotient FROM rates),
ranked AS (
  SELECT *, CAST(floor(rate) AS BIGINT) AS whole,
         COALESCE(SUM(size) OVER (PARTITION BY source ORDER BY quotient / (CAST(1 AS DOUBLE) + quotient), doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM drawn),
counted AS (
  SELECT *, whole + CASE WHEN rate > whole AND before + size / 2.0 <= target - whole * source_size
                         THEN 1 ELSE 0 END AS copies FROM ranked)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies
FROM counted
"""

OP5 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, a.n AS nu, b.n AS nv, COUNT(*) AS shared
  FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM common WHERE 100 * shared >= 85 * (nu + nv - shared)),
ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(node, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.node, w.v FROM reach r JOIN ways w ON w.u = r.other),
component AS (SELECT node, MIN(other) AS component_id FROM reach GROUP BY node)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id
FROM sets s JOIN component c ON c.node = s.doc_id
"""

OP13 = """
WITH usable AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same,
         CAST(list_inner_product(a.e, r.e) AS BIGINT) AS score
  FROM usable a JOIN usable r ON r.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
positive AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND n.score * 100 BETWEEN p.score * 80 AND p.score * 100
QUALIFY rank <= 5
"""

# The crc32 is computed byte by byte with a table of the reflected polynomial's remainders.
OP11 = """
WITH RECURSIVE remainders AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k:
           CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                     'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
  FROM documents),
counted AS (
  SELECT run, hex(encode(COALESCE(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h, COUNT(*) AS k
  FROM runs GROUP BY ALL),
summed AS (
  SELECT run, k, xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(range(0, length(h) // 2),
                                                   lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS crc
  FROM counted, remainders),
words AS MATERIALIZED (
  SELECT CASE WHEN crc % 97 = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2)
              ELSE run END AS word, CAST(SUM(k) AS BIGINT) AS n
  FROM summed GROUP BY 1 HAVING length(word) >= 5 AND SUM(k) >= 3),
places AS (SELECT word, unnest(range(1, length(word) + 1)) AS place FROM words),
without AS MATERIALIZED (
  SELECT word, place, substr(word, 1, place - 1) || substr(word, place + 1) AS rest FROM places),
near AS MATERIALIZED (
  SELECT a.word AS u, b.word AS v FROM without a JOIN without b ON a.rest = b.rest AND a.place = b.place
    AND a.word <> b.word
  UNION SELECT a.word, w.word FROM without a JOIN words w ON a.rest = w.word
  UNION SELECT w.word, a.word FROM without a JOIN words w ON a.rest = w.word),
ranked AS (
  SELECT near.u, near.v, other.n AS v_n, COUNT(*) OVER (PARTITION BY near.u) AS n_near,
         row_number() OVER (PARTITION BY near.u ORDER BY other.n DESC, near.v) AS place
  FROM near JOIN words other ON other.word = near.v),
variants AS MATERIALIZED (
  SELECT w.word, w.n, COALESCE(r.n_near, 0) AS n_near, CASE WHEN r.v_n >= 2 * w.n THEN r.v END AS form,
         CASE WHEN r.v_n >= 2 * w.n THEN r.v_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.u = w.word AND r.place = 1),
follow(word, root, next) AS (
  SELECT word, word, form FROM variants
  UNION ALL SELECT f.word, f.next, v.form FROM follow f JOIN variants v ON v.word = f.next)
SELECT v.word, v.form, f.root, v.n, v.n_near, v.form_n
FROM variants v JOIN follow f ON f.word = v.word AND f.next IS NULL
"""

ORACLES = {"op2_embedding_dedup": OP2, "op4_pareto_mix": OP4,
           "op5_jaccard_join": OP5, "op11_spelling_variants": OP11,
           "op13_hard_negatives": OP13}

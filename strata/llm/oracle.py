"""DuckDB SQL for the operators that SQL can express, over whole tables."""

ORACLE_SQL = {
    "op1_mixing": r"""
WITH sizes AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rk
  FROM sizes GROUP BY source),
weighed AS (
  SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 3 * source_size AS cap FROM per),
levels AS (
  SELECT *,
    (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::DOUBLE
      / (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::DOUBLE AS lvl
  FROM weighed
  WINDOW b AS (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, max(lvl) OVER () * w) AS target FROM levels),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(3.0::DOUBLE, target / source_size) ELSE 0.0::DOUBLE END AS rate
  FROM targets),
drawn AS (
  SELECT s.doc_id, s.size, r.source_size, r.target, r.rate,
    ('0x' || substr(md5('mix-1|' || coalesce(s.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT
      / 4503599627370496.0::DOUBLE AS u
  FROM sizes s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken,
  (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies
FROM drawn
""",
    "op11_hard_negatives": r"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_inner_product(a.vec, b.vec)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id)::INTEGER AS positive_rank
  FROM scored WHERE same QUALIFY positive_rank <= 5),
found AS (
  SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score, p.positive_rank,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_rank ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank
FROM found WHERE rank <= 5
""",
    "op13_lexical": r"""
WITH doc_words AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents WHERE text IS NOT NULL),
docs AS (SELECT row_no, doc_id, words, len(words) AS n FROM doc_words WHERE len(words) > 0),
totals AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM docs),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
wanted AS (SELECT DISTINCT term FROM items),
words AS (SELECT row_no, unnest(words) AS term FROM docs),
counts AS (SELECT row_no, term, count(*) AS tf FROM words SEMI JOIN wanted USING (term) GROUP BY row_no, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals),
parts AS (
  SELECT c.row_no, c.term, w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (10 + (90 * d.n * t.nn) // t.ll))) AS part
  FROM counts c JOIN weights w USING (term) JOIN docs d USING (row_no), totals t),
ranked AS (
  SELECT i.item_id, d.doc_id, sum(p.part)::BIGINT AS score
  FROM items i JOIN parts p USING (term) JOIN docs d USING (row_no) GROUP BY i.item_id, p.row_no, d.doc_id HAVING sum(p.part) > 0)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM ranked QUALIFY rank <= 10
""",
}

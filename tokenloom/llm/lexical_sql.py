"""Check SQL of the ranked lexical search."""

SEARCH = r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
len AS (SELECT doc_id, count(*) AS n FROM d GROUP BY ALL),
tot AS (SELECT count(*) AS nd, sum(n)::BIGINT AS nl FROM len),
q AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM q) GROUP BY ALL), tot
), i AS (
  SELECT tf.doc_id, tf.term, w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * (100 - 25 + ((25 * len.n * nd) // nl)))) AS s
  FROM tf JOIN w USING (term) JOIN len USING (doc_id), tot
), s AS (SELECT item_id, doc_id, sum(times * s)::BIGINT AS score FROM q JOIN i USING (term) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= 20"""

"""Check SQL of the spelling variants: neighbours by deleting each letter in turn."""

VARIANTS = r"""
WITH RECURSIVE crc AS MATERIALIZED (  -- one step of crc32 for each byte value
  SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS i))
), runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents) WHERE length(run) >= 7 GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id || ':' || run, ''),
      lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [(192 + (unicode(x) >> 6))::BIGINT, (128 + (unicode(x) & 63))::BIGINT] END))),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) AS h FROM runs, crc
), words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
    FROM hashed) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cut AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)
), near AS MATERIALIZED (
  SELECT DISTINCT * FROM (
    SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION ALL SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
    UNION ALL SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word)
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS form, max(near_n) AS form_n FROM near GROUP BY word
), facts AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN form_n >= 10 * w.n THEN form END AS form, CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root, 0 AS steps FROM facts
  UNION ALL SELECT c.word, f.form, steps + 1 FROM chain c JOIN facts f ON c.root = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM facts f JOIN (SELECT word, arg_max(root, steps) AS root FROM chain GROUP BY word) r USING (word)"""

"""Check SQL of the mixing query."""

MIX = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens FROM documents
), t AS (
  SELECT source, sum(tokens)::BIGINT AS total FROM d GROUP BY source HAVING sum(tokens) > 0
), c AS (SELECT sum(total)::DOUBLE AS corpus, count(*) AS n FROM t
), halved(i, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN lo ELSE (lo + hi) / 2 END, CASE WHEN ok THEN (lo + hi) / 2 ELSE hi END
  FROM (
    SELECT i, lo, hi,
      (SELECT ln(sum(pow(total / corpus, (lo + hi) / 2))) - sum(pow(total / corpus, (lo + hi) / 2) * (lo + hi) / 2 * ln(total / corpus))
          / sum(pow(total / corpus, (lo + hi) / 2)) <= 0.97 * ln(max(n))
        AND max(pow(total / corpus, (lo + hi) / 2 - 1)) / sum(pow(total / corpus, (lo + hi) / 2)) <= 2.0 FROM t, c) AS ok
    FROM halved WHERE i < 45)
), flat AS (
  SELECT ln(n) <= 0.97 * ln(n) AND max(corpus / total) / max(n) <= 2.0 AS ok, max(n) AS n FROM t, c GROUP BY n
), a AS (SELECT CASE WHEN flat.n < 2 THEN 1.0 WHEN flat.ok THEN 0.0 ELSE round(hi, 7) END AS a FROM halved, flat WHERE i = 45
), q AS (
  SELECT source, total, CAST(floor(pow(total::DOUBLE, a) / (SELECT sum(pow(total::DOUBLE, a)) FROM t) * corpus) AS BIGINT) AS quota FROM t, a, c
), p AS (SELECT *, quota // total AS whole, quota - (quota // total) * total AS rest FROM q
), e AS (
  SELECT doc_id, d.source, tokens, total, quota, whole, rest, epoch,
    CAST('0x' || substr(md5('17:' || epoch || ':' || doc_id), 1, 15) AS BIGINT) AS hash
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source, LATERAL (SELECT unnest(range(0, whole + 1)) AS epoch)
), s AS (
  SELECT *, sum(tokens) OVER (PARTITION BY source, epoch ORDER BY hash) AS upto FROM e
)
SELECT doc_id, source, CAST(epoch AS INTEGER) AS epoch,
  round(least(1.0, (epoch + hash / 1152921504606846976.0::DOUBLE) * total / quota), 6) AS place
FROM s WHERE epoch < whole OR (rest > 0 AND upto <= rest)"""

"""Registered queries: subword learning and encoding (A4-A8, J6).

The check SQL unrolls merges, so it covers the first few; the queries over
``MANY`` merges are tested against a slow learner and a slow encoder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text as T, tokens as K
from ..operators import subword as B
from ..session import fresh_path
from . import sql as S
from .common import DOC_COUNTS_SQL, doc_counts, docs
from .registry import query

C = F.col
MERGES, MORE, MANY = 12, 30, 1000
_O, _B, _C = S.q(B.OPEN), S.q(B.BETWEEN), S.q(B.CLOSE)


_FILES: dict[tuple, str] = {}


def learned(spark: SparkSession, folder: str, table: str, counts: Callable[[], DataFrame], merges: int) -> list[B.Merge]:
    """The first ``merges`` merges of a table's words, from a merge file in the shared folder.

    The file is learned once per session, for the table's files as they stand
    (names, sizes, times of change), and at most as long as asked for.
    """
    path = f"{folder}/{table}.parquet"
    stamp = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct().agg(
        F.bit_xor(F.xxhash64("file_path", "file_size", "file_modification_time"))).first()[0]
    key = (spark.sparkContext.applicationId, path, stamp, merges)
    if key not in _FILES:
        _FILES[key] = B.saved_merges(B.learn_merges(counts(), merges), spark, fresh_path(spark, "merges"))
    return B.loaded_merges(spark, _FILES[key], merges)


def learned_from_documents(spark: SparkSession, folder: str, merges: int) -> list[B.Merge]:
    return learned(spark, folder, "documents", lambda: doc_counts(spark, folder), merges)


def _start(counts: str) -> str:
    return f"""w0 AS MATERIALIZED (SELECT token, n, {_O} || array_to_string(regexp_extract_all(token, '(?s).') || ['</w>'], {_B}) || {_C} AS s FROM {counts})"""


def _sql_pairs(words: str) -> str:
    return f"""(SELECT l[i] AS a, l[i + 1] AS b, sum(n) AS n FROM (SELECT n, l, unnest(range(1, len(l))) AS i FROM
      (SELECT n, string_split(trim(s, {S.q(B.OPEN + B.CLOSE)}), {_B}) AS l FROM {words})) GROUP BY ALL)"""


def merges_sql(rounds: int, counts: str = DOC_COUNTS_SQL) -> str:
    """Common table expressions w0..wN (words) and b1..bN (best pairs), one merge per step."""
    parts = [_start(counts)]
    for k in range(1, rounds + 1):
        parts.append(f"b{k} AS MATERIALIZED (SELECT a, b, n FROM {_sql_pairs(f'w{k - 1}')} ORDER BY n DESC, a, b LIMIT 1)")
        parts.append(f"w{k} AS MATERIALIZED (SELECT token, w.n, replace(s, {_O} || a || {_B} || b || {_C}, {_O} || a || b || {_C}) AS s FROM w{k - 1} w, b{k})")
    return ",\n".join(parts)


def _final(rounds: int) -> str:
    return (f"(SELECT token, n, list_filter(list_transform(string_split(trim(s, {S.q(B.OPEN + B.CLOSE)}), {_B}), lambda p: replace(p, '</w>', '')), "
            f"lambda p: p <> '') AS p FROM w{rounds})")


_FINAL = _final(MERGES)


@query("a04_pair_counts", f"""
WITH {_start(DOC_COUNTS_SQL)} SELECT a AS "left", b AS "right", n::BIGINT AS n FROM {_sql_pairs('w0')}""")
def pair_counts(spark, folder):
    words = doc_counts(spark, folder).select("n", B.as_symbols(C("token")).alias("symbols"))
    return B.pair_counts(words)


def _ranked(spark, merges):
    return B.merge_table(spark, merges).withColumn("rank", C("rank").cast("long"))


@query("a05_learn_merges", f"WITH {merges_sql(MERGES)} " + " UNION ALL ".join(
    f"SELECT {k - 1}::BIGINT AS rank, a AS \"left\", b AS \"right\" FROM b{k}" for k in range(1, MERGES + 1)))
def learn_merges(spark, folder):
    return _ranked(spark, B.learn_merges(doc_counts(spark, folder), MERGES))


@query("a05_learn_100_merges")
def learn_100_merges(spark, folder):
    return _ranked(spark, B.learn_merges(doc_counts(spark, folder), 100))


@query("a05_learn_1000_merges")
def learn_1000_merges(spark, folder):
    return _ranked(spark, learned_from_documents(spark, folder, MANY))


def _applied(spark, folder, merges):
    segmented = B.segment(doc_counts(spark, folder), learned_from_documents(spark, folder, merges))
    shown = segmented.select("token", F.array_join(B.marked(C("pieces")), " ").alias("shown"))
    return shown.select("token", T.restore_subwords(C("shown")).alias("restored"), C("shown").alias("pieces"))


@query("a06_apply_merges", f"""
WITH {merges_sql(MERGES)} SELECT token, array_to_string(p, '@@ ') AS pieces, token AS restored FROM {_FINAL}""")
def apply_merges(spark, folder):
    return _applied(spark, folder, MERGES)


@query("a06_apply_1000_merges")
def apply_1000_merges(spark, folder):
    return _applied(spark, folder, MANY)


def _constrained(spark, folder, merges, least):
    learned_ones = learned_from_documents(spark, folder, merges)
    segmented = B.segment(doc_counts(spark, folder), learned_ones)
    limited = B.constrain(segmented, learned_ones, B.piece_vocabulary(segmented, least))
    return limited.select("token", F.array_join("pieces", "@@ ").alias("pieces"))


@query("a07_vocabulary_constrained", f"""
WITH RECURSIVE {merges_sql(MORE)}, f AS MATERIALIZED {_final(MORE)},
c AS (SELECT token, n, unnest(p) AS piece, generate_subscripts(p, 1) AS pos, len(p) AS k FROM f),
v AS MATERIALIZED (SELECT CASE WHEN pos = k THEN piece ELSE piece || '@@' END AS known FROM c GROUP BY 1 HAVING sum(n) >= 400),
m AS ({" UNION ALL ".join(f"SELECT {k} AS rank, a, b FROM b{k}" for k in range(1, MORE + 1))}),
h AS (SELECT a || b AS whole, arg_max(a, rank) AS a, arg_max(b, rank) AS b FROM m GROUP BY 1),
x AS MATERIALIZED (
  SELECT * FROM (SELECT whole AS piece, false AS final, a, b FROM h
    UNION ALL SELECT left(whole, length(whole) - 4), true, a, CASE WHEN right(b, 4) = '</w>' THEN left(b, length(b) - 4) ELSE b END FROM h WHERE right(whole, 4) = '</w>')
  WHERE CASE WHEN final THEN piece ELSE piece || '@@' END NOT IN (SELECT known FROM v)),
r AS (
  SELECT token, pos, '' AS path, piece, pos = k AS final FROM c
  UNION ALL SELECT token, pos, path || s.side, CASE WHEN s.side = '0' THEN x.a ELSE x.b END, r.final AND s.side = '1'
  FROM r JOIN x USING (piece, final), (VALUES ('0'), ('1')) s(side)
)
SELECT token, string_agg(piece, '@@ ' ORDER BY pos, path) AS pieces FROM r ANTI JOIN x USING (piece, final) GROUP BY token""")
def vocabulary_constrained(spark, folder):
    return _constrained(spark, folder, MORE, 400)


@query("a07_constrained_1000_merges")
def constrained_1000_merges(spark, folder):
    return _constrained(spark, folder, MANY, 400)


@query("a08_isolate_terms", f"""
SELECT token, array_to_string(CASE WHEN regexp_full_match(token, 'ea|tion') OR NOT regexp_matches(token, 'ea|tion') THEN [token]
  ELSE list_filter(string_split(regexp_replace(token, '(ea|tion)', chr(57345) || '\\1' || chr(57345), 'g'), chr(57345)), lambda p: p <> '') END, '|') AS parts
FROM {DOC_COUNTS_SQL}""")
def isolate_terms(spark, folder):
    return doc_counts(spark, folder).select("token", F.array_join(B.isolate_terms(C("token"), "ea|tion"), "|").alias("parts"))


@query("j06_subword_lookup", f"""
WITH {merges_sql(MERGES)}, t AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM (SELECT doc_id, {S.words('text')} AS w FROM documents))
SELECT doc_id, string_agg(array_to_string(p, '@@ '), ' ' ORDER BY pos) AS text FROM t JOIN {_FINAL} f USING (token) GROUP BY doc_id""")
def subword_lookup(spark, folder):
    return _looked_up(spark, folder, MERGES)


def _looked_up(spark, folder, merges):
    segmented = B.segment(doc_counts(spark, folder), learned_from_documents(spark, folder, merges))
    return B.encode_texts(docs(spark, folder), "doc_id", K.words(C("text")), segmented)


@query("j06_lookup_1000_merges")
def lookup_1000_merges(spark, folder):
    return _looked_up(spark, folder, MANY)

"""Registered queries: prediction scores (J9, A18-A23) and multiset operations (U2, U3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hashing as H, tokens as K
from ..operators import scoring as R
from . import sql as S
from .common import PAIRS_SQL, as_long, pairs
from .registry import query

C = F.col


def predictions(spark, folder):
    """Each answer with some words dropped as prediction; the answer and its question as references."""
    p = pairs(spark, folder).withColumn("id", C("conv_id") * 1000 + C("turn"))
    kept = F.filter(K.words(C("tgt")), lambda w, i: H.uniform("hyp", C("id"), i + 1) >= 0.15)
    return p.select("id", F.array_join(kept, " ").alias("hyp"), F.array("tgt", "src").alias("refs"))


PRED = f"""pred AS (SELECT id, list_filter({S.words('tgt')}, lambda w, i: {S.uniform('hyp', 'id', 'i')} >= 0.15::DOUBLE) AS h,
    [{S.words('tgt')}, {S.words('src')}] AS refs, tgt, src FROM (SELECT conv_id * 1000 + turn AS id, src, tgt FROM {PAIRS_SQL}))"""
GRAMS = f"""{PRED},
seg AS (SELECT id, 0 AS seg, h AS w FROM pred UNION ALL SELECT id, 1, refs[1] FROM pred UNION ALL SELECT id, 2, refs[2] FROM pred),
g AS (SELECT id, seg, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM (
    SELECT id, seg, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM seg, (VALUES (1), (2), (3), (4)) o(n))),
c AS (SELECT id, n, gram, seg, count(*) AS k FROM g GROUP BY ALL),
m AS (SELECT id, n, gram, max(CASE WHEN seg = 0 THEN k ELSE 0 END) AS hk, max(CASE WHEN seg > 0 THEN k ELSE 0 END) AS rk FROM c GROUP BY ALL),
s AS (SELECT id, """ + ", ".join(f"sum(CASE WHEN n = {n} THEN least(hk, rk) ELSE 0 END)::BIGINT AS m{n}" for n in R.ORDERS) + """ FROM m GROUP BY id),
l AS (SELECT id, len(h) AS hl, least(len(refs[1]), len(refs[2])) AS shortest, (len(refs[1]) + len(refs[2])) / 2.0::DOUBLE AS average,
    CASE WHEN (abs(len(refs[1]) - len(h)), len(refs[1])) <= (abs(len(refs[2]) - len(h)), len(refs[2])) THEN len(refs[1]) ELSE len(refs[2]) END AS closest, """ + \
    ", ".join(f"greatest(len(h) - {n - 1}, 0) AS p{n}" for n in R.ORDERS) + """ FROM pred),
st AS (SELECT l.*, """ + ", ".join(f"coalesce(m{n}, 0) AS m{n}" for n in R.ORDERS) + """ FROM l LEFT JOIN s USING (id)),
tot AS (SELECT sum(hl) AS hl, sum(shortest) AS shortest, sum(average) AS average, sum(closest) AS closest, """ + \
    ", ".join(f"sum(m{n}) AS m{n}, sum(p{n}) AS p{n}" for n in R.ORDERS) + " FROM st)"


def _sql_bleu(smooth: bool) -> str:
    add = "1.0::DOUBLE" if smooth else "0.0::DOUBLE"
    ps = [f"CASE WHEN p{n} + {add} > 0 THEN (m{n} + {add}) / (p{n} + {add}) ELSE 0 END" for n in R.ORDERS]
    logs = " + ".join(f"ln({p})" for p in ps)
    return (f"CASE WHEN least({', '.join(ps)}) > 0 THEN exp(({logs}) / 4) ELSE 0 END * "
            f"CASE WHEN hl > shortest THEN 1 WHEN hl > 0 THEN exp(1 - shortest::DOUBLE / hl) ELSE 0 END")


@query("j09_clipped_matches", f"""
WITH {GRAMS} SELECT id, n::BIGINT AS "order", sum(least(hk, rk))::BIGINT AS matches, sum(hk)::BIGINT AS grams FROM m GROUP BY id, n""")
def clipped_matches(spark, folder):
    return R.ngram_counts(predictions(spark, folder)).groupBy("id", as_long("order")).agg(
        F.sum(F.least("hyp_n", "ref_n")).alias("matches"), F.sum("hyp_n").alias("grams"))


@query("a18_corpus_bleu", f"""
WITH {GRAMS} SELECT round({_sql_bleu(True)}, 6) AS smoothed, round({_sql_bleu(False)}, 6) AS plain, hl::BIGINT AS hyp_len, shortest::BIGINT AS ref_len,
  m1::BIGINT AS match1, m4::BIGINT AS match4, p4::BIGINT AS possible4 FROM tot""")
def corpus_bleu(spark, folder):
    total = R.sum_statistics(R.overlap_statistics(predictions(spark, folder)))
    return total.select(F.round(R.bleu(True), 6).alias("smoothed"), F.round(R.bleu(False), 6).alias("plain"), "hyp_len",
                        C("shortest").alias("ref_len"), "match1", "match4", "possible4")


@query("a19_sentence_bleu", f"WITH {GRAMS} SELECT id, round({_sql_bleu(True)}, 6) AS bleu FROM st")
def sentence_bleu(spark, folder):
    return R.overlap_statistics(predictions(spark, folder)).select("id", F.round(R.bleu(True), 6).alias("bleu"))


@query("a19_mean_bleu", f"WITH {GRAMS} SELECT round(avg({_sql_bleu(True)}), 6) AS mean_bleu, count(*)::BIGINT AS n FROM st")
def mean_bleu(spark, folder):
    return R.overlap_statistics(predictions(spark, folder)).agg(
        F.round(F.avg(R.bleu(True)), 6).alias("mean_bleu"), F.count(F.lit(1)).alias("n"))


def _sql_scorer(ref: str) -> str:
    ratio = f"((hl + 1e-15) / ({ref} + 1e-9))"
    bp = f"(CASE WHEN {ratio} > 1 THEN 1.0::DOUBLE ELSE exp(1 - 1 / {ratio}) END)"
    parts = [f"((m{n} + 1e-15) / (p{n} + 1e-9))" for n in R.ORDERS]
    scores = [f"(pow({' * '.join(parts[:n])}, 1.0::DOUBLE / {n}) * {bp})" for n in R.ORDERS]
    logs = " + ".join(f"ln({s})" for s in scores)
    cols = ", ".join(f"round({s}, 6) AS bleu{n}" for n, s in zip(R.ORDERS, scores))
    return f"SELECT '{ref}' AS option, {cols}, round(exp(({logs}) / 4) * {bp}, 6) AS combined FROM tot"


@query("a20_scorer_bleu", f"WITH {GRAMS} " + " UNION ALL ".join(_sql_scorer(r) for r in ("closest", "average", "shortest")))
def scorer_bleu(spark, folder):
    total = R.sum_statistics(R.overlap_statistics(predictions(spark, folder)))
    options = []
    for option in ("closest", "average", "shortest"):
        scores, combined = R.scorer_bleu(option)
        shown = [F.round(s, 6).alias(f"bleu{n}") for n, s in zip(R.ORDERS, scores)]
        options.append(F.struct(F.lit(option).alias("option"), *shown, F.round(combined, 6).alias("combined")))
    return total.select(F.explode(F.array(*options)).alias("o")).select("o.*")


@query("a20_scorer_sentence_bleu", f"WITH {GRAMS} SELECT id, " + ", ".join(
    "round(pow(" + " * ".join(f"((m{k} + 1e-15) / (p{k} + 1e-9))" for k in R.ORDERS[:n]) + f", 1.0::DOUBLE / {n}) * "
    f"CASE WHEN (hl + 1e-15) / (closest + 1e-9) < 1 THEN exp(1 - 1 / ((hl + 1e-15) / (closest + 1e-9))) ELSE 1 END, 6) AS bleu{n}"
    for n in R.ORDERS) + " FROM st")
def scorer_sentence_bleu(spark, folder):
    scores, _ = R.scorer_bleu("closest")
    return R.overlap_statistics(predictions(spark, folder)).select(
        "id", *[F.round(s, 6).alias(f"bleu{n}") for n, s in zip(R.ORDERS, scores)])


def _sql_fourth() -> str:
    terms = []
    for n in R.ORDERS:
        zeros = " + ".join(f"(m{k} = 0)::INT" for k in R.ORDERS[:n])
        filled = f"(1 / (pow(2.0::DOUBLE, {zeros}) * 5 / ln(hl)))"
        value = f"CASE WHEN m{n} > 0 THEN m{n}::DOUBLE / greatest(p{n}, 1) WHEN hl > 1 THEN {filled} / greatest(p{n}, 1) END"
        terms.append(f"coalesce(ln({value}), 0) / 4")
    return ("CASE WHEN m1 = 0 THEN 0 ELSE CASE WHEN hl > closest THEN 1 WHEN hl = 0 THEN 0 ELSE exp(1 - closest::DOUBLE / hl) END * exp("
            + " + ".join(terms) + ") END")


@query("a21_fourth_smoothing_bleu", f"WITH {GRAMS} SELECT id, round({_sql_fourth()}, 6) AS bleu FROM st")
def fourth_smoothing_bleu(spark, folder):
    return R.overlap_statistics(predictions(spark, folder)).select("id", F.round(R.fourth_smoothing_bleu(), 6).alias("bleu"))


@query("a21_unsmoothed_corpus_bleu", f"""
WITH {GRAMS} SELECT round(CASE WHEN hl > closest THEN 1 ELSE exp(1 - closest::DOUBLE / hl) END * exp((""" + " + ".join(
    f"ln(CASE WHEN m{n} = 0 THEN 2.2250738585072014e-308::DOUBLE ELSE m{n}::DOUBLE / p{n} END)" for n in R.ORDERS) + """) / 4), 6) AS bleu FROM tot""")
def unsmoothed_corpus_bleu(spark, folder):
    total = R.sum_statistics(R.overlap_statistics(predictions(spark, folder)))
    return total.select(F.round(R.unsmoothed_corpus_bleu(), 6).alias("bleu"))


# one row of the table of common lengths per recursion step: a length grows at the latest match up to each place
ROUGE_SQL = f"""{PRED},
lr AS MATERIALIZED (SELECT id, k, string_split(array_to_string(h, ' '), ' ') AS a, string_split(ref, ' ') AS b FROM (SELECT id, h, unnest([tgt, src]) AS ref, unnest([1, 2]) AS k FROM pred)),
dp AS (SELECT id, k, 0::BIGINT AS i, list_transform(b, lambda x: 0::BIGINT) AS line FROM lr
  UNION ALL SELECT id, k, i + 1, CASE WHEN len(hits) = 0 THEN line ELSE list_transform(line, lambda x, j: greatest(x, coalesce(list_max(list_transform(list_filter(hits, lambda p: p <= j), lambda p: coalesce(line[p - 1], 0) + 1)), 0))) END
  FROM (SELECT dp.id, dp.k, i, line, list_filter(range(1, len(b) + 1), lambda j: b[j] = a[i + 1]) AS hits FROM dp JOIN lr ON lr.id = dp.id AND lr.k = dp.k WHERE i < len(a))),
lc AS (SELECT id, k, arg_max(line[-1], i) AS lcs FROM dp GROUP BY id, k),
pr AS (SELECT id, max(lcs / len(a)) AS p, max(lcs / len(b)) AS r FROM lr JOIN lc USING (id, k) GROUP BY id),
rl AS (SELECT id, CASE WHEN p > 0 AND r > 0 THEN (1 + 1.44::DOUBLE) * p * r / (r + 1.44::DOUBLE * p) ELSE 0::DOUBLE END AS score FROM pr)"""


@query("a22_rouge_l", f"WITH RECURSIVE {ROUGE_SQL} SELECT id, round(score, 6) AS rouge_l FROM rl")
def rouge_l(spark, folder):
    return R.rouge_l(predictions(spark, folder)).select("id", F.round("rouge_l", 6).alias("rouge_l"))


@query("a22_mean_rouge_l", f"WITH RECURSIVE {ROUGE_SQL} SELECT round(avg(score), 6) AS mean_rouge_l, count(*)::BIGINT AS n FROM rl")
def mean_rouge_l(spark, folder):
    return R.rouge_l(predictions(spark, folder)).agg(F.round(F.avg("rouge_l"), 6).alias("mean_rouge_l"), F.count(F.lit(1)).alias("n"))


F1_SQL = f"""{PRED},
ref AS (SELECT id, 1 AS ref_no, tgt AS ref, array_to_string(h, ' ') AS hyp FROM pred UNION ALL SELECT id, 2, src, array_to_string(h, ' ') FROM pred),
tok AS (SELECT id, ref_no, 0 AS side, unnest({S.words('lower(hyp)')}) AS t FROM ref UNION ALL SELECT id, ref_no, 1, unnest({S.words('lower(ref)')}) FROM ref),
cnt AS (SELECT id, ref_no, t, count(*) FILTER (WHERE side = 0) AS h, count(*) FILTER (WHERE side = 1) AS r FROM tok GROUP BY ALL),
ov AS (SELECT id, ref_no, sum(least(h, r)) AS same, sum(h) AS hn, sum(r) AS rn FROM cnt GROUP BY ALL),
pr AS (SELECT id, ref_no, CASE WHEN same > 0 THEN same / hn ELSE 0 END AS p, CASE WHEN same > 0 THEN same / rn ELSE 0 END AS r FROM ov),
f1 AS (SELECT *, CASE WHEN p > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM pr),
best AS (SELECT id, arg_max(p, (f, -ref_no)) AS p, arg_max(r, (f, -ref_no)) AS r, max(f) AS f FROM f1 GROUP BY id)"""


@query("a23_token_f1", f"WITH {F1_SQL} SELECT id, round(p, 6) AS \"precision\", round(r, 6) AS recall, round(f, 6) AS f1 FROM best")
def token_f1(spark, folder):
    return R.token_f1(predictions(spark, folder)).select(
        "id", *[F.round(n, 6).alias(n) for n in ("precision", "recall", "f1")])


@query("a23_mean_token_f1", f"""
WITH {F1_SQL} SELECT round(avg(p) * 100, 4) AS "precision", round(avg(r) * 100, 4) AS recall, round(avg(f) * 100, 4) AS f1 FROM best""")
def mean_token_f1(spark, folder):
    return R.token_f1(predictions(spark, folder)).agg(
        *[F.round(F.avg(n) * 100, 4).alias(n) for n in ("precision", "recall", "f1")])


_SIDES = f"""a AS (SELECT conv_id, unnest({S.words('src')}) AS token FROM {PAIRS_SQL}), b AS (SELECT conv_id, unnest({S.words('tgt')}) AS token FROM {PAIRS_SQL})"""


def _sides(spark, folder):
    p = pairs(spark, folder)
    return [p.select("conv_id", F.explode(K.words(C(c))).alias("token")) for c in ("src", "tgt")]


@query("u02_multiset_intersection", f"""
WITH {_SIDES}, i AS (SELECT * FROM a INTERSECT ALL SELECT * FROM b)
SELECT conv_id, token, count(*)::BIGINT AS n FROM i GROUP BY ALL""")
def multiset_intersection(spark, folder):
    a, b = _sides(spark, folder)
    return a.intersectAll(b).groupBy("conv_id", "token").agg(F.count(F.lit(1)).alias("n"))


@query("u03_multiset_union", f"""
WITH {_SIDES}, c AS (SELECT conv_id, token, count(*) AS n FROM a GROUP BY ALL UNION ALL SELECT conv_id, token, count(*) FROM b GROUP BY ALL)
SELECT conv_id, token, max(n)::BIGINT AS n FROM c GROUP BY ALL""")
def multiset_union(spark, folder):
    counted = [s.groupBy("conv_id", "token").agg(F.count(F.lit(1)).alias("n")) for s in _sides(spark, folder)]
    return counted[0].unionByName(counted[1]).groupBy("conv_id", "token").agg(F.max("n").alias("n"))

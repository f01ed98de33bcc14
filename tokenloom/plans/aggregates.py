"""Registered queries: counts, vocabularies, statistics and averages (A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hashing as H, tokens as K
from ..operators import stats, vocab as V
from ..operators.tokentables import one_row_each
from ..session import placed_by, table
from . import sql as S
from .common import DOC_COUNTS_SQL, DOC_TOKENS_SQL, as_long, doc_counts, docs, vocab_sql
from .registry import query

C = F.col


@query("a01_corpus_statistics", f"""
WITH t AS (SELECT source, doc_id, {S.words('text')} AS w FROM documents),
e AS (SELECT source, unnest(w) AS token FROM t),
r AS (SELECT t.source, count(*) AS records, sum(len(w)) AS tokens FROM t GROUP BY source),
u AS (SELECT source, count(DISTINCT token) AS u FROM e GROUP BY source)
SELECT r.source, records::BIGINT AS records, tokens::BIGINT AS tokens, u::BIGINT AS unique_tokens, u::BIGINT AS unique_union,
  printf('%.2f', tokens / records)::DOUBLE AS mean_length FROM r JOIN u USING (source)
UNION ALL SELECT 'Fullset', sum(records)::BIGINT, sum(tokens)::BIGINT, (SELECT sum(u) FROM u)::BIGINT,
  (SELECT count(DISTINCT token) FROM e)::BIGINT, printf('%.2f', sum(tokens) / sum(records))::DOUBLE FROM r""")
def corpus_statistics(spark, folder):
    return stats.corpus_statistics(docs(spark, folder), "source", K.words(C("text")))


@query("a02_token_counts", f"""
SELECT token, count(*)::BIGINT AS n FROM (SELECT unnest(flatten(list_transform({S.words('text')}, lambda w: string_split(w, 'e')))) AS token FROM documents)
GROUP BY token""")
def token_counts(spark, folder):
    nested = F.transform(K.words(C("text")), lambda w: F.split(w, "e"))
    return V.corpus_counts(docs(spark, folder), F.flatten(nested))


@query("a03_shard_counts", f"""
SELECT token, count(*)::BIGINT AS n, count(DISTINCT source)::BIGINT AS shards FROM
  (SELECT source, unnest({S.words('text')}) AS token FROM documents) GROUP BY token""")
def shard_counts(spark, folder):
    per_shard = (docs(spark, folder).select("source", F.explode(K.words(C("text"))).alias("token"))
                 .groupBy("source", "token").agg(F.count(F.lit(1)).alias("n")))
    return per_shard.groupBy("token").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("shards"))


@query("a09_substring_counts", f"""
WITH t AS (SELECT token, count(*) AS n FROM (SELECT unnest(list_filter(r, lambda t, i: t <> ' ' OR i = 1 OR i = len(r))) AS token
     FROM (SELECT regexp_extract_all(text, {S.q(K.ALNUM_RUNS)}) AS r FROM documents)) GROUP BY token),
s AS (SELECT token, n, unnest(range(1, length(token) + 1)) AS i FROM t),
p AS (SELECT n, unnest(list_transform(range(1, least(4, length(token) - i + 1) + 1), lambda k: substr(token, i, k))) AS piece FROM s)
SELECT piece, sum(n)::BIGINT AS n FROM p GROUP BY piece HAVING sum(n) >= 100""")
def substring_counts(spark, folder):
    counts = V.corpus_counts(docs(spark, folder), K.alnum_runs(C("text")))
    size = F.length("token")
    pieces = F.flatten(F.transform(
        F.sequence(F.lit(1), size),
        lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(4), size - i + 1)),
                              lambda k: F.substr(C("token"), i, k))))
    return (counts.select("n", F.explode(pieces).alias("piece")).groupBy("piece").agg(F.sum("n").alias("n"))
            .where(C("n") >= 100))


@query("a10_dictionary_finalise", f"""
WITH k AS (SELECT token, n::BIGINT AS n, row_number() OVER (ORDER BY n DESC, token) - 1 AS id FROM {DOC_COUNTS_SQL} WHERE n >= 5),
c AS (SELECT * FROM k WHERE id < 3003), t AS (SELECT count(*) AS total FROM c)
SELECT token, n, id::BIGINT AS id FROM c
UNION ALL SELECT printf('madeupword%04d', i::INT), 0, (total + i)::BIGINT FROM (SELECT total, unnest(range(0, (8 - total % 8) % 8)) AS i FROM t)""")
def dictionary_finalise(spark, folder):
    return V.finalise(doc_counts(spark, folder), 5, 3003, 8)


_IDS_SQL = f"""v AS {vocab_sql(14)},
t AS (SELECT doc_id, token, pos FROM (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM (SELECT doc_id, {S.words('text')} AS w FROM documents)))"""


@query("a11_dictionary_prune", f"""
WITH {_IDS_SQL}
SELECT 'max_vocab' AS rule, count(*) FILTER (WHERE id < 2000)::BIGINT AS kept_tokens, count(*) FILTER (WHERE id >= 2000)::BIGINT AS unknown_tokens,
  count(DISTINCT CASE WHEN id < 2000 THEN id END)::BIGINT AS dictionary FROM t JOIN v USING (token)
UNION ALL SELECT 'min_count', count(*) FILTER (WHERE n >= 20)::BIGINT, count(*) FILTER (WHERE n < 20)::BIGINT,
  count(DISTINCT CASE WHEN n >= 20 THEN id END)::BIGINT FROM t JOIN v USING (token)""")
def dictionary_prune(spark, folder):
    # ids fall with count, so both rules only need the vocabulary, not the corpus again
    vocab = V.assign_ids(doc_counts(spark, folder), 14)

    def report(rule, keep):
        return vocab.agg(F.lit(rule).alias("rule"), F.coalesce(F.sum(F.when(keep, C("n"))), F.lit(0)).alias("kept_tokens"),
                         F.coalesce(F.sum(F.when(~keep, C("n"))), F.lit(0)).alias("unknown_tokens"),
                         F.count_if(keep).alias("dictionary"))

    return report("max_vocab", C("id") < 2000).unionByName(report("min_count", C("n") >= 20))


@query("a11_remapped_ids", f"""
WITH v AS (SELECT token, id FROM {vocab_sql(14, 1000)}),
t AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM (SELECT doc_id, {S.words('text')} AS w FROM documents))
SELECT doc_id, string_agg(CASE WHEN v.id IS NULL OR v.id >= 400 THEN 3 ELSE v.id END::VARCHAR, ' ' ORDER BY pos) AS ids
FROM t LEFT JOIN v USING (token) GROUP BY doc_id""")
def remapped_ids(spark, folder):
    vocab = V.assign_ids(doc_counts(spark, folder), 14, 1000)
    ids = V.index(docs(spark, folder), "doc_id", K.words(C("text")), vocab, 3)
    pruned = F.transform("ids", lambda i: F.when(i >= 400, F.lit(3)).otherwise(i))
    return ids.where(F.size("ids") > 0).select("doc_id", F.array_join(pruned, " ").alias("ids"))


@query("a12_unknown_report", f"""
WITH c AS {DOC_COUNTS_SQL}, v AS (SELECT token FROM {vocab_sql(14, 3000)}), u AS (SELECT * FROM c ANTI JOIN v USING (token))
SELECT (SELECT sum(n) FROM c)::BIGINT AS words, (SELECT count(*) FROM c)::BIGINT AS unique_words, (SELECT count(*) FROM documents)::BIGINT AS sentences,
  (SELECT sum(n) FROM u)::BIGINT AS unknown, (SELECT count(*) FROM u)::BIGINT AS unique_unknown,
  round(100.0::DOUBLE * (SELECT sum(n) FROM u) / (SELECT sum(n) FROM c), 4) AS percent_unknown""")
def unknown_report(spark, folder):
    counts = doc_counts(spark, folder)
    vocab = V.assign_ids(counts, 14, 3000).select("token", F.lit(True).alias("known"))
    marked = counts.join(vocab, "token", "left").withColumn("unknown", C("known").isNull())
    one = marked.agg(F.sum("n").alias("words"), F.count(F.lit(1)).alias("unique_words"),
                     F.sum(F.when(C("unknown"), C("n"))).alias("unknown"), F.count_if("unknown").alias("unique_unknown"))
    return one.select("words", "unique_words", docs(spark, folder).agg(F.count(F.lit(1))).scalar().alias("sentences"),
                      "unknown", "unique_unknown", F.round(100.0 * C("unknown") / C("words"), 4).alias("percent_unknown"))


@query("a12_top_unknown", f"""
WITH v AS (SELECT token FROM {vocab_sql(14, 3000)})
SELECT token, n::BIGINT AS n FROM {DOC_COUNTS_SQL} ANTI JOIN v USING (token) ORDER BY n DESC, token LIMIT 30""")
def top_unknown(spark, folder):
    counts = doc_counts(spark, folder)
    vocab = V.assign_ids(counts, 14, 3000).select("token")
    return V.top_tokens(counts.join(vocab, "token", "left_anti"), 30)


@query("a13_indexing_statistics", f"""
WITH v AS (SELECT token, id FROM {vocab_sql(4, 3000)}), t AS {DOC_TOKENS_SQL},
r AS (SELECT token, count(*) AS n FROM t ANTI JOIN v USING (token) GROUP BY token)
SELECT 'nseq' AS stat, count(*)::BIGINT AS n FROM documents
UNION ALL SELECT 'ntok', (count(*) + (SELECT count(*) FROM documents))::BIGINT FROM t
UNION ALL SELECT 'nunk', sum(n)::BIGINT FROM r
UNION ALL SELECT 'replaced:' || token, n::BIGINT FROM r""")
def indexing_statistics(spark, folder):
    # every sequence also counts its end mark
    counts = doc_counts(spark, folder)
    vocab = V.assign_ids(counts, 4, 3000).select("token")
    replaced = counts.join(vocab, "token", "left_anti")
    nseq = docs(spark, folder).agg(F.lit("nseq").alias("stat"), F.count(F.lit(1)).alias("n"))
    ntok = counts.agg(F.lit("ntok").alias("stat"), F.sum("n").alias("n")).select(
        "stat", (C("n") + nseq.select("n").scalar()).alias("n"))
    nunk = replaced.agg(F.lit("nunk").alias("stat"), F.sum("n").alias("n"))
    words = replaced.select(F.concat(F.lit("replaced:"), "token").alias("stat"), "n")
    return nseq.unionByName(ntok).unionByName(nunk).unionByName(words)


_STOP = ["the", "of", "and", "to", "in", "der", "die", "das", "le", "la", "de", "el", "ha", "wa"]
_STOP_SQL = "(" + ", ".join(S.q(w) for w in _STOP) + ")"
_VECTOR = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"


@query("a14_document_frequency", f"""
WITH p AS (SELECT doc_id, token, count(*) AS n FROM (SELECT doc_id, unnest({_VECTOR}) AS token FROM documents) GROUP BY ALL),
f AS (SELECT token, count(*)::BIGINT AS df, sum(n)::BIGINT AS n FROM p WHERE token NOT IN {_STOP_SQL} GROUP BY token HAVING count(*) >= 10)
SELECT token, df, n FROM f ORDER BY n DESC, token LIMIT 20""")
def document_frequency(spark, folder):
    tokens = F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}_]{2,})"), 1)
    df = stats.document_frequency(docs(spark, folder), "doc_id", tokens, 10, _STOP)
    return V.top_tokens(df, 20).select("token", "df", "n")


@query("a15_term_weights", f"""
SELECT token, n::BIGINT AS n, round(n / (max(n) OVER ()), 6) AS weight FROM {DOC_COUNTS_SQL} ORDER BY n DESC, token LIMIT 5000""")
def term_weights(spark, folder):
    return stats.relative_weights(doc_counts(spark, folder), 5000).withColumn("weight", F.round("weight", 6))


_SPLIT_SQL = f"CASE WHEN {S.uniform('split', 'doc_id')} < 0.2::DOUBLE THEN 'test' ELSE 'train' END"


def split_column():
    return F.when(H.uniform("split", C("doc_id")) < 0.2, "test").otherwise("train")


@query("a16_mean_lengths", f"""
SELECT {_SPLIT_SQL} AS split, round(avg(length(text)), 4) AS mean_chars, round(avg(len({S.words('text')})), 4) AS mean_words FROM documents GROUP BY 1""")
def mean_lengths(spark, folder):
    return docs(spark, folder).groupBy(split_column().alias("split")).agg(
        F.round(F.avg(F.length("text")), 4).alias("mean_chars"),
        F.round(F.avg(F.size(K.words(C("text")))), 4).alias("mean_words"))


@query("a17_length_histogram", f"""
WITH b AS (SELECT {_SPLIT_SQL} AS split, length(text) // 500 AS bin, count(*) AS n FROM documents GROUP BY 1, 2)
SELECT split, bin::BIGINT AS bin, n::BIGINT AS n, round(n / sum(n) OVER (PARTITION BY split), 6) AS share FROM b""")
def length_histogram(spark, folder):
    d = docs(spark, folder).select(split_column().alias("split"), F.length("text").alias("chars"))
    return stats.length_histogram(d, "split", C("chars"), 500).withColumn("share", F.round("share", 6))


@query("a17_length_density")
def length_density(spark, folder):
    d = docs(spark, folder).select(split_column().alias("split"), F.length("text").alias("chars"))
    edges = stats.quantile_edges(stats.length_sketches(d, "split", C("chars")), 20)
    return stats.length_density(d, "split", C("chars"), edges)


@query("a24_weighted_mean", """
SELECT l_returnflag, l_linestatus, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS mean FROM lineitem GROUP BY ALL""")
def weighted_mean(spark, folder):
    m = stats.weighted_mean(table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"], C("l_discount"), C("l_quantity"))
    return m.withColumn("mean", F.round("mean", 6))


_TALLY_SQL = """WITH r AS (SELECT user_id, arg_min(event_type, (CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END, ts, event_id)) AS result,
  min(CASE WHEN event_type = 'purchase' THEN (ts, event_id) END) AS won FROM events GROUP BY user_id)"""
_STATUSES = ["purchase", "error", "click", "view", "signup"]


@query("a25_result_tally", _TALLY_SQL + "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE result = '{s}')::BIGINT AS {s}" for s in _STATUSES) + """,
  count(*)::BIGINT AS total, count(*) FILTER (WHERE result <> 'signup')::BIGINT AS total_evaluated,
  round(count(*) FILTER (WHERE result = 'purchase') / greatest(count(*) FILTER (WHERE result <> 'signup'), 1), 6) AS accuracy FROM r""")
def result_tally(spark, folder):
    results, _ = stats.attempt_tally(table(spark, folder, "events"), "user_id", ["ts", "event_id"], "event_type", "purchase")
    return stats.tally(results, _STATUSES, "purchase", "signup").withColumn("accuracy", F.round("accuracy", 6))


@query("a25_beam_contribution", _TALLY_SQL + """,
e AS (SELECT r.user_id, count(e.event_id) AS attempt FROM r LEFT JOIN events e ON e.user_id = r.user_id AND (e.ts, e.event_id) < r.won
      WHERE r.won IS NOT NULL GROUP BY r.user_id)
SELECT attempt::BIGINT AS attempt, count(*)::BIGINT AS successes,
  round(count(*) / (SELECT count(*) FILTER (WHERE result <> 'signup') FROM r), 6) AS contribution FROM e GROUP BY attempt""")
def beam_contribution(spark, folder):
    results, beams = stats.attempt_tally(table(spark, folder, "events"), "user_id", ["ts", "event_id"], "event_type", "purchase")
    evaluated = results.agg(F.greatest(F.count_if(C("result") != "signup"), F.lit(1))).scalar()
    return beams.select(as_long("attempt"), "successes", F.round(C("successes") / evaluated, 6).alias("contribution"))


@query("a26_perplexity", f"""
WITH t AS (SELECT lang, unnest({S.words('text')}) AS token FROM documents), c AS (SELECT lang, token, count(*) AS n FROM t GROUP BY ALL),
g AS (SELECT token, sum(n) AS total FROM c GROUP BY token), s AS (SELECT sum(total) AS size, arg_max(token, (total, token)) AS top FROM g)
SELECT lang, sum(n)::BIGINT AS tokens, round(exp(-sum(n * ln(total / size::DOUBLE)) / sum(n)), 3) AS perplexity,
  round(sum(CASE WHEN token = top THEN n ELSE 0 END) / sum(n), 6) AS accuracy FROM c JOIN g USING (token), s GROUP BY lang""")
def perplexity(spark, folder):
    c = (docs(spark, folder).select("lang", F.explode(K.words(C("text"))).alias("token"))
         .groupBy("lang", "token").agg(F.count(F.lit(1)).alias("n")))
    g = c.groupBy("token").agg(F.sum("n").alias("total"))
    scored = c.join(g, "token").withColumn("logp", F.log(C("total") / g.agg(F.sum("total").cast("double")).scalar()))
    top = g.agg(F.max_by("token", F.struct("total", "token"))).scalar()
    return scored.groupBy("lang").agg(
        F.sum("n").alias("tokens"), F.round(F.exp(-F.sum(C("n") * C("logp")) / F.sum("n")), 3).alias("perplexity"),
        F.round(F.sum(F.when(C("token") == top, C("n")).otherwise(0)) / F.sum("n"), 6).alias("accuracy"))


@query("a27_sequence_score", f"""
WITH t AS {DOC_TOKENS_SQL}, g AS {DOC_COUNTS_SQL}, s AS (SELECT sum(n)::DOUBLE AS size FROM g)
SELECT doc_id, round(avg(ln(n / size)), 5) AS score FROM t JOIN g USING (token), s GROUP BY doc_id""")
def sequence_score(spark, folder):
    texts = placed_by(docs(spark, folder).select("doc_id", "text"), "doc_id").select("doc_id", K.words(C("text")).alias("tokens"))
    per_doc = one_row_each(texts, ["doc_id"], "tokens", "token").groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("k"))
    g = per_doc.groupBy("token").agg(F.sum("k").alias("n"))
    scored = V.skewed_lookup(per_doc, g, "token", "n")
    logp = F.log(C("n") / g.agg(F.sum("n").cast("double")).scalar())
    return scored.groupBy("doc_id").agg(F.round(F.sum(C("k") * logp) / F.sum("k"), 5).alias("score"))


@query("a28_classification", """
WITH s AS (SELECT l.quality * 2 + l.toxic AS target, CASE WHEN d.n_chars > 1200 THEN 2 ELSE 0 END + CASE WHEN contains(d.text, '###') THEN 1 ELSE 0 END AS guess,
  d.n_chars / 1000.0::DOUBLE AS loss FROM labels l JOIN documents d USING (doc_id))
SELECT count(*)::BIGINT AS nsentences, sum((target = guess)::INT)::BIGINT AS acc_sum, round(sum((target = guess)::INT) / count(*), 6) AS acc,
  round(sum(target) / count(*), 6) AS target_mean, round(sum(loss) / count(*) / ln(2), 6) AS loss,
  sum((target <> 2)::INT)::BIGINT AS nn_nsents, round(sum((target <> 2 AND (target > 2) = (guess > 2))::INT) / greatest(sum((target <> 2)::INT), 1), 6) AS bin_acc_avg,
  round(sum((target > 2)::INT) / greatest(sum((target <> 2)::INT), 1), 6) AS bin_target_mean FROM s""")
def classification(spark, folder):
    rows = docs(spark, folder).select(
        "doc_id", (C("n_chars") / 1000.0).alias("loss"),
        (F.when(C("n_chars") > 1200, 2).otherwise(0) + F.contains(C("text"), F.lit("###")).cast("int")).alias("guess")
    ).join(table(spark, folder, "labels"), "doc_id").withColumn("target", C("quality") * 2 + C("toxic"))
    n = F.count(F.lit(1))
    hit = F.count_if(C("target") == C("guess"))
    rated = F.count_if(C("target") != 2)
    binary = F.count_if((C("target") != 2) & ((C("target") > 2) == (C("guess") > 2)))
    base = F.greatest(rated, F.lit(1))
    return rows.agg(
        n.alias("nsentences"), hit.alias("acc_sum"), F.round(hit / n, 6).alias("acc"),
        F.round(F.sum("target") / n, 6).alias("target_mean"), F.round(F.sum("loss") / n / F.log(F.lit(2.0)), 6).alias("loss"),
        rated.alias("nn_nsents"), F.round(binary / base, 6).alias("bin_acc_avg"),
        F.round(F.count_if(C("target") > 2) / base, 6).alias("bin_target_mean"))


@query("a29_sampling_weights", """
WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang), p AS (SELECT lang, n, pow(n / sum(n) OVER (), 0.7::DOUBLE) AS r FROM c)
SELECT lang, n::BIGINT AS n, round(r / sum(r) OVER (), 6) AS weight FROM p""")
def sampling_weights(spark, folder):
    return stats.sampling_weights(docs(spark, folder), "lang", 0.7).select("lang", "n", F.round("weight", 6).alias("weight"))


@query("a30_dataset_weights", """
SELECT lang, printf('%.2f', count(*) / (SELECT count(*) FROM documents))::DOUBLE AS weight FROM documents GROUP BY lang""")
def dataset_weights(spark, folder):
    counts = docs(spark, folder).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("lang", stats.two_digits(C("n") / counts.agg(F.sum("n")).scalar()).alias("weight"))


_CELLS = "(SELECT vec_id, label, unnest(embedding)::DOUBLE AS value, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)"


@query("a31_parameter_mean", f"""
SELECT label::BIGINT AS label, pos::BIGINT AS pos, round(avg(value), 6) AS value FROM {_CELLS} GROUP BY label, pos""")
def parameter_mean(spark, folder):
    m = stats.parameter_mean(table(spark, folder, "embeddings"), "label", "embedding")
    return m.select(as_long("label"), as_long("pos"), F.round("value", 6).alias("value"))


@query("a31_parameter_moving_mean", f"""
WITH k AS (SELECT vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id DESC) - 1 AS age, count(*) OVER (PARTITION BY label) AS n FROM embeddings),
w AS (SELECT vec_id, pow(0.9::DOUBLE, age) * CASE WHEN age = n - 1 THEN 1.0::DOUBLE ELSE 0.1::DOUBLE END AS weight FROM k)
SELECT label::BIGINT AS label, pos::BIGINT AS pos, round(sum(value * weight), 6) AS value FROM {_CELLS} JOIN w USING (vec_id) GROUP BY label, pos""")
def parameter_moving_mean(spark, folder):
    m = stats.parameter_moving_mean(table(spark, folder, "embeddings"), "label", "vec_id", "embedding", 0.1)
    return m.select(as_long("label"), as_long("pos"), F.round("value", 6).alias("value"))


@query("a31_uneven_parameters", """
SELECT p_size AS name, count(DISTINCT p_brand)::BIGINT AS models FROM part GROUP BY p_size
HAVING count(DISTINCT p_brand) < (SELECT count(DISTINCT p_brand) FROM part)""")
def uneven_parameters(spark, folder):
    # brands stand for models, part sizes for the parameters each of them holds
    return stats.uneven_parameters(table(spark, folder, "part"), "p_brand", "p_size")


@query("a32_vocabulary_union", f"""
SELECT DISTINCT token FROM (SELECT unnest({S.words('text')}) AS token FROM conversations
  UNION ALL SELECT unnest({S.words('text')}) FROM benchmark)""")
def vocabulary_union(spark, folder):
    parts = [table(spark, folder, n).select(F.explode(K.words(C("text"))).alias("token")) for n in ("conversations", "benchmark")]
    return parts[0].unionByName(parts[1]).distinct()

"""Registered queries: splits, batches, ordering, noise and masking (W) and set operations (U)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import noise as N, text as T, tokens as K
from ..operators import splits as P, vocab as V
from ..session import table
from . import sql as S
from .common import DOC_COUNTS_SQL, PAIRS_SQL, as_long, doc_counts, doc_words, docs, pairs, turns, vocab_sql
from .registry import query

C = F.col
HASH = "md5('{0}|' || {1})"


@query("w01_keyed_split", f"SELECT doc_id, CASE WHEN {S.uniform('w1', 'doc_id')} < 0.2::DOUBLE THEN 'test' ELSE 'train' END AS split FROM documents")
def keyed_split(spark, folder):
    return P.keyed_split(docs(spark, folder).select("doc_id"), C("doc_id"), "w1", 0.2)


_SPLIT = f"""p AS (SELECT doc_id, lang, row_number() OVER (ORDER BY {HASH.format('w2', 'doc_id')}, doc_id) - 1 AS place, count(*) OVER () AS n FROM documents),
k AS (SELECT doc_id, lang, CASE WHEN place < 20 THEN 'valid' WHEN place < 40 THEN 'test' ELSE 'train' END AS split,
  CASE WHEN place >= 40 THEN (place - 40) // ((n - 40) // 8) END AS shard FROM p)"""


@query("w02_train_valid_test", f"WITH {_SPLIT} SELECT doc_id, split, shard::BIGINT AS shard FROM k WHERE split <> 'train' OR shard < 8")
def train_valid_test(spark, folder):
    return P.train_valid_test(docs(spark, folder).select("doc_id"), "doc_id", "w2", 20, exact=True).withColumn("shard", as_long("shard"))


@query("w02_train_valid_test_all_rows", f"WITH {_SPLIT} SELECT doc_id, split, CASE WHEN split = 'train' THEN least(shard, 7) END::BIGINT AS shard FROM k")
def train_valid_test_all_rows(spark, folder):
    return P.train_valid_test(docs(spark, folder).select("doc_id"), "doc_id", "w2", 20).withColumn("shard", as_long("shard"))


@query("w03_line_quota", """
WITH f AS (SELECT lang, doc_id, len(string_split(text, chr(10))) AS lines FROM documents),
s AS (SELECT *, sum(lines) OVER (PARTITION BY lang ORDER BY doc_id) - lines AS before FROM f)
SELECT lang, doc_id, lines::BIGINT AS lines, least(lines, 300 - before)::BIGINT AS taken FROM s WHERE before < 300""")
def line_quota(spark, folder):
    files = docs(spark, folder).select("lang", "doc_id", F.size(K.lines(C("text"))).cast("long").alias("lines"))
    return P.line_quota(files, "lang", "doc_id", "lines", 300).select("lang", "doc_id", "lines", as_long("taken"))


@query("w04_smallest_group_cut", """
WITH r AS (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn, count(*) OVER (PARTITION BY lang) AS n FROM documents)
SELECT lang, doc_id FROM r WHERE rn <= (SELECT min(n) FROM r)""")
def smallest_group_cut(spark, folder):
    return P.smallest_group_cut(docs(spark, folder), "lang", "doc_id").select("lang", "doc_id")


@query("w05_head_lines", "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 25")
def head_lines(spark, folder):
    return docs(spark, folder).select("doc_id", "text").orderBy("doc_id").limit(25)


@query("w06_max_examples", "SELECT doc_id, source FROM documents WHERE length(text) > 0 ORDER BY doc_id LIMIT 101")
def max_examples(spark, folder):
    # asking for at most 100 keeps one more: the known loop stops only after passing the limit
    return docs(spark, folder).where(F.length("text") > 0).select("doc_id", "source").orderBy("doc_id").limit(100 + 1)


@query("w07_token_batches", f"""
WITH l AS (SELECT doc_id, len({S.words('text')}) + 2 AS length FROM documents),
b AS (SELECT doc_id, length, sum(length) OVER (ORDER BY length, doc_id) // 2048 AS raw FROM l)
SELECT doc_id, length::BIGINT AS length, (dense_rank() OVER (ORDER BY raw) - 1)::BIGINT AS batch FROM b""")
def token_batches(spark, folder):
    sizes = doc_words(spark, folder).select("doc_id", (F.size("tokens") + 2).cast("long").alias("length"))
    return P.token_batches(sizes, "doc_id", "length", 2048).select("doc_id", "length", as_long("batch"))


@query("w07_pair_token_batches", f"""
WITH l AS (SELECT conv_id * 1000 + turn AS id, len({S.words('src')}) + len({S.words('tgt')}) + 4 AS length FROM {PAIRS_SQL}),
b AS (SELECT id, length, sum(length) OVER (ORDER BY length, id) // 1024 AS raw FROM l)
SELECT id, length::BIGINT AS length, (dense_rank() OVER (ORDER BY raw) - 1)::BIGINT AS batch FROM b""")
def pair_token_batches(spark, folder):
    length = F.size(K.words(C("src"))) + F.size(K.words(C("tgt"))) + 4
    sizes = pairs(spark, folder).select((C("conv_id") * 1000 + C("turn")).alias("id"), length.cast("long").alias("length"))
    return P.token_batches(sizes, "id", "length", 1024).select("id", "length", as_long("batch"))


@query("w08_even_batches", """
SELECT doc_id, (ntile((SELECT ceil(count(*) / 32.0)::BIGINT FROM documents)) OVER (ORDER BY doc_id) - 1)::BIGINT AS batch FROM documents""")
def even_batches(spark, folder):
    return P.even_batches(docs(spark, folder).select("doc_id"), "doc_id", ["doc_id"], 32)


@query("w09_sorted_batches", f"""
WITH l AS (SELECT conv_id * 1000 + turn AS id, len({S.words('src')}) AS s, len({S.words('tgt')}) AS t FROM {PAIRS_SQL}),
b AS (SELECT id, (row_number() OVER (ORDER BY -s, -t, {HASH.format('w9', 'id')}) - 1) // 16 AS batch FROM l),
o AS (SELECT batch, row_number() OVER (ORDER BY {HASH.format('w9b', 'batch')}, batch) - 1 AS place FROM (SELECT DISTINCT batch FROM b))
SELECT id, batch::BIGINT AS batch, place::BIGINT AS place FROM b JOIN o USING (batch)""")
def sorted_batches(spark, folder):
    from ..functions.hashing import key_hash

    p = pairs(spark, folder).select((C("conv_id") * 1000 + C("turn")).alias("id"), (-F.size(K.words(C("src")))).alias("s"),
                                    (-F.size(K.words(C("tgt")))).alias("t"))
    keyed = p.withColumn("h", key_hash("w9", C("id")))
    return P.sorted_batches(keyed, ["s", "t", "h"], 16, "w9b").select("id", as_long("batch"), as_long("place"))


@query("w10_size_order", f"""
WITH l AS (SELECT conv_id * 1000 + turn AS id, len({S.words('src')}) AS s, len({S.words('tgt')}) AS t FROM {PAIRS_SQL})
SELECT id, (row_number() OVER (ORDER BY s, t, id) - 1)::BIGINT AS place, greatest(s, t)::BIGINT AS num_tokens, (s + t)::BIGINT AS total FROM l""")
def size_order(spark, folder):
    from ..operators.ranking import with_global_position

    p = pairs(spark, folder).select((C("conv_id") * 1000 + C("turn")).alias("id"), F.size(K.words(C("src"))).alias("s"),
                                    F.size(K.words(C("tgt"))).alias("t"))
    return with_global_position(p, ["s", "t", "id"], "place").select(
        "id", as_long("place"), F.greatest("s", "t").cast("long").alias("num_tokens"), (C("s") + C("t")).cast("long").alias("total"))


@query("w11_capped_batches", f"""
WITH b AS (SELECT doc_id, ntile((SELECT ceil(count(*) / 32.0)::BIGINT FROM documents)) OVER (ORDER BY doc_id) - 1 AS batch FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY {HASH.format('w11', 'doc_id')}, doc_id) AS rn FROM b)
SELECT doc_id, batch::BIGINT AS batch FROM r WHERE rn <= 12""")
def capped_batches(spark, folder):
    batched = P.even_batches(docs(spark, folder).select("doc_id"), "doc_id", ["doc_id"], 32)
    return P.cap_batches(batched, "batch", "doc_id", "w11", 12)


@query("w12_worker_ranges", """
WITH p AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS place, count(*) OVER () AS n FROM documents)
SELECT doc_id, (place // (n // 7))::BIGINT AS worker FROM p WHERE place // (n // 7) < 7""")
def worker_ranges(spark, folder):
    return P.worker_ranges(docs(spark, folder), "doc_id", 7, exact=True).select("doc_id", as_long("worker"))


@query("w12_worker_ranges_all_rows", "SELECT doc_id, (ntile(7) OVER (ORDER BY doc_id) - 1)::BIGINT AS worker FROM documents")
def worker_ranges_all_rows(spark, folder):
    return P.worker_ranges(docs(spark, folder), "doc_id", 7).select("doc_id", as_long("worker"))


_STREAMS_SQL = f"""
d AS (SELECT doc_id, {S.words('text')} || ['</s>'] AS w FROM documents),
o AS (SELECT doc_id, w, sum(len(w)) OVER (ORDER BY doc_id) - len(w) AS start, sum(len(w)) OVER () AS total FROM d),
e AS (SELECT start + pos - 1 AS i, token, total FROM (SELECT start, total, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM o)),
g AS (SELECT any_value(total) AS total, ceil(any_value(total) / (8 * 64.0))::BIGINT * 64 AS height FROM o),
f AS (SELECT i + height * 8 - g.total AS spot, token, height FROM e, g
      UNION ALL SELECT unnest(range(0, (height * 8 - total)::BIGINT)), '</s>', height FROM g),
r AS (SELECT spot // height AS stream, spot % height + 1 AS row, token FROM f WHERE spot % height + 1 < height
      UNION ALL SELECT unnest(range(0, 8)), 0, '</s>'),
b AS (SELECT (row // 64)::BIGINT AS batch, stream::BIGINT AS stream, count(*)::BIGINT AS steps, string_agg(token, ' ' ORDER BY row) AS tokens FROM r GROUP BY 1, 2)"""


def _streams(spark, folder, *more, **options):
    laid = P.stream_batches(doc_words(spark, folder), "doc_id", "tokens", 8, 64, **options)
    return laid.select(as_long("batch"), as_long("stream"), F.size("tokens").cast("long").alias("steps"),
                       F.array_join("tokens", " ").alias("tokens"), *more)


@query("w13_stream_batches", f"WITH {_STREAMS_SQL} SELECT * FROM b")
def stream_batches(spark, folder):
    return _streams(spark, folder)


@query("w13_evaluation_subsample", f"WITH {_STREAMS_SQL} SELECT b.* FROM b, g WHERE batch < (height // 64) // 5")
def evaluation_subsample(spark, folder):
    return _streams(spark, folder, subsample=5)


@query("w13_shuffled_batches", f"""
WITH {_STREAMS_SQL}, n AS (SELECT (height // 64) // 2 AS n FROM g),
k AS (SELECT DISTINCT batch, n FROM b, n WHERE batch < n),
p AS (SELECT batch, list_reduce([batch] || range(1, 65), lambda x, r: CASE WHEN
    ('0x' || substr(md5('w13|' || r || '|' || greatest(x, (('0x' || substr(md5('w13|k|' || r), 1, 12))::BIGINT % n - x + n) % n)), 1, 1))::BIGINT % 2 = 1
  THEN (('0x' || substr(md5('w13|k|' || r), 1, 12))::BIGINT % n - x + n) % n ELSE x END)::BIGINT AS place FROM k)
SELECT b.*, place FROM b JOIN p USING (batch)""")
def shuffled_batches(spark, folder):
    return _streams(spark, folder, "place", subsample=2, seed="w13")


@query("w14_vocabulary_ids", f"SELECT token, n, id::BIGINT AS id FROM {vocab_sql(4)}")
def vocabulary_ids(spark, folder):
    return V.assign_ids(doc_counts(spark, folder), 4)


@query("w15_top_vocabulary", f"SELECT token, n::BIGINT AS n FROM {DOC_COUNTS_SQL} ORDER BY n DESC, token LIMIT 64000")
def top_vocabulary(spark, folder):
    return V.top_tokens(doc_counts(spark, folder), 64000)


@query("w16_last_numbered", """
SELECT s_name, regexp_extract(s_name, '^Supplier#0*(\\d+)$', 1)::BIGINT AS number FROM supplier
WHERE regexp_extract(s_name, '^Supplier#0*(\\d+)$', 1)::BIGINT <= 80 ORDER BY number DESC LIMIT 5""")
def last_numbered(spark, folder):
    return P.last_numbered(table(spark, folder, "supplier"), "s_name", r"Supplier#0*(\d+)", 5, 80)


@query("w17_first_success", """
SELECT user_id, arg_min(event_type, (CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END, ts, event_id)) AS result, count(*)::BIGINT AS attempts
FROM events GROUP BY user_id""")
def first_success(spark, folder):
    failed = F.when(C("event_type") == "purchase", 0).otherwise(1)
    return table(spark, folder, "events").groupBy("user_id").agg(
        F.min_by("event_type", F.struct(failed, "ts", "event_id")).alias("result"), F.count(F.lit(1)).alias("attempts"))


_MARKED = [(". ", "\n"), (" the ", "\n\n# "), (" der ", "\n\n# "), (" le ", "\n\n# ")]


@query("w18_comments_above", f"""
WITH l AS (SELECT doc_id, list_transform(string_split({S.replaces('text', _MARKED)}, chr(10)), lambda x: {S.strip('x')}) AS l FROM documents),
c AS (SELECT doc_id, list_filter(list_transform(range(2, len(l) + 1), lambda i: CASE WHEN starts_with(l[i], 'T') AND starts_with(l[i - 1], '#')
   AND (i = 2 OR l[i - 2] = '') THEN l[i - 1] ELSE '' END), lambda x: x <> '') AS above FROM l)
SELECT doc_id, array_to_string(above, '|') AS above FROM c WHERE len(above) > 0""")
def comments_above(spark, folder):
    above = T.comments_above(T.replace_all(C("text"), _MARKED), "T", "#")
    return docs(spark, folder).select("doc_id", above.alias("a")).where(F.size("a") > 0).select(
        "doc_id", F.array_join("a", "|").alias("above"))


def with_words(spark, folder):
    """Documents with at least one word; the test stops at the first one and builds no tokens."""
    return docs(spark, folder).where(C("text").rlike(f"[^{K.SPACE[1:]}")).select("doc_id", K.words(C("text")).alias("tokens"))


def _u(seed: str, i: str = "i - 1") -> str:
    return S.uniform(seed, "doc_id", i)


_W = f"(SELECT doc_id, {S.words('text')} AS w FROM documents)"


@query("w28_shuffle_nearby", f"""
WITH e AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM {_W})
SELECT doc_id, string_agg(t, ' ' ORDER BY i - 1 + CASE WHEN i = 1 THEN -1.0::DOUBLE ELSE {_u('w28')} * 3.0::DOUBLE END, i) AS tokens FROM e GROUP BY doc_id""")
def shuffle_nearby(spark, folder):
    return with_words(spark, folder).select(
        "doc_id", F.array_join(N.shuffle_nearby(C("tokens"), C("doc_id"), "w28", 3.0), " ").alias("tokens"))


@query("w29_drop_tokens", f"""
WITH e AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM {_W}), s AS (SELECT doc_id, t, i, {_u('w29')} AS u FROM e),
m AS (SELECT *, min(u) OVER (PARTITION BY doc_id) AS least, max(u) OVER (PARTITION BY doc_id) AS most FROM s)
SELECT doc_id, string_agg(t, ' ' ORDER BY i) AS tokens FROM m WHERE u >= 0.9::DOUBLE OR (most < 0.9::DOUBLE AND u = least) GROUP BY doc_id""")
def drop_tokens(spark, folder):
    return with_words(spark, folder).select(
        "doc_id", F.array_join(N.drop_tokens(C("tokens"), C("doc_id"), "w29", 0.9), " ").alias("tokens"))


@query("w30_blank_tokens", f"""
WITH e AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM {_W})
SELECT doc_id, string_agg(CASE WHEN {_u('w30')} < 0.1::DOUBLE THEN '<mask>' ELSE t END, ' ' ORDER BY i) AS tokens FROM e GROUP BY doc_id""")
def blank_tokens(spark, folder):
    return with_words(spark, folder).select(
        "doc_id", F.array_join(N.blank_tokens(C("tokens"), C("doc_id"), "w30", 0.1, "<mask>"), " ").alias("tokens"))


@query("w30_noise_chain", f"""
WITH e AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM {_W}),
a AS (SELECT doc_id, t, row_number() OVER (PARTITION BY doc_id ORDER BY i - 1 + CASE WHEN i = 1 THEN -1.0::DOUBLE ELSE {_u('n-shuffle')} * 3.0::DOUBLE END, i) AS i FROM e),
b AS (SELECT doc_id, t, i, {_u('n-drop')} AS u FROM a), m AS (SELECT *, min(u) OVER (PARTITION BY doc_id) AS least, max(u) OVER (PARTITION BY doc_id) AS most FROM b),
c AS (SELECT doc_id, t, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS i FROM m WHERE u >= 0.1::DOUBLE OR (most < 0.1::DOUBLE AND u = least))
SELECT doc_id, string_agg(CASE WHEN {_u('n-blank')} < 0.1::DOUBLE THEN '<mask>' ELSE t END, ' ' ORDER BY i) AS tokens FROM c GROUP BY doc_id""")
def noise_chain(spark, folder):
    noisy = N.add_noise(C("tokens"), C("doc_id"), "n", 3.0, 0.1, 0.1, "<mask>")
    return with_words(spark, folder).select("doc_id", F.array_join(noisy, " ").alias("tokens"))


_INDEXED = f"""v AS (SELECT token, id FROM {vocab_sql(14, 5000)}),
e AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS i FROM {_W}), x AS (SELECT doc_id, i, coalesce(id, 3) AS id FROM e LEFT JOIN v USING (token))"""


def _indexed(spark, folder):
    vocab = V.assign_ids(doc_counts(spark, folder), 14, 5000)
    return V.index(docs(spark, folder), "doc_id", K.words(C("text")), vocab, 3).where(F.size("ids") > 0)


@query("w31_mask_for_prediction", f"""
WITH {_INDEXED}, c AS (SELECT doc_id, i, id, {_u('w31')} <= 0.15::DOUBLE AND i > 1 AND id <> 2 AS chosen, {_u('w31-fate')} AS fate, floor({_u('w31-id')} * 5014)::BIGINT AS other FROM x)
SELECT doc_id, string_agg(CASE WHEN NOT chosen THEN id WHEN fate < 0.8::DOUBLE THEN 5 WHEN fate < 0.8::DOUBLE + 0.1::DOUBLE THEN id ELSE other END::VARCHAR, ' ' ORDER BY i) AS input,
  string_agg(CASE WHEN chosen THEN id::VARCHAR ELSE '_' END, ' ' ORDER BY i) AS target FROM c GROUP BY doc_id""")
def mask_for_prediction(spark, folder):
    cells = N.mask_for_prediction(C("ids"), C("doc_id"), "w31", 0.15, 5, 5014, 2)
    return _indexed(spark, folder).select("doc_id", cells.alias("c")).select(
        "doc_id", F.array_join("c.input", " ").alias("input"), F.array_join("c.target", " ", "_").alias("target"))


@query("w31_weighted_choice", f"""
WITH e AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS i, len(w) AS n FROM {_W}),
r AS (SELECT doc_id, i, n, row_number() OVER (PARTITION BY doc_id ORDER BY -ln(1 - {_u('w31w')}) / (1.0::DOUBLE / length(t)), i) AS rn FROM e)
SELECT doc_id, string_agg((i - 1)::VARCHAR, ' ' ORDER BY i) AS chosen FROM r WHERE rn <= ceil(n * 0.15::DOUBLE) GROUP BY doc_id""")
def weighted_choice(spark, folder):
    weights = F.transform("tokens", lambda t: F.lit(1.0) / F.length(t))
    chosen = N.choose_weighted(C("tokens"), weights, C("doc_id"), "w31w", 0.15)
    return with_words(spark, folder).select("doc_id", F.array_join(chosen, " ").alias("chosen"))


@query("w32_mask_for_evaluation", f"""
WITH e AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM {_W}),
s AS (SELECT doc_id, t, i, CASE WHEN i = 1 THEN 2.0::DOUBLE ELSE {_u('w32')} END AS u FROM e), m AS (SELECT *, min(u) OVER (PARTITION BY doc_id) AS least FROM s)
SELECT doc_id, string_agg(CASE WHEN u <= 0.02::DOUBLE OR (least > 0.02::DOUBLE AND u = least) THEN '<mask>' ELSE t END, ' ' ORDER BY i) AS tokens FROM m GROUP BY doc_id""")
def mask_for_evaluation(spark, folder):
    masked = N.mask_for_evaluation(C("tokens"), C("doc_id"), "w32", 0.02, "<mask>")
    return with_words(spark, folder).select("doc_id", F.array_join(masked, " ").alias("tokens"))


@query("w33_weighted_draws", f"""
WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang), b AS (SELECT lang, sum(n) OVER (ORDER BY lang) / sum(n) OVER () AS upto FROM c),
d AS (SELECT i AS draw, {S.uniform('w33', 'i')} AS spot FROM range(20) r(i))
SELECT draw::BIGINT AS draw, (SELECT arg_min(lang, upto) FROM b WHERE upto > spot) AS lang FROM d""")
def weighted_draws(spark, folder):
    counts = docs(spark, folder).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    return P.weighted_draws(counts, "lang", "n", 20, "w33")


@query("w34_first_of_group", """
WITH l AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))
SELECT line, arg_min(doc_id, (doc_id, pos)) AS doc_id, arg_min(pos, (doc_id, pos))::BIGINT AS pos FROM l GROUP BY line""")
def first_of_group(spark, folder):
    # a minimum per line, merged before the shuffle, instead of a window over all its copies
    rows = docs(spark, folder).select("doc_id", F.posexplode(K.lines(C("text"))).alias("pos", "line"))
    first = rows.groupBy("line").agg(F.min(F.struct("doc_id", "pos")).alias("f"))
    return first.select("line", "f.doc_id", F.col("f.pos").cast("long").alias("pos"))


@query("u01_union", """
SELECT 'doc' AS part, lang AS name, count(*)::BIGINT AS n FROM documents GROUP BY lang
UNION ALL SELECT 'talk', role, count(*)::BIGINT FROM conversations GROUP BY role UNION ALL SELECT 'bench', 'item', count(*)::BIGINT FROM benchmark""")
def union(spark, folder):
    parts = [docs(spark, folder).select(F.lit("doc").alias("part"), C("lang").alias("name"), "text"),
             turns(spark, folder).select(F.lit("talk").alias("part"), C("role").alias("name"), "text"),
             table(spark, folder, "benchmark").select(F.lit("bench").alias("part"), F.lit("item").alias("name"), "text")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("part", "name").agg(F.count(F.lit(1)).alias("n"))


_SPECIALS = ["the", "and", "of", "der", "die"]


@query("u04_without_specials", f"""
SELECT token, n::BIGINT AS n FROM {DOC_COUNTS_SQL} WHERE token NOT IN ({', '.join(S.q(s) for s in _SPECIALS)})""")
def without_specials(spark, folder):
    specials = spark.createDataFrame([(s,) for s in _SPECIALS], "token string")
    return doc_counts(spark, folder).join(F.broadcast(specials), "token", "left_anti")


@query("u05_distinct_union", f"""
SELECT lower(token) AS token FROM (SELECT unnest({S.words('src')}) AS token FROM {PAIRS_SQL} UNION SELECT unnest({S.words('tgt')}) FROM {PAIRS_SQL}) GROUP BY 1""")
def distinct_union(spark, folder):
    p = pairs(spark, folder)
    sides = [p.select(F.explode(K.words(F.lower(c))).alias("token")) for c in ("src", "tgt")]
    return sides[0].union(sides[1]).distinct()


@query("u06_remove_and_add", f"""
WITH v AS (SELECT token, id FROM {vocab_sql(0, 1000)}), a AS (SELECT DISTINCT unnest({S.words('text')}) AS token FROM benchmark),
kept AS (SELECT * FROM v WHERE token NOT IN ({', '.join(S.q(s) for s in _SPECIALS)})),
new AS (SELECT token, 1000 + row_number() OVER (ORDER BY token) - 1 AS id FROM a ANTI JOIN kept USING (token))
SELECT token, id::BIGINT AS id FROM kept UNION ALL SELECT token, id::BIGINT FROM new""")
def remove_and_add(spark, folder):
    from ..operators.ranking import with_global_position

    specials = spark.createDataFrame([(s,) for s in _SPECIALS], "token string")
    vocab = V.assign_ids(doc_counts(spark, folder), 0, 1000).select("token", "id")
    kept = vocab.join(F.broadcast(specials), "token", "left_anti")
    words = table(spark, folder, "benchmark").select(F.explode(K.words(C("text"))).alias("token")).distinct()
    new = with_global_position(words.join(kept, "token", "left_anti"), ["token"], "id")
    return kept.unionByName(new.select("token", (C("id") + 1000).alias("id")))

"""Registered queries: arrays, maps, matrices and formulas (M)."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from ..functions import arrays as A, tokens as K
from ..operators import ranking, vocab as V
from ..session import table
from . import sql as S
from .common import PAIRS_SQL, doc_counts, doc_words, docs, pairs, turns, vocab_sql
from .registry import query

C = F.col
SRC, TGT = S.words("src"), S.words("tgt")


def joined(column, sep=" "):
    return F.array_join(column, sep)


@query("m01_bounds", f"""
SELECT conv_id, turn, array_to_string(['<s>'] || {TGT} || ['</s>'], ' ') AS tokens FROM {PAIRS_SQL}""")
def bounds(spark, folder):
    return pairs(spark, folder).select("conv_id", "turn", joined(A.with_bounds(K.words(C("tgt")))).alias("tokens"))


@query("m02_pad_batch", f"""
WITH p AS (SELECT conv_id, turn, {SRC} AS s, {TGT} AS t FROM {PAIRS_SQL}),
b AS (SELECT *, (row_number() OVER (ORDER BY -len(s), -len(t), conv_id, turn) - 1) // 16 AS batch FROM p),
m AS (SELECT *, max(len(t)) OVER (PARTITION BY batch) AS width FROM b)
SELECT conv_id, turn, batch::BIGINT AS batch, width::BIGINT AS width,
  array_to_string(t || list_transform(range(0, width - len(t)), lambda i: '<blank>'), ' ') AS padded,
  array_to_string(list_transform(list_transform(s, lambda w: string_split(replace(w, 'e', '_'), '_')),
     lambda u: array_to_string(u || list_transform(range(0, greatest(0, 4 - len(u))), lambda i: '<blank>'), '+')), ' ') AS subtokens
FROM m""")
def pad_batch(spark, folder):
    p = pairs(spark, folder).select("conv_id", "turn", K.words(C("src")).alias("s"), K.words(C("tgt")).alias("t"))
    sizes = p.select("conv_id", "turn", (-F.size("s")).alias("a"), (-F.size("t")).alias("b"))
    placed = ranking.with_global_position(sizes, ["a", "b", "conv_id", "turn"], "place")
    rows = placed.select("conv_id", "turn", F.floor(C("place") / 16).alias("batch")).join(p, ["conv_id", "turn"])
    width = F.max(F.size("t")).over(W.partitionBy("batch"))  # a batch holds 16 rows
    sub = F.transform("s", lambda w: A.pad(F.split(F.replace(w, F.lit("e"), F.lit("_")), "_"), F.lit(4), "<blank>"))
    return rows.withColumn("width", width).select(
        "conv_id", "turn", "batch", C("width").cast("long").alias("width"),
        joined(A.pad(C("t"), C("width"), "<blank>")).alias("padded"),
        joined(F.transform(sub, lambda u: joined(u, "+"))).alias("subtokens"))


@query("m03_relation_matrix", """
WITH r AS (SELECT conv_id, turn, list_transform(string_split(text, chr(10)), lambda l: string_split(l, ' ')) AS rows FROM conversations),
n AS (SELECT *, greatest(len(rows), list_max(list_transform(rows, lambda l: len(l)))) AS n FROM r)
SELECT conv_id, turn, n::BIGINT AS n, array_to_string(list_transform(
    rows || list_transform(range(0, n - len(rows)), lambda i: []::VARCHAR[]),
    lambda l: array_to_string(l || list_transform(range(0, n - len(l)), lambda i: ''), ',')), ';') AS matrix FROM n""")
def relation_matrix(spark, folder):
    as_json = turns(spark, folder).select("conv_id", "turn", F.to_json(F.split("text", "\n")).alias("line"))
    m = as_json.select("conv_id", "turn", A.parse_matrix(C("line")).alias("m"))
    return m.select("conv_id", "turn", F.size("m").cast("long").alias("n"),
                    joined(F.transform("m", lambda r: joined(r, ",")), ";").alias("matrix"))


@query("m04_source_vocabulary", f"""
WITH p AS (SELECT conv_id, turn, {SRC} AS s FROM {PAIRS_SQL}),
d AS (SELECT conv_id, turn, s, list_transform(list_filter(range(1, len(s) + 1), lambda i: list_position(s, s[i]) = i), lambda i: s[i]) AS v FROM p)
SELECT conv_id, turn, array_to_string(v, ' ') AS vocab, array_to_string(list_transform(s, lambda w: list_position(v, w) - 1), ' ') AS src_map FROM d""")
def source_vocabulary(spark, folder):
    s = K.words(C("src"))
    return pairs(spark, folder).select("conv_id", "turn", joined(F.array_distinct(s)).alias("vocab"),
                                       joined(A.source_map(s)).alias("src_map"))


@query("m05_alignment", f"""
WITH p AS (SELECT conv_id, turn, {SRC} AS s, {TGT} AS t FROM {PAIRS_SQL}),
d AS (SELECT conv_id, turn, t, list_transform(list_filter(range(1, len(s) + 1), lambda i: list_position(s, s[i]) = i), lambda i: s[i]) AS v FROM p)
SELECT conv_id, turn, array_to_string(list_transform(t, lambda w: CASE WHEN list_position(v, w) > 0 THEN list_position(v, w) - 1 ELSE -1 END), ' ') AS alignment FROM d""")
def alignment(spark, folder):
    return pairs(spark, folder).select(
        "conv_id", "turn", joined(A.align(K.words(C("tgt")), K.words(C("src")), -1)).alias("alignment"))


@query("m06_source_map_cells", f"""
WITH p AS (SELECT conv_id, turn, {SRC} AS s FROM {PAIRS_SQL}),
d AS (SELECT conv_id, turn, s, list_transform(list_filter(range(1, len(s) + 1), lambda i: list_position(s, s[i]) = i), lambda i: s[i]) AS v FROM p),
e AS (SELECT conv_id, turn, v, unnest(s) AS w, generate_subscripts(s, 1) - 1 AS pos FROM d)
SELECT conv_id, turn, pos::BIGINT AS pos, (list_position(v, w) - 1)::BIGINT AS vocab_index, 1::BIGINT AS cell FROM e""")
def source_map_cells(spark, folder):
    cells = pairs(spark, folder).select(
        "conv_id", "turn", F.posexplode(A.source_map(K.words(C("src")))).alias("pos", "vocab_index"))
    return cells.select("conv_id", "turn", C("pos").cast("long").alias("pos"),
                        C("vocab_index").cast("long").alias("vocab_index"), F.lit(1).cast("long").alias("cell"))


@query("m07_ids_to_text", f"""
WITH v AS (SELECT token, id FROM {vocab_sql(4, 500)}),
t AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos, len(w) AS size FROM (SELECT doc_id, {S.words('text')} AS w FROM documents)),
f AS (SELECT t.doc_id, t.pos, CASE WHEN v.id IS NOT NULL THEN t.token ELSE 'own' || (t.pos % 3) END AS word,
   min(CASE WHEN v.id = 10 THEN t.pos END) OVER (PARTITION BY t.doc_id) AS stop FROM t LEFT JOIN v USING (token))
SELECT d.doc_id, coalesce(string_agg(f.word, ' ' ORDER BY f.pos), '1') AS text
FROM documents d LEFT JOIN f ON f.doc_id = d.doc_id AND (f.stop IS NULL OR f.pos < f.stop) GROUP BY d.doc_id""")
def ids_to_text(spark, folder):
    # ids from 504 on point into the row's own vocabulary; id 10 plays the end mark
    vocab = V.assign_ids(doc_counts(spark, folder), 4, 500)
    ids = V.index(docs(spark, folder), "doc_id", K.words(C("text")), vocab, -1)
    extended = F.transform("ids", lambda i, p: F.when(i >= 0, i).otherwise(504 + (p + 1) % 3))
    rows = ids.select("doc_id", F.array_prepend(extended, F.lit(2)).alias("ids"),
                      F.array(F.lit("own0"), F.lit("own1"), F.lit("own2")).alias("own"))
    return V.ids_to_text(rows, "doc_id", C("ids"), vocab, F.lit(504), "own", begin=2, end=10)


@query("m08_replace_unknown", f"""
WITH p AS (SELECT conv_id, turn, {SRC} AS s, list_transform({TGT}, lambda w: CASE WHEN length(w) > 10 THEN '<unk>' ELSE w END) AS t FROM {PAIRS_SQL}),
e AS (SELECT conv_id, turn, s, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM p),
r AS (SELECT *, CASE WHEN w = '<unk>' THEN list_transform(s, lambda x, j: length(x)::DOUBLE / (1 + abs(i - j))) END AS weights FROM e)
SELECT conv_id, turn, string_agg(CASE WHEN w = '<unk>' THEN s[list_position(weights, list_max(weights))] ELSE w END, ' ' ORDER BY i) AS prediction
FROM r GROUP BY conv_id, turn""")
def replace_unknown(spark, folder):
    prediction = F.transform(K.words(C("tgt")), lambda w: F.when(F.length(w) > 10, F.lit("<unk>")).otherwise(w))
    best = A.replace_unknown(prediction, K.words(C("src")),
                             lambda i, s, j: F.length(s).cast("double") / (F.abs(i - j) + 1))
    return pairs(spark, folder).select("conv_id", "turn", joined(best).alias("prediction"))


@query("m09_reverse_and_strip", f"""
WITH p AS (SELECT doc_id, {S.words('text')} AS w, list_transform({S.words('text')}, lambda t: length(t)) AS ids FROM documents)
SELECT doc_id, array_to_string(list_reverse(w), ' ') AS reversed,
  array_to_string(ids[1:coalesce(list_max(list_filter(range(1, len(ids) + 1), lambda i: ids[i] NOT IN (3, 4, 5, 6, 7))), 0)], ' ') AS stripped
FROM p""")
def reverse_and_strip(spark, folder):
    return doc_words(spark, folder).select(
        "doc_id", joined(F.reverse("tokens")).alias("reversed"),
        joined(A.strip_tail(F.transform("tokens", F.length), [3, 4, 5, 6, 7])).alias("stripped"))


_N_LINES = "len(string_split(text, chr(10)))"


@query("m10_relative_positions", f"""
WITH n AS (SELECT conv_id, turn, {_N_LINES} AS n FROM conversations)
SELECT conv_id, turn,
  array_to_string(flatten(list_transform(range(0, n), lambda i: list_transform(range(0, n), lambda j: greatest(least(j - i, 3), -3) + 3))), ' ') AS signed,
  array_to_string(flatten(list_transform(range(0, n), lambda i: list_transform(range(0, n), lambda j: abs(greatest(least(j - i, 3), -3))))), ' ') AS unsigned
FROM n""")
def relative_positions(spark, folder):
    n = F.size(K.lines(C("text")))
    return turns(spark, folder).select("conv_id", "turn", n.alias("n")).select(
        "conv_id", "turn", joined(F.flatten(A.relative_positions(C("n"), 3, True))).alias("signed"),
        joined(F.flatten(A.relative_positions(C("n"), 3, False))).alias("unsigned"))


@query("m10_relative_runs", f"""
WITH n AS (SELECT conv_id, turn, {_N_LINES} AS n FROM conversations),
c AS (SELECT conv_id, turn, i, greatest(least(j - i, 3), -3) AS v FROM (SELECT *, unnest(range(0, n)) AS j FROM (SELECT *, unnest(range(0, n)) AS i FROM n)))
SELECT conv_id, turn, i::BIGINT AS "row", (v + 3)::BIGINT AS signed, abs(v)::BIGINT AS unsigned, count(*)::BIGINT AS times FROM c GROUP BY conv_id, turn, i, v""")
def relative_runs(spark, folder):
    n = turns(spark, folder).select("conv_id", "turn", F.size(K.lines(C("text"))).alias("n"))
    both = F.arrays_zip(A.relative_runs(C("n"), 3, True).alias("s"), A.relative_runs(C("n"), 3, False).alias("u"))
    runs = n.select("conv_id", "turn", F.explode(both).alias("r"))
    return runs.select("conv_id", "turn", C("r.s.row").cast("long").alias("row"), C("r.s.value").cast("long").alias("signed"),
                       C("r.u.value").cast("long").alias("unsigned"), C("r.s.times").cast("long").alias("times"))


@query("m11_masks", f"""
WITH n AS (SELECT conv_id, turn, {_N_LINES} AS n, (row_number() OVER (ORDER BY {_N_LINES}, conv_id, turn) - 1) // 16 AS batch FROM conversations),
b AS (SELECT *, max(n) OVER (PARTITION BY batch) AS w FROM n)
SELECT conv_id, turn, batch::BIGINT AS batch, array_to_string(list_transform(range(0, w), lambda i: CASE WHEN i < n THEN 1 ELSE 0 END), '') AS mask,
  array_to_string(list_transform(range(0, w), lambda i: array_to_string(list_transform(range(0, w), lambda j: CASE WHEN i < n AND j < n THEN 1 ELSE 0 END), '')), ' ') AS square
FROM b""")
def masks(spark, folder):
    # batches of 16 turns of similar length, so one long turn widens the masks of its batch only
    n = turns(spark, folder).select("conv_id", "turn", F.size(K.lines(C("text"))).alias("n"))
    placed = ranking.with_global_position(n, ["n", "conv_id", "turn"], "place").withColumn("batch", F.floor(C("place") / 16).cast("long"))
    sized = placed.withColumn("w", F.max("n").over(W.partitionBy("batch")))
    return sized.select(
        "conv_id", "turn", "batch", joined(F.transform(A.length_mask(C("n"), C("w")), lambda b: b.cast("int")), "").alias("mask"),
        joined(F.transform(A.square_mask(C("n"), C("w")), lambda r: joined(r, ""))).alias("square"))


@query("m12_truncate_with_end", f"""
SELECT doc_id, array_to_string(CASE WHEN len(w) > 50 THEN w[1:49] || ['</s>'] ELSE w END, ' ') AS tokens
FROM (SELECT doc_id, {S.words('text')} AS w FROM documents)""")
def truncate_with_end(spark, folder):
    return doc_words(spark, folder).select("doc_id", joined(A.truncate_with_end(C("tokens"), 50, "</s>")).alias("tokens"))


@query("m13_concat_pair", f"""
WITH p AS (SELECT conv_id, turn, ['</s>'] || {SRC} || ['</s>'] AS a, ['</s>'] || {TGT} || ['</s>'] AS b FROM {PAIRS_SQL})
SELECT conv_id, turn, array_to_string(a || b, ' ') AS tokens,
  array_to_string(list_transform(range(0, len(a) + len(b)), lambda i: CASE WHEN i >= len(a) THEN i - len(a) ELSE i END), ' ') AS positions,
  array_to_string(list_transform(range(0, len(a) + len(b)), lambda i: CASE WHEN i < len(a) THEN 0 ELSE 1 END), ' ') AS langs,
  array_to_string(a[1:len(a) - 1] || b, ' ') AS merged FROM p""")
def concat_pair(spark, folder):
    def framed(name):
        return A.with_bounds(K.words(C(name)), "</s>", "</s>").alias(name)

    p = pairs(spark, folder).select("conv_id", "turn", framed("src"), framed("tgt"))
    tokens, positions, langs = A.concat_pair(C("src"), C("tgt"), 0, 1, True)
    merged, _, _ = A.concat_pair(C("src"), C("tgt"), 0, 1, False)
    return p.select("conv_id", "turn", joined(tokens).alias("tokens"), joined(positions).alias("positions"),
                    joined(langs).alias("langs"), joined(merged).alias("merged"))


@query("m14_schedule_value", """
WITH b(x, y) AS (VALUES (0, 0.0::DOUBLE), (1000, 0.5::DOUBLE), (6000, 1.0::DOUBLE)),
r AS (SELECT x, y, lead(x) OVER (ORDER BY x) AS nx, lead(y) OVER (ORDER BY x) AS ny FROM b)
SELECT event_id, round(CASE WHEN r.nx IS NULL THEN r.y ELSE r.y + (event_id - r.x) * ((r.ny - r.y) / (r.nx - r.x)) END, 6) AS weight
FROM events JOIN r ON event_id >= r.x AND (r.nx IS NULL OR event_id < r.nx)""")
def schedule_value(spark, folder):
    step = A.schedule_value("0:0,1000:0.5,6000:1", C("event_id"))
    return table(spark, folder, "events").select("event_id", F.round(step, 6).alias("weight"))


@query("m15_length_penalty", f"""
SELECT conv_id, turn, round(pow((5 + len(w)) / 6.0::DOUBLE, 0.8::DOUBLE), 6) AS wu, len(w)::BIGINT AS average
FROM (SELECT conv_id, turn, {S.words('text')} AS w FROM conversations)""")
def length_penalty(spark, folder):
    n = F.size(K.words(C("text")))
    return turns(spark, folder).select("conv_id", "turn", F.round(A.length_penalty(n, 0.8), 6).alias("wu"),
                                       n.cast("long").alias("average"))


@query("m15_coverage_penalty", """
WITH c AS (SELECT vec_id, list_transform(embedding, lambda x: abs(x)::DOUBLE * 8 + 0.01::DOUBLE) AS c FROM embeddings)
SELECT vec_id, round(0.2::DOUBLE * -list_sum(list_transform(c, lambda x: ln(least(x, 1.0::DOUBLE)))), 6) AS wu,
  round(0.2::DOUBLE * (list_sum(list_transform(c, lambda x: greatest(x, 1.0::DOUBLE))) - len(c)), 6) AS summary FROM c""")
def coverage_penalty(spark, folder):
    cov = F.transform("embedding", lambda x: F.abs(x).cast("double") * 8 + F.lit(0.01))
    return table(spark, folder, "embeddings").select("vec_id", cov.alias("c")).select(
        "vec_id", F.round(A.coverage_log_penalty(C("c"), 0.2), 6).alias("wu"),
        F.round(A.coverage_sum_penalty(C("c"), 0.2), 6).alias("summary"))

"""Registered queries: joins (J); tree joins and subword joins live with their operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import tokens as K
from ..operators import pairing, vocab as V
from ..session import table
from . import sql as S
from .common import PAIRS_SQL, doc_counts, docs, pairs, turns, vocab_sql
from .registry import query

C = F.col


@query("j01_files_contents", """
SELECT p.page_id, p.url, d.lang, d.n_chars FROM pages p JOIN documents d ON p.page_id = d.doc_id""")
def files_contents(spark, folder):
    contents = docs(spark, folder).select(C("doc_id").alias("page_id"), "lang", "n_chars")
    return table(spark, folder, "pages").select("page_id", "url").join(contents, "page_id")


def _numbered(rows, name):
    return rows.select("conv_id", "turn", F.posexplode(K.lines(C(name))).alias("line_no", f"{name}_line"))


_LINES = """SELECT conv_id, turn, unnest(l) AS {0}_line, generate_subscripts(l, 1) - 1 AS line_no
  FROM (SELECT conv_id, turn, string_split({0}, chr(10)) AS l FROM p)"""


@query("j02_positional_zip", f"""
WITH p AS {PAIRS_SQL}, a AS ({_LINES.format('src')}), b AS ({_LINES.format('tgt')}),
n AS (SELECT conv_id, turn, len(string_split(src, chr(10))) = len(string_split(tgt, chr(10))) AS same_count FROM p)
SELECT a.conv_id, a.turn, a.line_no::BIGINT AS line_no, src_line, tgt_line, same_count
FROM a JOIN b USING (conv_id, turn, line_no) JOIN n ON n.conv_id = a.conv_id AND n.turn = a.turn""")
def positional_zip(spark, folder):
    p = pairs(spark, folder)
    counts = p.select("conv_id", "turn", (F.size(K.lines(C("src"))) == F.size(K.lines(C("tgt")))).alias("same_count"))
    zipped = pairing.zip_lines(_numbered(p, "src"), _numbered(p, "tgt"), ["conv_id", "turn"])
    return zipped.join(counts, ["conv_id", "turn"]).select(
        "conv_id", "turn", C("line_no").cast("long").alias("line_no"), "src_line", "tgt_line", "same_count")


@query("j03_longest_zip", f"""
WITH p AS {PAIRS_SQL}, a AS ({_LINES.format('src')}), b AS ({_LINES.format('tgt')})
SELECT conv_id, turn, line_no::BIGINT AS line_no, coalesce(src_line, '') || ' ||| ' || coalesce(tgt_line, '') AS line
FROM a FULL JOIN b USING (conv_id, turn, line_no)""")
def longest_zip(spark, folder):
    p = pairs(spark, folder)
    zipped = pairing.zip_lines(_numbered(p, "src"), _numbered(p, "tgt"), ["conv_id", "turn"], "full")
    line = F.concat(F.coalesce("src_line", F.lit("")), F.lit(" ||| "), F.coalesce("tgt_line", F.lit("")))
    return zipped.select("conv_id", "turn", C("line_no").cast("long").alias("line_no"), line.alias("line"))


@query("j04_vocabulary_lookup", f"""
WITH v AS (SELECT token, id FROM {vocab_sql(4, 5000)}),
t AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM (SELECT doc_id, {S.words('text')} AS w FROM documents))
SELECT d.doc_id, coalesce(i.ids, '') AS ids FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(coalesce(v.id, 0)::VARCHAR, ' ' ORDER BY pos) AS ids FROM t LEFT JOIN v USING (token) GROUP BY doc_id) i USING (doc_id)""")
def vocabulary_lookup(spark, folder):
    vocab = V.assign_ids(doc_counts(spark, folder), 4, 5000)
    ids = V.index(docs(spark, folder), "doc_id", K.words(C("text")), vocab, 0)
    return ids.select("doc_id", F.array_join("ids", " ").alias("ids"))


@query("j05_key_set_check", f"""
WITH h AS (SELECT DISTINCT conv_id FROM conversations WHERE role = 'user'), r AS (SELECT DISTINCT conv_id FROM conversations WHERE role = 'assistant')
SELECT 'both' AS side, count(*)::BIGINT AS n FROM h JOIN r USING (conv_id)
UNION ALL SELECT 'left', count(*)::BIGINT FROM h ANTI JOIN r USING (conv_id)
UNION ALL SELECT 'right', count(*)::BIGINT FROM r ANTI JOIN h USING (conv_id)""")
def key_set_check(spark, folder):
    t = turns(spark, folder)
    hyp = t.where(C("role") == "user").select("conv_id").distinct()
    ref = t.where(C("role") == "assistant").select("conv_id").distinct()
    both = hyp.join(ref, "conv_id").agg(F.lit("both").alias("side"), F.count(F.lit(1)).alias("n"))
    odd = pairing.key_mismatches(hyp, ref, "conv_id")
    sides = [odd.where(C("side") == s).agg(F.lit(s).alias("side"), F.count(F.lit(1)).alias("n")) for s in ("left", "right")]
    return both.unionByName(sides[0]).unionByName(sides[1])


@query("j07_skip_done", "SELECT doc_id, source FROM documents ANTI JOIN labels USING (doc_id)")
def skip_done(spark, folder):
    done = table(spark, folder, "labels").select("doc_id")
    return docs(spark, folder).select("doc_id", "source").join(done, "doc_id", "left_anti")


@query("j08_script_not_found", """
SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'script_not_found' WHEN l.quality = 1 THEN 'success' ELSE 'failure' END AS status
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def script_not_found(spark, folder):
    found = table(spark, folder, "labels").select(
        "doc_id", F.when(C("quality") == 1, "success").otherwise("failure").alias("status"))
    return docs(spark, folder).select("doc_id").join(found, "doc_id", "left").select(
        "doc_id", F.coalesce("status", F.lit("script_not_found")).alias("status"))


@query("j10_known_words", f"""
WITH v AS (SELECT token FROM {vocab_sql(0, 300)}), t AS (SELECT unnest({S.words('tgt')}) AS token FROM {PAIRS_SQL})
SELECT token, count(*)::BIGINT AS n FROM t SEMI JOIN v USING (token) GROUP BY token ORDER BY n DESC, token LIMIT 50""")
def known_words(spark, folder):
    vocab = V.assign_ids(doc_counts(spark, folder), 0, 300)
    counts = V.corpus_counts(pairs(spark, folder), K.words(C("tgt")))
    known = counts.join(vocab.select("token"), "token", "left_semi")
    return V.top_tokens(known, 50)


@query("j11_copy_score_cells", f"""
WITH c AS (SELECT token, count(*) AS n FROM (SELECT unnest({S.words('tgt')}) AS token FROM {PAIRS_SQL}) GROUP BY token),
v AS {vocab_sql(2, 200, 'c')},
d AS (SELECT conv_id, turn, list_transform(list_filter(range(1, len(s) + 1), lambda i: list_position(s, s[i]) = i), lambda i: s[i]) AS u
      FROM (SELECT conv_id, turn, {S.words('src')} AS s FROM {PAIRS_SQL})),
e AS (SELECT conv_id, turn, unnest(u) AS token, generate_subscripts(u, 1) + 1 AS i FROM d)
SELECT conv_id, turn, (202 + i)::BIGINT AS blank, v.id::BIGINT AS fill FROM e JOIN v USING (token)""")
def copy_score_cells(spark, folder):
    # the row vocabulary starts with the unknown and padding words, which never match
    p = pairs(spark, folder)
    target = V.assign_ids(V.corpus_counts(p, K.words(C("tgt"))), 2, 200)
    own = p.select("conv_id", "turn", F.posexplode(F.array_distinct(K.words(C("src")))).alias("i", "token"))
    hit = V.skewed_lookup(own, target.select("token", "n", "id"), "token", "n").drop("n")
    return hit.select("conv_id", "turn", (C("i") + 2 + 202).cast("long").alias("blank"), C("id").alias("fill"))


@query("j12_replace_mismatches", f"""
WITH b AS (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) AS nth FROM {PAIRS_SQL} WHERE left(src, 1) <> left(tgt, 1)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS nth FROM documents)
SELECT conv_id, turn, doc_id AS replacement FROM b LEFT JOIN r USING (nth)""")
def replace_mismatches(spark, folder):
    p = pairs(spark, folder).select("conv_id", "turn", F.left("src", F.lit(1)).alias("a"), F.left("tgt", F.lit(1)).alias("b"))
    spare = docs(spark, folder).select(C("doc_id").alias("replacement"))
    fixed = pairing.replace_mismatches(p, C("a") != C("b"), ["conv_id", "turn"], spare, ["replacement"])
    return fixed.select("conv_id", "turn", "replacement")


@query("j13_dictionary_differences", f"""
WITH a AS (SELECT token, count(*) AS n FROM (SELECT unnest({S.words('src')}) AS token FROM {PAIRS_SQL}) GROUP BY token),
b AS (SELECT token, count(*) AS n FROM (SELECT unnest({S.words('tgt')}) AS token FROM {PAIRS_SQL}) GROUP BY token),
x AS {vocab_sql(14, None, 'a')}, y AS {vocab_sql(14, None, 'b')}
SELECT id::BIGINT AS id, x.token AS left_token, y.token AS right_token FROM x FULL JOIN y USING (id)
WHERE NOT (x.token IS NOT DISTINCT FROM y.token AND x.n IS NOT DISTINCT FROM y.n)""")
def dictionary_differences(spark, folder):
    p = pairs(spark, folder)
    left, right = (V.assign_ids(V.corpus_counts(p, K.words(C(c))), 14) for c in ("src", "tgt"))
    return pairing.dictionary_differences(left, right)

"""Registered queries: filters (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays as A, text as T, tokens as K
from ..operators import filters as P
from ..session import fresh_path, table
from ..sources import sinks as O
from . import sql as S
from .registry import query

C = F.col


def docs(spark, folder):
    return table(spark, folder, "documents")


def talk(spark, folder):
    return table(spark, folder, "conversations")


@query("f01_corpus_files", """
SELECT page_id, url FROM pages WHERE NOT (html LIKE '%<meta name%') AND url LIKE '%ref=x'""")
def corpus_files(spark, folder):
    binary = F.contains(C("html"), F.lit("<meta name"))
    return P.corpus_files(table(spark, folder, "pages"), binary, C("url"), "ref=x").select("page_id", "url")


@query("f02_min_distinct_names", f"""
SELECT doc_id, len(list_distinct({S.words('text')}))::BIGINT AS n_names FROM documents
WHERE len(list_distinct({S.words('text')})) >= 30""")
def min_distinct_names(spark, folder):
    names = K.words(C("text"))
    return P.min_distinct(docs(spark, folder), names, 30).select(
        "doc_id", F.size(F.array_distinct(names)).cast("long").alias("n_names"))


@query("f03_short_comment", """
SELECT doc_id, pos, line FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS pos
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)) WHERE length(line) > 3""")
def short_comment(spark, folder):
    rows = docs(spark, folder).select("doc_id", F.posexplode(K.lines(C("text"))).alias("pos", "line"))
    return P.longer_than(rows, C("line"), 3).select("doc_id", C("pos").cast("long").alias("pos"), "line")


_FOOT = "nullif(regexp_extract(html, '<h1>(.*?)</h1>', 1), '')"


@query("f04_has_docstring", f"SELECT page_id, {_FOOT} AS docstring FROM pages WHERE {_FOOT} IS NOT NULL")
def has_docstring(spark, folder):
    doc = F.regexp_extract("html", "(?d)<h1>(.*?)</h1>", 1)
    return P.not_blank(table(spark, folder, "pages").select("page_id", doc.alias("docstring")), C("docstring"))


@query("f05_quarantine", """
SELECT page_id, instr(html, '</body>') = 0 AS failed,
  sum(CASE WHEN instr(html, '</body>') = 0 THEN 1 ELSE 0 END) OVER ()::BIGINT AS n_failed FROM pages""")
def quarantine(spark, folder):
    pages = table(spark, folder, "pages").withColumn("failed", F.instr("html", "</body>") == 0)
    good, bad = P.quarantine(pages.select("page_id", "failed"), C("failed"))
    n_failed = pages.agg(F.count_if("failed").alias("n")).scalar()
    return good.unionByName(bad).withColumn("n_failed", n_failed)


@query("f05_counted_quarantine", """
SELECT page_id, instr(html, '</body>') = 0 AS failed, sum(CASE WHEN instr(html, '</body>') = 0 THEN 1 ELSE 0 END) OVER ()::BIGINT AS n_failed,
  count(*) OVER ()::BIGINT AS n_rows FROM pages""")
def counted_quarantine(spark, folder):
    pages = table(spark, folder, "pages")
    good, bad, counted = O.write_quarantined(pages, F.instr("html", "</body>") == 0, fresh_path(spark, "quarantine"))
    rows = good.select("page_id", F.lit(False).alias("failed")).unionByName(bad.select("page_id", F.lit(True).alias("failed")))
    return rows.select("page_id", "failed", F.lit(counted["failed"]).cast("long").alias("n_failed"), F.lit(counted["rows"]).cast("long").alias("n_rows"))


@query("f06_length_agreement", f"""
WITH t AS (SELECT conv_id, turn, {S.words('text')} AS src, string_split(text, ' ') AS tag FROM conversations)
SELECT conv_id, turn, len(src)::BIGINT AS n FROM t WHERE len(src) = len(tag)""")
def length_agreement(spark, folder):
    t = talk(spark, folder).select("conv_id", "turn", K.words(C("text")).alias("src"), F.split("text", " ").alias("tag"))
    return P.same_length(t, C("src"), C("tag")).select("conv_id", "turn", F.size("src").cast("long").alias("n"))


@query("f06_matrix_agreement", f"""
WITH l AS (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line, len(string_split(text, chr(10))) AS n_lines, {S.words('text')} AS src FROM conversations),
m AS (SELECT conv_id, turn, greatest(any_value(n_lines), max(len(string_split(line, ' ')))) AS n, any_value(len(src)) AS n_src FROM l GROUP BY conv_id, turn)
SELECT count(*) FILTER (WHERE n <> n_src)::BIGINT AS violations, count(*)::BIGINT AS checked FROM m WHERE n_src > 0""")
def matrix_agreement(spark, folder):
    # the lines of a turn as a relation matrix: it fits the words only if it is as wide as there are words
    t = talk(spark, folder).select(K.words(C("text")).alias("src"), A.parse_matrix(F.to_json(F.split("text", "\n"))).alias("rel"))
    off = (F.size("rel") != F.size("src")) | F.exists("rel", lambda row: F.size(row) != F.size("src"))
    return P.drop_empty(t, C("src")).agg(F.count_if(off).alias("violations"), F.count(F.lit(1)).alias("checked"))


_HEAD = "regexp_extract(text, '^([^.]*)\\.', 1)"
_TAIL = "regexp_replace(text, '^[^.]*\\.', '')"


@query("f07_empty_examples", f"""
SELECT conv_id, turn, len({S.words(_HEAD)})::BIGINT AS n_src, len({S.words(_TAIL)})::BIGINT AS n_tgt FROM conversations
WHERE len({S.words(_HEAD)}) > 0 AND len({S.words(_TAIL)}) > 0""")
def empty_examples(spark, folder):
    t = talk(spark, folder).select(
        "conv_id", "turn", K.words(F.regexp_extract("text", r"^([^.]*)\.", 1)).alias("src"),
        K.words(F.regexp_replace("text", r"^[^.]*\.", "")).alias("tgt"))
    return P.drop_empty(t, C("src"), C("tgt")).select(
        "conv_id", "turn", F.size("src").cast("long").alias("n_src"), F.size("tgt").cast("long").alias("n_tgt"))


@query("f08_empty_sequences", f"""
SELECT conv_id, turn, len(w)::BIGINT AS n FROM (
  SELECT conv_id, turn, list_filter({S.words('text')}, lambda t: length(t) > 9) AS w FROM conversations) WHERE len(w) > 0""")
def empty_sequences(spark, folder):
    long_words = F.filter(K.words(C("text")), lambda t: F.length(t) > 9)
    return P.drop_empty(talk(spark, folder).select("conv_id", "turn", long_words.alias("w")), C("w")).select(
        "conv_id", "turn", F.size("w").cast("long").alias("n"))


@query("f09_long_sequences", f"""
SELECT 'max100' AS rule, count(*) FILTER (WHERE n <= 100)::BIGINT AS kept FROM (SELECT len({S.words('text')}) AS n FROM documents)
UNION ALL SELECT 'off', count(*)::BIGINT FROM documents""")
def long_sequences(spark, folder):
    d = docs(spark, folder).select(K.words(C("text")).alias("w"))
    kept = [(name, P.drop_long(d, most, C("w"))) for name, most in (("max100", 100), ("off", 0))]
    counts = [k.agg(F.lit(n).alias("rule"), F.count(F.lit(1)).alias("kept")) for n, k in kept]
    return counts[0].unionByName(counts[1])


@query("f10_class_and_size", f"""
SELECT d.doc_id, l.quality::BIGINT AS quality, len({S.words('text')})::BIGINT AS n_words FROM documents d JOIN labels l USING (doc_id)
WHERE l.quality <> 0 AND len({S.words('text')}) <= 400 AND n_chars <= 3000""")
def class_and_size(spark, folder):
    d = docs(spark, folder).select("doc_id", "n_chars", F.size(K.words(C("text"))).alias("n_words"))
    rows = d.join(table(spark, folder, "labels"), "doc_id")
    return P.class_and_size(rows, C("quality"), 0, [C("n_words"), C("n_chars"), C("toxic")], [400, 3000, None]).select(
        "doc_id", C("quality").cast("long").alias("quality"), C("n_words").cast("long").alias("n_words"))


@query("f11_class", "SELECT doc_id, quality::BIGINT AS quality FROM labels WHERE toxic <> 1")
def class_filter(spark, folder):
    rows = P.class_and_size(table(spark, folder, "labels"), C("toxic"), 1, [], [])
    return rows.select("doc_id", C("quality").cast("long").alias("quality"))


@query("f12_sentence_count", """
SELECT doc_id, len(string_split_regex(text, '\\. '))::BIGINT AS sentences FROM documents
WHERE len(string_split_regex(text, '\\. ')) <= 12""")
def sentence_count(spark, folder):
    return P.at_most_sentences(docs(spark, folder), C("text"), r"\. ", 12).select(
        "doc_id", F.size(F.split("text", r"\. ")).cast("long").alias("sentences"))


_CODELIKE = [("The ", "print x"), ("and.", ". iteritems ( )"), (" eine ", " raise xx , "), ("Les ", "k = 12 L")]


@query("f13_dialect", f"""
SELECT doc_id FROM (SELECT doc_id, {S.replaces('text', _CODELIKE)} AS code FROM documents) WHERE NOT (""" +
       " OR ".join([f"regexp_matches(code, {S.q(p)})" for p in T.PYTHON2_PATTERNS] +
                   [f"contains(code, {S.q(p)})" for p in T.PYTHON2_PHRASES]) + ")")
def dialect(spark, folder):
    code = docs(spark, folder).select("doc_id", T.replace_all(C("text"), _CODELIKE).alias("code"))
    return P.modern_python(code, C("code")).select("doc_id")


@query("f14_too_little_text", r"""
SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, '. ')) AS line FROM documents)
WHERE length(regexp_replace(line, '[^\p{L}\p{N}_]', '', 'g')) >= 5""")
def too_little_text(spark, folder):
    rows = docs(spark, folder).select("doc_id", F.explode(F.split("text", r"\. ")).alias("line"))
    return P.enough_words(rows, C("line"), 5)


@query("f15_length_outliers", "SELECT doc_id, n_chars FROM documents WHERE length(text) < 10000")
def length_outliers(spark, folder):
    return docs(spark, folder).where(F.length("text") < 10000).select("doc_id", "n_chars")


@query("f16_quote_parity", """
SELECT doc_id, (length(b) - length(replace(b, '"', ''))) % 2 = 0 AND (length(b) - length(replace(b, '''', ''))) % 2 = 0 AS balanced
FROM (SELECT doc_id, CASE WHEN instr(text, '#') > 0 THEN left(text, instr(text, '#') - 1) ELSE text END AS b FROM documents)""")
def quote_parity(spark, folder):
    return docs(spark, folder).select("doc_id", T.quotes_balanced(F.substring_index("text", "#", 1)).alias("balanced"))


@query("f17_has_text", f"""
SELECT doc_id, count(*)::BIGINT AS tokens, count(*) FILTER (WHERE length({S.strip(S.no_punct('w'))}) > 0)::BIGINT AS with_text
FROM (SELECT doc_id, unnest({S.words('text')}) AS w FROM documents) GROUP BY doc_id""")
def has_text(spark, folder):
    rows = docs(spark, folder).where(C("text").rlike(f"[^{K.SPACE[1:]}")).select("doc_id", K.words(C("text")).alias("w"))
    return rows.select("doc_id", F.size("w").cast("long").alias("tokens"),
                       F.size(F.filter("w", T.has_text)).cast("long").alias("with_text"))


_ONLY_MARKS = r"regexp_replace(text, '[^#$%&*]', '', 'g')"


@query("f18_empty_results", f"SELECT doc_id, {_ONLY_MARKS} AS marks FROM documents WHERE {_ONLY_MARKS} <> ''")
def empty_results(spark, folder):
    marks = docs(spark, folder).select("doc_id", F.regexp_replace("text", "[^#$%&*]", "").alias("marks"))
    return P.nonempty_tokens(marks, C("marks"))


@query("f19_special_ids", f"""
SELECT doc_id, array_to_string(list_filter(list_transform({S.words('text')}, lambda w: length(w)), lambda i: i >= 14 OR i = 3), ' ') AS ids
FROM documents""")
def special_ids(spark, folder):
    ids = F.transform(K.words(C("text")), F.length)  # word lengths stand for ids
    return docs(spark, folder).select("doc_id", F.array_join(P.without_specials(ids, 3, 14), " ").alias("ids"))


@query("f20_neutral_excluded", """
SELECT count(*)::BIGINT AS n, sum(CASE WHEN c > 2 THEN 1 ELSE 0 END)::BIGINT AS target_sum
FROM (SELECT quality * 2 + toxic AS c FROM labels) WHERE c <> 2""")
def neutral_excluded(spark, folder):
    c = (C("quality") * 2 + C("toxic")).alias("c")
    rows = table(spark, folder, "labels").select(c).where(C("c") != 2)
    return rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.count_if(C("c") > 2), F.lit(0)).alias("target_sum"))

"""Registered queries: sources, sinks (S), streaming (T) and plug-in surfaces (D).

Sources are checked by writing the given tables out in the source format below
the shared folder and reading them back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays as A, tokens as K
from ..operators import scoring as R, splits as P, vocab as V
from ..session import durable, fresh_path, staged, table
from ..sources import readers as I, sinks as O
from ..streaming import jobs as J
from . import sql as S
from .common import DOC_COUNTS_SQL, PAIRS_SQL, as_long, doc_counts, docs, pairs, turns, vocab_sql
from .registry import query
from .scores import F1_SQL, GRAMS, _sql_bleu, predictions
from .windows import _SPLIT

C = F.col


@query("s01_source_tree", """
SELECT source, count(*)::BIGINT AS lines, sum(length(line))::BIGINT AS chars, 0::BIGINT AS unreadable FROM
  (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY source""")
def source_tree(spark, folder):
    lines = docs(spark, folder).select("source", F.explode(K.lines(C("text"))).alias("value"))
    root = O.write_text_lines(lines, fresh_path(spark, "tree"), "source", lines_per_file=100_000)
    files = I.read_source_tree(spark, root, "*.txt").withColumn("source", F.regexp_extract("path", "source=([^/]+)/", 1))
    text = files.select("source", "valid", F.explode_outer(K.lines(F.regexp_replace("content", r"\n\z", ""))).alias("line"))
    return text.groupBy("source").agg(F.count("line").alias("lines"), F.sum(F.length("line")).alias("chars"),
                                      F.count_if(~C("valid")).alias("unreadable"))


@query("s02_gzip_json_lines", """
SELECT source || '/tree/master/doc' || doc_id || '.py' AS file, source AS repo_name, text AS content FROM documents""")
def gzip_json_lines(spark, folder):
    record = docs(spark, folder).select(C("source").alias("repo_name"), F.lit("refs/heads/master").alias("ref"),
                                        F.concat(F.lit("doc"), C("doc_id").cast("string"), F.lit(".py")).alias("path"),
                                        C("text").alias("content"))
    path = O.write_json_lines(record, fresh_path(spark, "json"), compress=True)
    return I.read_json_files(spark, path, spark.sparkContext.defaultParallelism).select("file", "repo_name", "content")


@query("s03_parallel_lines", f"""
SELECT (row_number() OVER (ORDER BY conv_id, turn) - 1)::BIGINT AS line_no, {S.collapse('src')} AS src, {S.collapse('tgt')} AS tgt,
  NULL::VARCHAR AS tag, 0::BIGINT AS unequal FROM {PAIRS_SQL}""")
def parallel_lines(spark, folder):
    # both files are written from the same frozen rows, so their lines correspond
    p = durable(pairs(spark, folder).select("conv_id", "turn", K.collapse_space(C("src")).alias("src"), K.collapse_space(C("tgt")).alias("tgt"))
                .repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn"))
    paths = {n: O.write_text_lines(p.select(n), fresh_path(spark, n)) for n in ("src", "tgt")}
    rows = I.read_parallel(spark, {**paths, "tag": None})
    odd = I.unequal_lines(rows, ["src", "tgt"]).agg(F.count(F.lit(1))).scalar()
    return rows.withColumn("unequal", odd)


@query("s04_labelled_folders", """
SELECT CASE WHEN l.quality = 1 THEN 'pos' ELSE 'neg' END AS label, replace(text, chr(10), ' ') AS text FROM documents d JOIN labels l USING (doc_id)""")
def labelled_folders(spark, folder):
    rows = docs(spark, folder).select("doc_id", "text").join(table(spark, folder, "labels"), "doc_id").withColumn(
        "line", F.replace(C("text"), F.lit("\n"), F.lit(" ")))
    root = fresh_path(spark, "labelled")
    for label, quality in (("pos", 1), ("neg", 0)):
        O.write_text_lines(rows.where(C("quality") == quality).select("line"), f"{root}/{label}")
    return I.read_labelled_folders(spark, root)


_SPACED_COUNTS = "(SELECT token, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS token FROM documents) GROUP BY token)"


def _vocabulary_file(spark, folder):
    """Space-cut tokens and counts as lines; tokens that hold a line break make malformed and repeated lines."""
    counts = V.corpus_counts(docs(spark, folder), F.split("text", " "))
    ordered = counts.repartitionByRange(C("n").desc(), "token").sortWithinPartitions(C("n").desc(), "token")
    return O.write_text_lines(ordered.select(F.concat_ws(" ", "token", "n").alias("value")), fresh_path(spark, "vocab"))


_LINES_SQL = f"""ls AS (SELECT unnest(l) AS line, generate_subscripts(l, 1) AS sub, r FROM (
  SELECT string_split(token || ' ' || n, chr(10)) AS l, row_number() OVER (ORDER BY n DESC, token) AS r FROM {_SPACED_COUNTS})),
nl AS (SELECT line, row_number() OVER (ORDER BY r, sub) - 1 AS line_no FROM ls)"""


@query("s05_vocabulary_file", f"""
WITH {_LINES_SQL}, f AS (SELECT line_no, {S.words('line')} AS f FROM nl),
u AS (SELECT f[1] AS token, min(line_no) AS line_no, arg_min(f[2], line_no) AS n FROM f WHERE len(f) = 2 GROUP BY 1)
SELECT token, n::BIGINT AS n, (14 + row_number() OVER (ORDER BY line_no) - 1)::BIGINT AS id FROM u""")
def vocabulary_file(spark, folder):
    lines = I.read_numbered_lines(spark, _vocabulary_file(spark, folder))
    return I.parse_vocabulary(lines, A.CORPUS_IDS, 14)


@query("s06_frequent_words", f"""
SELECT DISTINCT token FROM {DOC_COUNTS_SQL} WHERE n >= 20""")
def frequent_words(spark, folder):
    counts = doc_counts(spark, folder).select(F.concat_ws(" ", "token", "n").alias("value"))
    path = O.write_text_lines(counts, fresh_path(spark, "words"))
    return I.parse_frequent_words(spark.read.option("lineSep", "\n").text(path).withColumnRenamed("value", "line"), 20)


@query("s07_merge_file", f"""
WITH p AS (SELECT substr(token, 1, 1) AS "left", substr(token, 2, 1) AS "right", n, token FROM {DOC_COUNTS_SQL} WHERE length(token) >= 2),
r AS (SELECT "left", "right", row_number() OVER (ORDER BY n DESC, token) - 1 AS rank FROM p)
SELECT "left", "right", min(rank)::BIGINT AS rank FROM r WHERE rank < 500 GROUP BY ALL""")
def merge_file(spark, folder):
    # word beginnings by frequency: a merge list with many repeated pairs
    heads = doc_counts(spark, folder).where(F.length("token") >= 2).select(
        F.substring("token", 1, 1).alias("a"), F.substring("token", 2, 1).alias("b"), "n", "token")
    lines = heads.select(F.lit(1).alias("part"), "n", "token", F.concat_ws(" ", "a", "b").alias("value"))
    header = spark.range(1).select(F.lit(0).alias("part"), F.lit(0).cast("long").alias("n"), F.lit("").alias("token"), F.lit("#version: 0.2").alias("value"))
    keys = ["part", C("n").desc(), "token"]
    ordered = header.unionByName(lines).repartitionByRange(*keys).sortWithinPartitions(*keys)
    path = O.write_text_lines(ordered.select("value"), fresh_path(spark, "merges"))
    return I.parse_merges(I.read_numbered_lines(spark, path), 500)


@query("s08_embedding_words", """
SELECT DISTINCT 'v' || (vec_id // 2) || '_' || label AS token FROM embeddings UNION ALL SELECT unnest(['<s>', '</s>', '<blank>', '<unk>'])""")
def embedding_words(spark, folder):
    word = F.concat(F.lit("v"), F.floor(C("vec_id") / 2).cast("string"), F.lit("_"), C("label").cast("string"))
    line = F.concat_ws(" ", word, F.array_join(F.transform("embedding", lambda x: x.cast("string")), " "))
    path = O.write_text_lines(table(spark, folder, "embeddings").select(line.alias("value")), fresh_path(spark, "embeddings"))
    lines = spark.read.option("lineSep", "\n").text(path).withColumnRenamed("value", "line")
    return I.embedding_words(lines, ["<s>", "</s>", "<blank>", "<unk>"])


_FLAT = "replace(text, chr(10), ' ')"


@query("s09_generation_log", f"""
SELECT conv_id * 1000 + turn AS id, CASE role WHEN 'user' THEN 'S' WHEN 'assistant' THEN 'H' ELSE 'T' END AS kind, {_FLAT} AS text FROM conversations""")
def generation_log(spark, folder):
    kind = F.when(C("role") == "user", "S").when(C("role") == "assistant", "H").otherwise("T")
    key = (C("conv_id") * 1000 + C("turn")).cast("string")
    score = F.when(C("role") == "assistant", F.lit("-0.5\t")).otherwise("")
    line = F.concat(kind, F.lit("-"), key, F.lit("\t"), score, F.replace(C("text"), F.lit("\n"), F.lit(" ")))
    path = O.write_text_lines(turns(spark, folder).select(line.alias("value")), fresh_path(spark, "log"))
    lines = spark.read.option("lineSep", "\n").text(path).withColumnRenamed("value", "line")
    parts = [I.split_generation_log(lines, k, n).withColumn("kind", F.lit(k)) for k, n in (("S", 1), ("T", 1), ("H", 2))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).orderBy("id")


_HOST = "regexp_extract(url, '^https?://([^/]+)', 1)"


@query("s10_name_language", f"""
SELECT page_id, CASE WHEN len(string_split({_HOST}, '.')) >= 3 THEN string_split({_HOST}, '.')[2] END AS language FROM pages""")
def name_language(spark, folder):
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    return table(spark, folder, "pages").select("page_id", I.file_language(host).alias("language"))


@query("s11_numbered_records", """
SELECT source || '_number_' || generate_subscripts(l, 1) AS repo_name, 'refs/heads/master' AS ref, 'doc' || doc_id AS path, unnest(l) AS content
FROM (SELECT source, doc_id, string_split(text, chr(10)) AS l FROM documents)""")
def numbered_records(spark, folder):
    files = docs(spark, folder).select("source", F.concat(F.lit("doc"), C("doc_id").cast("string")).alias("path"), "text")
    path = O.write_json_lines(O.numbered_records(files, "source", "path", K.lines(C("text"))), fresh_path(spark, "records"))
    return spark.read.schema(I.SOURCE_FILE).json(path)


@query("s12_text_sinks", f"""
SELECT 'words' AS kind, count(*)::BIGINT AS lines, sum(length({S.collapse('text')}))::BIGINT AS chars FROM documents
UNION ALL SELECT 'sentence', count(*)::BIGINT, sum(length(string_split(replace(text, chr(10), ' '), '.')[1]))::BIGINT FROM documents""")
def text_sinks(spark, folder):
    d = docs(spark, folder)
    kinds = [d.select(F.lit("words").alias("kind"), K.collapse_space(C("text")).alias("value")),
             d.select(F.lit("sentence").alias("kind"), F.substring_index(F.replace(C("text"), F.lit("\n"), F.lit(" ")), ".", 1).alias("value"))]
    path = O.write_text_lines(kinds[0].unionByName(kinds[1]), fresh_path(spark, "kinds"), "kind")
    back = spark.read.option("lineSep", "\n").text(path)
    return back.groupBy("kind").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).alias("chars"))


@query("s13_prediction_report", f"""
WITH {GRAMS}, {F1_SQL[len(F1_SQL.split('ref AS')[0]):]}
SELECT st.id, array_to_string(pred.h, ' ') AS hyp, round({_sql_bleu(True)}, 6) AS bleu, round(best.f, 6) AS f1
FROM st JOIN pred USING (id) JOIN best USING (id)""")
def prediction_report(spark, folder):
    p = predictions(spark, folder)
    bleu = R.overlap_statistics(p).select("id", F.round(R.bleu(True), 6).alias("bleu"))
    f1 = R.token_f1(p).select("id", F.round("f1", 6).alias("f1"))
    report = p.join(bleu, "id").join(f1, "id")
    path = O.write_json_lines(report, fresh_path(spark, "report"))
    return spark.read.schema("id bigint, hyp string, refs array<string>, bleu double, f1 double").json(path).drop("refs")


@query("s14_tsv_sink", r"""
SELECT trim(regexp_replace(replace(replace(text, chr(10), ' '), chr(9), ' '), ' +', ' ', 'g')) AS text, quality::BIGINT AS label FROM documents JOIN labels USING (doc_id)""")
def tsv_sink(spark, folder):
    rows = docs(spark, folder).select("doc_id", "text").join(table(spark, folder, "labels"), "doc_id")
    line = O.tsv_line(F.replace(C("text"), F.lit("\n"), F.lit(" ")), C("quality"))
    path = O.write_text_lines(rows.select(line.alias("value")), fresh_path(spark, "tsv"))
    cut = F.split("value", "\t")
    return spark.read.option("lineSep", "\n").text(path).select(
        F.get(cut, F.lit(0)).alias("text"), F.get(cut, F.lit(1)).cast("long").alias("label"))


@query("s15_index_sink", f"""
WITH v AS (SELECT token, id FROM {vocab_sql(14, 3000)}), t AS (SELECT unnest({S.words('text')}) AS token FROM documents)
SELECT 'tokens' AS stat, count(*)::BIGINT AS n FROM t UNION ALL SELECT 'unknown', count(*)::BIGINT FROM t ANTI JOIN v USING (token)
UNION ALL SELECT 'unknown_words', count(DISTINCT token)::BIGINT FROM t ANTI JOIN v USING (token)
UNION ALL SELECT 'id_sum', sum(coalesce(id, 3))::BIGINT FROM t LEFT JOIN v USING (token)""")
def index_sink(spark, folder):
    counts = staged(doc_counts(spark, folder), "counts")  # read for the vocabulary and for the unknown words
    vocab = V.assign_ids(counts, 14, 3000)
    unknown = counts.join(vocab.select("token"), "token", "left_anti")
    path = O.write_index(V.index(docs(spark, folder), "doc_id", K.words(C("text")), vocab, 3), unknown, fresh_path(spark, "index"))
    ids = spark.read.parquet(f"{path}/sentences").select(F.explode("ids").alias("id"))
    stats = ids.agg(F.count(F.lit(1)).alias("tokens"), F.count_if(C("id") == 3).alias("unknown"), F.sum("id").alias("id_sum"))
    words = spark.read.parquet(f"{path}/unknown").agg(F.count(F.lit(1)).alias("unknown_words"))
    rows = [stats.select(F.lit(n).alias("stat"), C(n).alias("n")) for n in ("tokens", "unknown", "id_sum")]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(words.select(F.lit("unknown_words").alias("stat"), C("unknown_words").alias("n")))


@query("s16_shard_sink", f"""
WITH {_SPLIT} SELECT split, least(coalesce(shard, 0), 7)::BIGINT AS shard, count(*)::BIGINT AS n, sum(doc_id)::BIGINT AS id_sum FROM k
GROUP BY ALL""")
def shard_sink(spark, folder):
    shards = P.train_valid_test(docs(spark, folder).select("doc_id"), "doc_id", "w2", 20).na.fill(0, ["shard"])
    rows = docs(spark, folder).select("doc_id", "text").join(shards, "doc_id")
    path = O.write_shards(rows, fresh_path(spark, "shards"))
    return spark.read.parquet(path).groupBy("split", as_long("shard")).agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("id_sum"))


@query("s17_mismatch_report", f"""
SELECT conv_id * 1000 + turn AS id, left(src, 20) AS phrase, left(tgt, 20) AS sentiment FROM (
  SELECT conv_id, turn, {S.collapse('src')} AS src, {S.collapse('tgt')} AS tgt FROM {PAIRS_SQL}) WHERE left(src, 1) <> left(tgt, 1)""")
def mismatch_report(spark, folder):
    p = pairs(spark, folder).select((C("conv_id") * 1000 + C("turn")).alias("id"), K.collapse_space(C("src")).alias("s"), K.collapse_space(C("tgt")).alias("t"))
    odd = p.where(F.left("s", F.lit(1)) != F.left("t", F.lit(1))).select("id", F.left("s", F.lit(20)).alias("phrase"), F.left("t", F.lit(20)).alias("sentiment"))
    path = fresh_path(spark, "mismatch")
    options = {"sep": "\t", "header": "true", "quote": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    odd.write.options(**options).csv(path)
    return spark.read.options(**options).schema("id bigint, phrase string, sentiment string").csv(path)


@query("s18_missing_shards", f"""
WITH {_SPLIT}, m AS (SELECT DISTINCT lang AS name, split, least(coalesce(shard, 0), 7) AS shard FROM k),
x AS (SELECT n AS name, s.split, unnest(range(0, s.k)) AS shard FROM (VALUES ('en'), ('fr'), ('de'), ('es'), ('it')) l(n), (VALUES ('train', 8), ('valid', 1), ('test', 1)) s(split, k))
SELECT name, split, shard::BIGINT AS shard FROM x ANTI JOIN m USING (name, split, shard)""")
def missing_shards(spark, folder):
    shards = P.train_valid_test(docs(spark, folder).select("doc_id"), "doc_id", "w2", 20).na.fill(0, ["shard"])
    manifest = docs(spark, folder).select("doc_id", C("lang").alias("name")).join(shards, "doc_id").select("name", "split", "shard").distinct()
    gaps = O.missing_shards(spark, ["en", "fr", "de", "es", "it"], {"train": 8, "valid": 1, "test": 1}, manifest)
    return gaps.withColumn("shard", as_long("shard"))


@query("s19_document_lines", f"""
SELECT '<DOCUMENT_ID="' || source || '/tree/master/' || doc_id || '"> ' || {S.collapse('text')} || ' </DOCUMENT>' AS line FROM documents WHERE len({S.words('text')}) > 0""")
def document_lines(spark, folder):
    path = F.concat_ws("/", "source", F.lit("tree/master"), "doc_id")
    return docs(spark, folder).where(F.size(K.words(C("text"))) > 0).select(O.document_line(path, C("text")).alias("line"))


@query("t01_incremental_ingest", f"SELECT doc_id, source, len({S.words('text')})::BIGINT AS n_tokens FROM documents")
def incremental_ingest(spark, folder):
    output, checkpoint = fresh_path(spark, "ingest"), fresh_path(spark, "ingest-state")
    schema = spark.read.parquet(f"{folder}/documents.parquet").schema
    arrivals = f"{folder}/{{documents.parquet}}"  # one file or a folder of files: only as a pattern a stream takes both
    for _ in range(2):  # the second run finds nothing new
        J.ingest_new_files(J.file_stream(spark, arrivals, schema, "*"), output, checkpoint)
    return spark.read.parquet(output).select("doc_id", "source", F.size("tokens").cast("long").alias("n_tokens"))


@query("t02_running_statistics", f"""
SELECT source, count(*)::BIGINT AS records, sum(len({S.words('text')}))::BIGINT AS tokens, count(*) FILTER (WHERE len({S.words('text')}) < 30)::BIGINT AS rejected
FROM documents GROUP BY source""")
def running_statistics(spark, folder):
    arrivals = fresh_path(spark, "arrivals")
    files = spark.sparkContext.defaultParallelism  # of each of four batches, so that all cores write and read them
    docs(spark, folder).select("source", "text").repartition(4 * files).write.parquet(arrivals)
    output = fresh_path(spark, "statistics")
    stream = J.file_stream(spark, arrivals, spark.read.parquet(arrivals).schema, files_per_batch=files)
    J.running_statistics(stream, "source", output, fresh_path(spark, "statistics-state"))
    return J.latest_statistics(spark, output)


@query("d01_tokenizer_registry", f"""
SELECT doc_id, lang, len(CASE lang WHEN 'en' THEN regexp_extract_all(text, {S.q(K.WORD_OR_SYMBOL)}) WHEN 'de' THEN
   flatten(list_transform({S.words('text')}, lambda w: string_split(w, '_'))) WHEN 'fr' THEN
   (SELECT list_filter(r, lambda t, i: t <> ' ' OR i = 1 OR i = len(r)) FROM (SELECT regexp_extract_all(text, {S.q(K.ALNUM_RUNS)}) AS r)) ELSE {S.words('text')} END)::BIGINT AS n_tokens FROM documents""")
def tokenizer_registry(spark, folder):
    registry = (K.TokenizerRegistry().register("en", K.words_and_symbols)
                .register("de", lambda t: K.code_parts(t, camel=False)).register("fr", K.alnum_runs))
    return docs(spark, folder).select("doc_id", "lang", F.size(registry.tokenize(C("lang"), C("text"))).cast("long").alias("n_tokens"))

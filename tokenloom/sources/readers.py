"""Readers for corpus files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..functions import text as T
from ..functions.tokens import words

SOURCE_FILE = "repo_name string, ref string, path string, content string"


def read_source_tree(spark: SparkSession, root: str, glob: str = "*.py") -> DataFrame:
    """(path, content, valid): every matching file below ``root`` as one row.

    Files that are not valid UTF-8 are kept with ``valid`` false and null content.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
        .select("path", "content")
    )
    valid = F.is_valid_utf8(F.col("content").cast("string"))
    return files.select("path", F.when(valid, F.decode("content", "UTF-8")).alias("content"), valid.alias("valid"))


def read_json_files(spark: SparkSession, path: str, min_tasks: int | None = None) -> DataFrame:
    """(repo_name, path, content, file): gzip JSON lines, with the web path of each file.

    A gzip file is read by one task, so later work is spread over ``min_tasks``
    when there are fewer files than that.
    """
    rows = spark.read.schema(SOURCE_FILE).json(path)
    if min_tasks and rows.rdd.getNumPartitions() < min_tasks:
        rows = rows.repartition(min_tasks)
    return rows.withColumn("file", F.concat_ws("/", "repo_name", F.lit("tree/master"), "path"))


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line): text lines numbered from 0 across all files in path order.

    Large files stay splittable. A scan task reads its file blocks in order, so
    the row id gives each line's place in its block; only the table of blocks
    is numbered globally. It has one row per scan split
    (``spark.sql.files.maxPartitionBytes``, 128 MB by default), so it is sent to
    the scan tasks, and lines stay where they are read.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"))
    blocks = lines.groupBy("_file", "_block").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_file", "_block").rowsBetween(W.unboundedPreceding, -1)  # one row per file block
    offsets = blocks.select("_file", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return lines.join(F.broadcast(offsets), ["_file", "_block"]).select(
        (F.col("_offset") + F.col("_row") - F.col("_first")).alias("line_no"), "line")


def read_parallel(spark: SparkSession, paths: dict[str, str | None]) -> DataFrame:
    """One column per name, lines joined by number; a missing path gives a null column."""
    out = None
    for name, path in paths.items():
        if path is None:
            continue
        rows = read_numbered_lines(spark, path).withColumnRenamed("line", name)
        out = rows if out is None else out.join(rows, "line_no", "full")
    for name, path in paths.items():
        if path is None:
            out = out.withColumn(name, F.lit(None).cast("string"))
    return out.select("line_no", *paths)


def unequal_lines(parallel: DataFrame, names: list[str]) -> DataFrame:
    """Lines missing on some side; empty when all files have the same length."""
    present = [F.col(n).isNull().cast("int") for n in names]
    return parallel.where(sum(present[1:], present[0]).between(1, len(names) - 1))


def read_labelled_folders(spark: SparkSession, root: str) -> DataFrame:
    """(label, text): lines of files, labelled by the folder that holds them."""
    return spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(root).select(
        T.label_of_path(F.col("_metadata.file_path")).alias("label"), F.col("value").alias("text"))


def parse_vocabulary(lines: DataFrame, specials: dict[str, int], first_id: int) -> DataFrame:
    """(token, n, id) from numbered ``word count`` lines.

    Lines without exactly two fields, repeated words and words that are special
    are skipped, and later ids move up for each of them.
    """
    from ..operators.ranking import with_global_position

    fields = lines.where(~F.contains("line", F.lit("\u2028"))).select("line_no", words(F.col("line")).alias("f"))
    valid = fields.where(F.size("f") == 2).select("line_no", F.get("f", F.lit(0)).alias("token"), F.get("f", F.lit(1)).alias("n"))
    usable = valid.where(~F.col("token").isin(list(specials)))
    first = usable.groupBy("token").agg(F.min(F.struct("line_no", "n")).alias("f")).select("token", "f.line_no", "f.n")
    placed = with_global_position(first, ["line_no"], "place")
    return placed.select("token", F.col("n").cast("long").alias("n"), (F.col("place") + first_id).alias("id"))


def parse_frequent_words(lines: DataFrame, threshold: int | None) -> DataFrame:
    """Distinct words of ``word count`` lines at or above the threshold."""
    parts = F.split(F.regexp_replace("line", r"^[\r\n ]+|[\r\n ]+$", ""), " ")
    rows = lines.select(F.get(parts, F.lit(0)).alias("token"), F.get(parts, F.lit(1)).cast("long").alias("n"))
    return (rows if threshold is None else rows.where(F.col("n") >= threshold)).select("token").distinct()


def parse_merges(lines: DataFrame, merges: int = -1) -> DataFrame:
    """(left, right, rank): at most ``merges`` lines after an optional version header; first duplicate wins."""
    header = lines.where((F.col("line_no") == 0) & F.col("line").startswith("#version:")).agg(F.count(F.lit(1))).scalar()
    body = lines.withColumn("rank", F.col("line_no") - header).where(F.col("rank") >= 0)
    if merges >= 0:
        body = body.where(F.col("rank") < merges)
    parts = F.split(F.regexp_replace("line", r"^[\r\n ]+|[\r\n ]+$", ""), " ")
    pairs = body.select("rank", parts.alias("p")).select(
        F.when(F.size("p") == 2, F.get("p", F.lit(0))).otherwise(F.raise_error(F.lit("a merge line needs two symbols"))).alias("left"),
        F.get("p", F.lit(1)).alias("right"), "rank")
    return pairs.groupBy("left", "right").agg(F.min("rank").alias("rank"))


def embedding_words(lines: DataFrame, specials: list[str]) -> DataFrame:
    """Distinct normalised first fields of embedding lines, plus the special words."""
    from ..operators.tokentables import normalise_nfd

    first = F.substring_index(F.regexp_replace("line", r"\s+$", ""), " ", 1)
    found = lines.select(first.alias("token")).distinct()
    extra = lines.sparkSession.createDataFrame([(s,) for s in specials], "token string")
    return normalise_nfd(found).unionByName(extra).distinct()


def split_generation_log(lines: DataFrame, kind: str, fields: int = 1) -> DataFrame:
    """(id, text) of log lines of one kind (S, T or H): the text after ``fields`` tab-separated fields."""
    rows = lines.where(F.col("line").rlike(f"^{kind}-[0-9]+\t"))
    cut = F.substr(F.col("line"), F.length(F.substring_index("line", "\t", fields)) + 2)
    return rows.select(F.regexp_extract("line", f"^{kind}-([0-9]+)", 1).cast("long").alias("id"), cut.alias("text"))


def file_language(name: Column) -> Column:
    return T.language_of_name(name)

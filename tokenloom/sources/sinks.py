"""Writers and checks of written output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from ..functions.tokens import collapse_space


def write_json_lines(df: DataFrame, path: str, compress: bool = False) -> str:
    df.write.json(path, compression="gzip" if compress else "none")
    return path


def numbered_records(df: DataFrame, repo: str, path: str, texts: Column) -> DataFrame:
    """One record per text, its repository name numbered from 1 within its file."""
    rows = df.select(repo, path, F.posexplode(texts).alias("pos", "content"))
    return rows.select(
        F.concat(repo, F.lit("_number_"), (F.col("pos") + 1).cast("string")).alias("repo_name"),
        F.lit("refs/heads/master").alias("ref"), path, "content")


def by_folder(df: DataFrame, *columns: str) -> DataFrame:
    """Rows gathered by output folder in write tasks of even size.

    The rebalance hint lets the adaptive planner merge small folders' rows into
    one task and split a large folder over several, by measured bytes
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``). So a folder gets about
    its bytes / that size files, however many tasks made its rows.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


def write_text_lines(df: DataFrame, path: str, kind: str | None = None, lines_per_file: int = 0) -> str:
    """One line per row; with ``kind`` one folder per value of that column."""
    writer = (by_folder(df, kind) if kind else df).write.option("lineSep", "\n")
    if lines_per_file:
        writer = writer.option("maxRecordsPerFile", lines_per_file)
    (writer.partitionBy(kind) if kind else writer).text(path)
    return path


def tsv_line(text: Column, label: Column) -> Column:
    """``text<TAB>label`` with tabs and space runs taken out of the text."""
    clean = F.trim(F.regexp_replace(F.replace(text, F.lit("\t"), F.lit(" ")), " +", " "))
    return F.concat(clean, F.lit("\t"), label.cast("string"))


def document_line(path: Column, text: Column) -> Column:
    return F.concat(F.lit('<DOCUMENT_ID="'), path, F.lit('"> '), collapse_space(text), F.lit(" </DOCUMENT>"))


def write_index(indexed: DataFrame, unknown: DataFrame, path: str) -> str:
    """Id arrays and the unknown-word counts, as two tables below ``path``."""
    indexed.write.parquet(f"{path}/sentences")
    unknown.write.parquet(f"{path}/unknown")
    return path


def write_shards(df: DataFrame, path: str) -> str:
    """Rows by split and shard, in files of even size; a large shard is written by several tasks."""
    by_folder(df, "split", "shard").write.partitionBy("split", "shard").parquet(path)
    return path


def write_quarantined(df: DataFrame, failed: Column, path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(good rows, failed rows, counters) of one pass: rows are written by verdict while the counters are kept.

    A null verdict counts as failed. Counters: ``rows`` and ``failed``.
    """
    counters, verdict = Observation(), "_failed"
    while verdict in df.columns:
        verdict += "_"
    judged = df.withColumn(verdict, F.coalesce(failed, F.lit(True)))
    judged.observe(counters, F.count(F.lit(1)).alias("rows"), F.count_if(verdict).alias("failed")).write.partitionBy(verdict).parquet(path)
    schema = StructType([*df.schema.fields, StructField(verdict, BooleanType())])
    back = df.sparkSession.read.schema(schema).parquet(path)
    return back.where(~F.col(verdict)).drop(verdict), back.where(verdict).drop(verdict), counters.get


def missing_shards(spark: SparkSession, names: list[str], shards: dict[str, int], manifest: DataFrame) -> DataFrame:
    """Expected (name, split, shard) entries that the manifest lacks."""
    cells = _cells(shards)
    expected = spark.createDataFrame([(n,) for n in names], "name string").select("name", F.explode(cells).alias("c")).select(
        "name", "c.split", "c.shard")
    return expected.join(manifest, ["name", "split", "shard"], "left_anti")


def _cells(shards: dict[str, int]) -> Column:
    return F.array(*[
        F.struct(F.lit(split).alias("split"), F.lit(i).alias("shard")) for split, n in shards.items() for i in range(n)])

"""Streaming jobs: incremental ingest, counters that can be read while a job runs, and running statistics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType

from ..functions.tokens import words

COMPACT_EVERY = 16  # batches of running statistics between two compactions


def file_stream(spark: SparkSession, folder: str, schema: StructType, glob: str = "*.parquet",
                files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def ingest_new_files(stream: DataFrame, output: str, checkpoint: str) -> None:
    """Tokenises files that earlier runs with the same checkpoint have not seen, then stops."""
    tokenised = stream.select("doc_id", "source", words(F.col("text")).alias("tokens"))
    run = (
        tokenised.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    run.awaitTermination()


class _Counters(StreamingQueryListener):
    """Adds up the observed metrics of one query and hands on the sums after every batch."""

    def __init__(self, name: str, told: Callable[[dict[str, int]], None]):
        self.name, self.told, self.sums, self.seen = name, told, {}, -1

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(self.name)
        if found is None or event.progress.batchId <= self.seen:
            return
        self.seen = event.progress.batchId
        for name, n in found.asDict().items():
            self.sums[name] = self.sums.get(name, 0) + (n or 0)
        self.told(dict(self.sums))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def prepare_counted(stream: DataFrame, failed: Column, output: str, checkpoint: str,
                    told: Callable[[dict[str, int]], None] | None = None) -> dict[str, int]:
    """Writes rows by verdict (folders ``failed=true`` and ``failed=false``) and counts them in the same pass.

    ``told`` gets the counters (``rows``, ``failed``) after every batch, while
    later ones still run; the last ones are returned. A null verdict counts as
    failed. A run with the same checkpoint goes on where the last one stopped
    and counts its own rows only.
    """
    spark, name = stream.sparkSession, "prepare_counted"
    last: dict[str, int] = {"rows": 0, "failed": 0}

    def keep(sums: dict[str, int]) -> None:
        last.update(sums)
        if told:
            told(dict(sums))

    listener = _Counters(name, keep)
    spark.streams.addListener(listener)
    try:
        judged = stream.withColumn("failed", F.coalesce(failed, F.lit(True)))
        counted = judged.observe(name, F.count(F.lit(1)).alias("rows"), F.count_if("failed").alias("failed"))
        run = (
            counted.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint)
            .partitionBy("failed").outputMode("append").trigger(availableNow=True).start()
        )
        run.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    return last


def running_statistics(stream: DataFrame, group: str, output: str, checkpoint: str, compact_every: int = COMPACT_EVERY) -> None:
    """Counters per group; each batch writes the groups it changed, as folder ``changes/batch=N``.

    The state store holds one row per group. A batch that runs again after a
    failure replaces its own folder, so nothing counts twice. Every
    ``compact_every`` batches the changes are folded into ``base/upto=N``; what
    the base before it had replaced is deleted, so readers of the last base are
    not disturbed and the number of folders stays bounded.
    """
    spark = stream.sparkSession
    sized = stream.select(group, F.size(words(F.col("text"))).alias("_size"))
    counters = sized.groupBy(group).agg(
        F.count(F.lit(1)).alias("records"), F.sum("_size").alias("tokens"), F.count_if(F.col("_size") < 30).alias("rejected"))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/changes/batch={number}")
        if number % compact_every == compact_every - 1:
            before = _bases(spark, output)
            latest_statistics(spark, output, number).coalesce(1 + len(_batches(spark, output)) // 64).write.mode("overwrite").parquet(
                f"{output}/base/upto={number}")
            if before and before[-1] < number:
                _delete(spark, [f"{output}/base/upto={n}" for n in before[:-1]]
                        + [f"{output}/changes/batch={n}" for n in _batches(spark, output) if n <= before[-1]])

    run = (
        counters.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()


def latest_statistics(spark: SparkSession, output: str, upto: int | None = None) -> DataFrame:
    """The newest counters of every group: of the last base and the changes since, up to batch ``upto`` if given."""
    allowed = lambda numbers: [n for n in numbers if upto is None or n <= upto]
    base = allowed(n for n in _bases(spark, output) if upto is None or n < upto)[-1:]
    parts = [(n, f"{output}/base/upto={n}") for n in base]
    parts += [(n, f"{output}/changes/batch={n}") for n in allowed(_batches(spark, output)) if not base or n > base[0]]
    rows = None
    for number, path in parts:  # at most ``compact_every`` changes lie beyond the last base
        one = spark.read.parquet(path).withColumn("_batch", F.lit(number))
        rows = one if rows is None else rows.unionByName(one)
    group, *counters = [c for c in rows.columns if c != "_batch"]
    newest = rows.groupBy(group).agg(F.max_by(F.struct(*counters), "_batch").alias("_c"))
    return newest.select(group, "_c.*")


def _numbers(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Rising numbers of the complete folders ``name=N`` below a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not store.exists(path):
        return []
    found = [status.getPath() for status in store.listStatus(path)]
    done = [p.getName() for p in found if p.getName().startswith(f"{name}=") and store.exists(
        spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(n.split("=")[1]) for n in done)


def _bases(spark: SparkSession, output: str) -> list[int]:
    return _numbers(spark, f"{output}/base", "upto")


def _batches(spark: SparkSession, output: str) -> list[int]:
    return _numbers(spark, f"{output}/changes", "batch")


def _delete(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)

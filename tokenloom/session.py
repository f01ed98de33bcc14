"""Session settings and the shared folder for durable intermediate tables."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8, memory: str = "16g") -> SparkSession:
    """Session of one process for tests and the benchmark; clusters bring their own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tokenloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach: ``spark.checkpoint.dir``.

    A session of one process without that setting (a test, say) gets a folder
    below its warehouse. On a cluster it must be set, as no folder is known to
    be shared.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    folder = folder or context.getCheckpointDir()
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors reach")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/stages"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: freezes the rows and cuts the lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder for a written table."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read back.

    Cuts the lineage at files that outlive a lost executor and, unlike a
    checkpoint, keeps column pruning. ``discard`` deletes the files.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Deletes the files of ``staged`` frames that nothing reads any more."""
    for df in frames:
        jvm = df.sparkSession.sparkContext._jvm
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove the shuffle files of finished jobs now rather than at its next periodic collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


PLACED_BYTES = 8 << 20  # of compressed files behind one partition of texts that are taken apart
LONG_TEXT_TABLES = {"documents", "pages", "conversations"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables.

    A file with a single row group is read by one task. Where the scan of a
    text table has fewer tasks than cores (small inputs only) its rows are
    spread first; a large table is used as scanned, without this shuffle.
    """
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    spread = name in LONG_TEXT_TABLES and df.rdd.getNumPartitions() < cores
    return df.repartition(cores) if spread else df


def placed_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows hashed by key into the configured number of shuffle partitions.

    For steps that make many rows out of each row after the shuffle: the number
    is given so that small shuffled texts are not merged into few tasks. Where
    the files behind the rows have more than ``PLACED_BYTES`` for each of these
    partitions there are more of them, so a task's share stays bounded.
    """
    return df.repartition(places(df), *keys)


def places(df: DataFrame) -> int:
    """Partitions that ``placed_by`` makes."""
    given = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(given, -(-_stored_bytes(df) // PLACED_BYTES))


def _stored_bytes(df: DataFrame) -> int:
    """Size of the files that a frame reads; 0 for rows that come from elsewhere."""
    session, total = df.sparkSession, 0
    for folder in {file.rsplit("/", 1)[0] if len(files) > 1 else file for files in [df.inputFiles()] for file in files}:
        path = session._jvm.org.apache.hadoop.fs.Path(session._jvm.java.net.URI(folder))
        total += path.getFileSystem(session._jsparkSession.sessionState().newHadoopConf()).getContentSummary(path).getLength()
    return total

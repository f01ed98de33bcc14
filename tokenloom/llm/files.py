"""Flat binary files below the shared folder, written and read by tasks.

Names carry the task attempt, and only the rows a finished task returns name its
files, so attempts that were lost leave nothing that is read.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from ..session import fresh_path


def new_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one, as a URI that tasks can open."""
    path = re.sub(r"^file:/+", "file:///", fresh_path(spark, label))
    return path if re.match(r"^\w+://", path) else f"file://{path}"


def attempt_name() -> str:
    """A file name that no other task attempt uses."""
    context = TaskContext.get()
    return f"{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}" if context else uuid.uuid4().hex


def output(uri: str):
    """A stream into a new file."""
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(path)


def array(uri: str, dtype: str, count: int | None = None) -> np.ndarray:
    """The file's numbers: memory-mapped where the store is a mounted folder, read otherwise."""
    store, path = fs.FileSystem.from_uri(uri)
    if isinstance(store, fs.LocalFileSystem):
        size = store.get_file_info(path).size
        return np.memmap(path, dtype, "r") if size else np.zeros(0, dtype)
    with store.open_input_file(path) as source:
        return np.frombuffer(source.read_buffer(), dtype)


def rows_each(df: DataFrame, count: int, *keys: str) -> DataFrame:
    """Deals rows that stand for files or blocks to ``count`` tasks."""
    return df.repartition(max(1, count), *keys)

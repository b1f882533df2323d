"""What several operators need: tables, a shared folder, tables written between steps, folds."""

from __future__ import annotations

import ctypes
import inspect
import os
import sys
import tempfile
import zipfile
from collections.abc import Callable
from functools import cache, wraps
from pathlib import Path
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def _archive() -> str:
    package = Path(__file__).resolve().parent.parent
    path = os.path.join(tempfile.mkdtemp(prefix="stratalake-"), f"{package.name}.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    return path


def shipped(spark: SparkSession) -> SparkSession:
    """The session, after giving this package to executors, whose Python may not have it."""
    spark.sparkContext.addPyFile(_archive())
    return spark


def scratch(spark: SparkSession) -> str:
    """A new folder under the shared one that the session names in ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/stratalake-{uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read from there, so that nothing is computed twice."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def once(function: Callable) -> Callable:
    """The UDF, for columns that are filtered by: Spark would push the filter below them, and call the UDF for it too."""
    return function.asNondeterministic()


def drop_written(df: DataFrame) -> None:
    """Delete a table that ``written`` made, once no later step reads it."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def fold(doc_id: str, of: int) -> Column:
    """crc32 of the id as text modulo ``of``; a null id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % of


def size_bounded(df: DataFrame, rows: int) -> DataFrame:
    """A written table, marked for broadcast if it has no more than ``rows`` rows; else joined by shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores after it as it takes to differ from all columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, dropped: DataFrame, rows: int) -> DataFrame:
    """The documents that aren't in ``dropped`` (doc_id, text_hash), by id and text."""
    doc_id, text_hash = free_name(docs, "dropped_id"), free_name(docs, "dropped_hash")
    gone = dropped.select(F.col("doc_id").alias(doc_id), F.col("text_hash").alias(text_hash)).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(doc_id)) & (F.xxhash64("text") == F.col(text_hash))
    return docs.join(size_bounded(written(gone), rows), same, "left_anti")


def _find_libc() -> ctypes.CDLL | None:
    libc = ctypes.CDLL(None) if sys.platform == "linux" else None
    return libc if hasattr(libc, "malloc_trim") else None


_libc = _find_libc()


def _release_memory() -> None:
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def lean(step: Callable) -> Callable:
    """The function of an Arrow batch, or of a stream of them, that gives freed memory back when it ends.

    A Python worker lives on after its task, beside those of later stages, and would keep it.
    """
    if inspect.isgeneratorfunction(step):

        @wraps(step)
        def stream(batches):
            yield from step(batches)
            _release_memory()

        return stream

    @wraps(step)
    def batch(*columns):
        made = step(*columns)
        _release_memory()
        return made

    return batch

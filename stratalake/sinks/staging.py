"""Putting a finished dataset in the place of another.

Spark cannot overwrite what it is reading, so a merge of a dataset with a batch is
first written next to it and then published. A marker file stands beside the staged
data from the moment it is whole until it is published. A run that dies in between
leaves the marker, and the next run publishes again before it does anything else.

A dataset that is replaced is moved aside first and deleted last, so there is no moment
without either. One run at a time owns a path, see :mod:`stratalake.sinks.ownership`; what it
stages carries its token, and it looks whether it still is the owner before it moves or deletes.

Readers of the dataset may see it half published: there is no transaction log.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, StringType, StructField, StructType

from stratalake.functions.names import find_name
from stratalake.sinks import storage
from stratalake.sinks.ownership import Owner
from stratalake.sources.files import read_parquet

# Beside the target and so on its file system, where a rename can reach it.
_BATCH = "__batch"
_MERGED = "__merged"
_REPEATED = "__repeated"
_KNOWN = "__known"
_KEPT = "__kept"
_OLD = "__old"
_MARK = "__ready"

AUTO = "auto"
RENAME = "rename"
REWRITE = "rewrite"


def batch_stage(path: str, run: str = "") -> str:
    return path.rstrip("/") + _BATCH + run


def merge_stage(path: str, run: str = "") -> str:
    return path.rstrip("/") + _MERGED + run


def repeated_stage(path: str, run: str = "") -> str:
    return path.rstrip("/") + _REPEATED + run


def known_stage(path: str, run: str = "") -> str:
    return path.rstrip("/") + _KNOWN + run


def kept_stage(path: str, run: str = "") -> str:
    return path.rstrip("/") + _KEPT + run


def moves(spark: SparkSession, path: str, how: str) -> bool:
    """Whether a stage is published by renaming it."""
    return how == RENAME or (how == AUTO and storage.renames_in_place(spark, path))


def write_stage(df: DataFrame, stage: str, partitions: Sequence[str], options: Mapping | None = None) -> None:
    df.write.mode("overwrite").options(**(options or {})).partitionBy(*partitions).parquet(stage)


def publish(
    spark: SparkSession,
    stage: str,
    path: str,
    partitions: Sequence[str],
    options: Mapping | None = None,
    how: str = AUTO,
    owner: Owner | None = None,
) -> list[str]:
    """Put the staged data in place and return the partition directories it has.

    Unpartitioned, it replaces the dataset; partitioned, it replaces the partitions it
    has. Where a rename moves directories in place nothing is copied; elsewhere (object
    stores) Spark writes the staged data once more.
    """
    _require(owner)
    storage.write_text(spark, stage + _MARK, json.dumps(list(partitions)))
    return _put_in_place(spark, stage, path, partitions, options or {}, how, owner)


def _require(owner: Owner | None) -> None:
    if owner is not None:
        owner.require()


def _put_in_place(
    spark: SparkSession, stage: str, path: str, partitions: Sequence[str], options: Mapping, how: str, owner: Owner | None
) -> list[str]:
    directories = list(storage.partition_directories(spark, stage, len(partitions))) if partitions else []
    if moves(spark, path, how):
        _rename(spark, stage, path, partitions, directories, owner)
        spark.catalog.refreshByPath(path)
    else:
        _require(owner)
        _rewrite(spark, stage, path, partitions, options)
    _require(owner)
    # The marker goes first: without it a stage that is only half deleted is not taken up again.
    storage.delete(spark, stage + _MARK)
    storage.delete(spark, stage)
    return directories


def _rename(
    spark: SparkSession, stage: str, path: str, partitions: Sequence[str], directories: list[str], owner: Owner | None
) -> None:
    root = path.rstrip("/")
    aside = root + _OLD + (owner.suffix if owner else "")

    def move(directory: str) -> None:
        _require(owner)
        storage.replace_directory(spark, stage + directory, root + directory, aside + directory)

    whole = not partitions or not storage.exists(spark, path)
    storage.for_each(move, [""] if whole else [f"/{d}" for d in directories])


def publish_files(
    spark: SparkSession, stage: str, path: str, replaced: Sequence[str], depth: int = 0, owner: Owner | None = None
) -> list[str]:
    """Move the staged files among those of a dataset, then delete the ``replaced`` ones; return the directories they are in.

    ``depth`` is how many levels of partitions it has; names are relative to its root. Only where a
    rename moves files in place. The marker names the replaced files, so a
    run that dies in between is made good like any other.
    """
    _require(owner)
    storage.write_text(spark, stage + _MARK, json.dumps({"replaced": list(replaced), "depth": depth}))
    return _move_files(spark, stage, path, replaced, depth, owner)


def _move_files(
    spark: SparkSession, stage: str, path: str, replaced: Sequence[str], depth: int, owner: Owner | None
) -> list[str]:
    root = path.rstrip("/")
    staged = storage.files_below(spark, stage, depth)

    def move(name: str) -> None:
        _require(owner)
        storage.move_file(spark, f"{stage}/{name}", f"{root}/{name}")

    def drop(name: str) -> None:
        _require(owner)
        storage.delete(spark, f"{root}/{name}")

    storage.for_each(move, staged)
    storage.for_each(drop, replaced)
    spark.catalog.refreshByPath(path)
    storage.delete(spark, stage + _MARK)
    storage.delete(spark, stage)
    return sorted({name.rpartition("/")[0] for name in staged})


def _rewrite(spark: SparkSession, stage: str, path: str, partitions: Sequence[str], options: Mapping) -> None:
    staged = read_typed(spark, [stage], stage, {p: StringType() for p in partitions})
    if staged is None:
        return
    (
        staged.write.mode("overwrite")
        .options(**options)
        .option("partitionOverwriteMode", "dynamic" if partitions else "static")
        .partitionBy(*partitions)
        .parquet(path)
    )


def recover(spark: SparkSession, path: str, options: Mapping | None = None, how: str = AUTO, owner: Owner | None = None) -> None:
    """Finish what an earlier run left whole but not published, drop what it left unfinished."""
    for kind in (batch_stage(path), merge_stage(path)):
        marks = storage.beside(spark, path, kind[len(path.rstrip("/")) :])
        for stage in (name.removesuffix(_MARK) for name in marks if name.endswith(_MARK)):
            mark = _read_mark(spark, stage)
            if isinstance(mark, dict):
                _move_files(spark, stage, path, mark["replaced"], mark.get("depth", 0), owner)
            elif mark is not None and storage.exists(spark, stage):
                _put_in_place(spark, stage, path, mark, options or {}, how, owner)
    discard(spark, path, owner)


def discard(spark: SparkSession, path: str, owner: Owner | None = None) -> None:
    """Drop the stages of this run, or what an earlier one left of its own."""
    _require(owner)
    for suffix in (_BATCH, _MERGED, _REPEATED, _KNOWN, _KEPT, _OLD):
        # markers first: without one, a stage that is half deleted is not taken up again
        for name in sorted(storage.beside(spark, path, suffix), key=lambda name: not name.endswith(_MARK)):
            storage.delete(spark, name)


def _read_mark(spark: SparkSession, stage: str) -> list[str] | dict | None:
    """The partition columns a marked stage was written with, or the files it replaces; None for one that is not whole.

    They are taken from the marker, not from the run at hand, whose job may have changed.
    A marker that broke off was written by a run that had not moved anything yet.
    """
    text = storage.read_if_exists(spark, stage + _MARK)
    if text is None:
        return None
    try:
        return json.loads(text)
    except json.JSONDecodeError:
        return None


def read_typed(
    spark: SparkSession, paths: Sequence[str], base: str, types: Mapping[str, DataType], merge: bool = False
) -> DataFrame | None:
    """Read Parquet directories with the given partition column types, None if there are none.

    Directory names are text, and Spark would guess: ``p=001`` would come back as 1.
    ``merge`` takes the columns of all files together, for directories written at
    different times; a dataset written at once needs the footer of one file only.
    """
    df = read_parquet(spark, *paths, options={"mergeSchema": str(merge).lower(), "basePath": base})
    if df is None:
        return None
    types = {find_name(df.columns, name): dtype for name, dtype in types.items()}
    schema = StructType([StructField(f.name, types.get(f.name, f.dataType)) for f in df.schema])
    if all(df.schema[f.name].dataType == f.dataType for f in schema):
        return df
    return read_as(spark, paths, base, schema)


def read_as(spark: SparkSession, paths: Sequence[str], base: str, schema: StructType) -> DataFrame:
    """Read Parquet directories whose schema is known."""
    return spark.read.schema(schema).option("basePath", base).parquet(*paths)

"""The few file-system calls a sink needs, on whatever file system holds the path."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Schemes whose rename moves a directory without copying its files.
_RENAMES_IN_PLACE = ("hdfs", "viewfs", "file", "abfs", "abfss")

# Fixed value: the directory name of a NULL partition value.
_NULL_DIRECTORY = "__HIVE_DEFAULT_PARTITION__"

# Directories handled at once.
_AT_A_TIME = 16

T = TypeVar("T")
R = TypeVar("R")


def _open(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def for_each(work: Callable[[T], R], items: Iterable[T]) -> list[R]:
    """Do ``work`` for many directories, some at a time: each call waits for the file system."""
    with ThreadPoolExecutor(_AT_A_TIME) as pool:
        return list(pool.map(work, items))


def qualified(spark: SparkSession, path: str) -> str:
    """The path in full, for comparing two."""
    fs, where = _open(spark, path)
    return fs.makeQualified(where).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _open(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _open(spark, path)
    fs.delete(where, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, where = _open(spark, path)
    out = fs.create(where, True)
    out.write(bytearray(text, "utf-8"))
    out.close()


def read_if_exists(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is none."""
    fs, where = _open(spark, path)
    try:
        stream = fs.open(where)
    except Py4JJavaError:
        if fs.exists(where):
            raise
        return None
    try:
        return bytes(stream.readAllBytes()).decode("utf-8", "replace")
    finally:
        stream.close()


def rename(spark: SparkSession, source: str, target: str) -> bool:
    """Whether the file was there and was moved."""
    fs, where = _open(spark, source)
    _, there = _open(spark, target)
    try:
        return fs.rename(where, there)
    except Py4JJavaError:
        if fs.exists(where):
            raise
        return False


def beside(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """Files and directories next to ``path`` whose names are its own and the suffix, and maybe more."""
    fs, where = _open(spark, path.rstrip("/"))
    parent = where.getParent()
    if not fs.exists(parent):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(parent)]
    own = where.getName() + suffix
    above = path.rstrip("/")[: -len(where.getName())]
    return [above + name for name in sorted(names) if name.startswith(own)]


def renames_in_place(spark: SparkSession, path: str) -> bool:
    fs, _ = _open(spark, path)
    return fs.getUri().getScheme() in _RENAMES_IN_PLACE


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must not be there yet; False if it is."""
    fs, where = _open(spark, path)
    fs.mkdirs(where.getParent())
    try:
        out = fs.create(where, False)
    except Py4JJavaError:
        if fs.exists(where):
            return False
        raise
    out.write(bytearray(text, "utf-8"))
    out.close()
    return True


def written_at(spark: SparkSession, path: str) -> int | None:
    """When the file was written, in milliseconds of the file system's clock, or None if there is none."""
    fs, where = _open(spark, path)
    try:
        return fs.getFileStatus(where).getModificationTime()
    except Py4JJavaError:
        if fs.exists(where):
            raise
        return None


def replace_directory(spark: SparkSession, source: str, target: str, aside: str) -> None:
    """Move ``source`` to where ``target`` is, or was.

    The old directory is moved ``aside`` and deleted only when the new one is in its place.
    """
    fs, where = _open(spark, source)
    _, there = _open(spark, target)
    _, old = _open(spark, aside)
    if not fs.exists(where):
        raise OSError(f"{source} is gone, {target} is left as it is")
    fs.delete(old, True)
    fs.mkdirs(there.getParent())
    fs.mkdirs(old.getParent())
    if fs.exists(there) and not fs.rename(there, old):
        raise OSError(f"could not move {target} to {aside}")
    if not fs.rename(where, there):
        raise OSError(f"could not move {source} to {target}")
    fs.delete(old, True)


def move_file(spark: SparkSession, source: str, target: str) -> None:
    fs, where = _open(spark, source)
    _, there = _open(spark, target)
    fs.mkdirs(there.getParent())
    if not fs.rename(where, there):
        raise OSError(f"could not move {source} to {target}")


def data_files(spark: SparkSession, path: str) -> dict[str, int]:
    """Names and sizes of the data files right below ``path``."""
    fs, where = _open(spark, path)
    found = [s for s in fs.listStatus(where) if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
    return {s.getPath().getName(): s.getLen() for s in found}


def files_below(spark: SparkSession, path: str, depth: int) -> dict[str, int]:
    """Names relative to ``path``, and sizes, of the data files in the directories ``depth`` levels down."""
    if not exists(spark, path):
        return {}
    directories = list(partition_directories(spark, path, depth)) if depth else [""]
    return files_in(spark, path, directories)


def files_in(spark: SparkSession, path: str, directories: Iterable[str]) -> dict[str, int]:
    """Names relative to ``path``, and sizes, of the data files right in these directories below it."""
    prefixes = [f"{d}/" if d else "" for d in directories]
    found = for_each(lambda prefix: data_files(spark, f"{path}/{prefix}"), prefixes)
    return {prefix + name: size for prefix, own in zip(prefixes, found, strict=True) for name, size in own.items()}


def relative_name(spark: SparkSession, uri: str, depth: int) -> str:
    """The last parts of a file's address, given as a URI: its directories of so many levels, and its name."""
    where = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
    parts = [where.getName()]
    for _ in range(depth):
        where = where.getParent()
        parts.append(where.getName())
    return "/".join(reversed(parts))


def partition_directories(spark: SparkSession, path: str, depth: int) -> Iterator[str]:
    """The partition directories ``depth`` levels down, relative to ``path``."""
    fs, where = _open(spark, path)

    def walk(directory, prefix: str, left: int) -> Iterator[str]:
        for status in fs.listStatus(directory):
            name = status.getPath().getName()
            if status.isDirectory() and "=" in name:
                below = f"{prefix}/{name}" if prefix else name
                if left == 1:
                    yield below
                else:
                    yield from walk(status.getPath(), below, left - 1)

    yield from walk(where, "", depth)


def partition_values(directory: str) -> dict[str, str | None]:
    """The column values that ``a=1/b=x%20y`` stands for, as text."""
    levels = [level.partition("=") for level in directory.split("/")]
    return {unquote(name): None if value == _NULL_DIRECTORY else unquote(value) for name, _, value in levels}


def layout(spark: SparkSession, path: str) -> tuple[list[str], str] | None:
    """The partition columns of a dataset and one of its files, or None if there is no data."""
    fs, where = _open(spark, path)
    if not fs.exists(where):
        return None

    def walk(directory, columns: list[str]) -> tuple[list[str], str] | None:
        entries = fs.listStatusIterator(directory)
        while entries.hasNext():
            entry = entries.next()
            name = entry.getPath().getName()
            if entry.isDirectory() and "=" in name:
                found = walk(entry.getPath(), [*columns, unquote(name.partition("=")[0])])
                if found is not None:
                    return found
            elif entry.isFile() and not name.startswith(("_", ".")):
                return columns, entry.getPath().toString()
        return None

    return walk(where, [])


def require_layout(spark: SparkSession, path: str, partitions: Iterable[str]) -> str | None:
    """Fail if a dataset is stored by other partition columns; one of its files, None if it has no data."""
    found = layout(spark, path)
    if found is None:
        return None
    stored, file = found
    if [c.lower() for c in stored] != [c.lower() for c in partitions]:
        raise ValueError(f"{path} is not stored by partitions {list(partitions)} but {stored}; replace it to change that")
    return file

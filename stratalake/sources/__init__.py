"""Where rows come from: a registry of readers by source type."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource

from stratalake.layers import Layers, layer_path
from stratalake.sources.arrow_files import ArrowFiles
from stratalake.sources.files import read_delimited, read_parquet_source
from stratalake.sources.jdbc import Credentials, read_jdbc

Reader = Callable[[SparkSession, Mapping, Layers], DataFrame]

_PUSHES = "spark.sql.python.filterPushdown.enabled"


def read_own(kind: type[DataSource], spark: SparkSession, source: Mapping, layers: Layers) -> DataFrame:
    """The rows of a Python data source.

    It gets the job's ``options``; ``path``, under the landing layer, if the job has one; and ``push_filters``, which
    is ``true`` if the session lets a reader have ``pushFilters``, as Spark refuses such a reader otherwise.
    """
    spark.dataSource.register(kind)
    reader = spark.read.format(kind.name()).options(**source.get("options", {}))
    if "path" in source:
        reader = reader.option("path", layer_path(layers, "landing", source["path"]))
    return reader.option("push_filters", spark.conf.get(_PUSHES, "false")).load()


_READERS: dict[str, Reader] = {
    "csv": read_delimited,
    "txt": read_delimited,
    "parquet": read_parquet_source,
    "jdbc": read_jdbc,
    "arrow": partial(read_own, ArrowFiles),
}


def register_reader(source_type: str, reader: Reader) -> None:
    """Offer ``reader(spark, source, layers) -> DataFrame`` to jobs as ``source_type``."""
    _READERS[source_type] = reader


def register_source(source_type: str, kind: type[DataSource]) -> None:
    """Offer a Python data source to jobs as ``source_type``: its partitions are read by a task each."""
    register_reader(source_type, partial(read_own, kind))


def require_reader(source_type: str) -> Reader:
    try:
        return _READERS[source_type]
    except KeyError:
        raise ValueError(f"unable to read format {source_type!r}, have {sorted(_READERS)}") from None


def read_source(
    spark: SparkSession, source: Mapping, layers: Layers, credentials: Credentials | None = None
) -> DataFrame:
    """The rows a job's ``source`` describes."""
    reader = require_reader(source["type"])
    if reader is read_jdbc:
        reader = partial(read_jdbc, credentials=credentials)
    return reader(spark, source, layers)

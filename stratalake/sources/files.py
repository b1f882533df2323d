"""Delimited text and Parquet."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from stratalake.layers import Layers, layer_path

# The Spark error conditions for "nothing there".
_NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_delimited(spark: SparkSession, source: Mapping, layers: Layers) -> DataFrame:
    """CSV, or any other text with a separator, under the landing layer.

    Without a schema option every column is text. ``columns`` names all columns by
    position.
    """
    df = spark.read.options(**source.get("options", {})).csv(layer_path(layers, "landing", source["path"]))
    columns = source.get("columns")
    if columns is None:
        return df
    if len(columns) != len(df.columns):
        raise ValueError(f"columns names {len(columns)} columns, the source has {len(df.columns)}: {df.columns}")
    return df.toDF(*columns)


def read_parquet_source(spark: SparkSession, source: Mapping, layers: Layers) -> DataFrame:
    """A Parquet dataset under the landing layer."""
    path = layer_path(layers, "landing", source["path"])
    df = read_parquet(spark, path, options=source.get("options"))
    if df is None:
        raise ValueError(f"no Parquet data at {path}")
    return df


def read_parquet(spark: SparkSession, *paths: str, options: Mapping[str, str] | None = None) -> DataFrame | None:
    """A Parquet dataset, or None where there is none."""
    try:
        return spark.read.options(**(options or {})).parquet(*paths)
    except AnalysisException as error:
        if error.getCondition() in _NOTHING_THERE:
            return None
        raise

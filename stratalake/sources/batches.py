"""One import batch of a raw dataset."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from stratalake.functions.names import column
from stratalake.layers import BATCH_COLUMN
from stratalake.sources.files import read_parquet


def read_batch(
    spark: SparkSession, raw_path: str, batch_date: str, options: Mapping[str, str] | None = None
) -> DataFrame | None:
    """The rows of one batch date, or None if that date was never imported.

    Only the batch's own directory is listed and only its files give the schema, so
    the cost does not grow with the number of dates and columns that are new in this
    batch are kept. The batch id reads back as an integer.
    """
    root = raw_path.rstrip("/")
    df = read_parquet(
        spark,
        f"{root}/{BATCH_COLUMN}={batch_date}",
        options={**(options or {}), "basePath": root},
    )
    if df is None:
        return None
    return df.withColumn(BATCH_COLUMN, column(BATCH_COLUMN).cast("int"))

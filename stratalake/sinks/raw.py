"""The raw layer: one partition of a Parquet dataset per import date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.names import require_distinct
from stratalake.layers import BATCH_COLUMN
from stratalake.sinks import storage
from stratalake.sinks.catalog import refresh_table, require_registrable, table_name
from stratalake.sinks.ownership import owned


def stamp_batch(df: DataFrame, batch_date: str) -> DataFrame:
    """Add the batch id and put all column names in upper case."""
    stamped = df.withColumn(BATCH_COLUMN, F.lit(batch_date))
    names = [c.upper() for c in stamped.columns]
    require_distinct(names)
    return stamped.toDF(*names)


def save_raw(
    df: DataFrame, path: str, batch_date: str, database: str | None = None, table: str | None = None
) -> None:
    """Write ``df`` as the batch of ``batch_date``, in place of any earlier run of it.

    Other dates stay as they are. The write is narrow: every task writes what it
    reads. A run with no rows writes nothing and leaves an earlier run's rows. One run at a
    time writes a date; runs of several dates may write at once.
    """
    spark = df.sparkSession
    require_registrable(spark, database, table)
    batch = stamp_batch(df, batch_date)
    with owned(spark, f"{path.rstrip('/')}__{batch_date}"):
        (
            batch.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH_COLUMN)
            .parquet(path)
        )
    if database is not None:
        stored = storage.exists(spark, f"{path.rstrip('/')}/{BATCH_COLUMN}={batch_date}")
        written = [{BATCH_COLUMN: batch_date}] if stored else []
        refresh_table(spark, table_name(database, table), path, batch.schema, [BATCH_COLUMN], written)

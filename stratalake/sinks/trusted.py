"""The trusted layer: full replace, partition replace and keyed upsert."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from stratalake.functions.names import column, require_distinct, require_name
from stratalake.operators.gather import gather
from stratalake.sinks import staging, storage
from stratalake.sinks.catalog import create_table, refresh_table, require_registrable, table_name, with_table_columns
from stratalake.sinks.ownership import owned
from stratalake.sinks.storage import partition_values
from stratalake.sinks.upsert import NEWEST_WINS, upsert, with_directory_nulls, write_version
from stratalake.sinks.versions import SWITCH, current_version, new_version, switch

# The ways to store a batch, "Full" being another name for "Replace".
REPLACE = ("Replace", "Full")
REPLACE_PARTITION = "ReplacePartition"
UPSERT = "Upsert"
TUNING = ("broadcast_bytes", "publish", "large_batch_rows", "cluster")
INGEST_TYPES = (*REPLACE, REPLACE_PARTITION, UPSERT)


def save_trusted(
    df: DataFrame,
    path: str,
    trusted: Mapping,
    table: str | None = None,
    stale: str = NEWEST_WINS,
    rows: int | None = None,
) -> None:
    """Store a batch the way ``trusted["ingest_type"]`` says and register it if it has a database.

    ``rows`` is how many it has, if that is known: see :func:`stratalake.sinks.upsert.upsert`,
    to which ``broadcast_bytes``, ``publish``, ``large_batch_rows`` and ``cluster`` of ``trusted`` go.

    A replaced dataset or partition is written beside its place and moved there, where a
    rename does that: a write that fails leaves the stored rows, and files and table agree. With ``publish``
    ``switch`` a registered, unpartitioned table is published by one catalog statement, see
    :mod:`stratalake.sinks.versions`.
    """
    kind = trusted["ingest_type"]
    if kind not in INGEST_TYPES:
        raise ValueError(f"ingest type must be one of {INGEST_TYPES}, not {kind!r}")
    spark = df.sparkSession
    database = trusted.get("database")
    require_registrable(spark, database, table)
    require_distinct(df.columns)
    partitions = [require_name(df, p) for p in trusted.get("partitions", [])]
    options = trusted.get("options", {})
    name = table_name(database, table) if database is not None else None

    if trusted.get("publish") == SWITCH:
        if name is None or partitions:
            raise ValueError("publish 'switch' needs a database and no partitions")
        _save_version(df, path, trusted, name, stale, rows)
        return

    if kind == UPSERT:
        keys, order = as_list(trusted["key_column"]), as_list(trusted["order_column"])
        tuning = {field: trusted[field] for field in TUNING if field in trusted}
        schema, written = upsert(df, path, keys, order, partitions, stale, options, rows=rows, **tuning)
        if name:
            schema = with_table_columns(spark, name, path, schema)
            refresh_table(spark, name, path, schema, partitions, map(partition_values, written))
        return

    in_part = kind == REPLACE_PARTITION and bool(partitions)
    publish = trusted.get("publish", staging.AUTO)
    df = with_directory_nulls(df, partitions)
    with owned(spark, path) as owner:
        staging.recover(spark, path, options, publish, owner)
        if in_part:
            storage.require_layout(spark, path, partitions)
        if staging.moves(spark, path, publish):
            stage = staging.batch_stage(path, owner.suffix)
            staging.write_stage(gather(df, partitions), stage, partitions, options)
            written = staging.publish(spark, stage, path, partitions if in_part else (), options, publish, owner)
            staging.discard(spark, path, owner)
        else:
            owner.require()
            _overwrite(df, path, partitions, options, "dynamic" if in_part else "static")
            # One row per partition the write replaced, as the writer itself keeps on the driver.
            written = _written_values(df, partitions) if in_part and name else []
    if not name:
        return
    if in_part:
        values = [v if isinstance(v, dict) else storage.partition_values(v) for v in written]
        refresh_table(spark, name, path, df.schema, partitions, values)
    else:
        create_table(spark, name, path, df.schema, partitions)


def _save_version(df: DataFrame, path: str, trusted: Mapping, name: str, stale: str, rows: int | None) -> None:
    """Write all rows to a new directory and switch the table to it."""
    spark, options = df.sparkSession, trusted.get("options", {})
    with owned(spark, path) as owner:
        version = new_version(path, owner)
        if trusted["ingest_type"] == UPSERT:
            stored = current_version(spark, name, path)
            keys, order = as_list(trusted["key_column"]), as_list(trusted["order_column"])
            tuning = {field: trusted[field] for field in TUNING if field in trusted and field != "publish"}
            schema = write_version(df, path, stored, version, keys, order, owner, stale, options, rows=rows, **tuning)
        else:
            staging.write_stage(df, version, (), options)
            schema = df.schema
        if schema is not None:
            switch(spark, name, path, version, schema, owner)


def _written_values(df: DataFrame, partitions: Sequence[str]) -> list[dict]:
    return [v.asDict() for v in df.select([column(p).cast("string") for p in partitions]).distinct().collect()]


def _overwrite(df: DataFrame, path: str, partitions: Sequence[str], options: Mapping, mode: str) -> None:
    """Overwrite the dataset, or in ``dynamic`` mode the partitions ``df`` has."""
    (
        gather(df, partitions)
        .write.mode("overwrite")
        .options(**options)
        .option("partitionOverwriteMode", mode)
        .partitionBy(*partitions)
        .parquet(path)
    )


def as_list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)

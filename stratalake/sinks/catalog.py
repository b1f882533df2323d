"""External tables over the datasets that sinks write."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StructField, StructType

from stratalake.functions.names import find_name, quoted
from stratalake.operators.reconcile import reconciled
from stratalake.sinks import storage

# Partitions added by one statement.
_CHUNK = 200


def table_name(database: str, table: str) -> str:
    return f"{quoted(database)}.{quoted(table)}"


def require_registrable(spark: SparkSession, database: str | None, table: str | None) -> None:
    """Fail before any file is written if the dataset could not be registered as this table.

    A managed table of that name owns its files, and a new registration would delete them.
    """
    if database is None:
        return
    if not spark.catalog.databaseExists(database):
        raise ValueError(f"no such database: {database!r}")
    if table is None:
        raise ValueError(f"no table name for database {database!r}")
    name = table_name(database, table)
    if spark.catalog.tableExists(name):
        kind = spark.catalog.getTable(name).tableType
        if kind != "EXTERNAL":
            raise ValueError(f"{name} exists and is not an external table but {kind}")


def create_table(
    spark: SparkSession, name: str, path: str, schema: StructType, partitions: Sequence[str] = ()
) -> None:
    """Register the dataset anew, with its newest schema and all partitions found."""
    columns = StructType([StructField(f.name, f.dataType) for f in schema]).toDDL()
    partitioned = f"PARTITIONED BY ({', '.join(map(quoted, partitions))})" if partitions else ""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {partitioned} LOCATION {text(path)}")
    if partitions:
        spark.catalog.recoverPartitions(name)


def refresh_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: StructType,
    partitions: Sequence[str],
    written: Iterable[Mapping[str, str | None]],
) -> None:
    """Register the dataset, or add the ``written`` partitions, values as text, to its table.

    A table that already is as it should be only learns the new partitions, so the
    cost does not grow with the partitions it has.
    """
    if not _is_registered(spark, name, path, schema, partitions):
        create_table(spark, name, path, schema, partitions)
        return
    specs = [_partition_spec(values) for values in written]
    for start in range(0, len(specs), _CHUNK):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(specs[start : start + _CHUNK])}")
    spark.catalog.refreshTable(name)


def with_table_columns(spark: SparkSession, name: str, path: str, schema: StructType) -> StructType:
    """``schema`` and the columns, and fields of columns, only the dataset's table has.

    A merge sees the partitions it touches; others may have columns of their own.
    """
    if not spark.catalog.tableExists(name) or not _is_at(spark, name, path):
        return schema
    known = spark.table(name).schema
    fields = []
    for field in schema:
        own = find_name(known.names, field.name)
        kind = reconciled(known[own].dataType, field.dataType, widen=False) if own else None
        fields.append(StructField(field.name, kind or field.dataType))
    return StructType([*fields, *[f for f in known if find_name(schema.names, f.name) is None]])


def _is_registered(
    spark: SparkSession, name: str, path: str, schema: StructType, partitions: Sequence[str]
) -> bool:
    if not spark.catalog.tableExists(name):
        return False
    table = spark.table(name)
    if {f.name: f.dataType for f in table.schema} != {f.name: f.dataType for f in schema}:
        return False
    if list(partitions) != table.columns[len(table.columns) - len(partitions) :]:
        return False
    return _is_at(spark, name, path)


def location(spark: SparkSession, name: str) -> str:
    """Where the table's files are."""
    return spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first()["data_type"]


def _is_at(spark: SparkSession, name: str, path: str) -> bool:
    return storage.qualified(spark, location(spark, name)) == storage.qualified(spark, path)


def _partition_spec(values: Mapping[str, str | None]) -> str:
    parts = [f"{quoted(name)}={'NULL' if value is None else text(value)}" for name, value in values.items()]
    return f"PARTITION ({', '.join(parts)})"


def text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"

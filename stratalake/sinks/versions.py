"""Publishing a registered table by one catalog statement.

With ``publish`` ``switch`` a dataset is written whole, once, to a new directory beside its path, and then the
table's location is switched to it. Readers of the table see the old rows or the new ones, on object
stores too, where a directory can't be moved in place; nothing is written twice. The version before stays for readers
that began with it, and is deleted when the next but one is published, as is what a dead run left.

The table is the only way to such a dataset: its path names no fixed directory. New columns are added to the table
before the switch, so until then they are NULL. If a column's type changes the table is registered anew.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from stratalake.functions.names import find_name
from stratalake.sinks import storage
from stratalake.sinks.catalog import create_table, location, text
from stratalake.sinks.ownership import Owner

SWITCH = "switch"
_VERSION = "__v"


def new_version(path: str, owner: Owner) -> str:
    return path.rstrip("/") + _VERSION + owner.suffix


def current_version(spark: SparkSession, name: str, path: str) -> str | None:
    """Where the rows of the table are; the path itself for one that was not switched before, None without rows."""
    found = path
    if spark.catalog.tableExists(name):
        at = location(spark, name)
        versions = {storage.qualified(spark, v): v for v in storage.beside(spark, path, _VERSION)}
        found = versions.get(storage.qualified(spark, at), found)
    return found if storage.layout(spark, found) else None


def switch(spark: SparkSession, name: str, path: str, version: str, schema: StructType, owner: Owner) -> None:
    """Let the table show the new version, and delete those that no reader needs."""
    before = current_version(spark, name, path)
    owner.require()
    added = _added_columns(spark, name, schema) if spark.catalog.tableExists(name) else None
    if added is None:
        create_table(spark, name, version, schema)
    else:
        if added:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({StructType(added).toDDL()})")
        spark.sql(f"ALTER TABLE {name} SET LOCATION {text(version)}")
        spark.catalog.refreshTable(name)
    for old in [*storage.beside(spark, path, _VERSION), path.rstrip("/")]:
        if old not in (version, before):
            owner.require()
            storage.delete(spark, old)


def _added_columns(spark: SparkSession, name: str, schema: StructType) -> list | None:
    """The columns a table has to learn; None if it must be registered anew."""
    table = spark.table(name).schema
    known = {f.name: f.dataType for f in table}
    if any(find_name(schema.names, c) is None for c in known):
        return None
    if any(known[c] != schema[find_name(schema.names, c)].dataType for c in known):
        return None
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        return None
    return [f for f in schema if find_name(table.names, f.name) is None]

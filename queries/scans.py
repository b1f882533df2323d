"""Sources: Parquet, CSV with and without a header, other separators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.tables import ORDERS_AS_TEXT_SQL, orders_as_text, scratch, table, with_cents_as_text
from stratalake import read_source, register_reader
from stratalake.sources.arrow_files import open_store


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_source(spark, {"type": "parquet", "path": "lineitem.parquet"}, {"landing": sf_dir})


def scan_csv_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch(spark)
    orders_as_text(spark, sf_dir).write.csv(f"{landing}/orders", header=True)
    source = {"type": "csv", "path": "orders", "options": {"sep": ",", "header": "true"}}
    return read_source(spark, source, {"landing": landing})


def scan_csv_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch(spark)
    with_cents_as_text(table(spark, sf_dir, "customer")).write.csv(f"{landing}/customer")
    source = {"type": "csv", "path": "customer", "columns": ["ID", "NAME", "NATION", "BALANCE", "SEGMENT"]}
    return read_source(spark, source, {"landing": landing})


def scan_txt(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch(spark)
    with_cents_as_text(table(spark, sf_dir, "part")).write.csv(f"{landing}/part", sep="|", header=True)
    source = {"type": "txt", "path": "part/", "options": {"sep": "|", "header": "true"}}
    return read_source(spark, source, {"landing": {"path": f"{landing}/"}})


def own_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader that a user registers: JSON lines of a given schema."""
    landing = scratch(spark)
    nation = table(spark, sf_dir, "nation")
    nation.write.json(f"{landing}/nation")

    def read_json(spark, source, layers, credentials=None):
        return spark.read.schema(source["schema"]).json(f"{layers['landing']}/{source['path']}")

    register_reader("json_lines", read_json)
    source = {"type": "json_lines", "path": "nation", "schema": nation.schema}
    return read_source(spark, source, {"landing": landing})


def own_source_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as Arrow files, read in parts; conditions are applied by the tasks that read them."""
    landing = scratch(spark)
    _write_arrow(table(spark, sf_dir, "lineitem"), f"{landing}/lineitem")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    source = {"type": "arrow", "path": "lineitem", "options": {"split_bytes": str(1 << 20)}}
    rows = read_source(spark, source, {"landing": landing})
    return rows.where("l_linenumber >= 2 and l_returnflag in ('A', 'R') and l_linestatus = 'F'").where(F.col("l_quantity") < 30)


def _write_arrow(df: DataFrame, folder: str) -> None:
    """A file of each partition; a task that runs again puts the same file in the same place."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        store.create_dir(root)
        task = TaskContext.get()
        place = f"{root}/part-{task.partitionId():05d}"
        written = 0
        with store.open_output_stream(f"{place}-{task.taskAttemptId()}.tmp") as file:
            writer = None
            for batch in batches:
                writer = writer or pa.ipc.new_file(file, batch.schema)
                writer.write_batch(batch)
                written += len(batch)
            if writer:
                writer.close()
        if writer:
            store.move(f"{place}-{task.taskAttemptId()}.tmp", f"{place}.arrow")
        else:
            store.delete_file(f"{place}-{task.taskAttemptId()}.tmp")
        yield pa.RecordBatch.from_pydict({"rows": [written]})

    df.mapInArrow(write, "rows long").agg(F.sum("rows")).first()


CHECKS = {
    "own_source_partitions": (
        own_source_partitions,
        "SELECT * FROM lineitem WHERE l_linenumber >= 2 AND l_returnflag IN ('A', 'R') AND l_linestatus = 'F' AND l_quantity < 30",
    ),
    "scan_parquet": (scan_parquet, "SELECT * FROM lineitem"),
    "scan_csv_header": (scan_csv_header, ORDERS_AS_TEXT_SQL),
    "scan_csv_columns": (
        scan_csv_columns,
        'SELECT c_custkey::VARCHAR AS "ID", c_name AS "NAME", c_nationkey::VARCHAR AS "NATION", '
        'c_acctbal::DECIMAL(15,2)::VARCHAR AS "BALANCE", c_mktsegment AS "SEGMENT" FROM customer',
    ),
    "scan_txt": (
        scan_txt,
        "SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_brand, p_type, p_size::VARCHAR AS p_size, "
        "p_retailprice::DECIMAL(15,2)::VARCHAR AS p_retailprice FROM part",
    ),
    "own_reader": (own_reader, "SELECT * FROM nation"),
}

"""The raw layer: stamping, reruns, tables and reading one batch back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.tables import database, layers, scratch, table
from stratalake import read_batch, run_raw, save_raw


def _orders_job(conditions: list[dict]) -> dict:
    return {
        "job_name": "orders",
        "source": {"type": "parquet", "path": "orders.parquet", "conditions": conditions},
        "destination": {"path": "sales/orders"},
    }


def raw_stamp_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = {
        "job_name": "lineitem",
        "source": {"type": "parquet", "path": "lineitem.parquet"},
        "destination": {"path": "sales/lineitem/", "table_name": "lineitem", "raw": {}},
    }
    return spark.read.parquet(run_raw(spark, job, layers(spark, sf_dir), "20240101"))


def raw_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date is imported twice and another once; each date holds its last run."""
    job = _orders_job([{"filter_date": "o_orderdate", "days": 0, "compare": "<"}])
    where = layers(spark, sf_dir)
    run_raw(spark, job, where, "19980101", incremental=False)
    run_raw(spark, job, where, "20020101")
    return spark.read.parquet(run_raw(spark, job, where, "19980101"))


def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dates in a registered table; the second run adds its partition to it."""
    name = database(spark)
    job = {
        "job_name": "customer",
        "source": {"type": "parquet", "path": "customer.parquet"},
        "destination": {"path": "crm/customer", "table_name": "customer", "raw": {"database": name}},
    }
    where = layers(spark, sf_dir)
    run_raw(spark, job, where, "20240101")
    run_raw(spark, job, where, "20240102")
    return spark.table(f"{name}.customer")


def raw_batch_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = {
        "job_name": "events",
        "source": {
            "type": "parquet",
            "path": "events.parquet",
            "conditions": [{"filter_date": "ts", "days": -7, "compare": ">="}],
        },
        "destination": {"path": "web/events"},
    }
    where = layers(spark, sf_dir)
    run_raw(spark, job, where, "20240110")
    return read_batch(spark, run_raw(spark, job, where, "20240120"), "20240120")


def raw_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that is new in a batch is there when the batch is read."""
    path = f"{scratch(spark)}/raw/supplier"
    supplier = table(spark, sf_dir, "supplier")
    save_raw(supplier, path, "20240101")
    save_raw(supplier.withColumn("in_debt", F.col("s_acctbal") < 0), path, "20240102")
    return read_batch(spark, path, "20240102")


_CUSTOMER = (
    'c_custkey AS "C_CUSTKEY", c_name AS "C_NAME", c_nationkey AS "C_NATIONKEY", '
    'c_acctbal AS "C_ACCTBAL", c_mktsegment AS "C_MKTSEGMENT"'
)
_ORDERS = (
    'o_orderkey AS "O_ORDERKEY", o_custkey AS "O_CUSTKEY", o_orderstatus AS "O_ORDERSTATUS", '
    'o_totalprice AS "O_TOTALPRICE", o_orderdate AS "O_ORDERDATE", o_orderpriority AS "O_ORDERPRIORITY"'
)

CHECKS = {
    "raw_stamp_upper": (
        raw_stamp_upper,
        'SELECT l_orderkey AS "L_ORDERKEY", l_partkey AS "L_PARTKEY", l_suppkey AS "L_SUPPKEY", '
        'l_linenumber AS "L_LINENUMBER", l_quantity AS "L_QUANTITY", l_extendedprice AS "L_EXTENDEDPRICE", '
        'l_discount AS "L_DISCOUNT", l_tax AS "L_TAX", l_returnflag AS "L_RETURNFLAG", '
        'l_linestatus AS "L_LINESTATUS", l_shipdate AS "L_SHIPDATE", 20240101 AS "DT_IMPORT" FROM lineitem',
    ),
    "raw_rerun": (
        raw_rerun,
        f'SELECT {_ORDERS}, 19980101 AS "DT_IMPORT" FROM orders WHERE o_orderdate < TIMESTAMP \'1998-01-01\' '
        f'UNION ALL SELECT {_ORDERS}, 20020101 FROM orders WHERE o_orderdate < TIMESTAMP \'2002-01-01\'',
    ),
    "raw_table": (
        raw_table,
        f"SELECT {_CUSTOMER}, '20240101' AS \"DT_IMPORT\" FROM customer "
        f"UNION ALL SELECT {_CUSTOMER}, '20240102' FROM customer",
    ),
    "raw_batch_filter": (
        raw_batch_filter,
        'SELECT event_id AS "EVENT_ID", ts AS "TS", user_id AS "USER_ID", event_type AS "EVENT_TYPE", '
        'value AS "VALUE", props AS "PROPS", 20240120 AS "DT_IMPORT" FROM events '
        "WHERE ts >= TIMESTAMP '2024-01-13'",
    ),
    "raw_schema_drift": (
        raw_schema_drift,
        'SELECT s_suppkey AS "S_SUPPKEY", s_name AS "S_NAME", s_nationkey AS "S_NATIONKEY", '
        's_acctbal AS "S_ACCTBAL", s_acctbal < 0 AS "IN_DEBT", 20240102 AS "DT_IMPORT" FROM supplier',
    ),
}

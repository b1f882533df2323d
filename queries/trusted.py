"""Trusted datasets: replace, partition replace, tables, batch metrics."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.tables import database, layers, scratch, table
from stratalake import get_job, load_jobs, run_job, run_jobs, run_raw, run_trusted, save_trusted
from stratalake.operators.transforms import trim


def _orders_job(trusted: dict, conditions: list[dict] | None = None) -> dict:
    return {
        "job_name": "orders",
        "source": {"type": "parquet", "path": "orders.parquet", "conditions": conditions or []},
        "destination": {"path": "sales/orders", "table_name": "orders", "trusted": trusted},
    }


def replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch replaces all of the first."""
    job = _orders_job(
        {"ingest_type": "Replace"}, [{"filter_date": "o_orderdate", "days": -1461, "compare": ">="}]
    )
    where = layers(spark, sf_dir)
    for batch_date, incremental in (("20000101", False), ("20020101", True)):
        run_raw(spark, job, where, batch_date, incremental)
        result = run_trusted(spark, job, where, batch_date)
    return spark.read.parquet(result.path)


def replace_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch has one status only; the others keep their first rows."""
    path = f"{scratch(spark)}/trusted/orders"
    trusted = {"ingest_type": "ReplacePartition", "partitions": ["o_orderstatus"]}
    orders = table(spark, sf_dir, "orders")
    save_trusted(orders, path, trusted)
    finished = orders.filter("o_orderstatus = 'F' AND o_totalprice > 1000")
    save_trusted(finished.withColumn("o_totalprice", F.col("o_totalprice") + 1), path, trusted)
    return spark.read.parquet(path)


def replace_partition_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank padding in the partition column: trimmed, it is one partition with NULL, in files and table."""
    name = database(spark)
    path = f"{scratch(spark)}/trusted/orders"
    trusted = {"ingest_type": "ReplacePartition", "database": name, "partitions": ["o_orderstatus"]}
    orders = table(spark, sf_dir, "orders")
    blank = F.when(F.col("o_orderstatus") == "P", F.lit("   ")).otherwise(F.concat("o_orderstatus", F.lit("  ")))
    padded = trim(orders.withColumn("o_orderstatus", blank), [{"column_name": "o_orderstatus"}])
    save_trusted(padded, path, trusted, "orders")
    again = padded.filter("o_orderstatus = '' AND o_totalprice > 1000")
    save_trusted(again.withColumn("o_totalprice", F.col("o_totalprice") + 1), path, trusted, "orders")
    return spark.table(f"{name}.orders")


def replace_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch without rows leaves what is there."""
    job = _orders_job({"ingest_type": "Full"}, [{"filter_date": "o_orderdate", "days": 0, "compare": ">"}])
    where = layers(spark, sf_dir)
    run_raw(spark, job, where, "20200101", incremental=False)
    path = run_trusted(spark, job, where, "20200101").path
    run_raw(spark, job, where, "20200102")
    run_trusted(spark, job, where, "20200102")
    return spark.read.parquet(path)


def trusted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned table, then a batch that adds one partition to it and replaces another."""
    name = database(spark)
    path = f"{scratch(spark)}/trusted/lineitem"
    trusted = {
        "ingest_type": "ReplacePartition",
        "database": name,
        "partitions": ["l_returnflag", "l_linestatus"],
        "options": {"compression": "zstd"},
    }
    lineitem = table(spark, sf_dir, "lineitem")
    save_trusted(lineitem.filter("l_returnflag <> 'R'"), path, trusted, "lineitem")
    taxed = lineitem.filter("l_returnflag <> 'A'").withColumn("l_tax", F.lit(0.5))
    save_trusted(taxed, path, trusted, "lineitem")
    return spark.table(f"{name}.lineitem")


def replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered table that is replaced by a batch with another schema."""
    name = database(spark)
    path = f"{scratch(spark)}/trusted/part"
    trusted = {"ingest_type": "Replace", "database": name}
    part = table(spark, sf_dir, "part")
    save_trusted(part, path, trusted, "part")
    save_trusted(part.drop("p_name").withColumn("large", F.col("p_size") > 25), path, trusted, "part")
    return spark.table(f"{name}.part")


def job_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job from a file of jobs, both steps run from arguments given as text."""
    where = layers(spark, sf_dir)
    jobs = [
        _orders_job({"ingest_type": "Replace"}),
        {
            "job_name": "customer",
            "system": "crm",
            "source": {
                "type": "parquet",
                "path": "customer.parquet",
                "conditions": [{"filter_date": "absent", "days": 0, "compare": "="}],
            },
            "destination": {
                "path": "crm/customer/",
                "trusted": {
                    "ingest_type": "ReplacePartition",
                    "partitions": ["SEGMENT"],
                    "transformations": [
                        {
                            "name": "RenameCast",
                            "parameters": [
                                {"column_name": "C_MKTSEGMENT", "new_column_name": "SEGMENT", "data_type": "String"},
                                {"column_name": "C_ACCTBAL", "new_column_name": "BALANCE", "data_type": "Integer"},
                            ],
                        }
                    ],
                },
            },
        },
    ]
    file = f"{where['raw']}-jobs"
    spark.createDataFrame([(json.dumps(jobs),)], "value string").coalesce(1).write.text(file)
    job = get_job(load_jobs(spark, file), "customer")
    run_job(spark, job, where, "raw", "20240131", incremental="False")
    run_job(spark, job, where, "trusted", "20240131")
    return spark.read.parquet(f"{where['trusted']}/crm/customer")


def jobs_parallel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four jobs side by side, one of which fails: what each stored, with the rows that are there afterwards."""

    def job(name: str, file: str, **trusted) -> dict:
        return {
            "job_name": name,
            "source": {"type": "parquet", "path": file},
            "destination": {"path": f"together/{name}", "trusted": {"ingest_type": "Replace", **trusted}},
        }

    where = layers(spark, sf_dir)
    jobs = [
        job("orders", "orders.parquet", ingest_type="Upsert", key_column="O_ORDERKEY", order_column="DT_IMPORT"),
        job("absent", "absent.parquet"),
        job("customer", "customer.parquet", ingest_type="ReplacePartition", partitions=["C_MKTSEGMENT"]),
        job("events", "events.parquet"),
    ]
    outcomes = run_jobs(spark, jobs, where, "20240131", at_once=3, incremental="false")
    found = [
        spark.read.parquet(outcome.results[-1].path)
        .agg(F.count("*").alias("stored"), F.max("DT_IMPORT").cast("string").alias("batch"))
        .select(F.lit(outcome.job_name).alias("job"), F.lit(outcome.results[-1].rows).cast("long").alias("rows"), "stored", "batch")
        for outcome in outcomes
        if outcome.error is None
    ]
    failed = [(outcome.job_name, len(outcome.results)) for outcome in outcomes if outcome.error is not None]
    reported = spark.createDataFrame(failed, "job string, rows long").selectExpr("*", "0L AS stored", "'failed' AS batch")
    return reduce(DataFrame.union, found, reported)


def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = {
        "job_name": "events",
        "source": {"type": "parquet", "path": "events.parquet"},
        "destination": {"path": "events", "trusted": {"ingest_type": "Replace"}},
    }
    where = layers(spark, sf_dir)
    run_raw(spark, job, where, "20240131")
    result = run_trusted(spark, job, where, "20240131")
    return spark.createDataFrame([(result.batch_date, result.rows)], "batch_date string, rows long")


def batch_cast_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates and numbers as text, some unreadable: what each cast of an upsert lost, counted by the write."""
    where = layers(spark, scratch(spark))
    bad = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("bad")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    price = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_totalprice").cast("string"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", bad.alias("day"), price.alias("price"), F.lit("7").alias("one"))
    orders.write.parquet(f"{where['landing']}/orders.parquet")
    casts = [{"column_name": "PRICE", "new_column_name": "PAID", "data_type": "Double"}, {"column_name": "ONE", "new_column_name": "ONE", "data_type": "Int"}]
    transformations = [
        {"name": "CastDate", "parameters": [{"column_name": "DAY", "source_format": "yyyyMMdd"}]},
        {"name": "Trim", "parameters": [{"column_name": "PRICE"}]},
        {"name": "RenameCast", "parameters": casts},
    ]
    job = _orders_job({"ingest_type": "Upsert", "key_column": "O_ORDERKEY", "order_column": "DT_IMPORT", "transformations": transformations})
    run_raw(spark, job, where, "20240131", incremental=False)
    result = run_trusted(spark, job, where, "20240131")
    found = [(*loss, result.rows, result.exact) for loss in result.cast_losses]
    return spark.createDataFrame(found, "transform string, column string, lost long, rows long, exact boolean")


_ORDERS = (
    'o_orderkey AS "O_ORDERKEY", o_custkey AS "O_CUSTKEY", o_orderstatus AS "O_ORDERSTATUS", '
    'o_totalprice AS "O_TOTALPRICE", o_orderdate AS "O_ORDERDATE", o_orderpriority AS "O_ORDERPRIORITY"'
)

CHECKS = {
    "jobs_parallel": (
        jobs_parallel,
        """
        SELECT 'orders' AS job, count(*) AS rows, count(DISTINCT o_orderkey) AS stored, '20240131' AS batch FROM orders
        UNION ALL SELECT 'customer', count(*), count(*), '20240131' FROM customer
        UNION ALL SELECT 'events', count(*), count(*), '20240131' FROM events
        UNION ALL SELECT 'absent', 0, 0, 'failed'
        """,
    ),
    "replace_partition_table": (
        replace_partition_table,
        """
        SELECT * EXCLUDE (o_orderstatus), o_orderstatus FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL
        SELECT * EXCLUDE (o_orderstatus) REPLACE (o_totalprice + 1 AS o_totalprice), NULL
        FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 1000
        """,
    ),
    "replace": (
        replace,
        f'SELECT {_ORDERS}, 20020101 AS "DT_IMPORT" FROM orders WHERE o_orderdate >= TIMESTAMP \'1998-01-01\'',
    ),
    "replace_partition": (
        replace_partition,
        "SELECT * FROM orders WHERE o_orderstatus <> 'F' "
        "UNION ALL SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders "
        "WHERE o_orderstatus = 'F' AND o_totalprice > 1000",
    ),
    "replace_empty": (replace_empty, f'SELECT {_ORDERS}, 20200101 AS "DT_IMPORT" FROM orders'),
    "trusted_table": (
        trusted_table,
        "SELECT * REPLACE (CASE WHEN l_returnflag = 'A' THEN l_tax ELSE 0.5 END AS l_tax) FROM lineitem",
    ),
    "replace_table": (
        replace_table,
        "SELECT p_partkey, p_brand, p_type, p_size, p_retailprice, p_size > 25 AS large FROM part",
    ),
    "job_run": (
        job_run,
        'SELECT c_custkey AS "C_CUSTKEY", c_name AS "C_NAME", c_nationkey AS "C_NATIONKEY", '
        'trunc(c_acctbal)::INTEGER AS "BALANCE", c_mktsegment AS "SEGMENT", 20240131 AS "DT_IMPORT" FROM customer',
    ),
    "batch_cast_losses": (
        batch_cast_losses,
        """
        SELECT unnest(['CastDate', 'RenameCast', 'RenameCast']) AS transform, unnest(['DAY', 'PRICE', 'ONE']) AS column,
               unnest([count(*) FILTER (o_orderpriority = '5-LOW'), count(*) FILTER (o_orderstatus = 'P'), 0]) AS lost,
               unnest([count(*), count(*), count(*)]) AS rows, unnest([true, true, true]) AS exact
        FROM orders
        """,
    ),
    "batch_metrics": (batch_metrics, "SELECT '20240131' AS batch_date, count(*) AS rows FROM events"),
}

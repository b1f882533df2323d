"""The given tables, and a place for the layers a query writes."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder under the shared one the session names in ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/stratalake-{uuid4().hex}"


def layers(spark: SparkSession, landing: str) -> dict[str, str]:
    """Layers that read ``landing`` and write to a new folder."""
    root = scratch(spark)
    return {"landing": landing, "raw": f"{root}/raw", "trusted": f"{root}/trusted"}


def database(spark: SparkSession) -> str:
    """A new, empty database."""
    name = f"strata_{uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch(spark)}'")
    return name


def orders_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a delimited file holds them: text, dates as yyyyMMdd, money with two digits."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string"),
        F.col("o_custkey").cast("string"),
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(15,2)").cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("o_orderdate"),
        "o_orderpriority",
    )


def orders_with_bad_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as yyyyMMdd text, those of low priority orders unreadable."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", "bad")
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
        .alias("d"),
    )


def with_cents_as_text(df: DataFrame) -> DataFrame:
    """All columns, amounts as text with two digits, as engines write a double differently."""
    doubles = [c for c, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.col(c).cast("decimal(15,2)").cast("string") for c in doubles})


ORDERS_AS_TEXT_SQL = """
SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus,
       o_totalprice::DECIMAL(15,2)::VARCHAR AS o_totalprice,
       strftime(o_orderdate, '%Y%m%d') AS o_orderdate, o_orderpriority
FROM orders
"""

ORDERS_WITH_BAD_DATES_SQL = """
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'bad' ELSE strftime(o_orderdate, '%Y%m%d') END AS d
FROM orders
"""

"""Date conditions of an incremental load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.tables import (
    ORDERS_WITH_BAD_DATES_SQL,
    layers,
    orders_with_bad_dates,
    table,
)
from stratalake import incremental_filter, read_batch, run_raw


def incremental_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    conditions = [{"filter_date": "ts", "days": -2, "compare": ">="}]
    return incremental_filter(table(spark, sf_dir, "events"), conditions, "20240110")


def incremental_fmt(spark: SparkSession, sf_dir: str) -> DataFrame:
    conditions = [{"filter_date": "d", "days": "-30", "compare": ">", "date_format": "yyyyMMdd"}]
    return incremental_filter(orders_with_bad_dates(spark, sf_dir), conditions, "20000101")


def incremental_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    conditions = [
        {"filter_date": "d", "days": -365, "compare": ">=", "date_format": "yyyyMMdd"},
        {"filter_date": "d", "days": 7, "compare": "<", "date_format": "yyyyMMdd"},
    ]
    return incremental_filter(orders_with_bad_dates(spark, sf_dir), conditions, "19990601")


def incremental_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", "bad")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("d"),
    )
    return incremental_filter(orders, [{"filter_date": "d", "days": 0, "compare": "<>"}], "19990601")


def incremental_compares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other comparisons: up to a day, on it, not on it."""
    events = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("d"))
    found = []
    for n, compare in enumerate(["<=", "=", "==", "!="]):
        kept = incremental_filter(events, [{"filter_date": "d", "days": n - 2, "compare": compare}], "20240110")
        found.append(kept.select("event_id", F.lit(compare).alias("compare")))
    return found[0].union(found[1]).union(found[2]).union(found[3])


def incremental_off(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full load ignores the conditions the job has."""
    job = {
        "job_name": "events",
        "source": {
            "type": "parquet",
            "path": "events.parquet",
            "conditions": [{"filter_date": "ts", "days": -2, "compare": ">="}],
        },
        "destination": {"path": "events"},
    }
    path = run_raw(spark, job, layers(spark, sf_dir), "20240110", incremental=False)
    return read_batch(spark, path, "20240110")


CHECKS = {
    "incremental_ts": (incremental_ts, "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-08'"),
    "incremental_fmt": (
        incremental_fmt,
        f"SELECT * FROM ({ORDERS_WITH_BAD_DATES_SQL}) "
        "WHERE try_strptime(d, '%Y%m%d')::DATE > DATE '2000-01-01' - 30",
    ),
    "incremental_range": (
        incremental_range,
        f"SELECT * FROM ({ORDERS_WITH_BAD_DATES_SQL}) "
        "WHERE try_strptime(d, '%Y%m%d')::DATE >= DATE '1999-06-01' - 365 "
        "AND try_strptime(d, '%Y%m%d')::DATE < DATE '1999-06-01' + 7",
    ),
    "incremental_text": (
        incremental_text,
        "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders "
        "WHERE o_orderpriority <> '5-LOW' AND o_orderdate::DATE <> DATE '1999-06-01'",
    ),
    "incremental_compares": (
        incremental_compares,
        "SELECT event_id, '<=' AS compare FROM events WHERE ts::DATE <= DATE '2024-01-08' "
        "UNION ALL SELECT event_id, '=' FROM events WHERE ts::DATE = DATE '2024-01-09' "
        "UNION ALL SELECT event_id, '==' FROM events WHERE ts::DATE = DATE '2024-01-10' "
        "UNION ALL SELECT event_id, '!=' FROM events WHERE ts::DATE <> DATE '2024-01-11'",
    ),
    "incremental_off": (
        incremental_off,
        'SELECT event_id AS "EVENT_ID", ts AS "TS", user_id AS "USER_ID", event_type AS "EVENT_TYPE", '
        'value AS "VALUE", props AS "PROPS", 20240110 AS "DT_IMPORT" FROM events',
    ),
}

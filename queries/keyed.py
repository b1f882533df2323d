"""Keyed tables: the newest row per key, and merges of batches into what is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.tables import ORDERS_AS_TEXT_SQL, database, layers, orders_as_text, scratch, table
from stratalake import latest_per_key, run_raw, run_trusted, save_trusted, upsert


def dedupe_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(table(spark, sf_dir, "events"), ["user_id"], ["ts"])


def latest_event_per_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A handful of keys, each with a large part of all rows."""
    return latest_per_key(table(spark, sf_dir, "events"), ["event_type"], ["ts"])


def _stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders before the year 2000, all at version 1."""
    return table(spark, sf_dir, "orders").filter("o_orderdate < '2000-01-01'").withColumn("version", F.lit(1))


def _changed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders from 1997 on at version 2 and another price: some are stored, some are new."""
    return (
        table(spark, sf_dir, "orders")
        .filter("o_orderdate >= '1997-01-01'")
        .withColumn("o_totalprice", F.col("o_totalprice") + 1)
        .withColumn("version", F.lit(2))
    )


def _upsert_orders(spark: SparkSession, sf_dir: str, stored: DataFrame, changed: DataFrame, **how) -> DataFrame:
    path = f"{scratch(spark)}/trusted/orders"
    upsert(stored, path, ["o_orderkey"], ["version"])
    upsert(changed, path, ["o_orderkey"], ["version"], **how)
    return spark.read.parquet(path)


def upsert_newer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert_orders(spark, sf_dir, _stored_orders(spark, sf_dir), _changed_orders(spark, sf_dir))


def upsert_few(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few changed and a few new keys: only the files that hold the changed ones are rewritten."""
    path = f"{scratch(spark)}/trusted/orders"
    orders = table(spark, sf_dir, "orders").withColumn("version", F.lit(1))
    stored = orders.filter("o_orderkey % 1000 <> 7").repartitionByRange(8, "o_orderkey")
    save_trusted(stored, path, {"ingest_type": "Replace"})
    changed = orders.filter("o_orderkey % 1000 = 7 OR o_orderkey BETWEEN 100 AND 200")
    changed = changed.withColumn("version", F.lit(2)).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    upsert(changed, path, ["o_orderkey"], ["version"])
    return spark.read.parquet(path)


def upsert_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge for a batch with too many keys to broadcast, published by a rewrite."""
    return _upsert_orders(
        spark,
        sf_dir,
        _stored_orders(spark, sf_dir),
        _changed_orders(spark, sf_dir),
        broadcast_bytes=0,
        publish="rewrite",
    )


def upsert_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearly the whole table again, too much to broadcast: the few stored keys that stay are, while few."""
    path = f"{scratch(spark)}/trusted/orders"
    orders = table(spark, sf_dir, "orders").withColumn("version", F.lit(1))
    upsert(orders, path, ["o_orderkey"], ["version"])
    again = orders.filter("o_orderdate >= '1995-02-01'").withColumn("version", F.lit(2))
    upsert(again, path, ["o_orderkey"], ["version"], broadcast_bytes=500_000)
    return spark.read.parquet(path)


def _stale_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored orders, of which the finished ones are newer than any change."""
    version = F.when(F.col("o_orderstatus") == "F", 3).otherwise(1)
    return _stored_orders(spark, sf_dir).withColumn("version", version)


def upsert_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert_orders(spark, sf_dir, _stale_orders(spark, sf_dir), _changed_orders(spark, sf_dir))


def upsert_incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert_orders(
        spark, sf_dir, _stale_orders(spark, sf_dir), _changed_orders(spark, sf_dir), stale="incoming_wins"
    )


def upsert_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of one status; only that partition is read and rewritten."""
    path = f"{scratch(spark)}/trusted/orders"
    key, order, by = ["o_orderkey"], ["version"], ["o_orderstatus"]
    upsert(_stored_orders(spark, sf_dir), path, key, order, by)
    upsert(_changed_orders(spark, sf_dir).filter("o_orderstatus = 'F'"), path, key, order, by)
    return spark.read.parquet(path)


def upsert_partition_few(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few changed and new keys in partitions of eight files: only files that hold the changed ones are rewritten."""
    path = f"{scratch(spark)}/trusted/orders"
    orders = table(spark, sf_dir, "orders").withColumn("version", F.lit(1))
    stored = orders.filter("o_orderkey % 1000 <> 7").repartitionByRange(8, "o_orderkey")
    stored.write.partitionBy("o_orderstatus").parquet(path)
    changed = orders.filter("o_orderkey % 1000 = 7 OR o_orderkey BETWEEN 100 AND 200")
    changed = changed.withColumn("version", F.lit(2)).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    upsert(changed, path, ["o_orderkey"], ["version"], ["o_orderstatus"])
    return spark.read.parquet(path)


def upsert_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in files by ranges of both key columns; a batch of a range of customers, some of their orders new."""
    path = f"{scratch(spark)}/trusted/orders"
    orders = table(spark, sf_dir, "orders").withColumn("version", F.lit(1))
    keys, inside = ["o_custkey", "o_orderkey"], "o_custkey BETWEEN 100 AND 200"
    upsert(orders.filter(f"NOT ({inside} AND o_orderkey % 7 = 1)"), path, keys, ["version"], cluster=True)
    changed = orders.filter(inside).withColumn("version", F.lit(2)).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    upsert(changed, path, keys, ["version"], cluster=True)
    return spark.read.parquet(path)


def upsert_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a nested column that gains fields: stored ones lack them, and the merge gives them NULL."""
    path = f"{scratch(spark)}/trusted/orders"
    orders = table(spark, sf_dir, "orders")
    key, order, by = ["o_orderkey"], ["version"], ["o_orderstatus"]
    stored = orders.filter("o_orderdate < '2000-01-01'").select(
        "o_orderkey", "o_orderstatus", F.struct("o_custkey", F.array(F.struct("o_orderpriority")).alias("notes")).alias("about"), F.lit(1).alias("version")
    )
    notes = F.array(F.struct("o_orderpriority", F.year("o_orderdate").alias("year")))
    changed = orders.filter("o_orderdate >= '1997-01-01'").select(
        "o_orderkey", "o_orderstatus", F.struct("o_orderdate", "o_custkey", notes.alias("notes")).alias("about"), F.lit(2).alias("version")
    )
    upsert(stored, path, key, order, by)
    upsert(changed, path, key, order, by)
    found = spark.read.option("mergeSchema", "true").parquet(path)
    return found.select(
        "o_orderkey",
        "o_orderstatus",
        "version",
        "about.o_custkey",
        "about.o_orderdate",
        F.col("about.notes")[0]["o_orderpriority"].alias("o_orderpriority"),
        F.col("about.notes")[0]["year"].alias("year"),
    )


def upsert_table_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered table whose upserts are published by a switch of its location; the second brings a column."""
    name = database(spark)
    trusted = {"ingest_type": "Upsert", "database": name, "key_column": "o_orderkey", "order_column": "version", "publish": "switch"}
    path = f"{scratch(spark)}/trusted/orders"
    save_trusted(_stored_orders(spark, sf_dir), path, trusted, "orders")
    changed = _changed_orders(spark, sf_dir).withColumn("year", F.year("o_orderdate"))
    save_trusted(changed, path, trusted, "orders")
    return spark.table(f"{name}.orders")


def upsert_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations: those of users come again, in upper case, and win their ties."""
    path = f"{scratch(spark)}/trusted/conversations"
    turns = table(spark, sf_dir, "conversations").withColumn("version", F.lit(1))
    users = turns.filter("role = 'user'").withColumn("role", F.upper("role"))
    upsert(turns, path, ["conv_id", "turn"], ["version"])
    upsert(users, path, ["conv_id", "turn"], ["version"])
    return spark.read.parquet(path)


def upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered keyed table over three batch dates; each brings the last 30 days of events."""
    job = {
        "job_name": "users",
        "source": {
            "type": "parquet",
            "path": "events.parquet",
            "conditions": [
                {"filter_date": "ts", "days": -30, "compare": ">="},
                {"filter_date": "ts", "days": 0, "compare": "<"},
            ],
        },
        "destination": {
            "path": "web/users/",
            "table_name": "users",
            "trusted": {
                "ingest_type": "Upsert",
                "database": database(spark),
                "partitions": ["EVENT_TYPE"],
                "key_column": ["USER_ID"],
                "order_column": ["DT_IMPORT", "TS"],
            },
        },
    }
    where = layers(spark, sf_dir)
    for batch_date in ("20240111", "20240121", "20240201"):
        run_raw(spark, job, where, batch_date)
        run_trusted(spark, job, where, batch_date)
    return spark.table(f"{job['destination']['trusted']['database']}.users")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders from delimited text, in two overlapping loads, cleaned and merged by key."""
    where = layers(spark, scratch(spark))
    landing = orders_as_text(spark, sf_dir).withColumn(
        "o_orderpriority", F.concat(F.lit("  "), "o_orderpriority", F.lit(" "))
    )
    landing.write.csv(f"{where['landing']}/sales/orders", header=True)
    job = {
        "job_name": "orders",
        "source": {
            "type": "csv",
            "path": "sales/orders/",
            "options": {
                "sep": ",",
                "header": "true",
                "ignoreLeadingWhiteSpace": "false",
                "ignoreTrailingWhiteSpace": "false",
            },
            "conditions": [
                {"filter_date": "o_orderdate", "days": -1461, "compare": ">=", "date_format": "yyyyMMdd"},
                {"filter_date": "o_orderdate", "days": 0, "compare": "<", "date_format": "yyyyMMdd"},
            ],
        },
        "destination": {
            "path": "sales/orders/",
            "table_name": "orders",
            "raw": {},
            "trusted": {
                "ingest_type": "Upsert",
                "key_column": ["O_ORDERKEY"],
                "order_column": "DT_IMPORT",
                "transformations": [
                    {"name": "Trim", "parameters": [{"column_name": "O_ORDERPRIORITY"}]},
                    {
                        "name": "CastDate",
                        "parameters": [{"column_name": "O_ORDERDATE", "source_format": "yyyyMMdd"}],
                    },
                    {
                        "name": "RenameCast",
                        "parameters": [
                            {"column_name": "O_ORDERDATE", "new_column_name": "DT_ORDER", "data_type": "Date"},
                            {"column_name": "O_TOTALPRICE", "new_column_name": "PRICE", "data_type": "Float"},
                        ],
                    },
                ],
            },
        },
    }
    for batch_date in ("19990101", "20020101"):
        run_raw(spark, job, where, batch_date)
        result = run_trusted(spark, job, where, batch_date)
    return spark.read.parquet(result.path)


def _newest_sql(name: str, keys: str, order: str, rest: str) -> str:
    ties = ", ".join(f"{c} DESC NULLS LAST" for c in rest.split(", "))
    return (
        f"SELECT * FROM {name} QUALIFY row_number() OVER "
        f"(PARTITION BY {keys} ORDER BY {order} DESC NULLS LAST, {ties}) = 1"
    )


_CHANGED_SQL = """
SELECT * REPLACE (o_totalprice + 1 AS o_totalprice), 2 AS version
FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'
"""
_KEPT_SQL = "SELECT *, 1 AS version FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'"
_FINISHED_SQL = "CASE WHEN o_orderstatus = 'F' THEN 3 ELSE 1 END"
_UPSERT_SQL = f"{_KEPT_SQL} UNION ALL {_CHANGED_SQL}"

_FEW_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
       CASE WHEN changed THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN changed THEN 2 ELSE 1 END AS version
FROM (SELECT *, o_orderkey % 1000 = 7 OR o_orderkey BETWEEN 100 AND 200 AS changed FROM orders)
"""

CHECKS = {
    "upsert_clustered": (
        upsert_clustered,
        """
        SELECT * EXCLUDE (hit) REPLACE (o_totalprice + hit::INT AS o_totalprice), 1 + hit::INT AS version
        FROM (SELECT *, o_custkey BETWEEN 100 AND 200 AS hit FROM orders)
        """,
    ),
    "upsert_few": (upsert_few, _FEW_SQL),
    "upsert_partition_few": (upsert_partition_few, _FEW_SQL),
    "upsert_table_switch": (
        upsert_table_switch,
        f"SELECT *, NULL::INTEGER AS year FROM ({_KEPT_SQL}) UNION ALL SELECT *, year(o_orderdate)::INTEGER FROM ({_CHANGED_SQL})",
    ),
    "upsert_nested": (
        upsert_nested,
        """
        SELECT o_orderkey, o_orderstatus, CASE WHEN new THEN 2 ELSE 1 END AS version, o_custkey,
               CASE WHEN new THEN o_orderdate END AS o_orderdate, o_orderpriority,
               CASE WHEN new THEN year(o_orderdate)::INTEGER END AS year
        FROM (SELECT *, o_orderdate >= TIMESTAMP '1997-01-01' AS new FROM orders)
        """,
    ),
    "dedupe_batch": (
        dedupe_batch,
        _newest_sql(
            "lineitem",
            "l_orderkey, l_linenumber",
            "l_shipdate",
            "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus",
        ),
    ),
    "latest_event_per_user": (
        latest_event_per_user,
        _newest_sql("events", "user_id", "ts", "event_id, event_type, value, props"),
    ),
    "latest_event_per_type": (
        latest_event_per_type,
        _newest_sql("events", "event_type", "ts", "event_id, user_id, value, props"),
    ),
    "upsert_newer": (upsert_newer, _UPSERT_SQL),
    "upsert_shuffled": (upsert_shuffled, _UPSERT_SQL),
    "upsert_reload": (
        upsert_reload,
        "SELECT *, CASE WHEN o_orderdate >= TIMESTAMP '1995-02-01' THEN 2 ELSE 1 END AS version FROM orders",
    ),
    "upsert_stale": (
        upsert_stale,
        f"SELECT *, {_FINISHED_SQL} AS version FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' "
        "OR (o_orderdate < TIMESTAMP '2000-01-01' AND o_orderstatus = 'F') "
        f"UNION ALL SELECT * FROM ({_CHANGED_SQL}) "
        "WHERE o_orderdate >= TIMESTAMP '2000-01-01' OR o_orderstatus <> 'F'",
    ),
    "upsert_incoming": (
        upsert_incoming,
        f"SELECT *, {_FINISHED_SQL} AS version FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' "
        f"UNION ALL {_CHANGED_SQL}",
    ),
    "upsert_partitioned": (
        upsert_partitioned,
        "SELECT *, 1 AS version FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' "
        "OR (o_orderdate < TIMESTAMP '2000-01-01' AND o_orderstatus <> 'F') "
        f"UNION ALL SELECT * FROM ({_CHANGED_SQL}) WHERE o_orderstatus = 'F'",
    ),
    "upsert_composite": (
        upsert_composite,
        "SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'USER' ELSE role END AS role, text, 1 AS version "
        "FROM conversations QUALIFY row_number() OVER "
        "(PARTITION BY conv_id, turn ORDER BY role = 'user' DESC, role DESC, text DESC) = 1",
    ),
    "upsert_table": (
        upsert_table,
        'SELECT event_id AS "EVENT_ID", ts AS "TS", user_id AS "USER_ID", event_type AS "EVENT_TYPE", '
        'value AS "VALUE", props AS "PROPS", CASE WHEN max(ts) OVER p >= TIMESTAMP \'2024-01-02\' THEN 20240201 '
        'ELSE 20240121 END AS "DT_IMPORT" FROM events '
        "WINDOW p AS (PARTITION BY user_id, event_type) QUALIFY row_number() OVER (PARTITION BY user_id, event_type "
        "ORDER BY ts DESC, event_id DESC, value DESC, props DESC) = 1",
    ),
    "flagship": (
        flagship,
        'SELECT o_orderkey AS "O_ORDERKEY", o_custkey AS "O_CUSTKEY", o_orderstatus AS "O_ORDERSTATUS", '
        'o_totalprice::FLOAT AS "PRICE", strptime(o_orderdate, \'%Y%m%d\')::DATE AS "DT_ORDER", '
        'o_orderpriority AS "O_ORDERPRIORITY", '
        "CASE WHEN o_orderdate >= '19980101' THEN 20020101 ELSE 19990101 END AS \"DT_IMPORT\" "
        f"FROM ({ORDERS_AS_TEXT_SQL})",
    ),
}

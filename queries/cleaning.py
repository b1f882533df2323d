"""Trim, CastDate, RenameCast and chains of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.tables import (
    ORDERS_AS_TEXT_SQL,
    ORDERS_WITH_BAD_DATES_SQL,
    orders_as_text,
    orders_with_bad_dates,
    table,
)
from stratalake import apply_transforms, register_transform


def _padded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.concat(F.lit("  "), "o_orderstatus", F.lit(" ")).alias("o_orderstatus"),
        "o_totalprice",
        "o_orderdate",
        F.concat(F.lit("\t "), "o_orderpriority", F.lit("   ")).alias("o_orderpriority"),
        F.lit(20240101).alias("DT_IMPORT"),
    )


_PADDED_ORDERS_SQL = """
SELECT o_orderkey, o_custkey, '  ' || o_orderstatus || ' ' AS o_orderstatus, o_totalprice, o_orderdate,
       chr(9) || ' ' || o_orderpriority || '   ' AS o_orderpriority, 20240101 AS "DT_IMPORT"
FROM orders
"""


def trim_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = [
        {"name": "Trim", "parameters": [{"column_name": "o_orderstatus"}, {"column_name": "o_orderpriority"}]}
    ]
    return apply_transforms(_padded_orders(spark, sf_dir), entries)


def trim_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_transforms(_padded_orders(spark, sf_dir), [{"name": "Trim", "parameters": [{"column_name": "*"}]}])


def trim_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = [{"name": "Trim", "parameters": [{"column_name": "*"}]}]
    padded = table(spark, sf_dir, "documents").withColumn("text", F.concat(F.lit("   "), "text", F.lit("  ")))
    return apply_transforms(padded, entries)


def cast_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = [{"name": "CastDate", "parameters": [{"column_name": "d", "source_format": "yyyyMMdd"}]}]
    return apply_transforms(orders_with_bad_dates(spark, sf_dir), entries)


def rename_cast_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = [
        {
            "name": "RenameCast",
            "parameters": [
                {"column_name": "o_totalprice", "new_column_name": "PRICE", "data_type": "Float"},
                {"column_name": "o_orderkey", "new_column_name": "ID", "data_type": "Long"},
            ],
        }
    ]
    return apply_transforms(orders_as_text(spark, sf_dir), entries)


def rename_cast_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with a fraction, and text that is no number, as whole numbers."""
    entries = [
        {
            "name": "RenameCast",
            "parameters": [
                {"column_name": "o_totalprice", "new_column_name": "WHOLE_PRICE", "data_type": "Integer"},
                {"column_name": "o_orderpriority", "new_column_name": "PRIORITY", "data_type": "Integer"},
            ],
        }
    ]
    return apply_transforms(orders_as_text(spark, sf_dir), entries)


_CHAIN = [
    {"name": "Trim", "parameters": [{"column_name": "*"}]},
    {"name": "CastDate", "parameters": [{"column_name": "o_orderdate", "source_format": "yyyyMMdd"}]},
    {
        "name": "RenameCast",
        "parameters": [
            {"column_name": "o_orderdate", "new_column_name": "DT_ORDER", "data_type": "Date"},
            {"column_name": "o_totalprice", "new_column_name": "PRICE", "data_type": "Double"},
        ],
    },
]


def _padded_text_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_as_text(spark, sf_dir)
    return orders.select([F.concat(F.lit(" "), c, F.lit("  ")).alias(c) for c in orders.columns])


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_transforms(_padded_text_orders(spark, sf_dir), _CHAIN)


def chain_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the last entry shows: yyyyMMdd is no ISO date, so without the others it casts to NULL."""
    return apply_transforms(_padded_text_orders(spark, sf_dir), _CHAIN, mode="last")


def own_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A transform that a user registers, in a chain with the library's."""

    def upper(df, parameters):
        return df.withColumns({p["column_name"]: F.upper(p["column_name"]) for p in parameters})

    register_transform("Upper", upper)
    entries = [
        {"name": "Upper", "parameters": [{"column_name": "s_name"}]},
        {
            "name": "RenameCast",
            "parameters": [{"column_name": "s_name", "new_column_name": "supplier", "data_type": "string"}],
        },
    ]
    return apply_transforms(table(spark, sf_dir, "supplier"), entries)


CHECKS = {
    "own_transform": (own_transform, "SELECT * EXCLUDE (s_name), upper(s_name) AS supplier FROM supplier"),
    "trim_one": (
        trim_one,
        "SELECT * REPLACE (trim(o_orderstatus) AS o_orderstatus, trim(o_orderpriority) AS o_orderpriority) "
        f"FROM ({_PADDED_ORDERS_SQL})",
    ),
    "trim_all": (
        trim_all,
        "SELECT * REPLACE (o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, "
        "trim(o_orderstatus) AS o_orderstatus, o_totalprice::VARCHAR AS o_totalprice, "
        "o_orderdate::VARCHAR AS o_orderdate, trim(o_orderpriority) AS o_orderpriority) "
        f"FROM ({_PADDED_ORDERS_SQL})",
    ),
    "trim_texts": (
        trim_texts,
        "SELECT doc_id::VARCHAR AS doc_id, trim(text) AS text, trim(lang) AS lang, trim(source) AS source, "
        "n_chars::VARCHAR AS n_chars FROM documents",
    ),
    "cast_date": (
        cast_date,
        f"SELECT o_orderkey, try_strptime(d, '%Y%m%d')::DATE AS d FROM ({ORDERS_WITH_BAD_DATES_SQL})",
    ),
    "rename_cast_float": (
        rename_cast_float,
        'SELECT o_orderkey::BIGINT AS "ID", o_custkey, o_orderstatus, o_totalprice::FLOAT AS "PRICE", '
        f"o_orderdate, o_orderpriority FROM ({ORDERS_AS_TEXT_SQL})",
    ),
    "rename_cast_int": (
        rename_cast_int,
        'SELECT o_orderkey, o_custkey, o_orderstatus, trunc(o_totalprice::DOUBLE)::INTEGER AS "WHOLE_PRICE", '
        f'o_orderdate, NULL::INTEGER AS "PRIORITY" FROM ({ORDERS_AS_TEXT_SQL})',
    ),
    "chain": (
        chain,
        'SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice::DOUBLE AS "PRICE", '
        'strptime(o_orderdate, \'%Y%m%d\')::DATE AS "DT_ORDER", o_orderpriority '
        f"FROM ({ORDERS_AS_TEXT_SQL})",
    ),
    "chain_last": (
        chain_last,
        "SELECT ' ' || o_orderkey || '  ' AS o_orderkey, ' ' || o_custkey || '  ' AS o_custkey, "
        "' ' || o_orderstatus || '  ' AS o_orderstatus, o_totalprice::DOUBLE AS \"PRICE\", "
        "NULL::DATE AS \"DT_ORDER\", ' ' || o_orderpriority || '  ' AS o_orderpriority "
        f"FROM ({ORDERS_AS_TEXT_SQL})",
    ),
}

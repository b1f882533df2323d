"""The newest row of every key."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from stratalake.functions.names import column, require_name

_RANK = "__rank"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the largest ``order`` columns, NULL lowest.

    Ties fall to the largest remaining columns, so the same rows always give the
    same winner. Spark keeps one row per key in every map task before it shuffles
    (``WindowGroupLimit ... Partial``), so a key that holds a third of all rows
    sends no more than one row per task.
    """
    keys = [require_name(df, k) for k in keys]
    order = [require_name(df, o) for o in order]
    rest = [f for f in df.schema if f.name not in {*keys, *order}]
    ranking = [column(o).desc_nulls_last() for o in order]
    ranking += [_orderable(column(f.name), f.dataType).desc_nulls_last() for f in rest]
    newest_first = Window.partitionBy(*map(column, keys)).orderBy(*ranking)
    return df.withColumn(_RANK, F.row_number().over(newest_first)).filter(F.col(_RANK) == 1).drop(_RANK)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that more than one row has, found from the key columns alone."""
    counted = df.groupBy(*map(column, keys)).agg(F.count("*").alias(_RANK))
    return counted.filter(F.col(_RANK) > 1).drop(_RANK)


def latest_of_repeated(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], repeated: DataFrame
) -> DataFrame:
    """The result of :func:`latest_per_key`, given the few ``repeated`` keys, which are broadcast.

    Only rows of these keys are compared; all others are passed on where they are.
    """
    names = {k: f"__r{i}" for i, k in enumerate(keys)}
    few = F.broadcast(repeated.select(*[column(k).alias(r) for k, r in names.items()]))
    same = reduce(operator.and_, [column(k).eqNullSafe(F.col(r)) for k, r in names.items()])
    alone = df.join(few, same, "left_anti")
    return alone.unionByName(latest_per_key(df.join(few, same, "left_semi"), keys, order))


def _orderable(col: Column, dtype: DataType) -> Column:
    """Maps and variants have no order of their own, their text has."""
    return F.to_json(F.struct(col)) if _has_unordered(dtype) else col


def _has_unordered(dtype: DataType) -> bool:
    if isinstance(dtype, (MapType, VariantType)):
        return True
    if isinstance(dtype, ArrayType):
        return _has_unordered(dtype.elementType)
    if isinstance(dtype, StructType):
        return any(_has_unordered(f.dataType) for f in dtype)
    return False

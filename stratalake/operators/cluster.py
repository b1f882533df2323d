"""Rows in the order of their keys, so that a file holds a range of them and its statistics say which."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType

from stratalake.functions.names import column

# Ranges of each of several keys, as a power of two, and rows whose keys say where they begin.
BITS = 6
SAMPLE_ROWS = 4096

_RANGED = (NumericType, StringType, DateType, TimestampType, TimestampNTZType)
_CURVE = "__curve"


def clustered(df: DataFrame, keys: Sequence[str], partitions: Sequence[str] = ()) -> DataFrame:
    """``df`` with a range of keys in each task, sorted; partition after partition, if there are any.

    Rows with one key are in its order. With several they follow a curve that takes bits of all keys
    in turn, so that a range of any of them is in few files. Within a cell of the curve keys decide, so
    rows with one value of a key can be in several tasks. The number of tasks is that of the
    session's shuffles, fewer if they would be small.

    The frame is read for samples first, only its keys; where a row goes depends on them, what is written does not.
    """
    keys = [k for k in keys if k not in partitions]
    ranged = [k for k in keys if isinstance(df.schema[k].dataType, _RANGED)]
    names = [*partitions, *([_CURVE] if len(ranged) > 1 else []), *keys]
    if not names:
        return df
    by = [column(c) for c in names]
    found = with_curve(df, ranged) if len(ranged) > 1 else df
    return found.repartitionByRange(*by).sortWithinPartitions(*by).select(*map(column, df.columns))


def with_curve(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the place of each row on the curve through the ranges of these keys."""
    bits = min(BITS, 60 // len(keys))
    starts = range_starts(df, keys, 1 << bits)
    cells = {f"__cell{i}": _cell(column(k), starts[i], bits) for i, k in enumerate(keys)}
    curve = F.lit(0).cast("long")
    for bit in range(bits):
        for i, name in enumerate(cells):
            part = F.shiftright(F.col(name), bit).bitwiseAND(F.lit(1).cast("long"))
            curve = curve.bitwiseOR(F.shiftleft(part, bit * len(keys) + len(keys) - 1 - i))
    return df.withColumns(cells).withColumn(_CURVE, curve).drop(*cells)


def range_starts(df: DataFrame, keys: Sequence[str], ranges: int) -> list[list[Column]]:
    """Where the ranges of each key but the first begin, by quantiles of some rows chosen by hash."""
    some = df.select(*map(column, keys)).orderBy(F.xxhash64(*map(column, keys))).limit(SAMPLE_ROWS)

    def quantiles(name: str) -> Column:
        values = F.sort_array(F.collect_list(column(name)))
        steps = F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)), lambda i: F.get(values, F.floor(i * F.size(values) / ranges).cast("int")))
        return F.array_compact(F.array_distinct(steps)).cast("array<string>")

    found = some.agg(*[quantiles(k).alias(f"_{i}") for i, k in enumerate(keys)]).first()
    return [[F.lit(value).cast(df.schema[k].dataType) for value in found[i]] for i, k in enumerate(keys)]


def _cell(value: Column, starts: list[Column], bits: int) -> Column:
    """The number of the range a value is in, by halving; the bits of few ranges are the high ones."""

    def place(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low).cast("long")
        middle = (low + high) // 2
        return F.when(value < starts[middle], place(low, middle)).otherwise(place(middle + 1, high))

    return F.shiftleft(place(0, len(starts)), bits - len(starts).bit_length())

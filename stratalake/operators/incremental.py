"""The date conditions of an incremental load, as one filter."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, TimestampNTZType, TimestampType

from stratalake.functions.dates import parse_date
from stratalake.functions.names import column, require_name

# The comparisons a condition may name.
COMPARISONS = {
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "=": operator.eq,
    "==": operator.eq,
    "!=": operator.ne,
    "<>": operator.ne,
}

# Formats of one width whose text sorts as its dates do, with strftime's name for them.
_SORTABLE = {
    "yyyyMMdd": "%Y%m%d",
    "yyyy-MM-dd": "%Y-%m-%d",
    "yyyy/MM/dd": "%Y/%m/%d",
    "yyyyMMddHHmmss": "%Y%m%d",
    "yyyy-MM-dd HH:mm:ss": "%Y-%m-%d",
}


def incremental_filter(df: DataFrame, conditions: Sequence[Mapping], batch_date: str) -> DataFrame:
    """Keep the rows that meet all ``conditions`` as of ``batch_date`` (yyyyMMdd)."""
    if not conditions:
        return df
    return df.filter(reduce(operator.and_, [_condition(df, c, batch_date) for c in conditions]))


def _condition(df: DataFrame, condition: Mapping, batch_date: str) -> Column:
    """``filter_date compare (batch_date + days)``.

    Without ``date_format`` the column itself is compared, so timestamps compare
    as instants and the filter reaches the scan. With it, values are parsed and
    compared by day.
    """
    name = require_name(df, condition["filter_date"])
    dtype = df.schema[name].dataType
    if condition["compare"] not in COMPARISONS:
        raise ValueError(f"compare must be one of {list(COMPARISONS)}, not {condition['compare']!r}")
    compare = COMPARISONS[condition["compare"]]
    days = int(condition["days"])
    cutoff = F.date_add(F.to_date(F.lit(batch_date), "yyyyMMdd"), days)
    fmt = condition.get("date_format")
    if not fmt:
        return compare(_as_date_like(column(name), name, dtype), cutoff)
    try:
        by_day = compare(parse_date(column(name), dtype, fmt), cutoff)
    except ValueError as error:
        raise ValueError(f"condition on {name!r}: {error}") from None
    strict = df.sparkSession.conf.get("spark.sql.legacy.timeParserPolicy").upper() != "LEGACY"
    implied = _text_bounds(column(name), dtype, fmt, condition["compare"], batch_date, days) if strict else None
    return by_day if implied is None else implied & by_day


def _as_date_like(col: Column, name: str, dtype: DataType) -> Column:
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        return col
    if isinstance(dtype, StringType):
        return col.try_cast("date")
    raise ValueError(f"condition on {name!r}: a {dtype.simpleString()} column needs a date_format")


def _text_bounds(col: Column, dtype: DataType, fmt: str, compare: str, batch_date: str, days: int) -> Column | None:
    """A plain text comparison that every row meeting the condition also meets.

    Parsing a column hides it from the scan. Where the text sorts like its dates,
    comparing the text as well lets Parquet statistics or the database skip rows. Only a
    strict parser takes no text of another shape (``2024-1-5``), so under the session's
    LEGACY policy there is no bound.
    Years outside 0000-9999 carry a sign, which sorts before all digits.
    """
    if not isinstance(dtype, StringType) or fmt not in _SORTABLE:
        return None
    day = datetime.strptime(batch_date, "%Y%m%d") + timedelta(days=days)
    if not 1000 <= day.year < 9999:
        return None
    low = day.strftime(_SORTABLE[fmt])
    high = (day + timedelta(days=1)).strftime(_SORTABLE[fmt])
    signed = col < "0"
    bounds = {
        "<": col < low,
        "<=": col < high,
        ">": (col >= high) | signed,
        ">=": (col >= low) | signed,
        "=": (col >= low) & (col < high),
        "==": (col >= low) & (col < high),
    }
    return bounds.get(compare)

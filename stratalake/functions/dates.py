"""Parsing dates out of columns of any type that can hold one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, IntegralType, StringType, TimestampNTZType, TimestampType


def parse_date(col: Column, dtype: DataType, fmt: str) -> Column:
    """The day in ``col``; text that is not a date in ``fmt`` gives NULL.

    Dates and timestamps already are what they are, so ``fmt`` only applies to
    text and to whole numbers such as 20240131.
    """
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        return col.cast("date")
    if isinstance(dtype, StringType):
        return F.try_to_date(col, fmt)
    if isinstance(dtype, IntegralType):
        return F.try_to_date(col.cast("string"), fmt)
    raise ValueError(f"cannot parse a date out of a {dtype.simpleString()} column")

"""Casts that turn bad values into NULL, whatever the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, StringType

_NUMBER = r"^\s*[+-]?[0-9]+(\.[0-9]*)?\s*$"
_BARE_FRACTION = r"^\s*[+-]?\.[0-9]+\s*$"


def lenient_cast(col: Column, source: DataType, target: DataType) -> Column:
    """Cast to ``target``; a value that does not fit becomes NULL.

    Text with a fraction casts to a whole number by dropping the fraction, so
    "2.5" as int is 2. Exponents are no part of a whole number: "1e3" is NULL.
    """
    name = target.simpleString()
    if isinstance(source, StringType) and isinstance(target, IntegralType):
        # A try_cast of text that is no number costs an exception per row, a look at it first does not.
        return F.coalesce(
            F.when(col.rlike(_NUMBER), F.substring_index(col, ".", 1).try_cast(name)),
            F.when(col.rlike(_BARE_FRACTION), F.lit(0).cast(name)),
        )
    return col.try_cast(name)

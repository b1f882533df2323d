"""Column lookup by name, the way Spark resolves names: ignoring case."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A name as it stands in SQL, also when it has dots or spaces."""
    return f"`{name.replace('`', '``')}`"


def column(name: str) -> Column:
    """A column by its exact name."""
    return F.col(quoted(name))


def find_name(columns: Iterable[str], name: str) -> str | None:
    """The column that ``name`` stands for, or None."""
    columns = list(columns)
    if name in columns:
        return name
    return next((c for c in columns if c.lower() == name.lower()), None)


def require_name(df: DataFrame, name: str) -> str:
    found = find_name(df.columns, name)
    if found is None:
        raise ValueError(f"no column {name!r} among {df.columns}")
    return found


def require_distinct(columns: Iterable[str]) -> None:
    """Refuse column names a Parquet dataset cannot hold side by side."""
    twice = [c for c, n in Counter(c.lower() for c in columns).items() if n > 1]
    if twice:
        raise ValueError(f"column names appear more than once: {sorted(twice)}")

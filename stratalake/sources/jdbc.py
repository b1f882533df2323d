"""Database tables and queries over JDBC."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from stratalake.layers import Layers

STEPS, QUANTILES = "steps", "quantiles"

Credentials = Callable[[str], Mapping]

# The url and driver class of each known database type.
_DATABASES = {
    "sqlserver": {
        "url": "jdbc:sqlserver://{host}:{port};databaseName={dbname}",
        "driver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    },
}


def read_jdbc(
    spark: SparkSession, source: Mapping, layers: Layers, credentials: Credentials | None = None
) -> DataFrame:
    """A table, or the result of a query that runs in the database.

    Spark reads it as one partition unless ``source["split"]`` names a ``column`` of numbers,
    dates or timestamps and how many ``partitions`` to read at once: its least and largest
    value are asked for first, and each task reads a range of it. The ranges are equally wide, or with ``by``
    ``quantiles`` have equally many rows: the database is asked where they begin, for which it sorts the
    column, of any type it can sort. ``source["options"]`` may
    set ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` instead.
    """
    secret = credentials(source["secret_name"]) if credentials and "secret_name" in source else {}
    options = jdbc_options(source, secret)
    by = source["split"].get("by", STEPS) if "split" in source else None
    if by == QUANTILES:
        starts = spark.read.format("jdbc").options(**quantiles_options(options, source["split"])).load().collect()
        ranges = range_predicates(source["split"]["column"], [row[1] for row in sorted(starts, key=lambda row: row[0])])
        if ranges:
            others = {k: v for k, v in options.items() if k not in ("url", "dbtable", "query")}
            return spark.read.jdbc(options["url"], _relation(options), predicates=ranges, properties=others)
    elif by == STEPS:
        bounds = spark.read.format("jdbc").options(**bounds_options(options, source["split"])).load().first()
        options = split_options(options, source["split"], bounds)
    elif by is not None:
        raise ValueError(f"a split is by {STEPS!r} or {QUANTILES!r}, not {by!r}")
    return spark.read.format("jdbc").options(**options).load()


def bounds_options(options: Mapping[str, str], split: Mapping) -> dict[str, str]:
    """The options of a query for the least and the largest value of the column."""
    column = split["column"]
    query = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {_relation(options)}"
    return {k: v for k, v in options.items() if k != "dbtable"} | {"query": query}


def split_options(options: Mapping[str, str], split: Mapping, bounds: Sequence | None) -> dict[str, str]:
    """The options with a range of the column for each partition; as they are if it has no values.

    The ranges at both ends are open, and the first one takes NULL, so no row is left out.
    """
    _partitions(split)
    if bounds is None or bounds[0] is None:
        return dict(options)
    # Spark takes no partition column beside a query, but a query as a table.
    ranges = {
        "dbtable": _relation(options),
        "partitionColumn": split["column"],
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(split["partitions"]),
    }
    return {k: v for k, v in options.items() if k != "query"} | ranges


def quantiles_options(options: Mapping[str, str], split: Mapping) -> dict[str, str]:
    """The options of a query for (number, least value) of parts of the column's values with equally many rows."""
    column, parts = split["column"], _partitions(split)
    tiles = f"SELECT {column} AS v, NTILE({parts}) OVER (ORDER BY {column}) AS part FROM {_relation(options)} WHERE {column} IS NOT NULL"
    query = f"SELECT part, MIN(v) AS lo FROM ({tiles}) t GROUP BY part"
    return {k: v for k, v in options.items() if k != "dbtable"} | {"query": query}


def range_predicates(column: str, starts: Sequence) -> list[str]:
    """A condition for each range of a column, by where they begin, in the database's order; none for one range.

    Each row meets one of them: ranges meet, those at the ends are open, and the first one takes NULL. A value
    that fills several ranges has one.
    """
    cuts = [literal(b) for a, b in zip(starts, starts[1:], strict=False) if b != a]
    if not cuts:
        return []
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def literal(value: object) -> str:
    """A value as SQL, dates and times as Spark writes them in its own ranges. Where a range begins may
    be a little off, so times have milliseconds, which all databases read."""
    if isinstance(value, datetime):
        return f"'{value:%Y-%m-%d %H:%M:%S}.{value.microsecond // 1000:03d}'"
    if isinstance(value, date):
        return f"'{value:%Y-%m-%d}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def _partitions(split: Mapping) -> int:
    if int(split["partitions"]) < 1:
        raise ValueError(f"a split needs one partition at least, not {split['partitions']!r}")
    return int(split["partitions"])


def _relation(options: Mapping[str, str]) -> str:
    return f"({options['query']}) q" if "query" in options else options["dbtable"]


def jdbc_options(source: Mapping, secret: Mapping) -> dict[str, str]:
    """The reader options of a JDBC source; those the job sets itself come last and win."""
    options = {
        "url": _url(source, secret),
        "driver": _DATABASES.get(source.get("dbtype"), {}).get("driver", source.get("driver")),
        "user": secret.get("username"),
        "password": secret.get("password"),
    }
    if "query" in source:
        options["query"] = source["query"]
    else:
        options["dbtable"] = source["table"]
    options.update(source.get("options", {}))
    return {k: v for k, v in options.items() if v is not None}


def _url(source: Mapping, secret: Mapping) -> str:
    ready = source.get("url") or source.get("options", {}).get("url")
    if ready:
        return ready
    dbtype = source.get("dbtype")
    if dbtype not in _DATABASES:
        raise ValueError(f"no url template for dbtype {dbtype!r}, have {sorted(_DATABASES)}; or give a url")
    missing = {"host", "port", "dbname"} - set(secret)
    if missing:
        raise ValueError(f"credentials lack {sorted(missing)}")
    return _DATABASES[dbtype]["url"].format(**{k: secret[k] for k in ("host", "port", "dbname")})

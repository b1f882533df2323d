"""Named column transforms, and the chain of them that a job asks for."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DateType, MapType, StructType, VariantType

from stratalake.functions.casts import lenient_cast
from stratalake.functions.dates import parse_date
from stratalake.functions.names import column, find_name, require_distinct, require_name
from stratalake.layers import BATCH_COLUMN

Parameters = Sequence[Mapping[str, str]]
Transform = Callable[[DataFrame, Parameters], DataFrame]

CHAIN = "chain"
LAST = "last"


def trim(df: DataFrame, parameters: Parameters) -> DataFrame:
    """Strip spaces around the named columns; ``*`` is every column but the batch id.

    Only spaces go, tabs and line ends stay. A trimmed column is text afterwards.
    """
    renamed: dict[str, str] = {}
    for entry in parameters:
        name = entry["column_name"]
        if name == "*":
            renamed.update({c: renamed.get(c, c) for c in df.columns if c != BATCH_COLUMN})
        else:
            renamed[require_name(df, name)] = name
    nested = [
        f.name
        for f in df.schema
        if f.name in renamed and isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType))
    ]
    if nested:
        raise ValueError(f"Trim needs plain columns, these are nested: {nested}")
    return df.select(
        *[F.trim(column(c).cast("string")).alias(renamed[c]) if c in renamed else column(c) for c in df.columns]
    )


def cast_date(df: DataFrame, parameters: Parameters) -> DataFrame:
    """Parse each named column by its ``source_format`` into a date, in place."""
    return _select(df, _dates(df, parameters)[0])


def rename_cast(df: DataFrame, parameters: Parameters) -> DataFrame:
    """Cast each named column and give it its new name, entry by entry."""
    return _select(df, _casts(df, parameters)[0])


#: A column before and after a cast, by the name that the entry gives.
Changes = list[tuple[str, Column, Column]]


def _dates(df: DataFrame, parameters: Parameters) -> tuple[list, Changes]:
    fields, changes = _fields(df), []
    for entry in parameters:
        i = _index(fields, entry["column_name"])
        _, col, dtype = fields[i]
        try:
            fields[i] = (entry["column_name"], parse_date(col, dtype, entry["source_format"]), DateType())
        except ValueError as error:
            raise ValueError(f"CastDate on {entry['column_name']!r}: {error}") from None
        changes.append((entry["column_name"], col, fields[i][1]))
    return fields, changes


def _casts(df: DataFrame, parameters: Parameters) -> tuple[list, Changes]:
    fields, changes = _fields(df), []
    for entry in parameters:
        i = _index(fields, entry["column_name"])
        _, col, dtype = fields[i]
        target = DataType.fromDDL(entry["data_type"])
        fields[i] = (entry["new_column_name"], lenient_cast(col, dtype, target), target)
        changes.append((entry["column_name"], col, fields[i][1]))
    return fields, changes


def _fields(df: DataFrame) -> list[tuple[str, Column, DataType]]:
    return [(f.name, column(f.name), f.dataType) for f in df.schema]


def _index(fields: list[tuple[str, Column, DataType]], name: str) -> int:
    names = [n for n, _, _ in fields]
    found = find_name(names, name)
    if found is None:
        raise ValueError(f"no column {name!r} among {names}")
    return names.index(found)


def _select(df: DataFrame, fields: list[tuple[str, Column, DataType]]) -> DataFrame:
    require_distinct(name for name, _, _ in fields)
    return df.select(*[col.alias(name) for name, col, _ in fields])


_OWN: dict[str, Transform] = {
    "Trim": trim,
    "CastDate": cast_date,
    "RenameCast": rename_cast,
}
_TRANSFORMS = dict(_OWN)
_CHANGES = {"CastDate": _dates, "RenameCast": _casts}


# The fields that each entry of a transform's parameters needs.
_FIELDS = {
    "Trim": ("column_name",),
    "CastDate": ("column_name", "source_format"),
    "RenameCast": ("column_name", "new_column_name", "data_type"),
}


def require_parameters(name: str, parameters: Parameters) -> None:
    """Fail on parameters that a transform could not use, before anything is read."""
    if name not in _FIELDS or _TRANSFORMS[name] is not _OWN[name]:
        return
    for entry in parameters:
        missing = [field for field in _FIELDS[name] if not entry.get(field)]
        if missing:
            raise ValueError(f"{name} needs {missing} in {dict(entry)}")
        if "data_type" in _FIELDS[name]:
            try:
                DataType.fromDDL(entry["data_type"])
            except Exception:
                raise ValueError(f"{name} on {entry['column_name']!r}: no such type: {entry['data_type']!r}") from None


def register_transform(name: str, transform: Transform) -> None:
    """Offer ``transform(df, parameters) -> DataFrame`` to jobs as ``name``.

    It must give the same rows each time it runs, as Spark may run it more than once.
    """
    _TRANSFORMS[name] = transform


def transform_named(name: str) -> Transform:
    try:
        return _TRANSFORMS[name]
    except KeyError:
        raise ValueError(f"no such transform: {name!r}, have {sorted(_TRANSFORMS)}") from None


class CastLosses:
    """How many values became NULL in each cast of a job, counted by Spark while the batch is written.

    Nothing is read twice for it. Counts are there after the first action on the batch. They come from
    the tasks that ran, so a task that ran twice counts twice: ``rows_seen`` tells.
    """

    def __init__(self) -> None:
        self._seen: list[tuple[str, list[str], Observation]] = []

    def watch(self, df: DataFrame, name: str, parameters: Parameters) -> DataFrame:
        """The same rows, watched for what this transform will do to them."""
        if name not in _CHANGES or _TRANSFORMS[name] is not _OWN[name]:
            return df
        _, changes = _CHANGES[name](df, parameters)
        lost = [F.count_if(before.isNotNull() & after.isNull()).alias(f"lost{i}") for i, (_, before, after) in enumerate(changes)]
        observation = Observation()
        self._seen.append((name, [label for label, _, _ in changes], observation))
        return df.observe(observation, F.count(F.lit(1)).alias("rows"), *lost)

    def counts(self) -> list[tuple[str, str, int]]:
        """(transform, column, values that became NULL), in the order of the job."""
        return [(name, label, o.get[f"lost{i}"]) for name, labels, o in self._seen for i, label in enumerate(labels)]

    def rows_seen(self) -> int | None:
        """How many rows the casts ran over; None if there are no casts."""
        return max((o.get["rows"] for _, _, o in self._seen), default=None)


def apply_transforms(df: DataFrame, entries: Sequence[Mapping], mode: str = CHAIN, losses: CastLosses | None = None) -> DataFrame:
    """Run a job's transforms.

    ``chain`` feeds each one the result of the one before. ``last`` feeds every
    one the batch itself, so only the final entry shows in the result. ``losses`` is told
    what becomes NULL in casts.
    """
    if mode not in (CHAIN, LAST):
        raise ValueError(f"transform mode must be {CHAIN!r} or {LAST!r}, not {mode!r}")
    steps = [(entry["name"], transform_named(entry["name"]), entry["parameters"]) for entry in entries]
    for name, transform, parameters in steps if mode == CHAIN else steps[-1:]:
        if losses is not None:
            df = losses.watch(df, name, parameters)
        df = transform(df, parameters)
    return df

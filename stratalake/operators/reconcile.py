"""Types that grow: what stored and incoming columns have in common."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, FractionalType, IntegralType, MapType, NumericType, StructField, StructType

from stratalake.functions.names import column, find_name

# Whole numbers from narrow to wide.
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def reconciled(stored: DataType, incoming: DataType, widen: bool) -> DataType | None:
    """A type that holds values of both, or None if there is none.

    Structs have the fields of both, stored ones first, at any depth, within arrays and maps too. With
    ``widen`` numbers take the wider type. All fields may be null, as either side may lack them.
    """
    if stored == incoming:
        return stored
    if isinstance(stored, StructType) and isinstance(incoming, StructType):
        fields = []
        for field in stored:
            name = find_name(incoming.names, field.name)
            kind = field.dataType if name is None else reconciled(field.dataType, incoming[name].dataType, widen)
            if kind is None:
                return None
            fields.append(StructField(field.name, kind))
        fields += [StructField(f.name, f.dataType) for f in incoming if find_name(stored.names, f.name) is None]
        return StructType(fields)
    if isinstance(stored, ArrayType) and isinstance(incoming, ArrayType):
        element = reconciled(stored.elementType, incoming.elementType, widen)
        return None if element is None else ArrayType(element)
    if isinstance(stored, MapType) and isinstance(incoming, MapType):
        kinds = [reconciled(stored.keyType, incoming.keyType, widen), reconciled(stored.valueType, incoming.valueType, widen)]
        return None if None in kinds else MapType(*kinds)
    if widen and isinstance(stored, NumericType) and isinstance(incoming, NumericType):
        return _wider(stored, incoming)
    return None


def _wider(one: NumericType, two: NumericType) -> DataType:
    if isinstance(one, IntegralType) and isinstance(two, IntegralType):
        return max(one, two, key=lambda kind: _WHOLE.index(kind.simpleString()))
    if isinstance(one, DecimalType) or isinstance(two, DecimalType):
        # as Spark does when it brings both together in a union
        decimals = [k if isinstance(k, DecimalType) else _digits(k) for k in (one, two)]
        if None not in decimals:
            scale = max(d.scale for d in decimals)
            whole = max(d.precision - d.scale for d in decimals)
            return DecimalType(min(38, whole + scale), scale)
    return DataType.fromDDL("double") if one != two else one


def _digits(kind: NumericType) -> DecimalType | None:
    """The decimal that holds all numbers of a whole type."""
    if isinstance(kind, FractionalType):
        return None
    return DecimalType((3, 5, 10, 20)[_WHOLE.index(kind.simpleString())], 0)


def grown(df: DataFrame, schema: StructType) -> DataFrame:
    """The rows with their columns in the types of ``schema``, where those differ; fields they lack are NULL."""
    made = []
    for field in df.schema:
        name = find_name(schema.names, field.name)
        kind = field.dataType if name is None else schema[name].dataType
        value = column(field.name)
        made.append(value if kind == field.dataType else _as(value, field.dataType, kind).alias(field.name))
    return df.select(*made)


def _as(value: Column, kind: DataType, wanted: DataType) -> Column:
    if kind == wanted:
        return value
    if isinstance(kind, StructType):
        fields = []
        for field in wanted:
            name = find_name(kind.names, field.name)
            own = F.lit(None).cast(field.dataType) if name is None else _as(value.getField(name), kind[name].dataType, field.dataType)
            fields.append(own.alias(field.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _as(x, kind.elementType, wanted.elementType))
    if isinstance(kind, MapType):
        value = F.transform_keys(value, lambda k, _: _as(k, kind.keyType, wanted.keyType))
        return F.transform_values(value, lambda _, v: _as(v, kind.valueType, wanted.valueType))
    return value.cast(wanted)

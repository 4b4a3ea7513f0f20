"""Type tests on schema fields, and the labels derived from them."""

from __future__ import annotations

from pyspark.sql import types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATING = (T.FloatType, T.DoubleType)
INSTANTS = (T.DateType, T.TimestampType, T.TimestampNTZType)


def is_numeric(dtype: T.DataType) -> bool:
    """Numbers; a boolean is not one."""
    return isinstance(dtype, T.NumericType)


def is_categorical(dtype: T.DataType) -> bool:
    """Strings and booleans. Dates and timestamps are neither class."""
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType, T.BooleanType))


def is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))


def dtype_family(dtype: T.DataType) -> str:
    """The comparability family of a column for joins."""
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if is_numeric(dtype):
        return "numeric"
    if isinstance(dtype, INSTANTS):
        return "datetime"
    if is_text(dtype):
        return "text"
    return "other"


def storage_label(dtype: T.DataType, has_missing: bool) -> str:
    """Label of the in-memory type: a gap turns integers into float64."""
    if isinstance(dtype, INTEGRAL):
        return "float64" if has_missing else "int64"
    if is_numeric(dtype):
        return "float64"
    if isinstance(dtype, T.BooleanType):
        return "object" if has_missing else "bool"
    if isinstance(dtype, INSTANTS):
        return "datetime64"
    if is_text(dtype):
        return "str"
    return "object"


def columns_of(schema: T.StructType, test) -> list[str]:
    """Names of the columns whose type passes ``test``, in schema order."""
    return [f.name for f in schema.fields if test(f.dataType)]


def value_bytes(dtype: T.DataType) -> int | None:
    """Fixed width of one value, None where it depends on the value."""
    widths = {
        T.BooleanType: 1,
        T.ByteType: 1,
        T.ShortType: 2,
        T.IntegerType: 4,
        T.FloatType: 4,
        T.DateType: 4,
        T.LongType: 8,
        T.DoubleType: 8,
        T.TimestampType: 8,
        T.TimestampNTZType: 8,
        T.DecimalType: 16,
    }
    return widths.get(type(dtype))

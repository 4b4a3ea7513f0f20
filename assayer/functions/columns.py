"""Column expressions shared by the operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.functions.types import FLOATING, INTEGRAL, is_numeric, is_text

# All characters that count as white space, by rule rather than by list.
WHITE_SPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())

# Values up to this many bytes are their own key; a digest is longer, so the
# two cannot meet.
KEY_BYTES = 63


def ref(name: str) -> Column:
    """Reference to a column whatever characters its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def strip(value: Column) -> Column:
    """Trim every Unicode white space character on both sides."""
    return F.btrim(value, F.lit(WHITE_SPACE))


def is_blank(value: Column) -> Column:
    return value.isNull() | (strip(value) == "")


def nan_to_null(df: DataFrame) -> DataFrame:
    """One kind of missing: NaN becomes null in float and double columns."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, FLOATING)]
    if not floating:
        return df
    return df.withColumns({n: F.when(~F.isnan(ref(n)), ref(n)) for n in floating})


def compact(value: Column) -> Column:
    """Short strings as they are, long ones as digest: a key for equality only."""
    return F.when(F.octet_length(value) <= KEY_BYTES, value).otherwise(F.sha2(value, 256))


def text_key(value: Column, dtype: T.DataType) -> Column:
    """Any value as a string that is equal exactly when the values are equal."""
    if is_text(dtype):
        return value
    if isinstance(dtype, T.BinaryType):
        return F.base64(value)
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        shown = F.array_sort(F.map_entries(value)) if isinstance(dtype, T.MapType) else value
        # to_json never returns null, so a missing value is kept apart
        return F.when(value.isNotNull(), F.to_json(F.struct(shown.alias("v"))))
    return value.cast("string")


def key_class(dtype: T.DataType) -> str:
    """The type in which values of a column are grouped."""
    if isinstance(dtype, (*INTEGRAL, T.BooleanType)):
        return "bigint"
    if isinstance(dtype, FLOATING):
        return "double"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return dtype.simpleString()
    return "string"


def group_key(value: Column, dtype: T.DataType) -> Column:
    """A value in its key class; only long texts are digested."""
    cls = key_class(dtype)
    if cls == "string":
        return compact(text_key(value, dtype))
    if isinstance(dtype, T.BooleanType):
        return value.cast("int").cast("bigint")
    return value.cast(cls)


def row_keys(df: DataFrame) -> list[Column]:
    """Keys under which two rows are equal exactly when all values are, nulls included."""
    return [group_key(ref(f.name), f.dataType).alias(f"k{i}") for i, f in enumerate(df.schema.fields)]


def share_pct(part: Column, whole: Column) -> Column:
    """part / whole in percent, 0 when there is no row."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / F.nullif(whole, F.lit(0)) * 100.0)


def numeric_value(name: str) -> Column:
    return ref(name).cast("double")


def normalize_name(name: str) -> str:
    """Name under which columns of different tables are compared.

    Words are joined by one underscore and one trailing id is dropped.
    """
    plain = name.strip().lower()
    # Fixed value: the characters that join words.
    joined = re.sub(r"[^0-9a-zA-Z]+", "_", plain).strip("_")
    shorter = re.fullmatch(r"(.+?)(_id|id)", joined)
    if shorter:
        joined = shorter.group(1).strip("_")
    return joined or plain



def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]

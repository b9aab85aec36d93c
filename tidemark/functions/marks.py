"""Watermarks: typed scalars kept as (type, text)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import column
from tidemark.functions.wire import iso_timestamp

WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"


@dataclass(frozen=True)
class Mark:
    """A watermark as the state table keeps it."""

    type: str
    text: str


def mark_type(dtype: T.DataType) -> str:
    if isinstance(dtype, T.BooleanType):
        return "bool"
    if isinstance(dtype, T.IntegralType):
        return "int"
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "float"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    return "str"


def encode(value: Column, dtype: T.DataType) -> Column:
    """Text that casts back to the same value."""
    if isinstance(dtype, T.BooleanType):
        return value.cast("int").cast("string")
    if isinstance(dtype, T.TimestampType):
        return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    if isinstance(dtype, T.TimestampNTZType):
        return iso_timestamp(value)
    return value.cast("string")


def literal(mark: Mark, dtype: T.DataType) -> Column:
    """The mark in the column's own type, so that the comparison reaches the source."""
    text = F.lit(mark.text)
    return (text == "1") if isinstance(dtype, T.BooleanType) else text.cast(dtype)


def decode(kind: Column, text: Column) -> Column:
    """(type, text) back to typed values; text that does not decode stays text."""
    typed = {
        "as_bool": F.when(kind == "bool", text == "1"),
        "as_int": F.when(kind == "int", text.try_cast("bigint")),
        "as_float": F.when(kind == "float", text.try_cast("double")),
        "as_datetime": F.when(kind == "datetime", text.try_cast("timestamp_ntz")),
    }
    lost = F.coalesce(*[v.cast("string") for v in typed.values()]).isNull() & kind.isNotNull()
    return F.struct(*[v.alias(k) for k, v in typed.items()], F.when(lost, text).alias("as_str"))


def untyped_kind(text: Column) -> Column:
    """Type of a mark that came without one: whole number, number, date and time, text."""
    return (
        F.when(text.isNull(), None)
        .when(text.rlike(WHOLE_NUMBER) & text.try_cast("bigint").isNotNull(), "int")
        .when(text.try_cast("double").isNotNull(), "float")
        .when(text.try_cast("timestamp_ntz").isNotNull(), "datetime")
        .otherwise("str")
    )


def highest(df: DataFrame, field: str, previous: Mark | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Greatest value of the field, NULLs skipped, never below the previous mark."""
    top = F.max(column(field))
    if previous is not None:
        top = F.greatest(literal(previous, df.schema[field].dataType), top)
    return df.groupBy(*by).agg(top.alias("watermark"))

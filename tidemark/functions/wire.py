"""Values as the JSON wire carries them: one projection generated from the schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import column

# Longest text kept, and the marker put behind a cut text.
MAX_TEXT = 10_000
CUT_MARKER = "...[TRUNCATED]"


def truncate(text: Column, limit: int | None = MAX_TEXT) -> Column:
    """Cut by code points; texts within the limit, and all texts without one, stay as they are."""
    if limit is None:
        return text
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(CUT_MARKER))).otherwise(text)


def _six_digits(text: Column, width: int) -> Column:
    return F.when(F.instr(text, ".") > 0, F.rpad(text, width, "0")).otherwise(text)


def iso_timestamp(ts: Column) -> Column:
    """T between date and time; six digits of a second, or none when it is whole."""
    text = ts.cast("string")
    return _six_digits(F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 32)), 26)


def iso_time(t: Column) -> Column:
    return _six_digits(t.cast("string"), 15)


def interval_seconds(interval: Column) -> Column:
    return interval.cast("interval second").cast("decimal(18,6)").cast("double")


def binary_text(raw: Column, limit: int | None = MAX_TEXT) -> Column:
    """UTF-8 with U+FFFD for broken sequences, cut like any text."""
    return truncate(F.make_valid_utf8(raw.cast("string")), limit)


def finite(x: Column) -> Column:
    """NaN and the infinities have no JSON form."""
    x = x.cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def is_whole(x: Column) -> Column:
    """Whole numbers a BIGINT can hold."""
    return (x == F.floor(x)).cast("boolean")


def flat_int(x: Column) -> Column:
    """The whole number, or NULL where the value has a fraction."""
    return F.when(is_whole(x), x.cast("bigint"))


def flat_float(x: Column) -> Column:
    """The value where it has a fraction, else NULL."""
    return F.when(~is_whole(x), x.cast("double"))


def strip_nul(text: Column) -> Column:
    return F.translate(text, "\u0000", "")


def wire(c: Column, dtype: T.DataType, limit: int | None = None) -> Column:
    if isinstance(dtype, T.BooleanType):
        return c
    if isinstance(dtype, T.IntegralType):
        return c.cast("bigint")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return finite(c)
    if isinstance(dtype, T.DecimalType):
        return c.cast("double")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return iso_timestamp(c)
    if isinstance(dtype, T.TimeType):
        return iso_time(c)
    if isinstance(dtype, T.DayTimeIntervalType):
        return interval_seconds(c)
    if isinstance(dtype, T.BinaryType):
        return binary_text(c, limit)
    if isinstance(dtype, T.StringType):
        return truncate(c, limit)
    return c.cast("string")


def to_wire(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Every column in wire form. One narrow projection, no shuffle. `limit` cuts long texts
    and bytes (`MAX_TEXT` is the wire's own); without one they stay whole."""
    return df.select(*[wire(column(f.name), f.dataType, limit).alias(f.name) for f in df.schema])


def without_nul(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            strip_nul(column(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else column(f.name)
            for f in df.schema
        ]
    )


def text_or_empty(c: Column, dtype: T.DataType) -> Column:
    """Text of a value, with NULL, zero and false all as the empty string."""
    if isinstance(dtype, T.BooleanType):
        return F.when(c, F.lit("true")).otherwise("")
    if isinstance(dtype, T.NumericType):
        return F.when(c.isNull() | (c == 0), "").otherwise(c.cast("string"))
    return F.coalesce(c.cast("string"), F.lit(""))


def all_text(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Every column as text, from its wire form."""
    flat = to_wire(df, limit)
    return flat.select(*[text_or_empty(column(f.name), f.dataType).alias(f.name) for f in flat.schema])

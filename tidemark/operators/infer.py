"""Target types from the values of whole columns, or from the first row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import column, safe_names
from tidemark.functions.wire import finite, interval_seconds, iso_time, iso_timestamp, truncate

# Kinds of wire values from narrow to wide, and the column type each target
# gives them.
KINDS = ("null", "bool", "int", "float", "str")
TARGET_TYPES = {
    "mysql": {"null": "LONGTEXT", "bool": "TINYINT(1)", "int": "BIGINT", "float": "DOUBLE", "str": "MEDIUMTEXT"},
    "spark": {"null": "STRING", "bool": "BOOLEAN", "int": "BIGINT", "float": "DOUBLE", "str": "STRING"},
    "sqlite": dict.fromkeys(KINDS, "TEXT"),
}
# What the first row's value becomes, by kind, size of the number, length of the text.
INT_RANGE = (-2147483648, 2147483647)
SHORT_TEXT = 255


def _rank(kind: str) -> int:
    return KINDS.index(kind)


def value_rank(c: Column, dtype: T.DataType) -> Column:
    """Place of a value in KINDS; whole floats and decimals count as integers."""
    if isinstance(dtype, T.NullType):
        return F.lit(0)
    if isinstance(dtype, T.VariantType):
        return variant_rank(c)
    if isinstance(dtype, T.BooleanType):
        rank = F.lit(_rank("bool"))
    elif isinstance(dtype, T.IntegralType):
        rank = F.lit(_rank("int"))
    elif isinstance(dtype, (T.FractionalType, T.DayTimeIntervalType)):
        if isinstance(dtype, T.DayTimeIntervalType):
            c = interval_seconds(c)
        elif not isinstance(dtype, T.DecimalType):
            c = finite(c)
        rank = F.when(c == F.floor(c), _rank("int")).otherwise(_rank("float"))
    else:
        rank = F.lit(_rank("str"))
    return F.when(c.isNull(), 0).otherwise(rank)


def variant_rank(v: Column) -> Column:
    """The same for a value parsed from JSON."""
    kind = F.schema_of_variant(v)
    number = F.try_variant_get(v, "$", "double")
    return (
        F.when(v.isNull() | kind.isin("VOID"), 0)
        .when(kind == "BOOLEAN", _rank("bool"))
        .when(kind == "BIGINT", _rank("int"))
        .when((kind == "DOUBLE") | kind.startswith("DECIMAL"), F.when(number == F.floor(number), _rank("int")).otherwise(_rank("float")))
        .otherwise(_rank("str"))
    )


def kinds_seen(c: Column, dtype: T.DataType) -> Column:
    """The kinds a column's values have, as bits: a state that is merged by OR, in tasks and across runs."""
    bits = F.bit_or(F.call_function("shiftleft", F.lit(1), value_rank(c, dtype)))
    return F.coalesce(bits, F.lit(0))


def kinds_of(df: DataFrame) -> dict[str, int]:
    """kinds_seen() of every column, in one pass."""
    return dict(zip(df.columns, df.agg(*[kinds_seen(column(f.name), f.dataType).alias(f"k{i}") for i, f in enumerate(df.schema)]).first()))


def merged_kinds(before: Mapping[str, int] | None, delta: Mapping[str, int] | None) -> dict[str, int] | None:
    """Kinds of a table from those before and those of a delta; unknown once a delta's are."""
    if delta is None:
        return None
    return {n: (before or {}).get(n, 0) | delta.get(n, 0) for n in [*(before or {}), *delta]}


def widest_of_kinds(spark: SparkSession, names: Sequence[str], kinds: Mapping[str, int], target: str = "mysql", keys: Sequence[str] = ()) -> DataFrame:
    """widest() of a table from the kinds its values were seen to have; no row is read."""
    rows = [(i + 1, n, max(kinds.get(n, 0).bit_length() - 1, 0)) for i, n in enumerate(names)]
    ranked = spark.createDataFrame(rows, "ordinal INT, name STRING, rank INT")
    return _typed(ranked.withColumn("kind", kind_name(F.col("rank"))), target, keys)


def kind_name(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in KINDS]), rank + 1)


def type_name(kind: Column, target: str) -> Column:
    pairs = [F.lit(x) for kv in TARGET_TYPES[target].items() for x in kv]
    return F.element_at(F.create_map(*pairs), kind)


def widest(df: DataFrame, target: str = "mysql", keys: Sequence[str] = ()) -> DataFrame:
    """(ordinal, name, kind, type) of every column over all of its rows.

    One pass for all columns: each keeps a single integer, combined inside the tasks.
    """
    for k in keys:
        if k not in df.columns:
            raise ValueError(f"key {k!r} is not among the columns {df.columns}")
    ranks = df.agg(
        *[F.coalesce(F.max(value_rank(column(f.name), f.dataType)), F.lit(0)).alias(f"r{i}") for i, f in enumerate(df.schema)]
    )
    rows = F.array(
        *[F.struct(F.lit(i + 1).alias("ordinal"), F.lit(n).alias("name"), F.col(f"r{i}").alias("rank")) for i, n in enumerate(df.columns)]
    )
    typed = ranks.select(F.inline(rows)).withColumn("kind", kind_name(F.col("rank")))
    return _typed(typed, target, keys)


def widest_json(df: DataFrame, value: str, target: str = "mysql", keys: Sequence[str] = ()) -> DataFrame:
    """The same for rows that are JSON objects of unknown columns (variants)."""
    fields = df.select(column(value).alias("v")).lateralJoin(
        df.sparkSession.tvf.variant_explode(F.col("v").outer()).select("key", F.col("value"))
    )
    typed = (
        fields.groupBy(F.col("key").alias("name"))
        .agg(F.max(variant_rank(F.col("value"))).alias("rank"))
        .withColumn("kind", kind_name(F.col("rank")))
    )
    return _typed(typed, target, keys)


def _typed(typed: DataFrame, target: str, keys: Sequence[str]) -> DataFrame:
    column_type = type_name(F.col("kind"), target)
    if keys and target == "mysql":
        # a text key has to be short enough to be indexed
        text_key = F.col("name").isin(list(keys)) & F.col("kind").isin("str", "null")
        column_type = F.when(text_key, "VARCHAR(255)").otherwise(column_type)
    return typed.withColumn("type", column_type).drop("rank")


def _first_type(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BooleanType):
        named = F.lit("BOOLEAN")
    elif isinstance(dtype, T.IntegralType):
        named = F.when(c.between(*INT_RANGE), "INTEGER").otherwise("BIGINT")
    elif isinstance(dtype, (T.FractionalType, T.DayTimeIntervalType)):
        named = F.lit("DOUBLE PRECISION")
    else:
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            c = iso_timestamp(c)
        elif isinstance(dtype, T.TimeType):
            c = iso_time(c)
        else:
            c = truncate(c.cast("string"))
        named = F.when(F.length(c) <= SHORT_TEXT, "VARCHAR(255)").otherwise("TEXT")
    return F.when(c.isNull(), "TEXT").otherwise(named)


def first_row(df: DataFrame, order: str) -> DataFrame:
    """(ordinal, name, type) by the row that comes first in the given order alone.

    Each task keeps one row, so nothing is sorted or shuffled whole.
    """
    first = df.orderBy(order).limit(1)
    rows = F.array(
        *[
            F.struct(F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("name"), _first_type(column(f.name), f.dataType).alias("type"))
            for i, f in enumerate(df.schema)
        ]
    )
    return first.select(F.inline(rows))


def ddl(df: DataFrame, types: DataFrame, target: str = "mysql", keys: Sequence[str] = ()) -> str:
    """Column definitions of the target table, with quoted names, for a CREATE."""
    quote = "`" if target in ("mysql", "spark") else '"'
    safe = {c: f"{quote}{n}{quote}" for c, n in zip(df.columns, safe_names(df, target if target != "spark" else "mysql"))}
    by_name = {r["name"]: r["type"] for r in types.collect()}  # one row per column
    parts = [f"{safe[c]} {by_name[c]}" for c in df.columns]
    if keys:
        parts.append("PRIMARY KEY (" + ", ".join(safe[k] for k in keys) + ")")
    return ", ".join(parts)


def spark_schema(types: DataFrame) -> T.StructType:
    """A read schema from `widest(..., target='spark')`."""
    fields = [T.StructField(r["name"], T.DataType.fromDDL(r["type"])) for r in types.collect()]  # one row per column
    return T.StructType(fields)

"""Table scans: whole, above a watermark, by page."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import files
from tidemark.functions.marks import Mark, encode, literal, mark_type
from tidemark.functions.names import column, quoted



def load(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None, **options) -> DataFrame:
    """The whole table; pass the schema for text formats, inferring it costs a scan."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(".".join(quoted(p) for p in name.split(".")))


def as_mark(value, dtype: T.DataType, spark: SparkSession) -> Mark:
    """A Python scalar as a mark of the given column type."""
    if isinstance(value, Mark):
        return value
    text = spark.range(1).select(encode(F.lit(value).cast(dtype), dtype)).first()[0]
    return Mark(mark_type(dtype), text)


def above(df: DataFrame, field: str | None = None, mark=None, lookback=None) -> DataFrame:
    """Rows strictly above the mark; rows without the field never match.

    The mark takes the column's type and stays a literal, so the comparison is pushed
    to parquet and JDBC sources. `lookback` (a timedelta, or a number for numeric
    columns) lowers the threshold for sources whose rows arrive late.
    """
    if (field is None) != (mark is None):
        raise ValueError("field and mark belong together")
    if field is None:
        return df
    dtype = df.schema[field].dataType
    threshold = literal(as_mark(mark, dtype, df.sparkSession), dtype)
    if lookback is not None:
        if isinstance(dtype, T.NumericType) != isinstance(lookback, (int, float)):
            raise ValueError(f"lookback {lookback!r} does not fit {dtype.simpleString()}")
        if isinstance(dtype, T.DateType) and isinstance(lookback, dt.timedelta):
            # part of a day reads back the whole day
            lookback = -(-lookback // dt.timedelta(days=1))
        threshold = threshold - F.lit(lookback)
    return df.where(column(field) > threshold)


def page(df: DataFrame, key: str, limit: int, offset: int = 0) -> DataFrame:
    """One page in key order. Spark keeps offset + limit rows, so go deep by `page_after`."""
    return df.orderBy(key).offset(offset).limit(limit)


def page_after(df: DataFrame, key: str, last, limit: int) -> DataFrame:
    """The page behind the last key seen: the same cost at any depth."""
    return above(df, key, last).orderBy(key).limit(limit)


def pages(df: DataFrame, key: str, page_size: int) -> DataFrame:
    """Every row with its page number (from 0) in the order of a unique key of any orderable type.

    Rows are sorted over ranges of the key, so no task sorts them all, and written once;
    a row's number is its place in its range and the rows of the ranges before, one number
    for each. Rows without a key come first.
    """
    spark, path = df.sparkSession, files.scratch(df.sparkSession, "pages")
    ordered = df.repartitionByRange(column(key)).sortWithinPartitions(column(key))
    # the id is the range's number above 33 bits of place
    ordered.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.schema(T.StructType([*df.schema, T.StructField("_at", T.LongType())])).parquet(path)
    placed = placed.withColumn("_range", F.shiftright("_at", 33)).withColumn("_row", F.col("_at").bitwiseAND((1 << 33) - 1))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    ahead = placed.groupBy("_range").count().select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_ahead"))
    return (
        placed.join(ahead, "_range")
        .withColumn("page", F.floor((F.col("_ahead") + F.col("_row")) / page_size).cast("bigint"))
        .drop("_at", "_range", "_ahead", "_row")
    )


def list_tables(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, str]:
    """Tables below a folder as {name: path}, by name: one file or one folder each."""
    ending = f".{fmt}"
    found = {name.removesuffix(ending): f"{root.rstrip('/')}/{name}" for name, _ in files.children(spark, root)}
    return dict(sorted(found.items()))


def list_catalog(spark: SparkSession, database: str | None = None) -> list[str]:
    """User tables of the session catalog by name, without views."""
    return sorted(t.name for t in spark.catalog.listTables(database) if t.tableType not in ("VIEW", "TEMPORARY"))

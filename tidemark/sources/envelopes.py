"""JSON envelopes: {"table", "columns", "data": [rows], "count", "error"?}.

One envelope is one JSON document and is read by one task, so a large table comes as many
envelopes of at most PAGE_ROWS rows, one per line of a file.

An increment over envelopes reads only what is new where they lie in folders by ranges of
the watermark field: folders below the mark's own are pruned from the scan, and in the
mark's folder rows are filtered after they are parsed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.marks import literal
from tidemark.functions.names import column
from tidemark.functions.wire import to_wire
from tidemark.operators.merge import conform
from tidemark.sources.tables import above, as_mark

# Fixed value: rows per envelope.
PAGE_ROWS = 5_000

RANGE = "range_"

_HEAD = "table STRING, columns ARRAY<STRING>, count BIGINT, error STRING"


def read(
    spark: SparkSession, path: str, row: T.StructType | None = None, whole_files: bool = False, strict: bool = False
) -> DataFrame:
    """Envelopes with their trailer. Rows come typed when their schema is known, else as
    variants; `whole_files` reads pretty-printed documents, one per file. Text that is no
    JSON becomes an envelope of no table, or with `strict` an error."""
    schema = T.StructType.fromDDL(_HEAD).add("data", T.ArrayType(T.VariantType() if row is None else row))
    mode = "FAILFAST" if strict else "PERMISSIVE"
    return spark.read.schema(schema).option("mode", mode).option("multiLine", whole_files).json(path)


def reason() -> Column:
    """Why an envelope cannot be used, or NULL."""
    rows = F.coalesce(F.size("data"), F.lit(0))
    return (
        F.when(F.col("table").isNull(), "malformed")
        .when(F.col("error").isNotNull(), "error")
        .when(F.coalesce(F.size("columns"), F.lit(0)) <= 0, "no columns")
        .when(~F.col("count").eqNullSafe(F.when(rows < 0, 0).otherwise(rows).cast("bigint")), "count")
    )


def rejects(envelopes: DataFrame) -> DataFrame:
    """Unusable envelopes by table and reason."""
    return (
        envelopes.select("table", "count", "error", F.size("data").cast("bigint").alias("rows"), reason().alias("reason"))
        .where("reason IS NOT NULL")
        .groupBy("table", "reason")
        .agg(
            F.count("*").alias("envelopes"),
            F.sum("count").alias("declared_rows"),
            F.sum("rows").alias("found_rows"),
            F.max("error").alias("error"),
        )
    )


def trailers(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Envelopes with rows that are only counted, at half the cost of reading them."""
    return read(spark, path, T.StructType([]), whole_files)


def rows(
    spark: SparkSession, path: str, row: T.StructType | None = None, table: str | None = None, whole_files: bool = False
) -> DataFrame:
    """(table, row) of the tables none of whose envelopes is rejected.

    A late envelope can reject its whole table, so the verdicts are a pass of their own,
    one name for each rejected table, and the bodies are filtered where they are read.
    A torn document names no table and fails the scan.
    """
    return _accepted(read(spark, path, row, whole_files, strict=True), trailers(spark, path, whole_files), table)


def _accepted(found: DataFrame, seen: DataFrame, table: str | None) -> DataFrame:
    verdicts = seen.where(reason().isNotNull())
    if table is not None:
        found, verdicts = found.where(F.col("table") == table), verdicts.where(F.col("table") == table)
    bad = [r[0] for r in verdicts.select("table").where("table IS NOT NULL").distinct().collect()]  # as many as the source has tables
    good = found.where(~F.col("table").isin(bad)) if bad else found
    return good.select("table", F.explode("data").alias("row"))


def range_number(value: Column, dtype: T.DataType, step: int | float | dt.timedelta) -> Column:
    """Number of the range of length `step` that a value lies in."""
    if isinstance(dtype, T.NumericType) != isinstance(step, (int, float)):
        raise ValueError(f"ranges of {step!r} do not fit {dtype.simpleString()}")
    if isinstance(dtype, T.NumericType):
        return F.floor(value / F.lit(step)).cast("bigint")
    if not isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"{dtype.simpleString()} has no ranges")
    size = step // dt.timedelta(microseconds=1)
    if size <= 0:
        raise ValueError("a range must have a length")
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01T00:00:00").cast("timestamp_ntz"), value.cast("timestamp_ntz"))
    if isinstance(dtype, T.TimestampType):
        # counted from the epoch itself, whatever the session's time zone
        micros = F.unix_micros(value)
    return F.floor(micros / size).cast("bigint")


def write(df: DataFrame, path: str, table: str, page_rows: int = PAGE_ROWS, mode: str = "append", limit: int | None = None) -> None:
    """A table as envelopes of wire rows. Pages are cut from the rows of a task, so none grows
    beyond `page_rows`; rows are shuffled by page, since grouping cannot know that a page's
    rows lie together. Texts are whole unless `limit` gives the characters to keep."""
    _pages(df, table, page_rows, limit).write.mode(mode).text(path)


def write_ranges(
    df: DataFrame, path: str, table: str, field: str, step: int | float | dt.timedelta, page_rows: int = PAGE_ROWS, mode: str = "append",
    limit: int | None = None,
) -> None:
    """The same in folders by range of the watermark field; rows without it lie in a folder of their own.

    A range with a third of all rows is split over several tasks, and small ranges share one.
    """
    number = range_number(column(field), df.schema[field].dataType, step)
    pages = _pages(df, table, page_rows, limit, number)
    pages.hint("rebalance", RANGE).write.mode(mode).partitionBy(RANGE).text(path)


def _pages(df: DataFrame, table: str, page_rows: int, limit: int | None, number: Column | None = None) -> DataFrame:
    """(value): envelopes of at most `page_rows` rows; with `number` also of one range, which comes along."""
    own = [] if number is None else [RANGE]
    if own and RANGE in df.columns:
        raise ValueError(f"a column named {RANGE} has no place in folders by range")
    made = to_wire(df if number is None else df.withColumn(RANGE, number), limit)
    to_text = F.to_json(F.struct(*[column(c) for c in df.columns]), {"ignoreNullFields": "false"})
    paged = made.select(to_text.alias("row"), *own, F.monotonically_increasing_id().alias("id"))
    return (
        # the id is the task number above 33 bits of row number
        paged.groupBy(*own, F.shiftright("id", 33).alias("task"), F.floor(F.col("id").bitwiseAND((1 << 33) - 1) / page_rows).alias("page"))
        .agg(F.collect_list("row").alias("rows"))
        .select(envelope_text(F.lit(table), F.array(*[F.lit(c) for c in df.columns]), F.col("rows")).alias("value"), *own)
    )


def rows_above(
    spark: SparkSession, path: str, schema: T.StructType, field: str, mark, step: int | float | dt.timedelta, table: str | None = None
) -> DataFrame:
    """Rows strictly above the mark, of envelopes that write_ranges() wrote from a table of this schema.

    Only folders from the mark's range on are listed in the plan and read, for the verdicts as well: an
    envelope below them was judged by the increments before. Rows without the field never match.
    """
    dtype = schema[field].dataType
    mark = as_mark(mark, dtype, spark)
    wire = to_wire(spark.createDataFrame([], schema)).schema
    first = range_number(literal(mark, dtype), dtype, step)

    def ranged(row: T.StructType, mode: str) -> DataFrame:
        whole = T.StructType.fromDDL(_HEAD).add("data", T.ArrayType(row)).add(RANGE, T.LongType())
        return spark.read.schema(whole).option("mode", mode).json(path).where(F.col(RANGE) >= first)

    found = _accepted(ranged(wire, "FAILFAST"), ranged(T.StructType([]), "PERMISSIVE"), table)
    return above(conform(found.select("row.*"), schema), field, mark)


def envelope_text(table: Column, columns: Column, rows: Column, count: Column | None = None, error: Column | None = None) -> Column:
    """One envelope as text from the JSON texts of its rows."""
    count = F.size(rows) if count is None else count
    tail = F.lit("") if error is None else F.coalesce(F.concat(F.lit(', "error": '), _json_text(error)), F.lit(""))
    return F.concat(
        F.lit('{"table": '), _json_text(table),
        F.lit(', "columns": '), F.to_json(columns),
        F.lit(', "data": ['), F.array_join(rows, ","),
        F.lit('], "count": '), count.cast("string"), tail, F.lit("}"),
    )


def _json_text(text: Column) -> Column:
    """A JSON string literal."""
    listed = F.to_json(F.array(text))
    return F.when(text.isNotNull(), F.substring(listed, 2, F.length(listed) - 2))

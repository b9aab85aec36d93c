"""Counts and watermarks from file footers.

Parquet keeps the rows of each file and the least and greatest value of most columns in its
footer. Spark's second reader takes COUNT, MIN and MAX from there when it is told to; a
session of its own is told so here, and the caller's settings stay as they are. What the
footers do not tell (texts, timestamps) is read from the rows by the same query, and its
plan says which of the two it was.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.marks import Mark, literal
from tidemark.functions.names import column, quoted

_VIEW = "footer_source"


def _session(spark: SparkSession) -> SparkSession:
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return own


def plan(spark: SparkSession, path: str, field: str | None = None) -> str:
    """The plan by which facts() reads a table."""
    own = _session(spark)
    return own.sql(f"EXPLAIN FORMATTED {_query(own, path, field)}").first()[0]


def _query(own: SparkSession, path: str, field: str | None) -> str:
    own.read.parquet(path).createOrReplaceTempView(_VIEW)
    top = f", max({quoted(field)}) AS top" if field is not None else ""
    return f"SELECT count(*) AS n{top} FROM {_VIEW}"


def facts(spark: SparkSession, path: str, field: str | None = None) -> tuple[int, object, bool]:
    """(rows, greatest value of the field or None, whether the footers told)."""
    own = _session(spark)
    query = _query(own, path, field)
    pushed = "PushedAggregation: [COUNT(*)" in own.sql(f"EXPLAIN FORMATTED {query}").first()[0]
    try:
        row = own.sql(query).first()
    except Exception:
        if field is None or not pushed:
            raise
        # a file whose footer has no greatest value, since all of its values are NULL, fails Spark's reader
        own.conf.set("spark.sql.parquet.aggregatePushdown", "false")
        row, pushed = own.sql(query).first(), False
    return row["n"], row["top"] if field is not None else None, pushed


def row_counts(spark: SparkSession, tables: Mapping[str, str], workers: int = 16) -> DataFrame:
    """(table_name, rows, from_footers, error) of parquet tables {name: path}, one job each, a few at a time.

    Only footers are read. A table that cannot be read keeps its error and has no rows, not zero.
    """

    def count(path: str) -> tuple[int | None, bool | None, str | None]:
        try:
            n, _, pushed = facts(spark, path)
            return n, pushed, None
        except Exception as error:
            return None, None, str(error)

    schema = "table_name STRING, rows BIGINT, from_footers BOOLEAN, error STRING"
    if not tables:
        return spark.createDataFrame([], schema)
    with ThreadPoolExecutor(workers) as pool:
        results = list(pool.map(inheritable_thread_target(spark)(count), tables.values()))
    return spark.createDataFrame([(t, *r) for t, r in zip(tables, results)], schema)


def highest(spark: SparkSession, path: str, field: str, previous: Mark | None = None) -> DataFrame:
    """(watermark, from_footers): the greatest value of the field, NULLs skipped, never below the previous mark."""
    _, top, pushed = facts(spark, path, field)
    dtype = spark.read.parquet(path).schema[field].dataType
    made = spark.createDataFrame([(top, pushed)], T.StructType([T.StructField("watermark", dtype), T.StructField("from_footers", T.BooleanType())]))
    if previous is not None:
        made = made.withColumn("watermark", F.greatest(literal(previous, dtype), column("watermark")))
    return made

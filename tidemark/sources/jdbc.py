"""Relational sources and targets over Spark's JDBC connector.

The driver jar is the user's. Reads push the watermark predicate to the database; writes
go in batches, and a keyed delta lands in a staging table that one statement merges.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import with_safe_names
from tidemark.functions.wire import all_text, to_wire, without_nul

# Rows fetched per round trip, and rows per insert batch.
FETCH_ROWS = 5_000
INSERT_ROWS = 1_000

_QUOTE = {"mysql": "`", "postgres": '"', "ansi": '"'}


def quoted_table(table: str, dialect: str = "postgres") -> str:
    """`schema.table` as the database's quoted name; a part that is quoted already stays as it is."""
    q = _QUOTE[dialect]
    parts = re.findall(rf"{q}(?:[^{q}]|{q}{q})*{q}|[^.]+", table)
    return ".".join(p if p.startswith(q) else f"{q}{p.replace(q, q + q)}{q}" for p in parts)


def staging_table(table: str, dialect: str = "postgres") -> str:
    """The quoted name of the table beside `table` that a delta is staged in."""
    q = _QUOTE[dialect]
    return f"{quoted_table(table, dialect)[:-1]}_staging{q}"


def read_options(url: str, table: str, partition: tuple[str, object, object, int] | None = None, **more) -> dict[str, str]:
    """Options for `spark.read.format('jdbc')`.

    `partition` is (column, lower, upper, tasks): without it the whole table comes
    through one task, so give it for anything large.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(FETCH_ROWS)}
    if partition is not None:
        name, lower, upper, tasks = partition
        options |= {"partitionColumn": name, "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(tasks)}
    return options | {k: str(v) for k, v in more.items()}


def read(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(url, table, **kwargs)).load()


def write_options(url: str, table: str, key_types: dict[str, str] | None = None, **more) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "batchsize": str(INSERT_ROWS), "isolationLevel": "READ_COMMITTED"}
    if key_types:
        options["createTableColumnTypes"] = ", ".join(f"{c} {t}" for c, t in key_types.items())
    return options | {k: str(v) for k, v in more.items()}


def write(df: DataFrame, url: str, table: str, mode: str = "append", **kwargs) -> None:
    """Plain insert. `mode='overwrite', truncate=True` keeps the target's definition."""
    df.write.format("jdbc").options(**write_options(url, table, **kwargs)).mode(mode).save()


def key_types(schema: T.StructType, keys: Sequence[str]) -> dict[str, str]:
    """Text keys need a bounded type to be indexed."""
    return {k: "VARCHAR(255)" for k in keys if isinstance(schema[k].dataType, T.StringType)}


def merge_statement(table: str, staging: str, columns: Sequence[str], keys: Sequence[str], dialect: str = "postgres") -> str:
    """One statement that moves a staged delta into the live table; both tables by their quoted names."""
    q = _QUOTE[dialect]

    def name(n: str) -> str:
        return f"{q}{n.replace(q, q + q)}{q}"

    cols = ", ".join(map(name, columns))
    insert = f"INSERT INTO {quoted_table(table, dialect)} ({cols}) SELECT {cols} FROM {quoted_table(staging, dialect)}"
    if not keys:
        return insert
    rest = [c for c in columns if c not in keys]
    if dialect == "mysql":
        changed = rest or list(keys)[:1]
        return f"{insert} ON DUPLICATE KEY UPDATE " + ", ".join(f"{name(c)} = VALUES({name(c)})" for c in changed)
    target = ", ".join(map(name, keys))
    if not rest:
        return f"{insert} ON CONFLICT ({target}) DO NOTHING"
    return f"{insert} ON CONFLICT ({target}) DO UPDATE SET " + ", ".join(f"{name(c)} = EXCLUDED.{name(c)}" for c in rest)


def target_rows(df: DataFrame, target: str = "mysql", limit: int | None = None) -> DataFrame:
    """Names and values as the target stores them: wire values, for Postgres without NUL,
    for SQLite all text. `limit` cuts long texts."""
    if target == "sqlite":
        return with_safe_names(all_text(df, limit), target)
    rows = to_wire(df, limit)
    return with_safe_names(without_nul(rows) if target == "postgres" else rows, target)


def copy(df: DataFrame, url: str, table: str, target: str = "mysql", keys: Sequence[str] = (), stamp: bool = False, **kwargs) -> None:
    """One-off copy of a table; `stamp` adds `_synced_at`."""
    rows = target_rows(df, target)
    if stamp:
        rows = rows.withColumn("_synced_at", F.current_timestamp())
    write(rows, url, table, mode="overwrite", key_types=key_types(rows.schema, keys), **kwargs)


def upsert(df: DataFrame, url: str, table: str, keys: Sequence[str], dialect: str = "postgres", **kwargs) -> None:
    """Stage a delta without repeated keys (see `merge.dedupe_last`) in `<table>_staging`, merge it in one
    statement and drop the staging table, also when the statement fails."""
    spark, staging = df.sparkSession, staging_table(table, dialect)
    write(df, url, staging, mode="overwrite", key_types=key_types(df.schema, keys), **kwargs)
    connection = spark._jvm.java.sql.DriverManager.getConnection(
        url, str(kwargs.get("user", "")), str(kwargs.get("password", ""))
    )
    try:
        try:
            connection.createStatement().executeUpdate(merge_statement(table, staging, df.columns, keys, dialect))
        finally:
            connection.createStatement().executeUpdate(f"DROP TABLE {staging}")
    finally:
        connection.close()

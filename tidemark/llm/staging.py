"""Tables written to the shared folder, and orders and names that hold across partitions.

A staged table cuts lineage the way a checkpoint does: a lost executor costs the tasks it
ran, and what was numbered once keeps its numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import files

ROW_BITS = 33  # monotonically_increasing_id() keeps the row's place in its partition below


def staged(df: DataFrame, label: str) -> DataFrame:
    """`df` written once to the shared folder and read from there."""
    spark = df.sparkSession
    path = files.scratch(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def rows_in_order(df: DataFrame, order: Sequence[Column], label: str, **extra: Column) -> DataFrame:
    """(at, row, extra...): rows in a total order of `at`, in partitions of about equal size.

    A row is kept as a struct, so the caller's column names stay out of the way of an
    operator's own. Ties of `order` are broken by the place of the row, so that a key with a third of all
    rows is dealt over many partitions like any other rows.
    """
    keys = [c.alias(f"o{i}") for i, c in enumerate(order)]
    names = [f"o{i}" for i in range(len(keys))] + ["tie"]
    wide = df.select(F.struct("*").alias("row"), *keys, F.monotonically_increasing_id().alias("tie"), *[c.alias(n) for n, c in extra.items()])
    ordered = wide.repartitionByRange(*names).sortWithinPartitions(*names)
    return staged(ordered.select(F.monotonically_increasing_id().alias("at"), "row", *extra), label)


def part(at: Column) -> Column:
    """The partition that wrote a row of rows_in_order()."""
    return F.shiftright(at, ROW_BITS)


def place(at: Column) -> Column:
    """A row's place in that partition, from 0."""
    return at.bitwiseAND(F.lit((1 << ROW_BITS) - 1))


def sorted_names(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Distinct rows with an integer `name` that rises with their sort order. `df` is read twice."""
    ordered = df.select(*columns).distinct().repartitionByRange(*columns).sortWithinPartitions(*columns)
    return staged(ordered.withColumn("name", F.monotonically_increasing_id()), label)


def replacing(df: DataFrame, row: str, made: dict[str, Column], columns: Sequence[str]) -> DataFrame:
    """The fields of struct `row`, but for those whose names the operator gives, and the made columns."""
    taken = {n.lower() for n in made}
    kept = [F.col(row)[c].alias(c) for c in columns if c.lower() not in taken]
    return df.select(*kept, *[c.alias(n) for n, c in made.items()])


def ranked(rows: DataFrame) -> DataFrame:
    """Rows of rows_in_order() with `rank`, their place in the whole order from 0."""
    counts = rows.groupBy(part(F.col("at")).alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each written partition
    base = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.withColumn("part", part(F.col("at"))).join(F.broadcast(base), "part").withColumn("rank", F.col("base") + place(F.col("at"))).drop("part", "base")


def key_name(key: str, taken: Sequence[str]) -> str:
    """The name under which an operator returns the key: its own, or `key` where a column of the result has it."""
    return "key" if key.lower() in {t.lower() for t in taken} else key

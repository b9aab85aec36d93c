"""Contiguous shards of equal size by a global prefix sum.

Rows are put in order once and written. Sizes are then summed from rows that hold numbers
only: running sums inside each written partition, plus the totals of the partitions before
it. A cut is a place in that order, so a row's shard and slot follow from its place and
the cuts of its partition, and texts do not move again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import staging
from tidemark.llm.staging import part, place

OVERHEAD = 16


def byte_size(text: Column, overhead: int = OVERHEAD) -> Column:
    """UTF-8 bytes of a text (null: none) plus a fixed share for its row."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(overhead)


def shard(df: DataFrame, size: Column, order: list[Column], shards: int = 40) -> DataFrame:
    """Every row of `df` with size, shard (0 to shards - 1) and slot (from 0 in each shard).

    Shards are contiguous in `order`; a row belongs to the shard in whose equal share of
    all bytes its middle byte lies, so shards differ from the share by less than one row
    at either end. Rows that tie in `order` follow each other in any order. Null sizes and
    sizes below 0 count as 0; when all sizes are 0 every row is in shard 0. Columns of
    `df` with the names of the result are replaced. Fewer rows than shards leave shards empty.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    rows = staging.rows_in_order(df, order, "shard-rows", size=F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("long"))
    places = rows.select("at", "size", part(F.col("at")).alias("part"))
    totals = places.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    # one row for each written partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base_rows"),
        F.sum("bytes").over(Window.partitionBy()).alias("all"),
    )
    running = F.coalesce(F.sum("size").over(Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    middle = ((F.col("base") + F.col("start")).cast("decimal(38,0)") * 2 + F.col("size")) * shards
    cut = F.when(F.col("all") == 0, F.lit(0)).otherwise(F.least(F.floor(middle / (F.col("all") * 2)), F.lit(shards - 1))).cast("int")
    placed = places.withColumn("start", running).join(F.broadcast(base), "part").select("part", "at", "base_rows", cut.alias("shard"))
    pieces = staging.staged(placed.groupBy("part", "base_rows", "shard").agg(F.min("at").alias("at")), "shard-cuts")
    firsts = pieces.groupBy("shard").agg(F.min(F.col("base_rows") + place(F.col("at"))).alias("first"))
    # one row for each partition, with as many cuts as it has shards
    plan = pieces.join(firsts, "shard").groupBy("part", "base_rows").agg(F.array_sort(F.collect_list(F.struct("at", "shard", "first"))).alias("cuts"))
    own = F.element_at(F.filter("cuts", lambda c: c["at"] <= F.col("at")), -1)
    found = rows.withColumn("part", part(F.col("at"))).join(F.broadcast(plan), "part").withColumn("own", own)
    made = {
        "size": F.col("size"),
        "shard": F.col("own.shard"),
        "slot": F.col("base_rows") + place(F.col("at")) - F.col("own.first"),
    }
    return staging.replacing(found, "row", made, df.columns)


def write_shards(df: DataFrame, path: str) -> None:
    """One folder for each shard, its rows in the order of their slots."""
    df.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)

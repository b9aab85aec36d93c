"""Deletes: keys that a replica still has and its source has lost.

A watermark tells of new and changed rows, never of deleted ones. Both sides are summed up
by bucket of the key's hash: how many keys, the sum of one hash and the xor of another.
Such a digest does not depend on the order of rows and is combined inside the tasks, so a
bucket moves as one row. Buckets with equal digests hold the same keys; only the keys of
the others meet in an anti-join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import files
from tidemark.operators import merge

BUCKETS = 1 << 16
MOST_BUCKETS = 1 << 20  # numbers of buckets are broadcast: 8 MB

_BUCKET = "_digest_bucket"


def _keyed(df: DataFrame, keys: Sequence[str], buckets: int, fold_case: bool, collation: str | None) -> DataFrame:
    """Keys as they compare (_k0, ...) with their bucket; rows without a key have none."""
    merge.require_columns(df, keys)
    merge.require_collated_hash(df.sparkSession, collation)
    compared = merge.key_columns(keys, df.schema, fold_case, collation)
    named = [c.alias(f"_k{i}") for i, c in enumerate(compared)]
    kept = df.where(~merge.no_key(keys)).select(*named, *[merge.column(k) for k in keys])
    return kept.withColumn(_BUCKET, F.pmod(_hash(len(keys)), F.lit(buckets)))


def _hash(n: int, *seed: Column) -> Column:
    return F.xxhash64(*seed, *[F.col(f"_k{i}") for i in range(n)])


def _digests(keyed: DataFrame, n: int) -> DataFrame:
    h = _hash(n)
    # the sum in two halves, which cannot overflow below 2**31 keys a bucket
    return keyed.groupBy(_BUCKET).agg(
        F.count("*").alias("n"),
        F.sum(F.shiftright(h, 32)).alias("high"),
        F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        F.bit_xor(_hash(n, F.lit("second"))).alias("xor"),
    )


def digests(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS, fold_case: bool = False, collation: str | None = None) -> DataFrame:
    """(bucket, n, high, low, xor) of the keys of `df`, one row for each bucket that has any."""
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"from 1 to {MOST_BUCKETS} buckets")
    return _digests(_keyed(df, keys, buckets, fold_case, collation), len(keys)).withColumnRenamed(_BUCKET, "bucket")


def differing(live: DataFrame, source: DataFrame) -> DataFrame:
    """Buckets that live digests have and source digests do not have just so."""
    theirs = source.select("bucket", F.struct("n", "high", "low", "xor").alias("theirs"))
    met = live.select("bucket", F.struct("n", "high", "low", "xor").alias("ours")).join(theirs, "bucket", "left")
    return met.where(~F.col("ours").eqNullSafe(F.col("theirs"))).select("bucket")


def suspects(live: DataFrame, source: DataFrame, keys: Sequence[str], buckets: int = BUCKETS, fold_case: bool = False, collation: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Keys of both sides in the buckets whose digests differ."""
    spark, path = live.sparkSession, files.scratch(live.sparkSession, "digests")
    how = (keys, buckets, fold_case, collation)
    differing(digests(live, *how), digests(source, *how)).write.parquet(path)
    # at most one number for each of MOST_BUCKETS buckets
    wrong = F.broadcast(spark.read.schema("bucket BIGINT").parquet(path).withColumnRenamed("bucket", _BUCKET))
    return tuple(_keyed(df, *how).join(wrong, _BUCKET, "left_semi").drop(_BUCKET) for df in (live, source))


def deleted(live: DataFrame, source: DataFrame, keys: Sequence[str], buckets: int = BUCKETS, fold_case: bool = False, collation: str | None = None) -> DataFrame:
    """The keys of `live` that `source` does not have.

    Both are read twice and only for their keys. A key that is repeated on one side makes
    its bucket differ, which costs a join and changes nothing. Rows without a key are in
    neither side. Enough buckets are several times the number of deletes expected: then few
    keys share a bucket with a deleted one.
    """
    ours, theirs = suspects(live, source, keys, buckets, fold_case, collation)
    names = [f"_k{i}" for i in range(len(keys))]
    return ours.join(theirs.select(*names).distinct(), names, "left_anti").select(*[merge.column(k) for k in keys])

"""A table followed as a stream of files: every micro-batch is one merge and one commit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.replica import BUCKET_BYTES, Replica


def follow(
    spark: SparkSession, path: str, schema: T.StructType, replica: Replica, checkpoint: str, field: str,
    keys: Sequence[str] = (), order: Sequence[str] | None = None, bucket_bytes: int = BUCKET_BYTES, fmt: str = "parquet",
    files_per_batch: int | None = None, every: str | None = None, latest: bool | None = None, **options,
) -> StreamingQuery:
    """Merge files as they arrive. Stops after the files present, or with `every`
    ('15 minutes') keeps looking.

    The commit names the batch, so a batch that Spark repeats after a failure is merged
    once. A keyed batch holds no state between batches: of equal keys the row that arrives
    last wins, or with `latest` the one that is last by field and order.
    """
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def merge(batch: DataFrame, number: int) -> None:
        replica.apply(batch, field, keys, order, bucket_bytes, latest=latest, feed=checkpoint, batch=number)

    writer = reader.load(path).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()

"""Which tables a run takes, and how."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import files

POLICY_SCHEMA = "table_name STRING, skip BOOLEAN, field STRING, pk STRING"


@dataclass(frozen=True)
class Policy:
    """`incremental` maps a table to {'field': ...} and, where wanted, 'pk', 'order' (several
    columns with commas), 'fold_case', 'collation', 'latest', 'track_types', and 'deletes' (rows whose
    keys the source has lost go after each increment)."""

    skip: tuple[str, ...] = ()
    incremental: dict[str, dict] = field(default_factory=dict)


def load_policy(spark: SparkSession, path: str | None) -> Policy:
    """From a JSON or YAML file; no file means nothing skipped and nothing incremental."""
    if not path or not files.exists(spark, path):
        return Policy()
    text = spark.read.text(path, wholetext=True).first()
    if text is None:
        return Policy()
    if path.endswith(".json"):
        data = json.loads(text[0])
    else:
        try:
            import yaml
        except ImportError as error:
            raise RuntimeError("a YAML policy needs PyYAML; use JSON instead") from error
        data = yaml.safe_load(text[0])
    data = data or {}
    return Policy(tuple(data.get("skip") or ()), dict(data.get("incremental") or {}))


def policy_frame(spark: SparkSession, policy: Policy) -> DataFrame:
    rows = [(t, True, None, None) for t in policy.skip]
    rows += [(t, False, p.get("field"), p.get("pk")) for t, p in policy.incremental.items() if t not in policy.skip]
    return spark.createDataFrame(rows, POLICY_SCHEMA)


def without_skipped(listing: DataFrame, policy: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    skipped = policy.where("skip").select("table_name")
    kept = listing.join(skipped, "table_name", "left_anti")
    return kept.where(~F.col("table_name").isin(list(exclude))) if exclude else kept


def unknown_tables(listing: DataFrame, policy: DataFrame) -> DataFrame:
    """Policy entries for tables the source does not have: most likely misspelt."""
    return policy.select("table_name").join(listing, "table_name", "left_anti")


def modes(
    listing: DataFrame, policy: DataFrame, state: DataFrame, full_refresh: bool = False, exclude: Sequence[str] = ()
) -> DataFrame:
    """(table_name, mode, field, pk, watermark_type, watermark_value) of every table to take.

    A watermark counts for the field it was taken from and where rows are published, so an
    imported one does not; a full refresh ignores the incremental part of the policy.
    """
    kept = without_skipped(listing.select("table_name"), policy, exclude)
    marks = state.where("published").select(
        F.col("source_table").alias("table_name"), "watermark_field", "watermark_type", "watermark_value"
    )
    joined = kept.join(policy.drop("skip"), "table_name", "left").join(marks, "table_name", "left")
    listed = F.col("field").isNotNull() & F.lit(not full_refresh)
    usable = listed & F.col("watermark_value").isNotNull() & (
        F.col("watermark_field").isNull() | (F.col("watermark_field") == F.col("field"))
    )
    return joined.select(
        "table_name",
        F.when(usable, "incremental").when(listed, "incremental-initial").otherwise("full").alias("mode"),
        "field",
        "pk",
        F.when(usable, F.col("watermark_type")).alias("watermark_type"),
        F.when(usable, F.col("watermark_value")).alias("watermark_value"),
    )


def resume(plan: DataFrame, start_index: int = 0, tables: int | None = None) -> DataFrame:
    """The plan in table order from an index on; an index behind the end is an error."""
    if start_index:
        tables = plan.count() if tables is None else tables
        if not 0 <= start_index < tables:
            raise ValueError(f"start index {start_index} is outside 0..{tables - 1}")
    return plan.orderBy("table_name").offset(start_index)

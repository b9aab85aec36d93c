"""Reports of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_SCHEMA = (
    "table_name STRING, mode STRING, rows BIGINT, bytes BIGINT, fetch_sec DOUBLE, insert_sec DOUBLE, duration_sec DOUBLE, "
    "ok BOOLEAN, watermark STRING, error STRING"
)


def run_summary(report: DataFrame, total_tables: int | None = None, start_index: int = 0) -> DataFrame:
    """Counts, names of failed tables, seconds of the run, and where a run that stopped early goes on."""
    done = F.count("*")
    return report.agg(
        F.count_if("ok").alias("succeeded"),
        F.count_if(~F.col("ok")).alias("failed"),
        # one name per failed table
        F.array_join(F.sort_array(F.collect_list(F.when(~F.col("ok"), F.col("table_name")))), ",").alias("failed_tables"),
        F.coalesce(F.sum("rows"), F.lit(0).cast("bigint")).alias("rows"),
        # every row carries the time from the start of the run to the end of its table
        F.coalesce(F.max("duration_sec"), F.lit(0.0)).alias("duration_sec"),
        (F.lit(start_index).cast("bigint") + done).alias("next_index"),
        (F.lit(total_tables).cast("bigint") if total_tables is not None else start_index + done).alias("total_tables"),
    )


def write_csv(report: DataFrame, path: str) -> None:
    """A report has one row per table, so it goes to one file."""
    report.withColumnRenamed("table_name", "table").coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_catalog(classified: DataFrame, path: str) -> None:
    """The catalog for review, sorted by table: files follow each other by name, a small catalog is one file."""
    classified.orderBy("table_name").write.mode("overwrite").option("ignoreNullFields", False).json(path)

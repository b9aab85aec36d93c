"""Counts and marks from file footers."""

import datetime as dt

import pytest

from tidemark import Mark, files
from tidemark.sources import footers, tables


def test_plan_reads_footers_only(spark, sf_dir):
    steps = footers.plan(spark, f"{sf_dir}/events.parquet", "event_id")
    assert "PushedAggregation: [COUNT(*), MAX(event_id)]" in steps
    # a timestamp's greatest value is read from the rows, by the same query
    assert "PushedAggregation: [COUNT(*)" not in footers.plan(spark, f"{sf_dir}/events.parquet", "ts")


def test_the_callers_session_keeps_its_settings(spark, sf_dir):
    before = spark.conf.get("spark.sql.sources.useV1SourceList"), spark.conf.get("spark.sql.parquet.aggregatePushdown")
    footers.facts(spark, f"{sf_dir}/events.parquet")
    assert before == (spark.conf.get("spark.sql.sources.useV1SourceList"), spark.conf.get("spark.sql.parquet.aggregatePushdown"))
    assert "footer_source" not in {t.name for t in spark.catalog.listTables()}


@pytest.mark.parametrize(("field", "pushed"), [("event_id", True), ("ts", False), ("event_type", False)])
def test_facts_are_those_of_the_rows(spark, sf_dir, field, pushed):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    n, top, told = footers.facts(spark, f"{sf_dir}/events.parquet", field)
    assert (n, top, told) == (events.count(), events.agg({field: "max"}).first()[0], pushed)
    made = footers.highest(spark, f"{sf_dir}/events.parquet", field)
    assert made.schema["watermark"].dataType == events.schema[field].dataType and made.first()["watermark"] == top


def test_empty_files_nulls_and_previous_marks(spark):
    path = files.scratch(spark, "footers")
    spark.createDataFrame([(1, None), (None, None), (7, None)], "a int, b date").repartition(3).write.parquet(path)
    spark.createDataFrame([], "a int, b date").write.mode("append").parquet(path)
    assert footers.facts(spark, path, "a")[:2] == (3, 7)
    assert footers.facts(spark, path, "b")[:2] == (3, None)
    assert footers.highest(spark, path, "a", Mark("int", "9")).first()["watermark"] == 9
    assert footers.highest(spark, path, "b", Mark("datetime", "2024-01-02")).first()["watermark"] == dt.date(2024, 1, 2)


def test_a_broken_table_is_no_zero(spark):
    root = files.scratch(spark, "footers")
    spark.range(5).write.parquet(f"{root}/good")
    spark.createDataFrame([("PAR1 no footer",)], "v string").coalesce(1).write.text(f"{root}/bad")
    got = {r.table_name: (r.rows, r.from_footers, r.error is None) for r in footers.row_counts(spark, tables.list_tables(spark, root)).collect()}
    assert got == {"good": (5, True, True), "bad": (None, None, False)}
    assert footers.row_counts(spark, {}).isEmpty()

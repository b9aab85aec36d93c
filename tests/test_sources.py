"""Scans, envelopes, read-only SQL, JDBC text."""

import datetime as dt
import json

import duckdb
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import files
from tidemark.functions import wire
from tidemark.functions.marks import Mark
from tidemark.sources import envelopes, jdbc, query, tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def numbers(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (3, "e")], "n int, s string")


def test_above_is_strict_and_skips_nulls(spark):
    assert sorted(r.s for r in tables.above(numbers(spark), "n", 2).collect()) == ["e"]
    assert sorted(r.s for r in tables.above(numbers(spark), "n", Mark("int", "1")).collect()) == ["b", "c", "e"]
    assert sorted(r.s for r in tables.above(numbers(spark), "n", 2, lookback=1).collect()) == ["b", "c", "e"]
    assert tables.above(numbers(spark)).count() == 5


def test_field_and_mark_belong_together(spark):
    with pytest.raises(ValueError):
        tables.above(numbers(spark), "n")
    with pytest.raises(ValueError):
        tables.above(numbers(spark), mark=3)
    with pytest.raises(ValueError):
        tables.above(numbers(spark), "n", 2, lookback=dt.timedelta(days=1))


@pytest.mark.parametrize(
    "mark,lookback", [(Mark("datetime", "2024-01-16T00:00:00"), None), (dt.datetime(2024, 1, 16), dt.timedelta(days=2))]
)
def test_watermark_reaches_the_scan(spark, sf_dir, mark, lookback):
    df = tables.above(tables.load(spark, f"{sf_dir}/events.parquet"), "ts", mark, lookback).select("event_id")
    text = plan(df)
    assert "GreaterThan(ts," in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_pages_against_brute_force(spark):
    df = spark.range(0, 5_000, 3).select((F.col("id") * 7 % 5_003).alias("k"))
    got = {r.k: r.page for r in tables.pages(df, "k", page_size=100).collect()}
    assert got == {k: i // 100 for i, k in enumerate(sorted(got))}
    assert len(got) == df.count()
    assert tables.pages(df.where("false"), "k", 10).count() == 0
    with_null = df.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k"))
    numbered = tables.pages(with_null, "k", page_size=1)
    assert numbered.where("k IS NULL").first().page == 0
    assert sorted(r.page for r in numbered.collect()) == list(range(len(got) + 1))


def test_pages_of_text_keys(spark):
    df = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("k"), "id")
    got = {r.k: r.page for r in tables.pages(df, "k", page_size=7).collect()}
    assert got == {k: i // 7 for i, k in enumerate(sorted(got))}


def test_lookback_of_hours_on_a_date_reads_the_day(spark):
    df = spark.sql("SELECT DATE'2024-01-05' AS d UNION ALL SELECT DATE'2024-01-06'")
    assert tables.above(df, "d", dt.date(2024, 1, 6), lookback=dt.timedelta(hours=12)).count() == 1
    assert tables.above(df, "d", dt.date(2024, 1, 6), lookback=dt.timedelta(hours=36)).count() == 2


def test_page_and_page_after_agree(spark):
    df = spark.range(100).repartition(7)
    third = [r.id for r in tables.page(df, "id", 10, 20).collect()]
    assert third == list(range(20, 30)) == [r.id for r in tables.page_after(df, "id", 19, 10).collect()]
    assert tables.page(df, "id", 10, 95).count() == 5


def test_tables_of_folder_and_catalog(spark, sf_dir):
    found = tables.list_tables(spark, sf_dir)
    assert list(found) == sorted(found) and found["events"].endswith("/events.parquet")
    spark.sql("CREATE OR REPLACE TEMP VIEW only_a_view AS SELECT 1")
    assert "only_a_view" not in tables.list_catalog(spark)


def land(spark, docs, **kwargs):
    path = files.scratch(spark, "envelope")
    spark.createDataFrame([(json.dumps(d, **kwargs),) for d in docs], "value string").coalesce(1).write.text(path)
    return path


def envelope(table="t", columns=("a",), data=(), count=None, **more):
    return {"table": table, "columns": list(columns), "data": list(data), "count": len(data) if count is None else count, **more}


def test_envelope_cases(spark):
    three = [{"a": 1}, {"a": 2}, {"a": None}]
    path = land(
        spark,
        [
            envelope("clean", data=three),
            envelope("trailer", data=three[:2], error="cursor closed"),
            envelope("error", error="no such table"),
            envelope("empty"),
            envelope("bare", columns=()),
            envelope("short", data=three, count=4),
            envelope("pages", data=three),
            envelope("pages", data=three, error="second page broke"),
        ],
    )
    for found in (envelopes.read(spark, path), envelopes.trailers(spark, path)):
        bad = {(r["table"], r["reason"]) for r in envelopes.rejects(found).collect()}
        assert bad == {("trailer", "error"), ("error", "error"), ("bare", "no columns"), ("short", "count"), ("pages", "error")}
    good = envelopes.rows(spark, path).groupBy("table").count().collect()
    assert [tuple(r) for r in good] == [("clean", 3)]
    clean = envelopes.rows(spark, path, table="clean").select(F.variant_get("row", "$.a", "int").alias("a"))
    assert [r.a for r in clean.collect()] == [1, 2, None]
    assert envelopes.rows(spark, path, table="pages").count() == 0


@pytest.mark.parametrize("row", [None, T.StructType().add("a", "long")])
def test_torn_document(spark, row):
    path = files.scratch(spark, "envelope")
    whole = json.dumps(envelope(data=[{"a": 1}]))
    spark.createDataFrame([(whole,), (whole[:-15],)], "value string").coalesce(1).write.text(path)
    bad = envelopes.rejects(envelopes.trailers(spark, path)).collect()
    assert sum(r["envelopes"] for r in bad) == 1
    with pytest.raises(Exception, match="(?i)malformed"):
        envelopes.rows(spark, path, row).collect()


def test_value_of_another_type_fails(spark):
    path = land(spark, [envelope(data=[{"a": "text"}])])
    with pytest.raises(Exception, match="(?i)malformed"):
        envelopes.rows(spark, path, T.StructType().add("a", "long")).collect()


def test_envelope_of_one_pretty_document(spark):
    path = land(spark, [envelope(data=[{"a": "x\ny"}])], indent=2)
    found = envelopes.rows(spark, path, whole_files=True)
    assert found.select(F.variant_get("row", "$.a", "string")).first()[0] == "x\ny"


def test_envelope_round_trip_cuts_pages(spark):
    df = spark.range(0, 1_000, 1, 3).select("id", F.concat(F.lit('q"\\ü\n'), F.col("id").cast("string")).alias("s"), F.lit(None).cast("int").alias("n"))
    path = files.scratch(spark, "envelope")
    envelopes.write(df, path, "my-table", page_rows=100)
    assert envelopes.trailers(spark, path).agg(F.max(F.size("data"))).first()[0] == 100
    assert envelopes.rejects(envelopes.trailers(spark, path)).count() == 0
    back = envelopes.rows(spark, path, wire.to_wire(df).schema, "my-table").select("row.id", "row.s", "row.n").collect()
    assert sorted(map(tuple, back)) == sorted(map(tuple, df.collect()))


def test_envelope_bodies_are_not_shuffled(spark):
    path = land(spark, [envelope("t", data=[{"a": i}]) for i in range(4)] + [envelope("bad", data=[{"a": 1}], error="x")])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = envelopes.rows(spark, path)
        assert found.count() == 4
        assert "Exchange" not in plan(found) and "Join" not in plan(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_texts_are_whole_unless_cut(spark):
    df = spark.createDataFrame([("x" * 20_000,)], "s string")
    assert len(wire.to_wire(df).first().s) == 20_000
    assert len(wire.to_wire(df, wire.MAX_TEXT).first().s) == 10_000 + len(wire.CUT_MARKER)
    path = files.scratch(spark, "envelope")
    envelopes.write(df, path, "t")
    assert len(envelopes.rows(spark, path).select(F.variant_get("row", "$.s", "string")).first()[0]) == 20_000


def test_read_only_sql(spark):
    spark.range(3).createOrReplaceTempView("guarded")
    assert query.read_only(spark, "SELECT id FROM guarded ORDER BY id DESC").first()[0] == 2
    assert query.read_only(spark, "WITH x AS (SELECT 'UPDATE me; DROP TABLE t' AS s) SELECT s FROM x -- end").count() == 1
    assert query.read_only(spark, "SELECT id, id FROM guarded").count() == 3
    for text in (
        "DROP TABLE guarded", "DELETE FROM guarded", "INSERT INTO guarded VALUES (1)", "CREATE TABLE t AS SELECT 1", "SET a=b",
        "SELECT 1; DROP VIEW guarded", "SELECT 1) AS x; DROP VIEW guarded; SELECT (1", "TRUNCATE TABLE guarded", "",
    ):
        with pytest.raises((query.NotReadOnly, AnalysisException)):
            query.read_only(spark, text)
    for text in (
        "SELECT TRANSFORM(id) USING 'cat' AS x FROM guarded", "SELECT reflect('java.util.UUID', 'randomUUID')",
        "SELECT java_method /* x */ ('java.lang.System', 'getenv')", "WITH q AS (SELECT try_reflect('java.lang.System', 'nanoTime') AS n) SELECT n FROM q",
    ):
        with pytest.raises(query.NotReadOnly):
            query.read_only(spark, text)
    assert query.read_only(spark, "SELECT 'reflect(' AS a, \"ScriptTransformation\" AS b, 'it''s java_method(' AS c").count() == 1
    assert spark.catalog.tableExists("guarded")
    with pytest.raises(AnalysisException):
        query.read_only(spark, "SELECT nothing FROM guarded")


@pytest.mark.parametrize(
    "text",
    [
        # a raw string that ends in a backslash, a comment that hides the end
        r"""SELECT r'\' AS a, reflect("java.lang.System","getProperty","user.name") AS x -- '""",
        """SELECT 1 /* ' */, java_method('java.util.UUID', 'randomUUID') /* ' */""",
        "SELECT filter(array('a'), x -> reflect('java.util.UUID', 'randomUUID') = x)",
        "SELECT id FROM guarded WHERE id IN (SELECT length(reflect('java.util.UUID', 'randomUUID')) FROM guarded)",
        "SELECT (SELECT try_reflect('java.util.UUID', 'randomUUID'))",
        "SELECT * FROM guarded_by_view",
        "SELECT id FROM guarded ORDER BY reflect('java.util.UUID', 'randomUUID')",
        "SELECT * FROM (SELECT TRANSFORM(id) USING 'cat' AS x FROM guarded)",
        "SELECT own_function(id) FROM guarded",
    ],
)
def test_plans_that_do_more_than_read_are_refused(spark, text):
    spark.range(3).createOrReplaceTempView("guarded")
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW guarded_by_view AS SELECT reflect('java.util.UUID', 'randomUUID') AS x FROM guarded")
    spark.udf.register("own_function", lambda x: x)
    with pytest.raises(query.NotReadOnly):
        query.read_only(spark, text)


def test_registered_functions_can_be_allowed(spark):
    spark.udf.register("own_function", lambda x: x)
    assert query.read_only(spark, "SELECT own_function('a') AS a", functions=True).first().a == "a"
    with pytest.raises(query.NotReadOnly):
        query.read_only(spark, "SELECT own_function(reflect('java.util.UUID', 'randomUUID')) AS a", functions=True)


@pytest.mark.parametrize(
    "text",
    [
        "TABLE guarded", "VALUES (1), (2)", "SELECT count(*) FROM guarded GROUP BY ROLLUP(id)", "SELECT * FROM guarded TABLESAMPLE (100 PERCENT)",
        "SELECT id FROM guarded EXCEPT SELECT 1", "SELECT id FROM guarded INTERSECT SELECT 1 UNION ALL SELECT 2", "FROM guarded |> WHERE id > 0",
        "SELECT sum(id) OVER (ORDER BY id) FROM guarded", "SELECT * FROM (SELECT id FROM guarded) PIVOT (count(1) FOR id IN (1, 2))",
        "SELECT explode(sequence(1, id + 1)) FROM guarded", "SELECT /*+ REPARTITION(2) */ DISTINCT id FROM guarded LIMIT 2 OFFSET 1",
        "SELECT * FROM guarded a, LATERAL (SELECT a.id + 1 AS n)", "SELECT id FROM guarded CLUSTER BY id", "SELECT * FROM range(4)",
        "SELECT upper('x'), parse_json('{}'), url_decode('a'), try_add(1, 2), left('abc', 1), aes_encrypt('a', '0123456789abcdef')",
        "WITH RECURSIVE r(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM r WHERE n < 5) SELECT n FROM r",
        "SELECT stack(2, 1, 2), 'reflect(' -- reflect('java.util.UUID', 'randomUUID')",
    ],
)
def test_plans_that_read_are_allowed(spark, text):
    spark.range(3).createOrReplaceTempView("guarded")
    query.read_only(spark, text).collect()


def test_bound_parameters_stay_values(spark):
    spark.createDataFrame([(1, "a' OR '1' = '1"), (2, "b")], "id int, name string").createOrReplaceTempView("bound")
    asked = "SELECT id FROM IDENTIFIER(:t) WHERE IDENTIFIER(:c) = :v"
    assert [r.id for r in query.read_only(spark, asked, args={"t": "bound", "c": "name", "v": "a' OR '1' = '1"}).collect()] == [1]
    assert query.read_only(spark, asked, args={"t": "bound", "c": "name", "v": "x' OR '1' = '1"}).isEmpty()
    assert [r.id for r in query.read_only(spark, "SELECT id FROM bound WHERE id > ? AND name < ?", args=[1, "c"]).collect()] == [2]
    # a name is a name, not SQL
    with pytest.raises(query.NotReadOnly):
        query.read_only(spark, asked, args={"t": "bound; DROP VIEW bound", "c": "name", "v": "b"})
    with pytest.raises(AnalysisException):
        query.read_only(spark, asked, args={"t": "bound"})
    assert spark.catalog.tableExists("bound")


def test_increments_over_envelopes_read_new_folders_only(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    path, day = files.scratch(spark, "ranges"), dt.timedelta(days=1)
    envelopes.write_ranges(events, path, "events", "ts", day)
    written = spark.read.text(path).inputFiles()
    for mark in ("2024-01-16T00:00:00", "2024-01-16T13:14:15.5", "2000-01-01T00:00:00", "2100-01-01T00:00:00"):
        found = envelopes.rows_above(spark, path, events.schema, "ts", Mark("datetime", mark), day, "events")
        assert sorted(found.collect()) == sorted(events.where(F.col("ts") > F.lit(mark).cast("timestamp_ntz")).collect())
    found = envelopes.rows_above(spark, path, events.schema, "ts", Mark("datetime", "2024-01-16T13:14:15.5"), day, "events")
    steps = plan(found)
    assert "PartitionFilters: [isnotnull(range_" in steps and "PartitionFilters: []" not in steps
    read = found.select(F.input_file_name()).distinct().count()
    assert 0 < read < len(written)


def test_ranges_of_numbers_dates_and_nulls(spark):
    rows = [(-7, dt.date(1960, 1, 1), "a"), (0, dt.date(1970, 1, 1), "b"), (12, None, "c"), (None, dt.date(2024, 2, 29), "d"), (13, dt.date(2024, 3, 1), "e")]
    df = spark.createDataFrame(rows, "n int, d date, s string")
    path = files.scratch(spark, "ranges")
    envelopes.write_ranges(df, f"{path}/n", "t", "n", 5)
    envelopes.write_ranges(df, f"{path}/d", "t", "d", dt.timedelta(days=30))
    assert sorted(r.s for r in envelopes.rows_above(spark, f"{path}/n", df.schema, "n", -7, 5).collect()) == ["b", "c", "e"]
    assert sorted(r.s for r in envelopes.rows_above(spark, f"{path}/d", df.schema, "d", dt.date(1970, 1, 1), dt.timedelta(days=30)).collect()) == ["d", "e"]
    # all rows are there, those without the field in a folder of their own
    assert envelopes.rows(spark, f"{path}/n", wire.to_wire(df).schema).count() == 5
    for field, step in (("n", dt.timedelta(days=1)), ("d", 3), ("s", 1), ("s", dt.timedelta(days=1))):
        with pytest.raises(ValueError):
            envelopes.write_ranges(df, f"{path}/x", "t", field, step)


def test_a_rejected_envelope_above_the_mark_rejects_the_increment(spark):
    df = spark.range(20).withColumnRenamed("id", "n")
    path = files.scratch(spark, "ranges")
    envelopes.write_ranges(df, path, "t", "n", 10)
    bad = json.dumps(envelope("t", columns=["n"], data=[{"n": 99}], error="cursor closed"))
    spark.createDataFrame([(bad, 0)], "value string, range_ long").write.mode("append").partitionBy("range_").text(path)
    # it lies below the mark's folder: an increment before this one judged it
    assert envelopes.rows_above(spark, path, df.schema, "n", 12, 10, "t").count() == 7
    assert envelopes.rows_above(spark, path, df.schema, "n", 3, 10, "t").count() == 0


def test_jdbc_options():
    got = jdbc.read_options("jdbc:x", "t", partition=("id", 1, 1_000, 20))
    assert got == {
        "url": "jdbc:x", "dbtable": "t", "fetchsize": "5000", "partitionColumn": "id", "lowerBound": "1", "upperBound": "1000",
        "numPartitions": "20",
    }
    assert jdbc.write_options("jdbc:x", "t", key_types={"k": "VARCHAR(255)"}, truncate=True) == {
        "url": "jdbc:x", "dbtable": "t", "batchsize": "1000", "isolationLevel": "READ_COMMITTED",
        "createTableColumnTypes": "k VARCHAR(255)", "truncate": "True",
    }


def test_merge_statement_merges():
    con = duckdb.connect()
    con.execute("CREATE TABLE live (k INT PRIMARY KEY, v TEXT); INSERT INTO live VALUES (1, 'a'), (2, 'b')")
    con.execute("CREATE TABLE live_staging AS SELECT * FROM (VALUES (2, 'B'), (3, 'C')) t(k, v)")
    for _ in range(2):
        con.execute(jdbc.merge_statement("live", "live_staging", ["k", "v"], ["k"]))
    assert con.sql("SELECT * FROM live ORDER BY k").fetchall() == [(1, "a"), (2, "B"), (3, "C")]
    assert jdbc.merge_statement("t", "s", ["k"], ["k"]).endswith("DO NOTHING")
    assert jdbc.merge_statement("t", "s", ["k", "v"], ["k"], "mysql") == (
        "INSERT INTO `t` (`k`, `v`) SELECT `k`, `v` FROM `s` ON DUPLICATE KEY UPDATE `v` = VALUES(`v`)"
    )
    assert "ON " not in jdbc.merge_statement("t", "s", ["k", "v"], [])


def test_jdbc_names_are_quoted_once():
    assert jdbc.quoted_table("Orders") == '"Orders"'
    assert jdbc.quoted_table("public.orders") == '"public"."orders"'
    assert jdbc.quoted_table('"My.Schema".t', "ansi") == '"My.Schema"."t"'
    assert jdbc.quoted_table("db.my`t", "mysql") == "`db`.`my``t`"
    staging = jdbc.staging_table("public.Orders")
    assert staging == '"public"."Orders_staging"' and jdbc.quoted_table(staging) == staging
    con = duckdb.connect()
    con.execute('CREATE SCHEMA "S"; CREATE TABLE "S"."Live" (k INT PRIMARY KEY, v TEXT)')
    con.execute(f'CREATE TABLE {jdbc.staging_table("S.Live")} AS SELECT 1 AS k, \'a\' AS v')
    con.execute(jdbc.merge_statement("S.Live", jdbc.staging_table("S.Live"), ["k", "v"], ["k"]))
    con.execute(f"DROP TABLE {jdbc.staging_table('S.Live')}")
    assert con.execute('SELECT * FROM "S"."Live"').fetchall() == [(1, "a")]


def test_only_whole_marks_of_writers_are_left_out(spark, tmp_path):
    tables_of_users = ["_committed_12", "_committed_sales", "_started_jobs", "_temporary_orders", "_SUCCESS_rates", "_spark_metadata_copy", "orders"]
    for name in [*tables_of_users, "_temporary", "_spark_metadata"]:
        (tmp_path / name).mkdir()
    for name in ("_SUCCESS", "_started_4711", "_committed_4711", "_committed_vacuum4711", ".hidden"):
        (tmp_path / name).touch()
    assert list(tables.list_tables(spark, str(tmp_path))) == sorted(tables_of_users)

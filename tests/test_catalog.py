"""Catalog profiling, sizes, policy, plan, reports."""

import json

import pytest

from tidemark import files
from tidemark.operators import catalog, report
from tidemark.plans import policy
from tidemark.sources.tables import catalog_table

COLUMNS = [
    ("Jobs", ["CustomerID int", "JobID int", "ModifiedDate datetime", "Status str"]),
    ("Rates", ["RateCode str", "Updated str"]),
    ("JOBS", ["CustomerID int", "JobID int"]),
    ("Notes", ["Text str"]),
    ("Both", ["Updated str", "Changed datetime", "job_id int", "id int"]),
    ("Late", ["Changed datetime", "modified date", "is deleted int", "Active int"]),
    ("things", ["pk_thing int"]),
    ("Invoices", ["JobNo int", "InvoiceNo int", "Deleted int"]),
]


def columns(spark):
    rows = [(t, i + 1, *c.rsplit(" ", 1), None, True) for t, cols in COLUMNS for i, c in enumerate(cols)]
    return spark.createDataFrame(rows, catalog.COLUMNS_SCHEMA)


def test_classification(spark):
    got = {r[0]: tuple(r[1:]) for r in catalog.classify(columns(spark)).collect()}
    assert got == {
        "Jobs": ("JobID", "ModifiedDate", "Status", 4, "incremental"),
        "Rates": ("RateCode", None, None, 2, "full_refresh"),
        "JOBS": ("CustomerID", None, None, 2, "full_refresh"),
        "Notes": (None, None, None, 1, "full_refresh"),
        # the better pattern has the wrong type: no second candidate is tried
        "Both": ("id", None, None, 4, "full_refresh"),
        "Late": (None, "modified", "is deleted", 4, "incremental"),
        "things": ("pk_thing", None, None, 1, "full_refresh"),
        "Invoices": ("InvoiceNo", None, "Deleted", 3, "full_refresh"),
    }
    total = catalog.summary(catalog.classify(columns(spark)), spark.range(2)).first()
    assert tuple(total) == (8, 6, 2, 3, 2)


def test_catalog_file_is_sorted(spark):
    path = files.scratch(spark, "catalog")
    report.write_catalog(catalog.classify(columns(spark)), path)
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert [x["table_name"] for x in lines] == sorted(t for t, _ in COLUMNS)
    assert lines[-1]["mtime_col"] is None


def test_column_profile(spark):
    df = spark.createDataFrame([("abc", None), ("a", 2)], "`it's a \\ .name` string, n int")
    got = [tuple(r) for r in catalog.column_profile({"t'": df, "empty": df.where("false")}).collect()]
    assert got == [
        ("t'", 1, "it's a \\ .name", "string", 3, False), ("t'", 2, "n", "int", None, True),
        ("empty", 1, "it's a \\ .name", "string", None, False), ("empty", 2, "n", "int", None, False),
    ]


def test_sizes_keep_errors(spark):
    def broken():
        raise RuntimeError("no access " + "x" * 300)

    sizes = catalog.probe_sizes(spark, {"small": spark.range(3), "broken": broken, "big": lambda: spark.range(10)})
    ranked = catalog.ranked_sizes(sizes).collect()
    assert [(r.table_name, r.rows) for r in ranked] == [("big", 10), ("small", 3), ("broken", None)]
    assert ranked[2].error.startswith("no access") and len(ranked[2].error) == 310 and ranked[0].error is None
    assert tuple(catalog.size_totals(sizes).first()) == (3, 13, 1)
    assert [r.table_name for r in catalog.ranked_sizes(sizes, top=1).collect()] == ["big"]


def test_one_scan_counts_files_and_folders(spark):
    root = files.scratch(spark, "tables")
    spark.range(10).repartition(3).write.parquet(f"{root}/many-files")
    spark.range(4).selectExpr("id", "id % 2 AS p").write.partitionBy("p").parquet(f"{root}/split$")
    spark.range(0).write.parquet(f"{root}/empty")
    got = {r.table_name: r.rows for r in catalog.parquet_row_counts(spark, root).collect()}
    assert got == {"many-files": 10, "split$": 4, "empty": 0}


def test_odd_names_and_broken_tables_are_no_zeros(spark):
    root = files.scratch(spark, "tables")
    for name in ("a b", "p%q", "_x", "plus+", "ü#", "plain.parquet"):
        spark.range(7).write.parquet(f"{root}/{name}")
    spark.range(0).write.parquet(f"{root}/none")
    spark.createDataFrame([("PAR1 no footer",)], "v string").coalesce(1).write.text(f"{root}/broken")
    got = {r.table_name: (r.rows, r.error is not None) for r in catalog.parquet_row_counts(spark, root).collect()}
    seven = dict.fromkeys(("a b", "p%q", "_x", "plus+", "ü#", "plain"), (7, False))
    assert got == {**seven, "none": (0, False), "broken": (None, True)}
    assert tuple(catalog.size_totals(catalog.parquet_row_counts(spark, root)).first()) == (8, 42, 1)


def test_declared_lengths(spark):
    path = files.scratch(spark, "declared")
    spark.sql(f"CREATE TABLE declared_lengths (k BIGINT, a VARCHAR(25), b CHAR(3), c STRING, d DECIMAL(10,2)) USING parquet LOCATION '{path}'")
    try:
        spark.sql("INSERT INTO declared_lengths VALUES (1, 'x', 'y', 'z', 1.5)")
        found = catalog.columns(spark, {"t": catalog_table(spark, "declared_lengths"), "plain": spark.range(1)})
        got = {(r.table_name, r.name): (r.type, r.size, r.nullable) for r in found.collect()}
    finally:
        spark.sql("DROP TABLE declared_lengths")
    assert got == {
        ("t", "k"): ("bigint", None, True), ("t", "a"): ("varchar(25)", 25, True), ("t", "b"): ("char(3)", 3, True), ("t", "c"): ("string", None, True),
        ("t", "d"): ("decimal(10,2)", None, True), ("plain", "id"): ("bigint", None, False),
    }


def test_files_are_counted_by_tasks(spark, monkeypatch):
    """No list of files comes to the driver's Python, however many there are."""
    root = files.scratch(spark, "tables")
    spark.range(64).repartition(64).write.parquet(f"{root}/many")
    monkeypatch.setattr(type(spark.range(1)), "inputFiles", None)
    assert [tuple(r)[:2] for r in catalog.parquet_row_counts(spark, root).collect()] == [("many", 64)]


def test_schemas_need_no_job_and_keep_errors(spark, sf_dir):
    tables = {"orders": lambda: spark.read.parquet(f"{sf_dir}/orders.parquet"), "missing": lambda: spark.read.parquet(f"{sf_dir}/none.parquet")}
    found, errors = catalog.discover(spark, tables)
    assert "Scan" not in found._jdf.queryExecution().executedPlan().toString().replace("LocalTableScan", "").replace("Scan ExistingRDD", "")
    assert {r.table_name for r in found.collect()} == {"orders"}
    assert [r.table_name for r in errors.collect()] == ["missing"]
    assert catalog.summary(catalog.classify(found), errors).first().errors == 1
    with pytest.raises(ValueError, match="missing"):
        catalog.columns(spark, tables)


STATE = "source_table string, watermark_field string, watermark_type string, watermark_value string, published boolean"
RULES = policy.Policy(
    skip=("Photos",),
    incremental={"Scans": {"field": "day", "pk": "id"}, "Logs": {"field": "id"}, "Moved": {"field": "b"}, "Photos": {"field": "id"}, "Lgos": {"field": "id"}},
)


def modes(spark, **kwargs):
    listing = spark.createDataFrame([(t,) for t in ("Scans", "Logs", "Moved", "Photos", "Rest", "Old")], "table_name string")
    state = spark.createDataFrame([("Scans", "day", "datetime", "2026", True), ("Moved", "a", "int", "7", True), ("Rest", "x", "int", "1", True), ("Logs", None, "int", "4", False)], STATE)
    return listing, policy.modes(listing, policy.policy_frame(spark, RULES), state, **kwargs)


def test_modes(spark):
    listing, plan = modes(spark, exclude=["Old"])
    got = {r.table_name: (r.mode, r.field, r.pk, r.watermark_value) for r in plan.collect()}
    assert got == {
        "Scans": ("incremental", "day", "id", "2026"),
        "Logs": ("incremental-initial", "id", None, None),
        "Moved": ("incremental-initial", "b", None, None),  # the mark is of another field
        "Rest": ("full", None, None, None),
    }
    unknown = policy.unknown_tables(listing, policy.policy_frame(spark, RULES)).collect()
    assert [r.table_name for r in unknown] == ["Lgos"]


def test_full_refresh_ignores_the_incremental_policy(spark):
    _, plan = modes(spark, full_refresh=True)
    assert {r.mode for r in plan.collect()} == {"full"}
    assert plan.count() == 5


def test_resume(spark):
    _, plan = modes(spark)
    assert [r.table_name for r in policy.resume(plan, 3).collect()] == ["Rest", "Scans"]
    assert policy.resume(plan).count() == 5
    with pytest.raises(ValueError):
        policy.resume(plan, 5)


def test_policy_files(spark):
    root = files.scratch(spark, "policy")

    def written(name, text):
        files._fs(spark, root).mkdirs(files._path(spark, root))
        assert files.create_once(spark, f"{root}/{name}", text)
        return policy.load_policy(spark, f"{root}/{name}")

    assert policy.load_policy(spark, None) == policy.load_policy(spark, f"{root}/none.yaml") == policy.Policy()
    assert written("empty.yaml", "") == policy.Policy()
    assert written("blank.yaml", "skip:\nincremental:\n") == policy.Policy()
    same = written("p.json", json.dumps({"skip": ["A"], "incremental": {"B": {"field": "f", "pk": "k"}}}))
    assert same == policy.Policy(("A",), {"B": {"field": "f", "pk": "k"}})
    assert written("p.yaml", "skip:\n  - A\nincremental:\n  B:\n    field: f\n    pk: k\n") == same


def test_summary_of_a_stopped_run(spark):
    rows = [("a", "full", 3, 10, 0.1, 0.1, 0.2, True, None, None), ("b", "full", 0, None, 0.1, 0.0, 0.5, False, None, "x")]
    made = spark.createDataFrame(rows, report.REPORT_SCHEMA)
    assert tuple(report.run_summary(made, total_tables=7, start_index=2).first()) == (1, 1, "b", 3, 0.5, 4, 7)
    path = files.scratch(spark, "report")
    report.write_csv(made, path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["table", "mode", "rows", "bytes", "fetch_sec", "insert_sec", "duration_sec", "ok", "watermark", "error"]
    assert back.count() == 2


def test_columns_are_dealt_out_before_they_are_sorted(spark, root):
    columns(spark).coalesce(1).write.parquet(root)  # one file, which one task reads
    plan = catalog.classify(spark.read.parquet(root))._jdf.queryExecution().executedPlan().toString().splitlines()
    sorts, exchanges = ([i for i, line in enumerate(plan) if word in line] for word in ("Sort [", "Exchange hashpartitioning"))
    # further down is earlier; the minima of wide tables still combine before their second exchange
    assert len(exchanges) == 2 and exchanges[0] < max(sorts) < exchanges[1]


def test_best_columns_of_wide_and_repeated_tables(spark):
    names = {2: "other_id", 2500: "ID", 2700: "id", 1024: "modified", 1023: "updated_at", 3999: "status"}
    wide = [("wide", i, names.get(i, f"c{i}x"), "Date", None, True) for i in range(1, 4001)]
    twice = [("t", 1, n, "int", None, True) for n in ("b_id", "a_id")] * 2
    odd = [(None, None, "id", "int", None, True), (None, 1, "code", "int", None, True)]
    found = spark.createDataFrame([*wide, *twice, *odd], catalog.COLUMNS_SCHEMA)
    assert sorted(map(tuple, catalog.classify(found).collect()), key=str) == sorted([
        ("wide", "ID", "modified", "status", 4000, "incremental"),
        ("t", "a_id", None, None, 4, "full_refresh"),
        (None, "id", None, None, 2, "full_refresh"),
    ], key=str)


def test_a_large_catalog_is_not_one_tasks(spark, root):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        report.write_catalog(spark.range(1000).selectExpr("concat('t', id) AS table_name", "string(NULL) AS pk"), root)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    written = sorted((n for n, _ in files.children(spark, root) if n.startswith("part-")))
    assert len(written) > 1
    lines = [json.loads(r.value) for n in written for r in spark.read.text(f"{root}/{n}").collect()]
    assert [x["table_name"] for x in lines] == sorted(f"t{i}" for i in range(1000)) and lines[0]["pk"] is None

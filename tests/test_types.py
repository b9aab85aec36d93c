"""Type inference."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import infer

CASES = [
    # values, widest type, kind
    (["null", "null"], "LONGTEXT", "null"),
    (["true", "false"], "TINYINT(1)", "bool"),
    (["1", "2"], "BIGINT", "int"),
    (["3000000000"], "BIGINT", "int"),
    (["1", "2.5"], "DOUBLE", "float"),
    (["1.0", "2.0"], "BIGINT", "int"),
    (["true", "1"], "BIGINT", "int"),
    (["1", '"x"'], "MEDIUMTEXT", "str"),
    (["null"] * 50 + ['"late"'], "MEDIUMTEXT", "str"),
    (['{"a": 1}', "1"], "MEDIUMTEXT", "str"),
]


@pytest.mark.parametrize("values,target,kind", CASES)
def test_widest_of_json(spark, values, target, kind):
    rows = spark.createDataFrame([(f'{{"c": {v}}}',) for v in values], "j string").select(F.parse_json("j").alias("v"))
    got = infer.widest_json(rows, "v").collect()
    assert [(r["name"], r["kind"], r["type"]) for r in got] == [("c", kind, target)]
    single = rows.select(F.variant_get("v", "$.c", "variant").alias("c"))
    assert infer.widest(single).first()["type"] == target


def test_huge_whole_number_stays_double(spark):
    df = spark.createDataFrame([(1e30,)], "x double")
    assert infer.widest(df).first()["type"] == "DOUBLE"
    rows = spark.sql("""SELECT parse_json('{"x": 1e30}') AS v""")
    assert infer.widest_json(rows, "v").first()["type"] == "DOUBLE"


def test_widest_of_columns(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (true, 1, 1.0D, 2.5D, 'x', DATE'2026-01-01', CAST(NULL AS INT), 3.00BD, INTERVAL '1.5' SECOND), "
        "(NULL, NULL, 2.0D, 1.0D, NULL, NULL, NULL, 4.00BD, NULL) AS t(b, i, w, f, s, d, n, m, v)"
    )
    got = {r["name"]: r["type"] for r in infer.widest(df).collect()}
    assert got == {
        "b": "TINYINT(1)", "i": "BIGINT", "w": "BIGINT", "f": "DOUBLE", "s": "MEDIUMTEXT", "d": "MEDIUMTEXT", "n": "LONGTEXT",
        "m": "BIGINT", "v": "DOUBLE",
    }
    assert {r["type"] for r in infer.widest(df, "sqlite").collect()} == {"TEXT"}
    assert infer.spark_schema(infer.widest(df, "spark")).simpleString() == (
        "struct<b:boolean,i:bigint,w:bigint,f:double,s:string,d:string,n:string,m:bigint,v:double>"
    )


def test_empty_table_is_all_null(spark):
    got = infer.widest(spark.createDataFrame([], "a int, b string")).collect()
    assert [r["kind"] for r in got] == ["null", "null"]


def test_first_row_decides_alone(spark):
    df = spark.createDataFrame(
        [(2, 5, 3000000000, "x" * 300, 1.5, None, "s"), (1, 2147483647, 2147483648, "short", 1.0, "late", "x" * 256)],
        "k int, a int, b bigint, c string, d double, e string, f string",
    )
    got = {r["name"]: r["type"] for r in infer.first_row(df, "k").collect()}
    assert got == {
        "k": "INTEGER", "a": "INTEGER", "b": "BIGINT", "c": "VARCHAR(255)", "d": "DOUBLE PRECISION", "e": "VARCHAR(255)", "f": "TEXT",
    }
    nulls = spark.createDataFrame([(1, None, True)], "k int, x int, y boolean")
    assert [r["type"] for r in infer.first_row(nulls, "k").collect()] == ["INTEGER", "TEXT", "BOOLEAN"]


def test_text_key_is_short(spark):
    df = spark.createDataFrame([("k", 1)], "`a-id` string, n int")
    types = infer.widest(df, keys=["a-id"])
    assert types.first()["type"] == "VARCHAR(255)"
    assert infer.ddl(df, types, keys=["a-id"]) == "`a_id` VARCHAR(255), `n` BIGINT, PRIMARY KEY (`a_id`)"
    with pytest.raises(ValueError, match="missing"):
        infer.widest(df, keys=["missing"])

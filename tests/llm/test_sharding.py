import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import workload
from tidemark.llm.sharding import byte_size, shard, write_shards


def brute(sizes, n):
    """Shard of each size, in order, by exact whole numbers."""
    total, at, out = sum(sizes), 0, []
    for s in sizes:
        out.append(min(n - 1, (2 * at + s) * n // (2 * total)) if total else 0)
        at += s
    return out


def check(df, n):
    got = shard(df, byte_size(F.col("text")), [F.col("doc_id")], n).collect()
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    got.sort(key=lambda r: (r.shard, r.slot))
    assert [r["size"] for r in got] == [len((r.text or "").encode()) + 16 for r in got]
    assert [r.shard for r in got] == brute([r["size"] for r in got], n)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    return got


def test_against_brute_force(odd_documents):
    for n in (1, 3, 40):
        assert len(check(odd_documents, n)) == 18


def test_one_key_with_most_rows(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("text").alias("text"))
    got = check(df.repartition(5), 10)
    assert {sum(r.shard == s for r in got) for s in range(10)} == {300}


def test_no_sizes_and_no_rows(spark, no_documents):
    assert {r.shard for r in shard(spark.range(5), F.lit(None), [F.col("id")], 4).collect()} == {0}
    assert shard(no_documents, byte_size(F.col("text")), [F.col("doc_id")]).collect() == []
    with pytest.raises(ValueError):
        shard(no_documents, F.lit(1), [F.col("doc_id")], 0)


def test_query_over_the_given_table(spark, sf_dir):
    got = workload.op8_sharding(spark, sf_dir).collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(got) == len(docs)
    assert all(r.text_crc32 == zlib.crc32(docs[r.doc_id].encode()) and r["size"] == len(docs[r.doc_id].encode()) + 16 for r in got)
    bytes_of = [sum(r["size"] for r in got if r.shard == s) for s in range(40)]
    assert max(bytes_of) - sum(bytes_of) / 40 <= max(r["size"] for r in got)


def test_written_shards_hold_their_rows(spark, odd_documents, root):
    placed = shard(odd_documents, byte_size(F.col("text")), [F.col("doc_id")], 4)
    write_shards(placed, root)
    assert spark.read.parquet(root).count() == odd_documents.count()

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from brute import normal
from tidemark.llm.exact_dedup import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[normal(text)].append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[normal(text)]
        known = [i for i in ids if i is not None]
        out.append((doc_id, min(known, default=None), len(ids), hashlib.sha256(normal(text).encode()).hexdigest()))
    return sorted(out, key=str)


def check(df, **how):
    made = exact_dedup(df, **how)
    got = made.collect()
    expected = brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == expected
    kept = [r for r in got if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted({e[3] for e in expected})
    assert all(r.doc_id == r.keep_id for r in kept)
    return made


def test_against_brute_force(odd_documents):
    made = check(odd_documents)
    assert set(made.columns) == {"doc_id", "text", "extra", "row", "at", "name", "shard", "keep_id", "group_size", "kept", "text_sha256"}
    assert made.where("doc_id = 0").first()["row"] == "x"


def test_small_blocks_need_many_levels(odd_documents):
    check(odd_documents, block_bytes=7)


def test_hashes_that_collide_do_not_merge_texts(odd_documents):
    check(odd_documents, block_bytes=5000, hashed=lambda b: F.pmod(F.xxhash64(b), F.lit(2)))
    check(odd_documents.where("doc_id < 5 or doc_id > 7"), block_bytes=2, hashed=lambda b: F.lit(1).cast("long"))


def test_same_pieces_in_another_order(spark):
    df = spark.createDataFrame([(1, "aabb"), (2, "bbaa"), (3, "aabbaa"), (4, "aabb"), (5, "aa"), (6, "aabba")], "doc_id long, text string")
    check(df, block_bytes=2)


def test_empty_table(no_documents):
    assert exact_dedup(no_documents).collect() == []

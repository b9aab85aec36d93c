import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import brute_components, plain
from tidemark.llm import simhash, workload
from tidemark.llm.components import components


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def near_copies(n, seed, spread):
    """Fingerprints in clusters, chains and alone."""
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(n)}
    for centre in list(out)[: n // 8]:
        v = centre
        for _ in range(spread):
            for b in rng.sample(range(64), rng.randint(1, 4)):
                v ^= 1 << b
            out.add(v)
    return sorted(out)


@pytest.mark.parametrize(("bits", "most"), [(3, 4096), (3, 3), (0, 4096), (1, 2), (6, 4)])
def test_links_have_the_components_of_all_pairs(spark, bits, most):
    values = near_copies(200, bits, 6) + [0]
    fps = spark.createDataFrame([(signed(v),) for v in sorted(set(values))], "fp long").repartition(3)
    links = simhash.links(fps, bits, most)
    assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= bits for r in links.collect())
    got = {r.node: r.root for r in components(links).collect()}
    expected = brute_components(sorted(set(values)), bits)
    groups = {}
    for v, r in expected.items():
        groups.setdefault(r, set()).add(signed(v))
    for members in groups.values():
        roots = {got.get(m, m) for m in members}
        assert roots == {min(members)}


def test_a_dense_group_beyond_one_comparison(spark):
    values = [signed(0x0123456789ABCDEF ^ (1 << a) ^ (1 << b)) for a in range(64) for b in range(a)]
    fps = spark.createDataFrame([(v,) for v in values], "fp long").repartition(4)
    links = simhash.links(fps, 3, 16)
    roots = components(links)
    assert roots.select("root").distinct().count() == 1
    assert roots.count() == len(values)


def test_fingerprints(odd_documents):
    rows = odd_documents.select("doc_id", "text", simhash.fingerprints(F.col("text")).alias("fp")).collect()
    assert [r.fp for r in rows] == [signed(plain(r.text)) for r in rows]


def test_groups_over_odd_rows(odd_documents, no_documents):
    got = simhash.simhash_groups(odd_documents).collect()
    assert "keep_id" in got[0].asDict() and len(got) == odd_documents.count()
    prints = {int(r.fingerprint, 16) for r in got}
    roots = brute_components(sorted(prints), 3)
    for r in got:
        ids = [x.doc_id for x in got if roots[int(x.fingerprint, 16)] == roots[int(r.fingerprint, 16)]]
        assert r.component_id == min((i for i in ids if i is not None), default=None)
    assert sum(r.kept for r in got) == len(set(roots.values()))
    assert simhash.simhash_groups(no_documents).collect() == []


def test_query_against_brute_force(spark, sf_dir):
    got = workload.op10_simhash(spark, sf_dir).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == {i: plain(t) for i, t in docs.items()}
    roots = brute_components(sorted({int(r.fingerprint, 16) for r in got}), 3)
    least = {}
    for r in got:
        root = roots[int(r.fingerprint, 16)]
        least[root] = min(least.get(root, r.doc_id), r.doc_id)
    assert all(r.component_id == least[roots[int(r.fingerprint, 16)]] for r in got)


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(500)] + [(1000, 1001), (1001, 1001)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {i: 0 for i in range(501)} | {1000: 1000, 1001: 1000}


def test_segments_cover_all_bits():
    for bits in range(0, 9):
        parts = simhash._segments(64, 0, bits)
        assert sum(d + 1 for _, _, d in parts) == bits + 1 or bits == 0
        assert all(d <= 1 for _, _, d in parts)
    assert np.bitwise_count(np.uint64(7)) == 3

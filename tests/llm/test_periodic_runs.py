from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import periodic_runs as pr
from tidemark.llm import workload


def brute_runs(words, least_length=6, least_exponent=4):
    """All maximal stretches of every period, the smallest period of each."""
    found, numbers = {}, {}
    w = np.array([numbers.setdefault(x, len(numbers)) for x in words])
    for q in range(1, len(words) // least_exponent + 1):
        same = np.concatenate([[0], w[q:] == w[:-q], [0]])
        for i, j in zip(np.flatnonzero(np.diff(same) == 1).tolist(), np.flatnonzero(np.diff(same) == -1).tolist()):
            if j - i + q >= max(least_length, least_exponent * q):
                found.setdefault((i, j - i + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(key, text):
    words = split(text)
    h = zlib.crc32(str(key).encode())
    n, g = len(words), h // 10
    if key is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(key, text):
    words = planted(key, text)
    runs = brute_runs(words)
    best = (None, None, None, None)
    if runs:
        s, n, q = max(runs, key=lambda r: (r[1] * 10**12 // r[2], -r[0], -r[2]))
        best = (s, n, q, 1000 * n // q)

    def sha(t):
        return hashlib.sha256(t.encode()).hexdigest()

    return key, len(runs), *best, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(brute_collapsed(words, runs)))


def together(texts, **how):
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    flat = np.array([w for t in texts for w in t], dtype=np.int64)
    of, *found = pr.find_runs(flat, sizes, **how)
    out = [[] for _ in texts]
    for t, *run in zip(of.tolist(), *(x.tolist() for x in found)):
        out[t].append(tuple(run))
    return out


small = st.lists(st.integers(0, 2), max_size=60)
powers = st.tuples(st.lists(st.integers(0, 3), max_size=6), st.lists(st.integers(0, 2), min_size=1, max_size=5), st.integers(1, 12), st.lists(st.integers(0, 3), max_size=6)).map(lambda t: t[0] + t[1] * t[2] + t[3])


@settings(max_examples=300, deadline=None)
@given(st.lists(small | powers, max_size=6), st.sampled_from([(6, 4), (2, 2), (4, 2), (6, 3)]))
def test_all_runs_of_texts_side_by_side(texts, least):
    how = {"least_length": least[0], "least_exponent": least[1]}
    assert together(texts, **how) == [brute_runs(t, *least) for t in texts]


def test_fibonacci_words_and_long_powers():
    a, b = [0], [0, 1]
    for _ in range(10):
        a, b = b, b + a
    assert together([b], least_length=2, least_exponent=2) == [brute_runs(b, 2, 2)]
    assert together([[7] * 5000, [1, 2] * 3000, list(range(4000))]) == [[(0, 5000, 1)], [(0, 6000, 2)], []]


def test_few_lookups_on_a_long_power():
    """Depths beyond a quarter of a text are not looked up, and rotations are not made one by one."""
    n = 200_000
    assert together([[0] * n]) == [[(0, n, 1)]]


def test_lookups_in_pieces(monkeypatch):
    monkeypatch.setattr(pr, "CHECKED", 7)
    rng = random.Random(5)
    texts = [[rng.randrange(2) for _ in range(200)] for _ in range(5)]
    assert together(texts, least_length=2, least_exponent=2) == [brute_runs(t, 2, 2) for t in texts]


def test_smallest_period_and_dropped_words(spark):
    rows = [(1, "x " + "ab cd " * 5 + "ab y", 0), (2, "a a a a a", 0), (3, "a a a a a a b", 1), (4, None, 2), (5, "", 3), (5, "one two", 4), (None, "z\tz\nz\x0bz\x0cz\rz", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    made = {(r["doc_id"], r["collapsed"]): [tuple(x) for x in r["runs"]] for r in pr.periodic_runs(df).collect()}
    assert made == {
        (1, "x ab cd y"): [(1, 11, 2)], (2, "a a a a a"): [], (3, "a b"): [(0, 6, 1)], (4, ""): [], (5, ""): [], (5, "one two"): [], (None, "z"): [(0, 6, 1)],
    }


def test_odd_rows(spark, odd_documents, no_documents):
    found = pr.digest(pr.periodic_runs(odd_documents))
    want = []
    for r in odd_documents.select("doc_id", "text").collect():
        words = split(r["text"])
        runs = brute_runs(words)
        want.append((r["doc_id"], len(runs), hashlib.sha256(" ".join(brute_collapsed(words, runs)).encode()).hexdigest()))
    assert Counter((r["doc_id"], r["n_runs"], r["collapsed_sha256"]) for r in found.collect()) == Counter(want)
    assert pr.digest(pr.periodic_runs(no_documents)).isEmpty()


def test_the_greatest_run(spark):
    runs = [[(0, 9, 2), (3, 18, 4), (30, 9, 2)], [], [(5, 8, 2), (1, 12, 3), (1, 4, 1)], None]
    df = spark.createDataFrame([(r,) for r in runs], f"runs {pr.RUNS}")
    made = [r[0] and tuple(r[0]) for r in df.select(pr.greatest(df["runs"])).collect()]
    assert made == [(0, 9, 2), None, (5, 8, 2), None]


def test_query_against_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    made = workload.op12_periodic_runs(spark, sf_dir)
    assert made.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, made.collect())) == sorted(expected(*d) for d in docs)


@pytest.mark.parametrize("key", [0, 1, 7, 123456, -5])
def test_planting(spark, key):
    texts = ["", " ", "a", "a b c d e f g h i j k l m n o p", "a\tb\nc " * 40]
    for text in texts:
        df = spark.createDataFrame([(key, text)], "doc_id long, text string")
        assert split(pr.with_planted_runs(df).first()["text"]) == planted(key, text)

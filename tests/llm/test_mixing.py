import numpy as np
import pytest
from tidemark.llm import mixing, workload


def dense(tokens, p, targets, least, steps=40_000):
    """The smallest residual, by accelerated projected gradient over a matrix."""
    a = np.array(p).T * np.array(tokens, float) / sum(tokens)
    goal = np.array(targets) / sum(tokens)
    size = np.linalg.norm(a @ a.T, 2)
    r = y = np.full(len(tokens), max(1.0, least))
    momentum = 1.0
    for _ in range(steps):
        new = np.maximum(y - a.T @ (a @ y - goal) / size, least)
        later = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        y = new + (momentum - 1) / later * (new - r)
        r, momentum = new, later
    return r


def test_targets_are_met(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    made = workload.op6_mixing(spark, sf_dir).collect()
    p = np.array([r.posterior for r in made])
    tokens = np.array([r.tokens for r in made])
    rates = np.array([r.rate for r in made])
    assert len(made) == docs.count() and (rates >= 0).all()
    assert np.allclose(p.sum(axis=1), 1)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.tokens == len((texts[r.doc_id] or "").encode().split()) for r in made)
    totals = (rates * tokens) @ p
    share = np.array([workload.MIXTURE[d] for d in sorted(workload.MIXTURE)])
    assert np.allclose(totals / tokens.sum(), share, atol=1e-5)
    assert {r.copies for r in made} <= {int(np.floor(x)) + d for x in rates for d in (0, 1)}


def test_posteriors_tell_the_language(spark):
    sf = "/root/testdata/sf0.01"
    made = {r.doc_id: int(np.argmax(r.posterior)) for r in workload.op6_mixing(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()}
    rows = [r for r in docs.collect() if r.doc_id not in labels]
    right = sum(sorted(workload.MIXTURE)[made[r.doc_id]] == r.lang for r in rows)
    assert right / len(rows) > 0.9


@pytest.mark.parametrize(("targets", "least", "spread"), [([40, 30, 30], 0.0, 0.4), ([95, 3, 2], 0.0, 0.05), ([1, 0, 99], 0.0, 3), ([150, 200, 100], 1.0, 0.4)])
def test_fit_against_a_dense_solution(spark, targets, least, spread):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([spread] * 3, 60)
    tokens = rng.integers(0, 400, 60)
    goal = np.array(targets) / 100 * tokens.sum()
    df = spark.createDataFrame([(int(t), [float(x) for x in q]) for t, q in zip(tokens, p)], "tokens long, p array<double>")
    fitted = mixing.fit(df, goal, least).collect()
    p, tokens = np.array([r.p for r in fitted]), np.array([r.tokens for r in fitted])
    got = np.array([r.rate for r in fitted])
    want = dense(tokens, p, goal, least)
    reach = lambda r: np.abs((r * tokens) @ p - goal).max() / tokens.sum()
    assert (got >= least).all()
    assert reach(got) <= reach(want) + 1e-3


def test_odd_rows(spark, odd_documents, no_documents):
    labelled = spark.createDataFrame([(0, "a"), (0, "b"), (11, "b"), (None, "a"), (5, "c"), (5, None)], "key long, domain string")
    got = mixing.mix(odd_documents, labelled, {"a": 1.0, "b": 3.0})
    assert got.count() == odd_documents.count()
    assert got.where("rate is null or copies is null or tokens is null").count() == 0
    assert {r.tokens for r in got.where("text is null or text = ''").collect()} == {0}
    assert "x" in {r["row"] for r in got.collect()}
    assert mixing.mix(no_documents, labelled, {"a": 1.0}).collect() == []
    assert mixing.mix(odd_documents, labelled.limit(0), {"a": 1.0, "b": 1.0}).count() == odd_documents.count()
    for bad in ({}, {"a": -1.0}, {"a": 0.0}):
        with pytest.raises(ValueError):
            mixing.mix(odd_documents, labelled, bad)


def test_main_path_is_native(spark, sf_dir):
    plan = workload.op6_mixing(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))

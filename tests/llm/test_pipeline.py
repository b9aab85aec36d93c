import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from brute import brute_components, normal, plain
from tidemark.llm import toxicity


def test_every_stage_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "simhash near-dedup", "mixing sources to target weights", "best-fit packing"]
    stages = dict(corpus_pipeline.STAGES)

    clean = stages["toxicity"](spark, docs, sf_dir)
    assert clean.columns == docs.columns
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = {r.doc_id: r.predicted for r in toxicity.score_documents(docs, labels).collect()}
    kept = {r.doc_id for r in clean.collect()}
    assert kept == {i for i, p in scored.items() if not p}

    once = stages["exact dedup"](spark, clean, sf_dir)
    least = {}
    for i in sorted(kept):
        least.setdefault(normal(texts[i]), i)
    ids = [r.doc_id for r in once.collect()]
    assert once.columns == docs.columns and sorted(ids) == sorted(least.values())

    near = stages["simhash near-dedup"](spark, once, sf_dir)
    prints = {i: plain(texts[i]) for i in ids}
    roots = brute_components(sorted(set(prints.values())), 3)
    least = {}
    for i in sorted(ids):
        least.setdefault(roots[prints[i]], i)
    ids = [r.doc_id for r in near.collect()]
    assert near.columns == docs.columns and sorted(ids) == sorted(least.values())

    mixed = stages["mixing sources to target weights"](spark, near, sf_dir)
    copies = [r.doc_id for r in mixed.collect()]
    assert mixed.columns == docs.columns and set(copies) == set(ids)
    assert len(ids) <= len(copies) < 3 * len(ids)

    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = stages["best-fit packing"](spark, mixed, sf_dir).collect()
    for i in set(copies):
        own = sorted((r.piece, r.start, r.length) for r in pieces if r.doc_id == i)
        n = len(slow.encode(texts[i] or "", add_special_tokens=False).ids) + 1
        assert sum(length for _, _, length in own) == n * copies.count(i)


def test_run(spark, sf_dir):
    made = corpus_pipeline.run(spark, sf_dir)
    rows = made.collect()
    used = {}
    for r in rows:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in used.values():
        parts.sort()
        assert [a for a, _ in parts] == [int(x) for x in np.cumsum([0, *[n for _, n in parts][:-1]])]
        assert parts[-1][0] + parts[-1][1] <= 1024


def test_nothing_and_odd_rows(spark, root, no_documents):
    kind = "doc_id long, text string, lang string, source string, n_chars long, shard int"
    rows = [(1, None, None, None, None, 1), (None, "some words here", "en", "s", 3, 1), (2, "", "en", "s", 0, 1), (2, "some words here", "xx", "s", 0, 1), (3, "other words again " * 4000, "de", "s", 0, 1)]
    for name, found, kept in (("none", [], set()), ("odd", rows, {1, 2, 3})):
        spark.createDataFrame(found, kind).write.parquet(f"{root}/{name}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/{name}/labels.parquet")
        assert {r.doc_id for r in corpus_pipeline.run(spark, f"{root}/{name}").collect()} == kept

from __future__ import annotations

import re
from collections import Counter
from itertools import permutations
from math import factorial

import pytest
from pyspark.sql import functions as F

from tidemark.llm import filter_audit as fa


def brute(docs, labels):
    """All orders document by document."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    rows = []
    for i, text, part in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = set()
        if len(words) < 100:
            fails.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text):
            fails.add("C")
        if re.search("[#$%&*|]", text):
            fails.add("D")
        if i is not None and least[text] < i:
            fails.add("E")
        rows.append((part or "", fails, i in good, i in toxic))
    out, shapley = {}, Counter()
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                removed = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                failing = sum(f in r[1] for r in mine)
                shapley[part, f] += len(removed)
                out[part, "".join(order), step] = [
                    len(left), len(removed), failing - len(removed), sum(r[1] == {f} for r in mine), sum(r[2] for r in removed), sum(r[3] for r in removed),
                ]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(made):
    return {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["toxic_lost"], r["shapley"]) for r in made.collect()}


@pytest.fixture(scope="module")
def some():
    many = " ".join(f"w{i}" for i in range(120))
    docs = [
        (1, many, "en"), (2, many, "en"), (3, many, "de"), (2, many, "en"), (4, "SHORT & LOUD", "en"), (5, "SHORT & LOUD", None), (6, None, ""), (7, "", None),
        (8, "", "de"), (9, "a " * 300, "en"), (10, "a " * 300, "de"), (11, many + " $", "de"), (12, many.upper(), "en"), (None, many, "en"), (None, many, None),
        (13, "\x0b\x0c\t", "en"), (14, "\x85\xa0 é Ünï", "fr"), (15, many + "!", "fr"), (15, many + "!", "fr"),
    ]
    labels = [(1, 1, 0), (2, 1, 1), (4, 0, 1), (4, 1, 0), (5, None, 1), (9, 1, None), (None, 1, 1), (99, 1, 1), (10, 0, 1)]
    return docs, labels


def test_paths_count_all_orders():
    for k in range(1, 7):
        reach, leave = fa.path_counts(k)
        assert reach[-1] == leave[0] == factorial(k)
        for n in range(k + 1):
            layer = [s for s in range(1 << k) if s.bit_count() == n]
            assert sum(reach[s] * leave[s] for s in layer) == factorial(k)
        assert len(fa.edges(k)) == k << k - 1
        # every order uses k edges
        assert sum(w for *_, w in fa.edges(k)) == k * factorial(k)


def test_equals_every_order_document_by_document(spark, some):
    docs, labels = some
    df = spark.createDataFrame([(i, t, p, "x", 1, True) for i, t, p in docs], "doc_id long, text string, lang string, part string, n int, mask boolean").repartition(3)
    made = fa.quality_audit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert found(made) == brute(docs, labels)


def test_given_documents(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    expected = brute([tuple(r) for r in docs.select("doc_id", "text", "lang").collect()], [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    assert found(fa.quality_audit(docs, labels)) == expected


def test_nothing_in_nothing_out(spark, no_documents):
    empty = no_documents.withColumn("lang", F.lit("en"))
    assert fa.quality_audit(empty, spark.createDataFrame([], "doc_id long, quality int, toxic int")).isEmpty()


def test_shares_add_up(spark, some):
    """In every order all steps together remove what fails anything, so shares sum to k! times that."""
    docs, labels = some
    made = found(fa.quality_audit(spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))
    for part in {k[0] for k in made}:
        shares = [made[part, "ABCDE", s][-1] for s in range(1, 6)]
        removed = sum(made[part, "ABCDE", s][1] for s in range(1, 6))
        assert sum(shares) == 120 * removed


def test_any_filters(spark):
    classes = spark.createDataFrame([("p", 0b01, True, 3), ("p", 0b11, False, 2), ("p", 0, None, 5), ("q", 0b10, None, 1)], "part string, mask int, seen boolean, n long")
    made = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in fa.audit(classes, ["X", "Y"], ["seen"]).collect()}
    assert made["p", "XY", 1] == (5, 5, 0, 3, 3, 5 + 3)
    assert made["p", "XY", 2] == (5, 0, 2, 0, 0, 2)
    assert made["p", "YX", 1] == (8, 2, 0, 0, 0, 2)
    assert made["q", "YX", 1] == (0, 1, 0, 1, 0, 2)
    with pytest.raises(ValueError):
        fa.audit(classes, ["X", "X"])


def test_a_hot_text_is_counted_before_it_moves(spark):
    """Copies of one text meet as counts: the last exchanges see classes, not rows."""
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("the same text").alias("text"), F.lit("en").alias("lang"))
    made = found(fa.quality_audit(df, spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")))
    assert made["en", "EABCD", 1][:2] == (1, 19_999)
    assert made["en", "AEBCD", 1][4] == 1

import random
import re
from collections import Counter
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import line_dedup, workload


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def normal(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ")


def brute(rows, k, least):
    """(key, line) of every line with its class, its links and whether it stays."""
    lines = [(doc, n, normal(x)) for doc, text in rows for n, x in enumerate((text or "").split("\n"))]
    texts = sorted({x for _, _, x in lines})
    root = {x: x for x in texts}
    links = dict.fromkeys(texts, 0)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(texts):
        for b in texts[i + 1 :]:
            if min(len(a), len(b)) >= least and abs(len(a) - len(b)) <= k and distance(a, b) <= k:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    first = {}
    for doc, n, x in sorted(lines, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        first.setdefault(find(x), (doc, n))
    return sorted(((doc, n, *first[find(x)], links[x]) for doc, n, x in lines), key=str)


def varied(seed, n):
    rng = random.Random(seed)
    lines = ["".join(rng.choice("abcde ") for _ in range(rng.randint(8, 40))).strip() or "x" for _ in range(n)]
    for _ in range(n):
        x = list(rng.choice(lines))
        for _ in range(rng.randint(1, 4)):
            at = rng.randrange(len(x) + 1)
            if rng.random() < 0.5 and x:
                del x[min(at, len(x) - 1)]
            else:
                x.insert(at, rng.choice("abcdeé\U0001f600"))
        lines.append("".join(x))
    return lines


@settings(max_examples=400, deadline=None)
@given(st.text("ab", max_size=24), st.text("ab", max_size=24), st.integers(0, 5))
def test_within_is_the_edit_distance(a, b, k):
    assert line_dedup.within(a, b, k) == (distance(a, b) <= k)


def test_within_on_longer_lines():
    for x in (lines := varied(5, 60)):
        for y in lines:
            assert line_dedup.within(x, y, 3) == (distance(x, y) <= 3)


@pytest.mark.parametrize("k", [0, 1, 2, 3])
def test_lines_within_the_threshold_share_an_entry_and_sketch(k):
    def entries(x):
        return {(n * (k + 1) + i, x[p : p + s]) for n in range(max(4 * k, len(x) - k), len(x) + 1) for i, p, s in line_dedup.places(len(x), n, k)}

    lines = [x for x in varied(k, 80) if len(x) >= 4 * k + 1]
    for a in lines:
        for b in lines:
            if distance(a, b) <= k:
                assert entries(a) & entries(b)
                assert ((line_dedup.sketch(a) ^ line_dedup.sketch(b)) & (2**64 - 1)).bit_count() <= 2 * k


@pytest.mark.parametrize(("k", "least", "most"), [(2, 12, 4096), (2, 7, 3), (1, 5, 2), (2, 7, 2), (0, 1, 4096)])
def test_against_brute_force(spark, k, least, most):
    lines = varied(7 + k, 70)
    rng = random.Random(1)
    rows = [(i, "\n".join(rng.sample(lines, rng.randint(1, 6)))) for i in range(60)] + [(None, lines[0]), (70, None), (71, ""), (72, "\n\n"), (60, lines[1] + "\t\n " + lines[1])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lid int, line string").repartition(4)
    got = line_dedup.dedup_lines(df, threshold=k, least_chars=least, most_together=most).collect()
    assert sorted(((r.doc_id, r.line_no, r.class_key, r.class_line, r.links) for r in got), key=str) == brute(rows, k, least)
    kept = [r for r in got if r.kept]
    assert len({(r.class_key, r.class_line) for r in got}) == len(kept)
    assert all((r.doc_id, r.line_no) == (r.class_key, r.class_line) for r in kept)


def test_repeated_rows_and_no_rows(spark):
    df = spark.createDataFrame([(1, "the very same line"), (1, "the very same line"), (1, "the very same lime")], "doc_id long, text string")
    got = line_dedup.dedup_lines(df).collect()
    assert sum(r.kept for r in got) == 1 and {r.links for r in got} == {1}
    assert line_dedup.dedup_lines(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(df, threshold=4)


def test_one_line_in_most_documents_and_counters(spark):
    df = spark.range(220).select(F.col("id").alias("doc_id"), F.concat(F.lit("a line that everyone has\npage "), F.col("id"), F.lit(" of all the pages")).alias("text"))
    got = line_dedup.dedup_lines(df, most_together=30)
    assert got.where("kept").count() == 2
    # two digits may differ, or be added
    assert got.where("line_no = 1 and doc_id = 5").first().links == len([i for i in range(220) if i != 5 and distance("5", str(i)) <= 2])


@pytest.mark.parametrize("k", [1, 2])
def test_short_rests_share_an_entry(k):
    def entries(x):
        return {(n * (k + 1) + i, x[p : p + s]) for n in range(max(0, len(x) - k), len(x) + 1) for i, p, s in line_dedup.places(len(x), n, k)}

    texts = ["".join(x) for n in range(7) for x in product("ab", repeat=n)]
    entered = {x: entries(x) for x in texts}
    assert all(entered[a] & entered[b] for a in texts for b in texts if line_dedup.within(a, b, k))


def components_of(n, edges):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("made", ["order {:06d} was shipped to the customer", "{:03d} {:03d} was shipped to the customer {:03d}"])
def test_lines_of_one_template_meet_in_bounded_runs(spark, made, root):
    rng = random.Random(3)
    texts = sorted({made.format(*(rng.randrange(1000) for _ in range(3))) for _ in range(700)})
    lines = spark.createDataFrame(list(enumerate(texts)), "lid long, line string")
    # under the least of all keys no pair is left to another entry
    met = lines.select(F.lit(-(2**63)).alias("key"), "lid", F.udf(line_dedup.sketch, "long")("line").alias("sketch"))
    line_dedup._runs(met, lines, 2, 100).write.parquet(f"{root}/runs")
    runs = spark.read.parquet(f"{root}/runs")
    # a block's lines are chosen by a hash, so its size is not exact
    assert max(r["count"] for r in runs.groupBy("run").count().collect()) <= 300
    got = line_dedup._links_of_entries(met, lines, 2, 12, 100).collect()
    near = {(i, j) for i, a in enumerate(texts) for j, b in enumerate(texts[i + 1 :], i + 1) if line_dedup.within(a, b, 2)}
    forest, degree = {(r.a, r.b) for r in got if r.b >= 0}, Counter()
    for r in got:
        degree[r.a] += r.n
    assert forest <= near and components_of(len(texts), forest) == components_of(len(texts), near)
    assert +degree == Counter(x for pair in near for x in pair)


@pytest.mark.parametrize("n", [100, 250, 1000, 5000])
def test_a_group_of_near_copies_gives_a_forest_not_pairs(spark, n, root):
    """Lines that each differ from one line by a character: all pairs link, and no table holds them."""
    base = "the quick brown fox jumps over the lazy dog and then sleeps until the sun is high in the sky again"
    made = sorted({base[:i] + c + base[i + 1 :] for i in range(len(base)) for c in "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"})
    texts = random.Random(n).sample(made, n)
    spark.createDataFrame(list(enumerate(texts)), "lid long, line string").repartition(8).write.parquet(f"{root}/lines")
    links, degrees = line_dedup.edit_links(spark.read.parquet(f"{root}/lines"), 2, 12)
    forest = {(r.a, r.b) for r in links.collect()}
    # a forest for each entry that is the least some pair shares
    assert n - 1 <= links.count() < 3 * n
    assert set(components_of(n, forest)) == {0}
    assert {(r.lid, r.links) for r in degrees.collect()} == {(i, n - 1) for i in range(n)}


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 3), st.integers(2, 40))
def test_a_run_links_what_belongs_to_it(seed, k, n):
    """Forest and counts of a run against all pairs; pairs with a lesser key in common are left to that key's entry."""
    rng = random.Random(seed)
    lines = varied(seed, n)
    keys = [frozenset(rng.sample(range(200), rng.randint(0, 5))) for _ in lines]
    met = line_dedup._Lines(lines, k, keys)
    i, j = (x.astype("int64") for x in np.triu_indices(len(lines), 1))
    for at in range(0, len(i), 50):
        met.link(i[at : at + 50], j[at : at + 50])
    near = {(a, b) for a in range(len(lines)) for b in range(a + 1, len(lines)) if not keys[a] & keys[b] and distance(lines[a], lines[b]) <= k}
    assert set(met.edges) <= near and len(met.edges) < len(lines)
    assert components_of(len(lines), met.edges) == components_of(len(lines), near)
    assert met.degree.tolist() == [sum(x in pair for pair in near) for x in range(len(lines))]


def test_a_key_named_like_a_result(spark):
    df = spark.createDataFrame([(5, "some line or other", 1), (6, "some line or other", 1)], "line_no long, text string, kept int")
    got = line_dedup.dedup_lines(df, key="line_no")
    assert got.columns == ["key", "row_no", "line_no", "class_key", "class_line", "links", "kept"]
    assert sorted((r.key, r.line_no, r.class_key, r.kept) for r in got.collect()) == [(5, 0, 5, True), (6, 0, 5, False)]


def test_a_very_long_line(spark):
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefgh ") for _ in range(300_000)) + "z"
    df = spark.createDataFrame([(1, long), (2, long[:150_000] + "!" + long[150_000:]), (3, "!" + long[:-3]), (4, long[1:] + "aaa")], "doc_id long, text string")
    got = sorted((r.doc_id, r.class_key, r.links) for r in line_dedup.dedup_lines(df).collect())
    assert got == [(1, 1, 1), (2, 1, 1), (3, 3, 0), (4, 4, 0)]


def test_kept_texts(spark):
    df = spark.createDataFrame([(1, "first line here\nsecond line here"), (2, "first  line here.\nthird one is new"), (3, "second line hera")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.kept_texts(df).collect()}
    assert got == {1: "first line here\nsecond line here", 2: "third one is new", 3: ""}


def test_query_on_some_given_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").where("length(text) < 900").collect()][:60]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.dedup_lines(df).collect()
    assert sorted(((r.doc_id, r.line_no, r.class_key, r.class_line, r.links) for r in got), key=str) == brute(rows, 2, 12)
    assert set(workload.op1_line_dedup(spark, sf_dir).columns) == {"doc_id", "line_no", "class_key", "class_line", "links", "kept"}

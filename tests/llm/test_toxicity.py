import zlib
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import toxicity, workload
from tidemark.llm.toxicity import MARKS, Model
from tidemark.llm.transducers import Transducer, compose


def model():
    return Model({"vequ": 3.0}, {"idiot": ("i", 2.0), "kill": ("t", 2.5)}, (-1.0, *[1.0] * 2, *[2.0] * 2, -1.0, -1.0, 0.0, 0.0, 0.0))


@pytest.mark.parametrize(
    ("text", "mark"),
    [
        ("What an idiot.", "insult"),
        ("You idiot!", "aimed insult"),
        ("idiot, that is what you are", "aimed insult"),
        ("They will kill", "aimed threat"),
        ("kill it", "threat"),
        ("Nobody is not an idiot", "negated"),
        ("He said idiot", "reported"),
        ("« idiot »", "reported"),
        ("un vequment", "insult"),
        ('"hi" you idiot', "aimed insult"),
        ("she wrote code and you idiot broke it", "aimed insult"),
        ("no problem you idiot", "aimed insult"),
        ("he said you are an idiot", "reported"),
        ("he said, you idiot", "reported"),
        ("he wrote that the man, an idiot, left", "reported"),
        ('they know " the idiot', "aimed insult"),
        ('"hi" and "idiot" it is', "reported"),
        ('he said "no" and you idiot left', "aimed insult"),
        ("no, idiot", "insult"),
        ("you never kill", "negated"),
    ],
)
def test_marks_of_a_clause(text, mark):
    found = model().marks(text)
    assert [m for m, w in zip(MARKS, found) if w > 0] == [mark]


def test_clauses_words_and_bounds():
    m = model()
    # a negation reaches a few words, and no machine looks beyond its clause
    assert m.marks("not one two three four idiot")[MARKS.index("insult")] > 0
    assert m.marks("you. idiot")[MARKS.index("insult")] > 0
    for text in ("idiotic", "xidiot", "ovequ", "", None, "   ", "?!."):
        assert not m.marks(text)[:-1].any()
    assert m.marks("x" * 1_000_000 + " idiot")[MARKS.index("insult")] > 0
    assert 0 < m.score(None) < m.score("you idiot") < 1


def cascade(symbols):
    """All readings, machine after machine: what one writes the next one reads."""
    readings = [(tuple(symbols), (0.0,) * len(symbols))]
    for machine in toxicity.MACHINES:
        made = []
        for tape, weights in readings:
            todo = [(0, machine.start, (), ())]
            while todo:
                at, state, written, gained = todo.pop()
                if at == len(tape):
                    if state in machine.finals:
                        made.append((written, tuple(a + b for a, b in zip(weights, gained))))
                    continue
                todo += [(at + 1, end, (*written, out), (*gained, w)) for end, out, w in machine.arcs.get((state, tape[at]), ())]
        readings = made
    return readings


def test_composition_reads_as_the_machines_in_a_row():
    """Every input has one reading through all five machines, and the composed machine gives it."""
    whole = compose(*toxicity.MACHINES)
    for n in range(5):
        for symbols in product(toxicity.SYMBOLS, repeat=n):
            ((written, weights),) = cascade(symbols)
            ((path, weight),) = whole.paths(symbols)
            assert path == written and weight == pytest.approx(sum(weights))
            assert toxicity.READER.read(symbols) == [(i, m, w) for i, (m, w) in enumerate(zip(written, weights)) if m]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(toxicity.SYMBOLS), min_size=5, max_size=14))
def test_longer_clauses_read_as_in_a_row(symbols):
    ((written, weights),) = cascade(symbols)
    assert toxicity.READER.read(symbols) == [(i, m, pytest.approx(w)) for i, (m, w) in enumerate(zip(written, weights)) if m]


def test_composition_of_any_machines():
    # a guesses where b comes from; c doubles the price of x
    a = Transducer.of(0, [1], [(0, "a", 0, "x", 1.0), (0, "a", 1, "y", 0.5), (1, "a", 1, "x", 2.0)])
    b = Transducer.of("s", ["s"], [("s", "x", "s", "u", 0.25), ("s", "y", "s", "v", 0.0), ("s", "y", "t", "w", 9.0)])
    made = compose(a, b)
    assert sorted(made.paths("aaa")) == [(("u", "u", "v"), 3.0), (("u", "v", "u"), 4.0), (("v", "u", "u"), 5.0)]
    assert list(made.paths("")) == []
    # a state from which nothing ends is gone
    assert all(out != "w" for arcs in made.arcs.values() for _, out, _ in arcs)


def test_learned_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.1"
    rows = workload.op2_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    hits = sum(y and p for y, p in held)
    assert hits / sum(p for _, p in held) > 0.95
    assert hits / sum(y for y, _ in held) > 0.85


def test_held_out_labels_and_other_columns_are_no_inputs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    one = toxicity.score_documents(docs, labels).select("doc_id", "score").collect()
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = toxicity.score_documents(docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y")), turned).select("doc_id", "score").collect()
    assert sorted(one) == sorted(other)


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(0, 1), (0, None), (None, 1), (2, 0), (2, 1), (11, 7)], "doc_id long, toxic int")
    got = toxicity.score_documents(odd_documents, labels)
    assert got.count() == odd_documents.count()
    assert got.where("score is null or held_out is null").count() == 0
    assert {r.score for r in got.where("text is null or text = ''").collect()} == {got.where("doc_id = 4").first().score}
    assert toxicity.score_documents(no_documents, labels).collect() == []
    assert toxicity.score_documents(odd_documents, labels.limit(0)).count() == odd_documents.count()


def test_copies_teach_once(spark):
    copied = "alpha bravo charlie delta echo foxtrot golf"
    rows = [(i, copied, 1) for i in range(50)] + [(100 + i, f"word{i} other{i} thing{i} vequ{i}", 1) for i in range(20)] + [(200 + i, f"clean{i} text{i} here{i} now{i}", 0) for i in range(200)]
    df = spark.createDataFrame(rows, "key long, text string, toxic int")
    stems, _ = toxicity._learn_stems(toxicity.sample(df.select("key", "toxic"), df.select("key", "text"), 1000))
    assert "alpha" not in stems and any(s.startswith("veq") for s in stems)

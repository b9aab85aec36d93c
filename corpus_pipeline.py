"""From documents to packed sequences: each stage works on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, mixing, packing, simhash, toxicity
from tidemark.llm.staging import staged
from tidemark.llm.workload import MIXTURE, languages

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def without_toxic(spark, docs, sf_dir):
    """Documents that the classifier does not call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score_documents(docs, labels).where("predicted = 0").select(*DOCUMENT)


def one_of_equal_texts(spark, docs, sf_dir):
    """The document with the smallest id of those whose texts are equal but for white space."""
    return exact_dedup.exact_dedup(docs).where("kept").select(*DOCUMENT)


def one_of_near_copies(spark, docs, sf_dir):
    """The document with the smallest id of each SimHash component."""
    return simhash.simhash_groups(docs).where("kept").select(*DOCUMENT)


def to_target_weights(spark, docs, sf_dir):
    """Documents in the copies that bring the languages to their shares.

    No document is left out: rates are at least 1, and the budget is the least in which no
    language has to shrink, judged by the languages the documents name.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    words = F.size(F.split(F.coalesce("text", F.lit("")), mixing.WORD_BREAK))
    have = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.sum(words).alias("n")).where(F.col("lang").isin(list(MIXTURE))).collect()}
    total = sum(MIXTURE.values())
    budget = max([n * total / MIXTURE[lang] for lang, n in have.items()], default=0.0)
    mixed = mixing.mix(docs, languages(docs, labels), MIXTURE, budget=budget, least=1.0)
    return mixed.select(*DOCUMENT, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select(*DOCUMENT)


def packed(spark, docs, sf_dir):
    """The pieces of all documents and their places in sequences of 1,024 tokens."""
    pieces = packing.tokenised(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return packing.place(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES = [
    ("toxicity", without_toxic),
    ("exact dedup", one_of_equal_texts),
    ("simhash near-dedup", one_of_near_copies),
    ("mixing sources to target weights", to_target_weights),
    ("best-fit packing", packed),
]

# a learned score, XXH64 and a tokenizer are beyond SQL; the tests hold run() against brute force
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

"""Mixing documents to target weights with soft domain membership.

A naive Bayes classifier learned from a labelled table gives every document a posterior over
the domains, from the last characters of all its words. Rates are then the least-squares
solution, under a lower bound, of: the expected tokens of every domain, over all documents,
are its share of the budget. One step of projected gradient descent needs the current
totals only, which are a few sums, and moves each document's rate along its own posterior; so
a step is one aggregation and nothing is joined or sorted.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import staging

SAMPLE = 20_000
VOCABULARY = 4096
SUFFIX = 3
SMOOTHING = 0.5
SHARPNESS = 4.0
MOST_STEPS = 40
STEPS_TOGETHER = 6  # rates are written after so many steps, which bounds the formula of one
TOLERANCE = 1e-7
WORD_BREAK = r"[\x20\x09-\x0D]+"


def _words(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys..., end): the last characters of every word of `text`."""
    words = rows.select(*keys, F.explode(F.split(F.coalesce("text", F.lit("")), WORD_BREAK)).alias("word")).where("word <> ''")
    return words.select(*keys, F.substring("word", -SUFFIX, SUFFIX).alias("end"))


def classifier(texts: DataFrame, labelled: DataFrame, domains: list[str], sample: int = SAMPLE, vocabulary: int = VOCABULARY) -> tuple[DataFrame, list[float]]:
    """(end, weights): what a word ending adds to each domain's score, and the domains' log shares.

    Learned from at most `sample` labelled rows, those with the smallest hash of their key,
    and the `vocabulary` most frequent endings in their whole texts. A key that is labelled
    more than once counts with its smallest domain; domains without a target are left out.
    """
    known = labelled.where(F.col("domain").isin(domains) & F.col("key").isNotNull()).groupBy("key").agg(F.min("domain").alias("domain"))
    known = staging.staged(known.orderBy(F.xxhash64("key"), "key").limit(sample), "labelled")
    ends = _words(texts.join(F.broadcast(known), "key"), "domain")
    per = [F.count(F.when(F.col("domain") == d, 1)).cast("double").alias(f"c{i}") for i, d in enumerate(domains)]
    counts = staging.staged(ends.groupBy("end").agg(F.count("*").alias("n"), *per).orderBy(F.desc("n"), "end").limit(vocabulary), "endings")
    total = counts.agg(F.count("*"), *[F.sum(f"c{i}") for i in range(len(domains))]).first()
    rows = {r["domain"]: r["n"] for r in known.groupBy("domain").agg(F.count("*").alias("n")).collect()}  # one row for each domain
    logs = [F.log((F.col(f"c{i}") + SMOOTHING) / ((total[i + 1] or 0.0) + SMOOTHING * max(1, total[0]))) for i in range(len(domains))]
    share = [float(np.log((rows.get(d, 0) + 1) / (sum(rows.values()) + len(domains)))) for d in domains]
    return counts.select("end", *[x.alias(f"w{i}") for i, x in enumerate(logs)]), share


def posteriors(rows: DataFrame, weights: DataFrame, share: list[float], sharpness: float = SHARPNESS) -> DataFrame:
    """(at, tokens, p): words of each row with any, and its posterior as an array in the domains' order.

    A document counts as `sharpness` words, however long it is, so that membership stays
    soft. Words with unknown endings say nothing.
    """
    n = len(share)
    # at most as many rows as the vocabulary
    met = _words(rows, "at").join(F.broadcast(weights), "end", "left")
    sums = met.groupBy("at").agg(F.count("*").alias("tokens"), F.count("w0").alias("known"), *[F.sum(f"w{i}").alias(f"s{i}") for i in range(n)])
    mean = [F.coalesce(F.col(f"s{i}") / F.col("known"), F.lit(0.0)) * sharpness + share[i] for i in range(n)]
    scores = sums.select("at", "tokens", F.array(*mean).alias("s"))
    return scores.select("at", "tokens", _softmax(F.col("s")).alias("p"))


def _softmax(scores: Column) -> Column:
    powers = F.transform(scores, lambda x: F.exp(x - F.array_max(scores)))
    total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.transform(powers, lambda x: x / total)


def _moved(rate: Column, p: Column, step: np.ndarray, least: float) -> Column:
    """A rate after one step along the document's posterior, and back above the bound."""
    for i, s in enumerate(step):
        rate = rate - p[i] * float(s)
    return F.greatest(rate, F.lit(float(least)))


def fit(docs: DataFrame, targets: np.ndarray, least: float = 0.0, most_steps: int = MOST_STEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """Staged rows (tokens, p, ...) with `rate`, by projected gradient descent towards `targets` tokens for each domain.

    Rates start at 1. The residual is measured in the inverse of the second moment of the
    documents that are above the bound, in which a step of length one is exact until
    another rate meets the bound. Ends when every domain is within `tolerance` of the
    target total, or when no total moves any more (targets out of reach), or after `most_steps`.
    """
    n = len(targets)
    docs = docs.withColumn("rate", F.lit(float(max(1.0, least))))
    t, p, rate = F.col("tokens").cast("double"), F.col("p"), F.col("rate")
    free = F.when(rate > least, t).otherwise(0.0)
    sums = [F.sum(t), *[F.sum(rate * t * p[i]) for i in range(n)], *[F.sum(free * p[i] * p[j]) for i in range(n) for j in range(n)]]
    last = None
    for k in range(most_steps):
        total, *found = (x or 0.0 for x in docs.agg(*sums).first())
        now, second = np.array(found[:n]), np.array(found[n:]).reshape(n, n)
        if not total:
            break
        residual = (now - targets) / total
        if np.abs(residual).max() <= tolerance * targets.sum() / total or (last is not None and np.abs(now - last).max() <= 1e-10 * total):
            break
        step = np.linalg.solve(second / total + 1e-6 * np.eye(n), residual)
        docs = docs.withColumn("rate", _moved(rate, p, step, least))
        if k % STEPS_TOGETHER == STEPS_TOGETHER - 1:
            docs = staging.staged(docs, "rates")
        last = now
    return docs


def mix(df: DataFrame, labelled: DataFrame, targets: dict[str, float], key: str = "doc_id", text: str = "text", budget: float | None = None, least: float = 0.0, sample: int = SAMPLE, keep_text: bool = True) -> DataFrame:
    """Every row of `df` with tokens, posterior, rate and copies.

    `labelled` has (key, domain). `targets` are nonnegative weights, of any sum; `budget` is
    the tokens (words) the mixture is to have, those of `df` if None. `rate` is how often a
    document should occur on average, at least `least`; `copies` is that number, rounded up
    or down by a hash of the row so that expectations hold. Rows without words, null texts
    included, have 0 tokens, the domains' shares as posterior and rate 1 or `least`. Null keys
    are documents like others and have no label. Repeated rows are rounded each for itself.
    Columns of `df` with the names of the result are replaced.
    """
    domains = sorted(targets)
    weight = np.array([targets[d] for d in domains], dtype=float)
    if not len(domains) or (weight < 0).any() or not weight.sum() or least < 0:
        raise ValueError("targets must be nonnegative and not all 0, least at least 0")
    columns = [c for c in df.columns if keep_text or c != text]
    rows = df.select(F.monotonically_increasing_id().alias("at"), F.struct(*[F.col(c) for c in columns]).alias("row"), F.col(key).alias("key"), F.col(text).alias("text"))
    rows = staging.staged(rows if not keep_text or text not in columns else rows.drop("text"), "mix-rows")
    texts = rows.select("at", "key", F.col("text") if "text" in rows.columns else F.col(f"row.{text}").alias("text"))
    weights, share = classifier(texts, labelled, domains, sample)
    found = posteriors(texts.select("at", "text"), weights, share)
    prior = np.exp(share) / np.exp(share).sum()
    docs = rows.select("at", "key").join(found, "at", "left").select("at", "key", F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"), F.coalesce("p", F.array(*[F.lit(float(x)) for x in prior])).alias("p"))
    docs = staging.staged(docs, "posteriors")
    total = docs.agg(F.sum("tokens")).first()[0] or 0
    fitted = fit(docs, weight / weight.sum() * (total if budget is None else budget), least)
    rate = F.when(F.col("tokens") > 0, F.col("rate")).otherwise(F.lit(float(max(1.0, least))))
    even = F.pmod(F.xxhash64("key", "at"), F.lit(1 << 40)) / float(1 << 40)
    rated = fitted.select("at", "tokens", "p", rate.alias("rate"), even.alias("even"))
    made = {
        "tokens": F.col("tokens"),
        "posterior": F.col("p"),
        "rate": F.col("rate"),
        "copies": F.floor(F.col("rate") + F.col("even")).cast("int"),
    }
    return staging.replacing(rows.select("at", "row").join(rated, "at"), "row", made, columns)

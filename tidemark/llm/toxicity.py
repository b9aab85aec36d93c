"""Toxicity by a weighted finite-state grammar over clauses.

A lexicon maps the words of a clause to symbols with weights: insult, threat, target,
negation, report, quotation mark, break, other. Five weighted transducers read them in a
row, and their composition is one machine over pairs of states whose weights are added:

    negation  marks insults and threats that a negation before them reaches
    report    marks those inside closed quotation marks, or in what someone is said to say
    target    marks those that are aimed at someone, before or behind them in the clause
    insult    writes a mark for each insult
    threat    writes a mark for each threat

Marks, not words, are what a document is scored on: the weight of a mark is that of its
word and of the arcs that led to it.

Insults are learned: from labelled rows, the beginnings of words that tell toxic texts
from others join the fixed lists with their log odds as weights. A logistic regression over
the weighted marks turns them into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import staging
from tidemark.llm.transducers import Reader, Transducer, compose

# Words of the grammar in English, French, German and Spanish.
INSULTS = (
    "idiot", "stupid", "moron", "loser", "scum", "trash", "pathetic", "worthless", "clown", "disgusting", "imbecile",
    "imbécile", "crétin", "abruti", "ordure", "dummkopf", "trottel", "abschaum", "estúpido", "imbécil", "basura",
)
THREATS = (
    "kill", "murder", "strangle", "stab", "beat", "destroy", "hurt", "burn", "tuer", "frapper", "étrangler",
    "töten", "umbringen", "schlagen", "matar", "golpear", "quemar",
)
TARGETS = ("you", "your", "yourself", "he", "she", "they", "them", "tu", "toi", "vous", "du", "dich", "ihr", "sie", "tú", "usted", "ustedes", "vosotros")
NEGATIONS = ("not", "no", "never", "neither", "without", "don", "doesn", "didn", "isn", "aren", "wasn", "ne", "pas", "jamais", "nicht", "kein", "keine", "nie", "nunca", "ni", "sin")
REPORTS = ("said", "says", "wrote", "called", "claimed", "quoted", "dit", "écrit", "appelé", "sagte", "schrieb", "nannte", "dijo", "escribió", "llamó")
BREAKS = ("and", "but", "so", "because", "while", "et", "mais", "und", "aber", "weil", "y", "e", "pero", "porque", ",")

SAMPLE = 20_000
STEM = (3, 12)
MOST_STEMS = 500
LEAST_CHI2 = 50.0
LEAST_ODDS = 1.5
CANDIDATES = 20_000
NEGATION_REACH = 3
# Weights of the arcs that mark an insult or a threat.
AIMED = 0.5
SOFTENED = -0.5
DEFAULT_WEIGHT = 2.0
RIDGE = 1.0

CLAUSE_END = re.compile(r"[.!?;:\n]")
WORD = re.compile(r"[^\W_]+|[,\"«»“”„]")
QUOTES = set("\"«»“”„")
MARKS = ("insult", "aimed insult", "threat", "aimed threat", "negated", "reported")


# what the lexicon writes: insult, threat, target, negation, report, quotation mark, break, other
SYMBOLS = "itynrqbo"


def negation_machine() -> Transducer:
    """A negation reaches NEGATION_REACH symbols, but not across a break or someone who is addressed. States: symbols it still reaches."""
    arcs = []
    for reach in range(NEGATION_REACH + 1):
        for symbol in SYMBOLS:
            after = NEGATION_REACH if symbol == "n" else 0 if symbol in "by" else max(0, reach - 1)
            negated = symbol in "it" and reach > 0
            arcs.append((reach, symbol, after, f"{symbol}-" if negated else symbol, SOFTENED if negated else 0.0))
    return Transducer.of(0, range(NEGATION_REACH + 1), arcs)


def report_machine() -> Transducer:
    """Quotation marks hold to the one that closes them; the last of an odd number opens nothing, which is guessed.

    A report verb holds until a break behind which someone else is named, but for the break
    right behind the verb. States: (plain, just said, said, said and break; no quotation open, one open, none to come).
    """
    arcs = []
    for mode in ("plain", "just", "said", "break"):
        for symbol in (*SYMBOLS, "i-", "t-"):
            after = {
                "plain": "just" if symbol == "r" else "plain",
                "just": "just" if symbol == "r" else "said",
                "said": {"r": "just", "b": "break"}.get(symbol, "said"),
                "break": {"r": "just", "b": "break", "y": "plain"}.get(symbol, "said"),
            }[mode]
            if symbol == "q":
                closed = "said" if mode == "just" else mode
                arcs += [((mode, "none"), "q", (mode, "open"), "q", 0.0), ((mode, "open"), "q", (closed, "none"), "q", 0.0), ((mode, "none"), "q", (mode, "last"), "q", 0.0)]
                continue
            for quote in ("none", "open", "last"):
                reported = symbol in ("i", "t") and (mode != "plain" or quote == "open")
                # what is quoted has no say in who reports
                end = mode if quote == "open" else after
                arcs.append(((mode, quote), symbol, (end, quote), f'{symbol}"' if reported else symbol, SOFTENED if reported else 0.0))
    modes = ("plain", "just", "said", "break")
    return Transducer.of(("plain", "none"), [(m, q) for m in modes for q in ("none", "last")], arcs)


def target_machine() -> Transducer:
    """An insult or threat is aimed if a target stands before or behind it in the clause.

    Before a target is seen it is guessed whether one comes: states are open, named, coming, none to come.
    """
    passed = (*SYMBOLS, "i-", "t-", 'i"', 't"')
    arcs = []
    for symbol in passed:
        if symbol in ("i", "t"):
            arcs += [
                ("named", symbol, "named", f"{symbol}!", 0.0), ("coming", symbol, "coming", f"{symbol}!", 0.0), ("none", symbol, "none", symbol, 0.0),
                ("open", symbol, "coming", f"{symbol}!", 0.0), ("open", symbol, "none", symbol, 0.0),
            ]
        elif symbol == "y":
            arcs += [(state, "y", "named", "y", 0.0) for state in ("open", "named", "coming")]
        else:
            arcs += [(state, symbol, state, symbol, 0.0) for state in ("open", "named", "coming", "none")]
    return Transducer.of("open", ("open", "named", "none"), arcs)


def _marker(symbol: str, kind: str, others: Sequence[str]) -> Transducer:
    """Writes the marks of one kind, hands on those of others, and writes nothing for the rest."""
    arcs = [(0, symbol, 0, kind, 0.0), (0, f"{symbol}!", 0, f"aimed {kind}", AIMED), (0, f"{symbol}-", 0, "negated", 0.0), (0, f'{symbol}"', 0, "reported", 0.0)]
    return Transducer.of(0, [0], arcs + [(0, o, 0, o if o in MARKS or o[:1] == "t" else "", 0.0) for o in others])


def insult_machine() -> Transducer:
    return _marker("i", "insult", [*"tynrqbo", "t!", "t-", 't"'])


def threat_machine() -> Transducer:
    return _marker("t", "threat", ["", "insult", "aimed insult", "negated", "reported"])


MACHINES = (negation_machine(), report_machine(), target_machine(), insult_machine(), threat_machine())
READER = Reader(compose(*MACHINES))


@dataclass
class Model:
    """Word beginnings and whole words with their weights, and the weights of the marks."""

    stems: dict[str, float] = field(default_factory=dict)
    words: dict[str, tuple[str, float]] = field(default_factory=dict)
    coefficients: tuple[float, ...] = ()

    def __post_init__(self):
        self.automaton = None
        self.other = {w: s for ws, s in ((TARGETS, "y"), (NEGATIONS, "n"), (REPORTS, "r"), (BREAKS, "b"), (QUOTES, "q")) for w in ws}

    def __getstate__(self):
        return {"stems": self.stems, "words": self.words, "coefficients": self.coefficients}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def _hits(self, text: str) -> dict[int, tuple[str, float]]:
        """Start of a word: its symbol and weight, for insults and threats."""
        if self.automaton is None:
            self.automaton = ahocorasick.Automaton()
            for w in {*self.stems, *self.words}:
                self.automaton.add_word(w, w)
            self.automaton.make_automaton()
        found: dict[int, tuple[str, float]] = {}
        if not len(self.automaton):
            return found
        for end, w in self.automaton.iter(text):
            at = end - len(w) + 1
            if at and text[at - 1].isalnum():
                continue
            if w in self.stems:
                hit = ("i", self.stems[w])
            elif end + 1 < len(text) and text[end + 1].isalnum():
                continue
            else:
                hit = self.words[w]
            if at not in found or found[at][1] < hit[1]:
                found[at] = hit
        return found

    def marks(self, text: str | None) -> np.ndarray:
        """What the clauses of a text add up to: a weight for each mark, their number, and their share of the words."""
        out = np.zeros(len(MARKS) + 3)
        text = (text or "").lower()
        out[-1] = math.log1p(len(text) / 6)
        hits = self._hits(text)
        if not hits:
            return out
        n, done = 0, -1
        for at in sorted(hits):
            if at < done:
                continue
            # the clause around the word; every other word of it that counts is met on the way
            first = max(text.rfind(c, 0, at) for c in ".!?;:\n") + 1
            end = CLAUSE_END.search(text, at)
            done = end.start() if end else len(text)
            symbols, weights = [], []
            for word in WORD.finditer(text, first, done):
                symbol, weight = hits.get(word.start(), (None, 0.0))
                symbols.append(symbol or self.other.get(word[0], "o"))
                weights.append(weight)
            for place, mark, weight in READER.read(symbols):
                out[MARKS.index(mark)] += max(0.0, weights[place] + weight)
                n += 1
        out[: len(MARKS)] = np.log1p(np.maximum(out[: len(MARKS)], 0))
        out[-3] = math.log1p(n)
        out[-2] = min(1.0, 60.0 * n / max(6, len(text)))
        return out

    def score(self, text: str | None) -> float:
        z = self.coefficients[0] + float(np.dot(self.coefficients[1:], self.marks(text)))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def _beginnings(text: str) -> set[str]:
    """Words and their beginnings."""
    out = set()
    for w in {w for w in WORD.findall(text.lower()) if w[0].isalpha()}:
        out.update(w[:n] for n in range(STEM[0], min(STEM[1], len(w)) + 1))
    return out


def _origin(text: str) -> int:
    """The smallest hash of three words in a row: mostly the same for copies with small changes."""
    words = text.encode().lower().split()
    spans = range(max(1, len(words) - 2))
    return min(xxhash.xxh64_intdigest(b" ".join(words[i : i + 3])) for i in spans) >> 1


def sample(labels: DataFrame, texts: DataFrame, rows: int) -> DataFrame:
    """(key, text, toxic, origin) of at most `rows` labelled rows, those with the smallest hash of their key.

    Of rows with the same origin one stays, so that a text copied a thousand times does not
    teach that all its words are toxic.
    """
    known = labels.where(F.col("key").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("key").agg(F.max("toxic").alias("toxic"))
    known = known.orderBy(F.xxhash64("key"), "key").limit(rows)
    # at most `rows` rows
    found = texts.where("text is not null").join(F.broadcast(known), "key")

    def origins(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(origin=[_origin(t) for t in f["text"]])

    kind = f"key {labels.schema['key'].dataType.simpleString()}, text string, toxic int, origin long"
    made = staging.staged(found.select("key", "text", F.col("toxic").cast("int").alias("toxic")).mapInPandas(origins, kind), "labelled")
    first = made.groupBy("origin", "toxic").agg(F.min("key").alias("key")).groupBy("key", "toxic").agg(F.first("origin").alias("origin"))
    return made.join(first, ["key", "toxic", "origin"]).select("key", "text", "toxic")


def _learn_stems(rows: DataFrame) -> tuple[dict[str, float], dict[str, tuple[str, float]]]:
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        toxic: Counter[str] = Counter()
        clean: Counter[str] = Counter()
        for f in frames:
            for text, y in zip(f["text"], f["toxic"]):
                (toxic if y else clean).update(_beginnings(text))
        seen = list(toxic.keys() | clean.keys())
        yield pd.DataFrame({"stem": seen, "toxic": [toxic[s] for s in seen], "clean": [clean[s] for s in seen]})

    per = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    yes, no = per.get(1, 0), per.get(0, 0)
    if not yes or not no:
        return {}, {w: (s, DEFAULT_WEIGHT) for ws, s in ((INSULTS, "i"), (THREATS, "t")) for w in ws}
    counts = rows.select("text", "toxic").mapInPandas(count, "stem string, toxic long, clean long").groupBy("stem").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    odds = F.log((F.col("a") + 0.5) / (yes + 1.0) / ((F.col("b") + 0.5) / (no + 1.0)))
    n, a, b = float(yes + no), F.col("a").cast("double"), F.col("b").cast("double")
    chi2 = n * F.pow(a * (no - b) - b * (yes - a), F.lit(2.0)) / ((a + b) * (n - a - b + 0.5) * yes * no)
    counts = staging.staged(counts.select("stem", "a", "b", odds.alias("odds"), chi2.alias("chi2")), "beginnings")
    fixed = {w: s for ws, s in ((INSULTS, "i"), (THREATS, "t")) for w in ws}
    told = {r["stem"]: r["odds"] for r in counts.where(F.col("stem").isin(list(fixed)) & (F.col("a") + F.col("b") >= 10)).collect()}
    words = {w: (s, max(0.0, told.get(w, DEFAULT_WEIGHT))) for w, s in fixed.items()}
    best = counts.where((F.col("odds") >= LEAST_ODDS) & (F.col("chi2") >= LEAST_CHI2)).orderBy(F.desc("chi2"), F.desc(F.length("stem")), "stem").limit(CANDIDATES)
    stems: dict[str, float] = {}
    taken: set[str] = set()
    for r in best.collect():
        s = r["stem"]
        # one of a word's beginnings is enough: the one that tells most
        if s in taken or any(s[:i] in stems for i in range(STEM[0], len(s))):
            continue
        stems[s] = r["odds"]
        taken.update(s[:i] for i in range(STEM[0], len(s) + 1))
        if len(stems) == MOST_STEMS:
            break
    return stems, words


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(labels: DataFrame, texts: DataFrame, rows: int = SAMPLE) -> Model:
    """A model from (key, toxic) and (key, text), learned from at most `rows` labelled rows.

    Labels that are not 0 or 1 and null keys are left out; a key with several labels is
    toxic if one says so. Without both kinds of rows the fixed lists decide.
    """
    learned = staging.staged(sample(labels, texts, rows), "sample")
    # few files hold the sample: its rows are dealt to all cores, `rows` of them at most
    learned = learned.repartition(learned.sparkSession.sparkContext.defaultParallelism, "key")
    model = Model(*_learn_stems(learned))
    model.coefficients = (-2.0, *[1.5, 2.0, 1.5, 2.0, 0.2, 0.2], 0.0, 0.0, 0.0)

    def features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"toxic": f["toxic"], "marks": [model.marks(t).tolist() for t in f["text"]]})

    # one short row for each labelled row of the bounded sample
    seen = learned.select("text", "toxic").mapInPandas(features, "toxic int, marks array<double>").collect()
    y = np.array([r["toxic"] for r in seen], dtype=float)
    if len(y) and 0 < y.sum() < len(y):
        model.coefficients = tuple(float(w) for w in _logistic(np.array([r["marks"] for r in seen]), y))
    return model


def scores(text: Column, model: Model) -> Column:
    """The score of every text; null counts as empty."""

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return of(text)


def held_out(key: Column) -> Column:
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(5)) == 0


def score_documents(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", rows: int = SAMPLE) -> DataFrame:
    """Every row of `df` with held_out, score and predicted; learned from labels (key, toxic) that are not held out.

    Whole texts are scored, null as empty; a null key is not held out and never learned from.
    Repeated rows get the same score. Columns of `df` with the names of the result are replaced.
    """
    known = labels.select(F.col(key).alias("key"), "toxic").where(~held_out(F.col("key")))
    model = fit(known, df.select(F.col(key).alias("key"), F.col(text).alias("text")), rows)
    scored = df.select(F.struct("*").alias("row"), scores(F.col(text), model).alias("s"))
    made = {
        "held_out": F.coalesce(held_out(F.col(f"row.{key}")), F.lit(False)),
        "score": F.col("s"),
        "predicted": (F.col("s") >= 0.5).cast("int"),
    }
    return staging.replacing(scored, "row", made, df.columns)

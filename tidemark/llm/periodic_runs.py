"""Runs of words that repeat with a period, by branching squares in an enhanced suffix array.

The suffixes of a text are sorted over its words. An interval of the suffix array whose
neighbours share d words or more, and one pair of them exactly d, splits at that pair into
two children. Two suffixes i and i + d in different children share exactly d words, so
w[i:i+2d] is a square that cannot be moved one word to the right. Each run has one such
square for its period, and to find it only the suffixes of the smaller child need to look
up the places of i + d and i - d. A square is moved to the left as far as its words allow,
in steps of powers of two, which merges all its rotations into the run.

Texts are put side by side and handled together as arrays: the text is the first part of
every sort key, so nothing meets across texts. There are no tree nodes; the bounds of an
interval come from pointers that jump over larger neighbours.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
BATCH_WORDS = 1 << 16
CHECKED = 1 << 21

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def rank_levels(words: np.ndarray, text: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Ranks of every place by its next 1, 2, 4, ... words; the last level tells all places apart.

    A rank is the place in sorted order of the first of all equal ones, so a place that is
    alone keeps its rank and only the others are sorted again. `ends` is where the text of a
    place ends; a text that ends sorts before one that goes on.
    """
    n = len(words)
    levels = []
    key = text.astype(np.uint64) << np.uint64(32) | words.astype(np.uint64)
    active, base, step = np.arange(n), np.zeros(n, dtype=np.int64), 1
    rank = np.zeros(n, dtype=np.int64)
    while True:
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        fresh = np.empty(len(order), dtype=bool)
        fresh[:1] = True
        np.not_equal(sorted_key[1:], sorted_key[:-1], out=fresh[1:])
        # groups are consecutive in sorted order, and a group of g rows takes the ranks base to base + g - 1
        places = np.arange(len(order))
        group = base[order]
        start = np.empty(len(order), dtype=bool)
        start[:1] = True
        np.not_equal(group[1:], group[:-1], out=start[1:])
        inside = places - np.maximum.accumulate(np.where(start, places, 0))
        new = group + np.maximum.accumulate(np.where(fresh, places, 0)) - places + inside
        rank[active[order]] = new
        levels.append(rank.astype(np.int32))
        last = np.empty(len(order), dtype=bool)
        last[-1:] = True
        last[:-1] = fresh[1:]
        again = order[~(fresh & last)]
        if not len(again):
            return levels
        active = active[again]
        base = rank[active]
        follow = active + step
        inside_text = follow < ends[active]
        after = np.where(inside_text, rank[np.minimum(follow, n - 1)] + 1, 0)
        key = base.astype(np.uint64) << np.uint64(32) | after.astype(np.uint64)
        step *= 2


def shared_words(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many words the suffixes at a and b share; both lie in texts, a <> b in the same one or any others."""
    n = len(levels[0])
    total = np.zeros(len(a), dtype=np.int64)
    a, b = a.copy(), b.copy()
    end_a, end_b = ends[a], ends[b]
    for k in range(len(levels) - 1, -1, -1):
        level, size = levels[k], 1 << k
        # the level that tells all places apart may do so by where a text ends
        same = (a < end_a) & (b < end_b) & (level[np.minimum(a, n - 1)] == level[np.minimum(b, n - 1)])
        total += same * size
        a += same * size
        b += same * size
    return total


def _bound(lcp: np.ndarray, at: np.ndarray, side: int, strict: bool) -> np.ndarray:
    """The nearest place before (side -1) or behind (side 1) each of `at` whose value is less, or not greater unless `strict`."""
    n = len(lcp)
    jump = np.arange(n) + side
    own = lcp
    todo = at
    while len(todo):
        target = jump[todo]
        inside = (target >= 0) & (target < n)
        todo, target = todo[inside], target[inside]
        over = own[target] >= own[todo] if strict else own[target] > own[todo]
        todo, target = todo[over], target[over]
        jump[todo] = jump[target]
    return jump[at]


def squares(lcp: np.ndarray, order: np.ndarray, place: np.ndarray, deepest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of all branching squares. lcp[j] is what the suffixes at places j - 1 and j share;
    splits deeper than `deepest` are passed over."""
    n = len(lcp)
    nodes = np.flatnonzero((lcp > 0) & (lcp <= deepest))
    if not len(nodes):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    everything = np.flatnonzero(lcp > 0)
    left = _bound(lcp, everything, -1, strict=False)[np.searchsorted(everything, nodes)]
    right = _bound(lcp, everything, 1, strict=True)[np.searchsorted(everything, nodes)]
    depth = lcp[nodes]
    before_smaller = nodes - left <= right - nodes
    first = np.where(before_smaller, left, nodes)
    size = np.where(before_smaller, nodes - left, right - nodes)
    low, high = np.where(before_smaller, nodes, left), np.where(before_smaller, right, nodes)
    starts, periods = [], []
    total = np.cumsum(size)
    at = 0
    while at < len(nodes):
        # as many nodes as make about CHECKED lookups, at least one
        done = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + CHECKED, side="right")))
        sizes = size[at:to]
        offset = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        i = order[np.repeat(first[at:to], sizes) + offset]
        d, lo, hi = (np.repeat(x[at:to], sizes) for x in (depth, low, high))
        for other, start in ((i + d, i), (i - d, i - d)):
            other = np.where((other >= 0) & (other < n), other, i)  # a suffix is never in the other child itself
            there = place[other]
            hit = (there >= lo) & (there < hi)
            starts.append(start[hit])
            periods.append(d[hit])
        at = to
    return np.concatenate(starts), np.concatenate(periods)


def find_runs(words: np.ndarray, sizes: np.ndarray, least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of all runs of texts put side by side, by text, start, period.

    `words` are numbers from 0, equal in a text where the words are equal; `sizes` are the
    words of each text. A run is maximal, its period is its smallest, and it has
    `least_length` words and `least_exponent` (2 or more) periods at least.
    """
    none = tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    n = len(words)
    if not n:
        return none
    text = np.repeat(np.arange(len(sizes)), sizes)
    begins = np.cumsum(sizes) - sizes
    ends = (begins + sizes)[text]
    levels = rank_levels(words, text, ends)
    place = levels[-1].astype(np.int64)
    order = np.empty(n, dtype=np.int64)
    order[place] = np.arange(n)
    lcp = np.zeros(n, dtype=np.int64)
    lcp[1:] = shared_words(levels, order[:-1], order[1:], ends)
    lcp[1:][text[order[1:]] != text[order[:-1]]] = 0
    start, period = squares(lcp, order, place, sizes[text[order]] // least_exponent)
    if not len(start):
        return none
    stop = start + 2 * period
    # all rotations at once: to the left by powers of two, each at most once from the largest
    floor = begins[text[start]]
    for k in range(len(levels) - 1, -1, -1):
        back = start - (1 << k)
        fits = back >= floor
        back = np.where(fits, back, start)
        # equal here means equal over all 2**k words: both stretches end inside the text
        start = np.where(fits & (levels[k][back] == levels[k][back + period]) & (back + period < n), back, start)
    length = stop - start
    long = (length >= least_length) & (length >= least_exponent * period)
    start, length, period = start[long], length[long], period[long]
    # multiples of a run's period give the same stretch
    by = np.lexsort((period, length, start))
    start, length, period = start[by], length[by], period[by]
    first = np.ones(len(start), dtype=bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[first], length[first], period[first]
    of = text[start]
    by = np.lexsort((period, start, of))
    return of[by], (start - begins[of])[by], length[by], period[by]


def collapsed(words: list, runs: Iterable[tuple[int, int, int]]) -> list:
    """The words without those that any run (start, length, period) holds after its first period."""
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    covered = np.cumsum(gone[:-1]) > 0
    return [w for w, drop in zip(words, covered.tolist()) if not drop]


def _batch_runs(texts: list[bytes | None], least_length: int, least_exponent: int) -> tuple[list, list]:
    """(n_words, runs, collapsed) of some texts as columns."""
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    split = [t.split() if t else [] for t in texts]
    sizes = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    words = np.fromiter(map(numbers.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=int(sizes.sum()))
    of, *found = find_runs(words, sizes, least_length, least_exponent)
    edges = np.searchsorted(of, np.arange(len(split) + 1)).tolist()
    runs = list(zip(*(x.tolist() for x in found)))
    made, kept = [], []
    for own, a, b in zip(split, edges, edges[1:]):
        mine = runs[a:b]
        made.append([{"start": s, "length": n, "period": p} for s, n, p in mine])
        kept.append(b" ".join(collapsed(own, mine) if mine else own))
    return made, kept


def periodic_runs(df: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT) -> DataFrame:
    """One row for each row of `df`: key, runs (by start, then period) and the collapsed text.

    Words are [^\\x20\\x09-\\x0D]+, numbered from 0. `collapsed` joins by one space the words
    that no run holds after its first period. Null and empty texts have no runs and an empty
    collapsed text. Repeated rows and keys are rows of their own; other columns are ignored.
    A text is handled whole by one task, together with others up to BATCH_WORDS words; memory
    grows with the words of that batch times the logarithm of its longest repetition.
    """
    if least_exponent < 2 or least_length < 2:
        raise ValueError("a run has two words and two periods at least")
    struct = T.DataType.fromDDL(RUNS)
    schema = T.StructType([T.StructField("id", df.schema[key].dataType), T.StructField("runs", struct), T.StructField("collapsed", T.StringType())])
    wire = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            at = 0
            while at < batch.num_rows:
                # about BATCH_WORDS words, judged by five bytes a word
                to, held, some = at, 0, []
                while to < batch.num_rows and (to == at or held < 5 * BATCH_WORDS):
                    some.append(texts[to].as_py())
                    held += len(some[-1] or b"")
                    to += 1
                runs, kept = _batch_runs(some, least_length, least_exponent)
                kept = pa.array(kept, pa.binary()).cast(pa.string(), safe=False)
                yield pa.RecordBatch.from_arrays([ids.slice(at, to - at), pa.array(runs, wire), kept], ["id", "runs", "collapsed"])
                at = to

    rows = df.select(F.col(key).alias("id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(find, schema).select(F.col("id").alias(key), "runs", "collapsed")


def greatest(runs: Column) -> Column:
    """The run of the greatest exact length / period, the first of equal ones; null without runs."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def with_planted_runs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text) in which a tenth of the rows, by a hash of the key, repeat with a period from some word on.

    With h the CRC-32 of the key as text and g = h // 10, a text of n > 0 words with h % 10 = 0 gets
    for each word i >= a = g % n the word a + (i - a) % p of the original, p = 1 + (n - a) // (3 + g % 8).
    """
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g = F.floor(h / 10)
    planted = df.select(key, text, h.alias("h"), g.alias("g"), F.when(h % 10 == 0, words).alias("words"))
    planted = planted.withColumn("n", F.size("words").cast("long"))
    some = (F.col("h") % 10 == 0) & (F.col("n") > 0)
    a = F.when(some, F.col("g") % F.col("n"))
    planted = planted.withColumn("a", a).withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    moved = F.transform("words", lambda w, i: F.when(i >= F.col("a"), F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))).otherwise(w))
    return planted.select(key, F.when(some, F.array_join(moved, " ")).otherwise(F.col(text)).alias(text))


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """What periodic_runs() found, as counts and digests."""
    best = F.col("best")
    line = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    # a line feed behind every run
    lines = F.array_join(F.transform(line, lambda t: F.concat(t, F.lit("\n"))), "")
    return found.withColumn("best", greatest(F.col("runs"))).select(
        key,
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )

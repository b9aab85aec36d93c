"""Line deduplication by a segment-partition edit join.

Distinct lines are cut into threshold + 1 segments. Lines within the threshold leave one
segment of the shorter line whole, and it lies in the longer line at one of a few places
that the two lengths allow. So each line is entered under its own segments and under those
substrings of it that could be a segment of a line as long or shorter, and lines that meet
under an entry are candidates.

Candidates are first held against each other by a sketch, the parities of character
counts, of which an edit changes two bits at most. Lines that have a partner then meet
again under their entry with their texts, and a banded bit-parallel edit distance verifies
each pair under the least entry it shares, nowhere else. An entry gives a spanning forest
of its links and how many links each line has: never more rows than twice its lines.

Where an entry has too many lines for one task, what all of them begin and end with is
taken off, which changes no distance, and the rest is entered again; where that takes
nothing off, blocks of lines meet, each two in a run of their own. Neither loses a link.
"""

from __future__ import annotations

import os.path
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce
from operator import ne

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import staging
from tidemark.llm.components import components

THRESHOLD = 2
LEAST_CHARS = 12
MOST_TOGETHER = 4096
ROUNDS = 3  # how often lines are entered again before blocks of them meet
SKETCH_BITS = 32  # letters fall into bits of their own, and every entry carries a sketch
CELLS = 1 << 22
ROWS_OUT = 1 << 16


def normalised(text: Column) -> Column:
    """Each run of white space but line ends as one space. Most texts have nothing to replace, and finding that out is cheap."""
    odd = F.lit(False)
    for mark in ("  ", "\t", "\x0b", "\f", "\r"):
        odd = odd | F.contains(text, F.lit(mark))
    return F.when(odd, F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]{2,}|[\x09\x0B-\x0D]", " ")).otherwise(text)


def segments(length: int, threshold: int) -> list[tuple[int, int]]:
    """(start, length) of the segments of a line: as even as can be, the longer ones last."""
    n = threshold + 1
    short, longer = divmod(length, n)
    out, at = [], 0
    for i in range(n):
        size = short + (i >= n - longer)
        out.append((at, size))
        at += size
    return out


def places(length: int, shorter: int, threshold: int) -> list[tuple[int, int, int]]:
    """(segment, start, size): substrings of a line of `length` that can be a segment of one of `shorter` characters.

    Counting edits from the left, the i-th segment is moved by at most i; from the right, by
    at most threshold - i against the difference in length. A pair that matches has a
    segment that both counts allow.
    """
    moved = length - shorter
    out = []
    for i, (at, size) in enumerate(segments(shorter, threshold)):
        first = max(0, at - i, at + moved - (threshold - i))
        last = min(length - size, at + i, at + moved + (threshold - i))
        out += [(i, p, size) for p in range(first, last + 1)]
    return out


def sketch(line: str) -> int:
    """Parities of the counts of characters, by their code modulo the bits of the sketch."""
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype="<u4") % SKETCH_BITS
    odd = np.bincount(codes, minlength=SKETCH_BITS) & 1
    return int(np.packbits(odd.astype(np.uint8), bitorder="little").view("<u4")[0])


def within(a: str, b: str, threshold: int) -> bool:
    """Whether the edit distance is at most `threshold`."""
    if abs(len(a) - len(b)) > threshold:
        return False
    at = _common(a, b)
    a, b = a[at:], b[at:]
    at = _common(a[::-1], b[::-1])
    a, b = a[: len(a) - at], b[: len(b) - at]
    if len(a) == len(b) and sum(map(ne, a, b)) <= threshold:
        return True
    m, n = len(a), len(b)
    if min(m, n) <= threshold:
        return _by_rows(a, b) <= threshold
    return _banded(a, b, threshold) <= threshold


def _common(a: str, b: str) -> int:
    """Characters that both begin with."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _by_rows(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _banded(a: str, b: str, k: int) -> int:
    """Edit distance where it is at most k, else some number above k; both longer than k.

    Bits are the rows of `a` from k above the diagonal to k below it, kept as differences to
    the row above; the band moves down by a row with each character of `b`.
    """
    where: dict[str, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    m, full, foot = len(a), (1 << 2 * k + 1) - 1, 1 << 2 * k
    up, down = full ^ ((1 << k) - 1), 0  # rows 0 to k: one more than the row above
    distance = k
    for j, y in enumerate(b):
        same = where.get(y, 0)
        same = (same >> j - k if j >= k else same << k - j) & full
        diagonal = ((((same & up) + up) ^ up) | same | down) & full
        right_up = (down | ~(diagonal | up)) & full
        right_down = diagonal & up
        if j < m - k:
            distance += not diagonal & foot
        else:
            last = 1 << m - 1 - j + k
            distance += bool(right_up & last) - bool(right_down & last)
        if distance > 3 * k + 1:
            return distance
        up = (right_down | ~(diagonal >> 1 | right_up)) & full
        down = diagonal >> 1 & right_up
    return distance


ENTRIES = "key long, lid long, sketch long"


def _planner(threshold: int, least_chars: int):
    plans: dict[int, list[tuple[int, int, int]]] = {}

    def plan(length: int) -> list[tuple[int, int, int]]:
        """(seed, start, end) of all entries of a line; the seed tells length and segment."""
        if length not in plans:
            if len(plans) > 10_000:
                plans.clear()
            plans[length] = [
                (shorter * (threshold + 1) + i, p, p + size)
                for shorter in range(max(least_chars, length - threshold), length + 1)
                for i, p, size in places(length, shorter, threshold)
            ]
        return plans[length]

    return plan


def _enter(threshold: int, least_chars: int):
    names = ["key", "lid", "sketch"]
    plan = _planner(threshold, least_chars)

    def enter(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            keys, lids, sketches = [], [], []

            def out() -> pa.RecordBatch:
                made = np.array(keys, dtype=np.uint64).view(np.int64)
                return pa.RecordBatch.from_arrays([pa.array(made), pa.array(lids, pa.int64()), pa.array(sketches, pa.int64())], names)

            for lid, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                entries = plan(len(line))
                own = sketch(line)
                if line.isascii():
                    raw = line.encode()
                    keys += [digest(raw[a:b], seed) for seed, a, b in entries]
                else:
                    keys += [digest(line[a:b].encode("utf-8", "surrogatepass"), seed) for seed, a, b in entries]
                lids += [lid] * len(entries)
                sketches += [own] * len(entries)
                if len(keys) >= ROWS_OUT:
                    yield out()
                    keys, lids, sketches = [], [], []
            if keys:
                yield out()

    return enter


def _entry_keys(line: str, plan) -> list[int]:
    """The keys of _enter() for one line."""
    return _signed(xxhash.xxh64_intdigest(line[a:b].encode("utf-8", "surrogatepass"), seed) for seed, a, b in plan(len(line)))


def _rest_keys(key: int, line: str, head: int, tail: int, plan) -> list[int]:
    """Keys under entry `key` of what is left of a line without its ends."""
    rest, under = line[head : len(line) - tail], key.to_bytes(8, "little", signed=True)
    return _signed(xxhash.xxh64_intdigest(under + rest[a:b].encode("utf-8", "surrogatepass"), seed) for seed, a, b in plan(len(rest)))


def _signed(keys: Iterable[int]) -> list[int]:
    return [k - (k >> 63 << 64) for k in keys]


AGAIN = "key long, lid long, sketch long, cut long, chain array<long>"


def _enter_again(threshold: int):
    """Entries (key, lid, sketch, cut, chain) of what is left of lines without the ends that their run shares.

    `chain` tells how a run came about: the key of an entry, then head, tail and key of each time its lines were entered again.
    """
    plan = _planner(threshold, 0)
    names = ["key", "lid", "sketch", "cut", "chain"]
    kinds = [*[pa.int64()] * 4, pa.list_(pa.int64())]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    def enter(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            out: list[tuple] = []
            for key, lid, own, line, head, tail, chain in zip(*(c.to_pylist() for c in some.columns)):
                out += [(k, lid, own, head + tail, [*chain, head, tail, k]) for k in set(_rest_keys(key, line, head, tail, plan))]
                if len(out) >= ROWS_OUT:
                    yield batch(out)
                    out = []
            if out:
                yield batch(out)

    return enter


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)


def _shared(texts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(key, n, head, tail): characters that all lines of a run begin and end with, from the least and greatest of them."""
    for f in texts:
        heads = [len(os.path.commonprefix([x, y])) for x, y in zip(f["low"], f["high"])]
        tails = [len(os.path.commonprefix([x, y])) for x, y in zip(f["back_low"], f["back_high"])]
        tails = [min(t, least - h) for t, least, h in zip(tails, f["least"], heads)]
        yield pd.DataFrame({"key": f["key"], "n": f["n"], "head": pd.Series(heads, dtype="int64"), "tail": pd.Series(tails, dtype="int64")})


def _close_pairs(own: np.ndarray, bits: int, other: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of sketches that differ in at most `bits` bits, block by block: i < j, or i in `own` and j in `other`."""
    step = max(1, CELLS // max(1, len(own if other is None else other)))
    for at in range(0, len(own), step):
        if other is None:
            close = np.triu(np.bitwise_count(own[at : at + step, None] ^ own[None, at:]) <= bits, 1)
        else:
            close = np.bitwise_count(own[at : at + step, None] ^ other[None, :]) <= bits
        i, j = np.nonzero(close)
        if len(i):
            yield at + i, j + (at if other is None else 0)


def _meet(bits: int, most: int):
    """Of rows (key, lid, sketch), sorted by key, those whose sketch is close to another line's under the key.

    Of an entry with more than `most` lines all rows are given.
    """
    names = ["key", "lid", "sketch"]

    def batch(key, lids, own) -> pa.RecordBatch:
        keys = np.broadcast_to(key, len(lids))
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x).view(np.int64), pa.int64()) for x in (keys, lids, own)], names)

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, n, all_of_it = None, [], 0, False

        def close() -> Iterator[pa.RecordBatch]:
            if n > 1:
                lids, own = (np.concatenate(x) for x in zip(*held))
                # a line can be entered twice under a key
                lids, first = np.unique(lids, return_index=True)
                own = own[first]
                has = np.zeros(len(lids), dtype=bool)
                for i, j in _close_pairs(own, bits):
                    has[i] = has[j] = True
                if has.any():
                    yield batch(key, lids[has], own[has])

        for rows in batches:
            keys, lids, own = (rows.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(keys):
                continue
            own = own.astype(np.int64).view(np.uint64)
            bounds = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
            sizes = np.diff(bounds)
            # keys with two rows that lie inside the batch, all at once
            inside = np.ones(len(sizes), dtype=bool)
            inside[-1] = False
            inside[0] &= keys[0] != key
            two = bounds[:-1][inside & (sizes == 2)]
            near = two[(np.bitwise_count(own[two] ^ own[two + 1]) <= bits) & (lids[two] != lids[two + 1])]
            if len(near):
                both = np.stack([near, near + 1], axis=1).ravel()
                yield batch(keys[both], lids[both], own[both])
            for i in np.flatnonzero(~inside | (sizes > 2)).tolist():
                a, b = int(bounds[i]), int(bounds[i + 1])
                if keys[a] != key:
                    yield from close()
                    key, held, n, all_of_it = keys[a], [], 0, False
                if all_of_it:
                    yield batch(key, lids[a:b], own[a:b])
                    continue
                held.append((lids[a:b], own[a:b]))
                n += b - a
                if n > most:
                    for x, y in held:
                        yield batch(key, x, y)
                    held, n, all_of_it = [], 0, True
        yield from close()

    return meet


class _Lines:
    """The lines of a run: a spanning forest of their links, and how many links each has."""

    def __init__(self, lines: list[str], threshold: int, lesser: list[frozenset[int]]):
        self.lines, self.threshold, self.lesser = lines, threshold, lesser
        self.lengths = np.array(list(map(len, lines)))
        self.degree = np.zeros(len(lines), dtype=np.int64)
        self.edges: list[tuple[int, int]] = []
        self.parent = list(range(len(lines)))
        # the keys that most lines share, as bits: who has one in common meets elsewhere
        common = [k for k, n in Counter(k for keys in lesser for k in keys).most_common(65) if n > 1]
        self.all_in_mask = len(common) <= 64
        bit = {k: 1 << i for i, k in enumerate(common[:64])}
        self.mask = np.array([sum(bit.get(k, 0) for k in keys) for keys in lesser], dtype=np.uint64)
        # characters as numbers, where they do not take much room
        self.widest = int(self.lengths.max())
        self.codes = None
        if 2 < len(lines) and len(lines) * self.widest <= CELLS:
            self.codes = np.zeros((len(lines), self.widest), dtype=np.uint32)
            for i, line in enumerate(lines):
                self.codes[i, : len(line)] = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype="<u4")

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        """Verify the pairs of places i and j that belong to this run."""
        mine = (self.mask[i] & self.mask[j] == 0) & (i != j) & (np.abs(self.lengths[i] - self.lengths[j]) <= self.threshold)
        i, j = i[mine], j[mine]
        if not self.all_in_mask:
            apart = np.array([self.lesser[a].isdisjoint(self.lesser[b]) for a, b in zip(i.tolist(), j.tolist())], dtype=bool)
            i, j = i[apart], j[apart]
        step = max(1, CELLS // max(1, self.widest)) if self.codes is not None else ROWS_OUT
        for at in range(0, len(i), step):
            self._verify(i[at : at + step], j[at : at + step])

    def _verify(self, i: np.ndarray, j: np.ndarray) -> None:
        near = np.zeros(len(i), dtype=bool)
        if self.codes is not None:
            # lines of one length that differ in few places need no search for the best alignment
            same = self.lengths[i] == self.lengths[j]
            near[same] = (self.codes[i[same]] != self.codes[j[same]]).sum(axis=1) <= self.threshold
        for at in np.flatnonzero(~near).tolist():
            near[at] = within(self.lines[i[at]], self.lines[j[at]], self.threshold)
        i, j = i[near], j[near]
        self.degree += np.bincount(i, minlength=len(self.lines)) + np.bincount(j, minlength=len(self.lines))
        roots = np.array(self.parent)
        while (up := roots[roots]).tolist() != roots.tolist():
            roots = up
        for a, b in zip(*(x[roots[i] != roots[j]].tolist() for x in (i, j))):
            if (u := self._root(a)) != (v := self._root(b)):
                self.parent[max(u, v)] = min(u, v)
                self.edges.append((a, b))

    def _root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x


LINKS = "a long, b long, n long"


def _verify_runs(threshold: int, least_chars: int):
    """Rows (run, side, lid, sketch, line, chain), sorted by run, to a spanning forest of their links and counts of links.

    Gives (a, b, 0) for an edge of the forest, and (a, -1, n) for a line with n links. Lines
    of side 0 are held against each other, those of side 1 against those of side 2. A pair
    whose lines share a lesser key than the run's is left to the entry of that key, so each
    link is verified and counted once in all.
    """
    first, again = _planner(threshold, least_chars), _planner(threshold, 0)

    def lesser(line: str, chain: list[int]) -> frozenset[int]:
        """Keys the line shares with whoever meets it earlier, marked by how often lines had been entered."""
        found = [k << 3 for k in _entry_keys(line, first) if k < chain[0]]
        for level in range(1, len(chain) // 3 + 1):
            before, head, tail, key = chain[3 * level - 3 : 3 * level + 1]
            found += [k << 3 | level for k in _rest_keys(before, line, head, tail, again) if k < key]
        return frozenset(found)

    def links(held: dict[tuple[int, int], tuple], chain: list[int]) -> Iterator[pa.RecordBatch]:
        rows = {row[0]: row for row in held.values()}
        if len(rows) < 2:
            return
        lids = sorted(rows)
        place = {lid: i for i, lid in enumerate(lids)}
        sides = [np.array(sorted(place[lid] for side, lid in held if side == s), dtype=np.int64) for s in range(3)]
        sketches = np.array([rows[lid][1] for lid in lids], dtype=np.int64).view(np.uint64)
        met = _Lines([rows[lid][2] for lid in lids], threshold, [lesser(rows[lid][2], chain) for lid in lids])
        for one, two in ((sides[0], None), (sides[1], sides[2])):
            if len(one) and (two is None or len(two)):
                for i, j in _close_pairs(sketches[one], 2 * threshold, None if two is None else sketches[two]):
                    met.link(one[i], (one if two is None else two)[j])
        found = [(lids[min(a, b)], lids[max(a, b)], 0) for a, b in met.edges]
        found += [(lids[i], -1, int(met.degree[i])) for i in np.flatnonzero(met.degree)]
        for at in range(0, len(found), ROWS_OUT):
            yield _batch(found[at : at + ROWS_OUT], ["a", "b", "n"])

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, held, chain = None, {}, []
        for batch in batches:
            for own_run, side, lid, own, line, own_chain in zip(*(c.to_pylist() for c in batch.columns)):
                if own_run != run:
                    yield from links(held, chain)
                    run, held, chain = own_run, {}, own_chain
                held[side, lid] = (lid, own, line)
        yield from links(held, chain)

    return verify


def _in_blocks(large: DataFrame, most_together: int) -> DataFrame:
    """(run, side, lid, sketch, chain): every two blocks of the lines under an entry as a run."""
    blocks = F.ceil(F.col("n") / most_together).cast("long")
    rows = large.select("key", "lid", "sketch", "chain", blocks.alias("blocks"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("lid"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    return rows.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("run"), side.alias("side"), "lid", "sketch", "chain")


def _runs(met: DataFrame, lines: DataFrame, threshold: int, most_together: int) -> DataFrame:
    """(run, side, lid, sketch, chain): the lines that meet under entries (key, lid, sketch), in runs of about 2 * `most_together` lines at most.

    Up to `most_together` lines meet under the entry itself. Beyond, they are entered again
    without the ends that all of them share; where that takes nothing more off, blocks meet.
    """
    left = met.select("key", "lid", "sketch", F.lit(0).cast("long").alias("cut"), F.array("key").alias("chain"))
    runs = []
    for turn in range(ROUNDS + 1):
        sizes = staging.staged(left.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > most_together), "hot-entries")
        if sizes.isEmpty():
            runs.append(left.select(F.col("key").alias("run"), F.lit(0).alias("side"), "lid", "sketch", "chain"))
            break
        small = left.join(sizes, "key", "left_anti")
        runs.append(small.select(F.col("key").alias("run"), F.lit(0).alias("side"), "lid", "sketch", "chain"))
        sized = left.join(sizes, "key")
        if turn == ROUNDS:
            runs.append(_in_blocks(sized, most_together))
            break
        large = staging.staged(sized.drop("n").join(lines, "lid"), "hot-lines")
        back = F.reverse("line")
        ends = large.groupBy("key").agg(
            F.count("*").alias("n"), F.min(F.char_length("line")).alias("least"),
            F.min("line").alias("low"), F.max("line").alias("high"), F.min(back).alias("back_low"), F.max(back).alias("back_high"),
        )
        ends = staging.staged(ends.mapInPandas(_shared, "key long, n long, head long, tail long"), "hot-ends")
        ended = large.join(ends, "key")
        shorter = F.col("head") + F.col("tail") > F.col("cut")
        runs.append(_in_blocks(ended.where(~shorter), most_together))
        again = ended.where(shorter).select("key", "lid", "sketch", "line", "head", "tail", "chain")
        left = staging.staged(again.mapInArrow(_enter_again(threshold), AGAIN), "entered-again")
    return reduce(DataFrame.unionByName, runs)


def _links_of_entries(met: DataFrame, lines: DataFrame, threshold: int, least_chars: int, most_together: int) -> DataFrame:
    """LINKS of the lines that meet under entries (key, lid, sketch)."""
    runs = _runs(met, lines, threshold, most_together).join(lines, "lid").select("run", "side", "lid", "sketch", "line", "chain")
    return runs.repartition("run").sortWithinPartitions("run").mapInArrow(_verify_runs(threshold, least_chars), LINKS)


def edit_links(lines: DataFrame, threshold: int, least_chars: int, most_together: int = MOST_TOGETHER) -> tuple[DataFrame, DataFrame]:
    """Of staged distinct lines (lid, line): links (a, b) with the components of all pairs within
    `threshold` edits, and (lid, links), how many such pairs each line is in."""
    entries = lines.mapInArrow(_enter(threshold, least_chars), ENTRIES)
    met = entries.repartition("key").sortWithinPartitions("key").mapInArrow(_meet(2 * threshold, most_together), ENTRIES)
    met = staging.staged(met, "line-candidates")
    found = staging.staged(_links_of_entries(met, lines, threshold, least_chars, most_together), "line-links")
    degrees = found.where("b = -1").groupBy(F.col("a").alias("lid")).agg(F.sum("n").alias("links"))
    return found.where("b >= 0").select("a", "b"), degrees


def line_table(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(at, key, line_no, line): the normalised lines of every row; a null or empty text is one empty line."""
    rows = df.select(F.monotonically_increasing_id().alias("at"), F.col(key).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    lines = rows.select("at", "id", F.posexplode(F.split(normalised(F.col("text")), "\n")).alias("line_no", "raw"))
    return lines.select("at", "id", "line_no", F.trim("raw").alias("line"))


def _identity(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("line"), line).alias("h2")]


def dedup_lines(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, least_chars: int = LEAST_CHARS, most_together: int = MOST_TOGETHER) -> DataFrame:
    """One row for each line of `df`: key, line_no, class_key, class_line, links, kept.

    Lines link when their normalised texts are within `threshold` edits and both have at
    least `least_chars` characters; shorter ones, empty lines included, are in a class only
    with lines equal to them. A class is a component of these links; its representative, and
    the line that is kept, is the first by (key, row, line number), null keys last. `links`
    counts the different texts a line's text is linked to. `most_together` says from how many
    lines on an entry is split; it leaves nothing out. Repeated rows and keys are rows of
    their own. Equality of normalised lines is that of two 64-bit hashes. Other columns are
    ignored; a key that is named like a column of the result is returned as `key`.
    """
    if threshold < 0 or least_chars <= 3 * threshold:
        raise ValueError("least_chars must be above three times the threshold")
    lines = line_table(df, key, text)
    seen = staging.staged(lines.select("at", "id", "line_no", *_identity(F.col("line"))), "line-places")
    distinct = lines.groupBy("line").agg(F.lit(1).alias("one")).select(F.monotonically_increasing_id().alias("lid"), "line", *_identity(F.col("line")))
    distinct = staging.staged(distinct, "distinct-lines")
    long_ones = distinct.where(F.char_length("line") >= least_chars).select("lid", "line")
    links, degree = edit_links(long_ones, threshold, least_chars, most_together)
    roots = components(links).withColumnRenamed("node", "lid")
    texts_of = distinct.select("lid", "h1", "h2").join(roots, "lid", "left").join(degree, "lid", "left")
    texts_of = staging.staged(texts_of.select("h1", "h2", F.coalesce("root", "lid").alias("root"), F.coalesce("links", F.lit(0)).alias("links")), "line-classes")
    placed = staging.staged(seen.join(texts_of, ["h1", "h2"]).select("at", "id", "line_no", "root", "links"), "lines-in-classes")
    order = F.struct(F.col("id").isNull().alias("missing"), F.col("id"), F.col("at"), F.col("line_no"))
    first = staging.staged(placed.groupBy("root").agg(F.min(order).alias("first")), "first-lines")
    return placed.join(first, "root").select(
        F.col("id").alias(staging.key_name(key, ("row_no", "line_no", "class_key", "class_line", "links", "kept"))),
        F.col("at").alias("row_no"),
        "line_no",
        F.col("first.id").alias("class_key"),
        F.col("first.line_no").alias("class_line"),
        "links",
        ((F.col("first.at") == F.col("at")) & (F.col("first.line_no") == F.col("line_no"))).alias("kept"),
    )


def kept_texts(df: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """(key, text): every row with the lines that dedup_lines() keeps, as they were written."""
    rows = staging.staged(df.select(F.col(key).alias("id"), F.col(text).alias("text")), "line-documents")
    made = dedup_lines(rows, "id", "text", **how).where("kept").groupBy("row_no").agg(F.sort_array(F.collect_list("line_no")).alias("keep"))
    numbered = rows.select(F.monotonically_increasing_id().alias("row_no"), "id", F.split(F.coalesce("text", F.lit("")), "\n").alias("lines"))
    kept = F.transform(F.coalesce("keep", F.array().cast("array<int>")), lambda i: F.get("lines", i))
    return numbered.join(made, "row_no", "left").select(F.col("id").alias(key), F.array_join(kept, "\n").alias(text))

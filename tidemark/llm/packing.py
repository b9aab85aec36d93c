"""Best-fit packing of token pieces, planned over the histogram of their lengths.

A plan needs counts only: there are at most `capacity` lengths, however many documents.
Best fit, longest first, then places all pieces of a length in bulk, and each bulk is a run
of slots. A piece takes the slot of its rank among the pieces of its length; ranks come from
counters of the tasks that tokenised plus the counts of the tasks before, so no length,
however common, is gathered anywhere and no piece is sorted.
"""

from __future__ import annotations

import base64
import bisect
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import staging

CAPACITY = 1024
END_ID = 2
FLUSH_BYTES = 4 << 20
MOST_BROADCAST = 1 << 19  # rows of three numbers: 24 MB

PIECES = "piece int, start long, length long, ids binary, part int, rank long"
SPECIAL = "<|endoftext|>"


class Encoder:
    """Ids of a byte-level BPE given as `json`, and as `ranks` of the same vocabulary.

    The ranks give the same ids several times faster. Texts that hold a special token's
    string, and texts that the faster library refuses, go to the slower one.
    """

    def __init__(self, json: str, ranks: str):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.json = json
        self.slow = None
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})

    def reference(self, text: str) -> np.ndarray:
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.json)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def ids(self, text: str) -> np.ndarray:
        if SPECIAL in text:
            return self.reference(text)
        try:
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
        except (ValueError, RuntimeError):
            return self.reference(text)


@lru_cache(maxsize=2)
def encoder(json: str, ranks: str) -> Encoder:
    return Encoder(json, ranks)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; only the first may be shorter than the capacity."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def tokenised(df: DataFrame, json: str, ranks: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of every document: key, piece, start, length, ids (little-endian unsigned 32-bit), part, rank.

    A document is the ids of its text (null: empty) and the end id, so an empty text is one
    piece of one id. `rank` counts the pieces of a length that task `part` has seen. A key
    that is named like another column here or in place() is returned as `key`.
    """
    kind = df.schema[key].dataType
    named = staging.key_name(key, ("piece", "start", "length", "ids", "part", "rank", "sequence_id", "offset", "runs", "own", "base"))

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        made: list[tuple] = []
        held = 0
        own = encoder(json, ranks)
        end = np.array([end_id], dtype="<u4")
        names = [named, "piece", "start", "length", "ids", "part", "rank"]
        wire = None

        def flush() -> pa.RecordBatch:
            columns = list(zip(*made)) if made else [()] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, [wire, pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()])], names)

        for batch in batches:
            wire = batch.schema.field(0).type
            for k, words in zip(batch.column(0), batch.column(1)):
                words = words.as_py()
                ids = np.concatenate([own.ids(words), end]) if words else end
                for n, (start, length) in enumerate(cut(len(ids), capacity)):
                    made.append((k.as_py(), n, start, length, ids[start : start + length].tobytes(), part, seen[length]))
                    seen[length] += 1
                    held += 4 * length
                if held >= FLUSH_BYTES:
                    yield flush()
                    made.clear()
                    held = 0
        if made:
            yield flush()

    schema = T.StructType([T.StructField(named, kind), *T.StructType.fromDDL(PIECES)])
    return staging.staged(df.select(key, text).mapInArrow(split, schema), "pieces")


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, per sequence, first sequence, offset) of best fit, longest first.

    Rank k of a run lies in sequence first + (k - first rank) // per, behind
    (k - first rank) % per others. Sequences with the same free space are handled together:
    the tightest that fits stays the tightest while it fits another of the same length.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free space: (first sequence, how many)
    spaces: list[int] = []
    opened = 0

    def give(space: int, first: int, n: int) -> None:
        if space and n:
            if not free[space]:
                bisect.insort(spaces, space)
            free[space].append((first, n))

    def tightest(length: int) -> int | None:
        i = bisect.bisect_left(spaces, length)
        return spaces[i] if i < len(spaces) else None

    for length in sorted((n for n in counts if counts[n]), reverse=True):
        left, rank = counts[length], 0
        while left:
            space = tightest(length)
            if space is None:
                space = capacity
                n = -(-left // (space // length))
                first = opened
                opened += n
            else:
                first, n = free[space].pop()
                if not free[space]:
                    spaces.remove(space)
            per = space // length
            full = min(n, left // per)
            if full:
                runs.append((length, rank, per, first, capacity - space))
                give(space - per * length, first, full)
                rank, left, first, n = rank + full * per, left - full * per, first + full, n - full
            if n and 0 < left < per:
                runs.append((length, rank, left, first, capacity - space))
                give(space - left * length, first, 1)
                rank, left, first, n = rank + left, 0, first + 1, n - 1
            give(space, first, n)
    return runs


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of staged tokenised() with sequence_id and offset instead of part and rank.

    The plan is at most a few runs for each length and goes to every task.
    """
    spark = pieces.sparkSession
    counted = staging.staged(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most one row for each length
    runs = spark.createDataFrame(best_fit(counts, capacity), "length long, rank long, per long, first long, at long")
    plan = runs.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("rank", "per", "first", "at"))).alias("runs"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = staging.staged(counted.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "piece-ranks")
    # a row for each task and length grows with the input: beyond a bound it is no broadcast
    base = F.broadcast(base) if base.count() <= MOST_BROADCAST else base.hint("merge")
    ranked = pieces.join(base, ["part", "length"]).withColumn("rank", F.col("base") + F.col("rank")).join(F.broadcast(plan), "length")
    own = F.element_at(F.filter("runs", lambda r: r["rank"] <= F.col("rank")), -1)
    k = F.col("rank") - F.col("own.rank")
    kept = [c for c in pieces.columns if c not in ("part", "rank")]
    return ranked.withColumn("own", own).select(
        *kept,
        (F.col("own.first") + F.floor(k / F.col("own.per"))).alias("sequence_id"),
        (F.col("own.at") + k % F.col("own.per") * F.col("length")).alias("offset"),
    )


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the packed sequences, each at most one capacity long."""
    rows = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("pieces"), F.sum("length").alias("length"))
    return rows.select("sequence_id", "length", F.aggregate("pieces.ids", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"))

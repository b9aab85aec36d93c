"""SimHash fingerprints and their components by multi-index hashing.

Of two fingerprints that differ in at most r bits, cut into r // 2 + 1 segments, one segment
differs in at most one bit. So each fingerprint is entered under every segment's value and
under the values next to it, and only fingerprints that meet under a value are compared in
full. Of two neighbouring values one has the bit that the other lacks, so it is enough to
enter values with one bit cleared.

Fingerprints under one value are compared inside a task, and only a spanning forest of what
links is kept: a group of near copies gives as many rows as it has fingerprints, not their
pairs. A value with more fingerprints than one comparison may hold is entered anew by the
same rule under segments of the remaining bits, so all of its links are found as well.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.llm import staging
from tidemark.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
MOST_TOGETHER = 4096
TALLY_ROWS = 1 << 15
COMPARE_CELLS = 1 << 22


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The signed 64-bit SimHash of a text in UTF-8.

    A-Z are lower-cased; words are [^\\x20\\x09-\\x0D]+, which is how bytes split. Shingles count
    as often as they occur. Fewer words than a shingle has make one shingle; no words and null give 0.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        shingle = len(words)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    firsts, lasts = (ends - lengths)[: len(words) - shingle + 1], ends[shingle - 1 :]
    tally = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(firsts), TALLY_ROWS):
        spans = zip(firsts[at : at + TALLY_ROWS].tolist(), lasts[at : at + TALLY_ROWS].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        tally += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(tally * 2 > len(firsts), bitorder="little").view("<i8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """fingerprint() of a text column."""

    @pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return of(text.cast("binary"))


def _segments(width: int, first: int, max_bits: int) -> list[tuple[int, int, int]]:
    """(first bit, bits, bits that may differ) of the segments of `width` bits from bit `first`."""
    n = min(max_bits // 2 + 1, width)
    each, spare = divmod(max_bits, n)
    edges = [first + width * i // n for i in range(n + 1)]
    return [(a, b - a, each if i <= spare else each - 1) for i, (a, b) in enumerate(zip(edges, edges[1:])) if i <= spare or each]


def _entries(fp: Column, segment: tuple[int, int, int]) -> Column:
    """The segment's value and, where a bit may differ, the values with one set bit cleared."""
    first, bits, differ = segment
    mask = (1 << bits) - 1
    value = F.shiftrightunsigned(fp, first).bitwiseAND(F.lit(mask if mask < 1 << 63 else -1))
    if not differ:
        return F.array(value)
    cleared = F.transform(F.sequence(F.lit(0), F.lit(bits - 1)), lambda b: F.when(F.getbit(value, b) == 1, value.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), b))))
    return F.concat(F.array(value), F.filter(cleared, lambda v: v.isNotNull()))


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of the links among distinct fingerprints, as pairs of arrays."""
    links, rest = [], fps
    while len(rest) > 1:
        frontier, rest = rest[:1], rest[1:]
        while len(frontier) and len(rest):
            step = max(1, COMPARE_CELLS // len(rest))
            near, far = frontier[:step], frontier[step:]
            close = np.bitwise_count(near[:, None] ^ rest[None, :]) <= max_bits
            hit = close.any(axis=0)
            links.append((near[close.argmax(axis=0)[hit]], rest[hit]))
            frontier, rest = np.concatenate([far, rest[hit]]), rest[~hit]
    return links


def _linker(max_bits: int, most: int | None):
    """Links among rows (z, value, fp) sorted by (z, value): (a, b, z, value), b null for rows put off."""
    names = ["a", "b", "z", "value"]

    def batch(a, b, z, value) -> pa.RecordBatch:
        put = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b, pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), put, pa.array(np.broadcast_to(z, len(a)), pa.int32()), pa.array(np.broadcast_to(value, len(a)), pa.int64())], names)

    def link(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_n, key, putting_off = [], 0, None, False

        def close() -> Iterator[pa.RecordBatch]:
            if held_n > 1:
                found = _forest(np.unique(np.concatenate(held)), max_bits)
                if found:
                    yield batch(np.concatenate([a for a, _ in found]).view(np.int64), np.concatenate([b for _, b in found]).view(np.int64), 0, 0)

        for rows in batches:
            z, value, fp = (rows.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(z):
                continue
            fp = fp.astype(np.int64).view(np.uint64)
            edges = np.flatnonzero((np.diff(z) != 0) | (np.diff(value) != 0)) + 1
            bounds = np.concatenate([[0], edges, [len(z)]])
            if key == (z[0], value[0]):
                keep = np.flatnonzero(np.diff(bounds) > 1).tolist()
                keep = sorted({0, len(bounds) - 2, *keep})
            else:
                keep = sorted({len(bounds) - 2, *np.flatnonzero(np.diff(bounds) > 1).tolist()})
            for i in keep:
                a, b = int(bounds[i]), int(bounds[i + 1])
                if key != (z[a], value[a]):
                    yield from close()
                    held, held_n, key, putting_off = [], 0, (z[a], value[a]), False
                if putting_off:
                    yield batch(fp[a:b].view(np.int64), None, *key)
                    continue
                held.append(fp[a:b])
                held_n += b - a
                if most is not None and held_n > most:
                    yield batch(np.concatenate(held).view(np.int64), None, *key)
                    held, held_n, putting_off = [], 0, True
        yield from close()

    return link


def _turned(fp: Column, n: int) -> Column:
    """The bits rotated to the right by n."""
    return F.shiftleft(fp, 64 - n).bitwiseOR(F.shiftrightunsigned(fp, n)) if n else fp


LINKS = "a long, b long, z int, value long"


def links(fps: DataFrame, max_bits: int = MAX_BITS, most_together: int | None = MOST_TOGETHER) -> DataFrame:
    """(a, b): links among distinct fingerprints `fp` that have the same components as all pairs within max_bits.

    `most_together` only says where a value is split further; it leaves nothing out. Values
    that are split meet again under segments of the other bits, where at most the
    fingerprints that agree in both segments, and their neighbours, are in one task.
    """
    if not 0 <= max_bits < 32:
        raise ValueError("max_bits must be from 0 to 31")
    fp = F.col("fp")
    firsts = _segments(64, 0, max_bits)
    if len(firsts) == 1:
        most_together = None  # a value of all 64 bits has itself and its 64 neighbours
    entries = F.array(*[F.struct(F.lit(z).alias("z"), _entries(fp, s).alias("values")) for z, s in enumerate(firsts)])
    rows = fps.select("fp", F.explode(entries).alias("e")).select("fp", F.col("e.z").alias("z"), F.explode("e.values").alias("value"))
    met = rows.select("z", "value", "fp").repartition("z", "value").sortWithinPartitions("z", "value")
    found = staging.staged(met.mapInArrow(_linker(max_bits, most_together), LINKS), "links")
    put_off = found.where("b is null")
    if put_off.isEmpty():
        return found.select("a", "b")
    # under one segment's value: the same rule over the other bits, turned into the low places
    done = found.where("b is not null").select("a", "b")
    for z, (first, bits, _) in enumerate(firsts):
        turned = _turned(F.col("a"), (first + bits) % 64)
        rest = _segments(64 - bits, 0, max_bits)
        again = F.array(*[F.struct(F.lit(i).alias("y"), _entries(F.col("turned"), s).alias("values")) for i, s in enumerate(rest)])
        wide = put_off.where(F.col("z") == z).select(F.col("a").alias("fp"), "value", turned.alias("turned"))
        wide = wide.select("fp", "value", F.explode(again).alias("e")).select("fp", "value", F.col("e.y").alias("y"), F.explode("e.values").alias("other"))
        keyed = wide.select("y", F.struct("value", "other").alias("key"), "fp")
        numbered = keyed.select("y", F.xxhash64("y", "key").alias("value"), "fp")
        second = numbered.repartition("y", "value").sortWithinPartitions("y", "value")
        done = done.unionByName(staging.staged(second.mapInArrow(_linker(max_bits, None), LINKS), f"links-{z}").select("a", "b"))
    return done


def simhash_groups(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS, keep_text: bool = True) -> DataFrame:
    """Every row of `df` with fingerprint (16 hex digits), component_id and kept.

    Fingerprints link when they differ in at most `max_bits` bits; component_id is the
    smallest key that can be reached, the row's own included, and null only where every
    row of the component lacks a key. One row of each component is kept: the one with that
    key, and one of them where keys repeat. Null and empty texts have fingerprint zero and
    link like any other. Columns of `df` with the names of the result are replaced.
    """
    columns = [c for c in df.columns if keep_text or c != text]
    rows = df.select(F.struct(*[F.col(c) for c in columns]).alias("row"), F.col(key).alias("id"), fingerprints(F.col(text), shingle).alias("fp"), F.monotonically_increasing_id().alias("at"))
    rows = staging.staged(rows, "fingerprints")
    distinct = staging.staged(rows.select("fp").distinct(), "distinct-fingerprints")
    roots = components(links(distinct, max_bits)).withColumnRenamed("node", "fp")
    slim = rows.select("at", "id", "fp")
    rooted = staging.staged(slim.join(roots, "fp", "left").select("at", "id", F.coalesce("root", "fp").alias("root")), "rooted")
    order = F.struct(F.col("id").isNull().alias("missing"), F.col("id"), F.col("at"))
    leaders = staging.staged(rooted.groupBy("root").agg(F.min(order).alias("first")), "leaders")
    grouped = rooted.join(leaders, "root").select("at", "first")
    made = {
        "fingerprint": F.lpad(F.lower(F.hex("fp")), 16, "0"),
        "component_id": F.col("first.id"),
        "kept": F.col("first.at") == F.col("at"),
    }
    return staging.replacing(rows.drop("id").join(grouped, "at"), "row", made, columns)

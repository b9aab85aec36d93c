"""Exact deduplication by deterministic block naming.

A normalised text is cut into blocks of fixed size. The distinct blocks are sorted and
numbered; then adjacent names of a document are paired, the distinct pairs sorted and
numbered, and so on until every document has one name. Two documents have the same name on
the same level exactly when their texts are the same: no hash decides.

Contents travel once. Blocks are sorted by (64-bit hash, content), so a hash that stands for
one content, which a count over the distinct blocks shows, names its block without moving
it again. Only where a hash stands for several contents are these compared and numbered.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import staging

BLOCK_BYTES = 8192


def normalised(text: Column) -> Column:
    """Each run of [\\x20\\x09-\\x0D] as one space; null as empty.

    A single space is left alone, which is the same and saves most of the work.
    """
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def _once(value: Column, make: Callable[[Column], Column]) -> Column:
    """make(value) with `value` computed once, also where make() uses it inside a lambda."""
    return F.transform(F.array(value), make)[0]


def _blocks(norm: Column, size: int) -> Column:
    """The UTF-8 bytes in blocks; one empty block for an empty text."""

    def cut(raw: Column) -> Column:
        last = F.greatest(F.octet_length(raw) - 1, F.lit(0))
        return F.transform(F.sequence(F.lit(0), F.floor(last / size).cast("int")), lambda i: F.substring(raw, i * size + 1, F.lit(size)))

    return _once(norm.cast("binary"), cut)


def _distinct_blocks(rows: DataFrame, norm: Column, size: int, hashed: Callable[[Column], Column]) -> DataFrame:
    return rows.select(F.explode(_blocks(norm, size)).alias("block")).groupBy(hashed(F.col("block")).alias("hash"), "block").agg(F.lit(1).alias("one"))


def name_documents(rows: DataFrame, norm: Column, block_bytes: int = BLOCK_BYTES, hashed: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(at, level, name) of staged rows (at, hashes); equal texts, and only these, share (level, name)."""
    contents = staging.staged(_distinct_blocks(rows, norm, block_bytes, hashed).groupBy("hash").agg(F.count("*").cast("int").alias("n")), "block-hashes")
    names = staging.sorted_names(contents.select("hash", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("tie")), ["hash", "tie"], "block-names")
    shared = contents.where("n > 1").select("hash")
    if shared.isEmpty():
        letters = rows.select("at", F.size("hashes").alias("k"), F.posexplode("hashes").alias("pos", "hash")).withColumn("tie", F.lit(0))
    else:
        own = _distinct_blocks(rows, norm, block_bytes, hashed).join(shared, "hash", "left_semi").groupBy("hash").agg(F.array_sort(F.collect_set("block")).alias("all"))
        ties = own.select("hash", F.posexplode("all").alias("tie", "block"))
        whole = rows.select("at", F.size("hashes").alias("k"), F.posexplode(_blocks(norm, block_bytes)).alias("pos", "block"))
        letters = whole.withColumn("hash", hashed(F.col("block"))).join(ties, ["hash", "block"], "left")
        letters = letters.select("at", "k", "pos", "hash", F.coalesce("tie", F.lit(0)).alias("tie"))
    current = staging.staged(letters.join(names, ["hash", "tie"]).select("at", "k", "pos", "name"), "names-0")
    done = current.where("k = 1").select("at", F.lit(0).alias("level"), "name")
    level = 0
    # a level halves the number of names of a document, so the longest text sets the number of rounds
    while not (rest := current.where("k > 1")).isEmpty():
        level += 1
        pairs = rest.groupBy("at", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
            F.ceil(F.first("k") / 2).cast("int").alias("k"),
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
        )
        pairs = staging.staged(pairs, f"pairs-{level}")
        names = staging.sorted_names(pairs, ["a", "b"], f"pair-names-{level}")
        current = staging.staged(pairs.join(names, ["a", "b"]).select("at", "k", "pos", "name"), f"names-{level}")
        done = done.unionByName(current.where("k = 1").select("at", F.lit(level).alias("level"), "name"))
    return done


def exact_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES, hashed: Callable[[Column], Column] = F.xxhash64, keep_text: bool = True) -> DataFrame:
    """Every row of `df` with keep_id, group_size, kept and text_sha256.

    Texts are equal when they are after normalised(). Of equal texts the row with the
    smallest key stays; a null key comes last, and of repeated keys one row stays. Null
    texts count as empty, and all empty texts are one group. Columns of `df` with the
    names of the result are replaced; an empty table gives an empty result. With
    `keep_text` false the text column is left out of the result.
    """
    norm = normalised(F.col(f"row.{text}"))
    read_once = _once(normalised(F.col(text)), lambda n: F.struct(F.sha2(n.cast("binary"), 256).alias("sha"), F.transform(_blocks(n, block_bytes), lambda b: hashed(b)).alias("hashes")))
    numbered = df.select(F.monotonically_increasing_id().alias("at"), F.struct("*").alias("row"), read_once.alias("once"))
    rows = staging.staged(numbered.select("at", "row", "once.sha", "once.hashes"), "documents")
    names = name_documents(rows, norm, block_bytes, hashed)
    columns = [c for c in df.columns if keep_text or c != text]
    slim = rows.select("at", F.struct(*[F.col("row")[c].alias(c) for c in columns]).alias("row"), F.col(f"row.{key}").alias("id"), "sha")
    named = staging.staged(rows.select("at", F.col(f"row.{key}").alias("id")).join(names, "at"), "named")
    order = F.struct(F.col("id").isNull().alias("missing"), F.col("id"), F.col("at"))
    # written first: a large group then meets its row in a join whose large partitions Spark splits
    groups = staging.staged(named.groupBy("level", "name").agg(F.min(order).alias("first"), F.count("*").alias("n")), "groups")
    joined = slim.join(named.join(groups, ["level", "name"]).select("at", "first", "n"), "at")
    made = {
        "keep_id": F.col("first.id"),
        "group_size": F.col("n"),
        "kept": F.col("first.at") == F.col("at"),
        "text_sha256": F.col("sha"),
    }
    return staging.replacing(joined, "row", made, columns)

"""How filters interact: what each removes in every order, and its Shapley share.

With k filters there are k! orders but only 2**k states, the sets of filters applied so far.
An edge of this lattice applies one more filter to a state and removes the documents that
fail it and nothing in the state. Counting paths forward from the empty state and backward
from the full one tells how many orders use an edge, so the Shapley sum of a filter is the
sum of its edges' removals weighted by both counts, and the steps of every order are read
from the same edges.

Documents enter as counts of classes: rows alike in part, failed filters and flags. From
there on nothing grows with the table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOST_FILTERS = 6  # 720 orders


def path_counts(k: int) -> tuple[list[int], list[int]]:
    """For every state (a bit set of k filters) the orders that reach it and the orders that leave it to the full state."""
    full = (1 << k) - 1
    reach, leave = [0] * (full + 1), [0] * (full + 1)
    reach[0] = leave[full] = 1
    for state in range(full + 1):
        for f in range(k):
            if not state >> f & 1:
                reach[state | 1 << f] += reach[state]
    for state in range(full, -1, -1):
        for f in range(k):
            if not state >> f & 1:
                leave[state] += leave[state | 1 << f]
    return reach, leave


def edges(k: int) -> list[tuple[int, int, int]]:
    """(state, filter, orders that use the edge)."""
    reach, leave = path_counts(k)
    return [(s, f, reach[s] * leave[s | 1 << f]) for s in range(1 << k) for f in range(k) if not s >> f & 1]


def steps(names: Sequence[str]) -> list[tuple[str, int, int, int]]:
    """(filter_order, step, state before, filter) of every order."""
    out = []
    for order in permutations(range(len(names))):
        state = 0
        for n, f in enumerate(order):
            out.append(("".join(names[i] for i in order), n + 1, state, f))
            state |= 1 << f
    return out


def repeats_earlier(rows: DataFrame, key: str, same: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(same..., by..., repeats, n): rows counted by whether a row of a smaller key has equal `same` columns.

    No row is joined to its group: rows are counted by group and `by` columns, with the
    least key and the number of rows that have it, and only these counts meet. A row
    without a key is in no order with others: it repeats nothing and nothing repeats it.
    """
    keyed = rows.groupBy(key, *same, *by).agg(F.count("*").alias("n"))
    counted = keyed.groupBy(*same, *by).agg(
        F.sum(F.when(F.col(key).isNotNull(), F.col("n"))).alias("n_keyed"),
        F.sum(F.when(F.col(key).isNull(), F.col("n"))).alias("n_lost"),
        F.min(key).alias("least"),
        F.min_by("n", F.col(key)).alias("n_least"),
    )
    whole = Window.partitionBy(*same)
    first = F.when(F.col("least") == F.min("least").over(whole), F.col("n_least")).otherwise(0)
    split = counted.withColumn("n_first", F.when(F.col("least").isNull(), 0).otherwise(first))
    no = F.col("n_first") + F.coalesce("n_lost", F.lit(0))
    yes = F.coalesce("n_keyed", F.lit(0)) - F.col("n_first")
    both = F.array(F.struct(F.lit(False).alias("repeats"), no.alias("n")), F.struct(F.lit(True).alias("repeats"), yes.alias("n")))
    return split.select(*same, *by, F.inline(both)).where("n > 0")


def failed(conditions: Mapping[str, Column]) -> Column:
    """The bit set of the filters a row fails, in the order of the mapping; an unknown condition is not failed."""
    return reduce(Column.bitwiseOR, [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions.values())], F.lit(0))


def audit(classes: DataFrame, names: Sequence[str], flags: Sequence[str] = ()) -> DataFrame:
    """One row for each part, order and step of the filters `names`.

    `classes` has part, mask (bits in the order of the names), n and a boolean for each flag.
    Columns: part, filter_order, step, kept, removed, redundant, unique_fails, a count of
    removed rows `<flag>_lost` for each flag, and shapley: what the filter removes, summed
    over all orders. Parts without rows do not appear; a null flag is no flag.
    """
    k = len(names)
    if not 0 < k <= MOST_FILTERS or len(set(names)) != k:
        raise ValueError(f"from 1 to {MOST_FILTERS} different filters")
    spark = classes.sparkSession
    counts = classes.groupBy("part", "mask").agg(F.sum("n").alias("n"), *[F.sum(F.when(F.col(f), F.col("n")).otherwise(0)).alias(f"n_{f}") for f in flags])
    # a part has 2**k masks at most, and each meets the k * 2**(k - 1) edges
    lattice = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"), F.lit(w).cast("long").alias("orders")) for s, f, w in edges(k)])
    met = counts.select("*", F.inline(lattice))
    fails = F.col("mask").bitwiseAND(F.call_function("shiftleft", F.lit(1), F.col("filter"))) != 0
    before = F.col("mask").bitwiseAND(F.col("state")) != 0
    only = F.col("mask") == F.call_function("shiftleft", F.lit(1), F.col("filter"))

    def total(when: Column, n: str = "n") -> Column:
        return F.sum(F.when(when, F.col(n)).otherwise(0))

    edge = met.groupBy("part", "state", "filter", "orders").agg(
        total(~before & ~fails).alias("kept"),
        total(~before & fails).alias("removed"),
        total(before & fails).alias("redundant"),
        total(only).alias("unique_fails"),
        *[total(~before & fails, f"n_{f}").alias(f"{f}_lost") for f in flags],
    )
    share = F.sum(F.col("removed") * F.col("orders")).over(Window.partitionBy("part", "filter"))
    # k! orders of k steps, whatever the table
    plan = spark.createDataFrame(steps(names), "filter_order string, step int, state int, filter int")
    every = edge.withColumn("shapley", share).join(F.broadcast(plan), ["state", "filter"])
    return every.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", *[f"{f}_lost" for f in flags], "shapley")


WORD_BREAK = r"[\x20\x09-\x0D]+"


def quality_conditions(text: Column) -> dict[str, Column]:
    """The filters on a text alone, true where it fails; null is empty. E (a repeated text) needs the table."""
    words = F.filter(F.split(text, WORD_BREAK), lambda w: w != "")
    n = F.size(words)
    return {
        "A": n < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.char_length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def quality_audit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """audit() of five filters over `df` by `part`, with good (quality = 1) and toxic (toxic = 1) losses.

    Null texts are empty and null parts are the empty part. A row whose key is null has no
    label and fails no E; rows of one key are rows of their own and do not repeat each
    other. Of repeated labels any 1 counts. Equality of texts is that of two 64-bit hashes and the length.
    Other columns are ignored, whatever their names.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    conditions = quality_conditions(F.col("body"))
    same = ["h1", "h2", "size"]
    rows = df.select(F.col(key).alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"), body.alias("body"))
    rows = rows.select("id", "part", F.xxhash64("body").alias("h1"), F.xxhash64(F.lit("second"), "body").alias("h2"), F.length("body").alias("size"), failed(conditions).alias("mask"))
    marks = labels.select(F.col(key).alias("id"), "quality", "toxic").groupBy("id").agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    # rows without a key match no label and would all meet in one task of the join
    no = F.lit(False)
    with_key = rows.where("id IS NOT NULL").join(marks.where("id IS NOT NULL AND (good OR toxic)"), "id", "left").withColumns({"good": F.coalesce("good", no), "toxic": F.coalesce("toxic", no)})
    labelled = with_key.unionByName(rows.where("id IS NULL").withColumns({"good": no, "toxic": no}))
    counted = repeats_earlier(labelled, "id", same, ["part", "mask", "good", "toxic"])
    names = [*conditions, "E"]
    whole = F.col("mask").bitwiseOR(F.when(F.col("repeats"), 1 << len(conditions)).otherwise(0))
    return audit(counted.select("part", whole.alias("mask"), "good", "toxic", "n"), names, ["good", "toxic"])

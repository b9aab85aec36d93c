"""Exact top-k inner products by block-at-a-time pruning.

Rows are numbered so that similar ones follow each other: by the nearest of a bounded
sample of rows, which are chained by distance. Ranges of these numbers are the blocks, and
each block keeps a forward index (its vectors as a matrix) and the largest and smallest
value of every term. The sum over the query's terms of what they can add at most bounds
every score in a block. A query visits blocks from the highest bound down and stops when
the bound falls below its k-th score.

A first pass scores each query in the one block of all that has its highest bound. The
k-th score there is a floor that the query takes along to every group of blocks, so no
group starts anew.

Queries go in chunks against groups of blocks, each pair in one task, so nothing passes
through the driver and a task holds one chunk and one group. Each pair gives at most k rows
for a query, which are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import staging

BLOCK = 512
GROUP_BLOCKS = 32
CHUNK = 1024
PIVOTS = 1024  # rows of the sample by which all rows are put in order

BLOCKS = "block long, rows int, bytes int, ids binary, terms binary, high binary, low binary"
LARGEST = np.iinfo(np.int64).max
HITS = "query_id long, vec_id long, score long"


def scaled(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component as whole numbers; null where a component is null or not finite."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(fine, F.transform(wide, lambda x: F.floor(x * scale).cast("long")))


def _matrix(vectors: list[np.ndarray]) -> np.ndarray:
    """Rows of one width; missing components add nothing."""
    dims = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), dims), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    """One row with the forward index of a block: its matrix in the narrowest whole numbers that hold it."""
    rows = rows.sort_values("vec_id", kind="stable")
    terms = _matrix(list(rows["terms"]))
    terms = terms.astype(np.result_type(np.min_scalar_type(terms.min(initial=-1)), np.min_scalar_type(-int(terms.max(initial=0)) - 1)))
    made = (rows["block"].iloc[0], len(rows), terms.itemsize, rows["vec_id"].to_numpy(np.int64).tobytes(), terms.tobytes(), terms.max(axis=0).tobytes(), terms.min(axis=0).tobytes())
    return pd.DataFrame([made], columns=["block", "rows", "bytes", "ids", "terms", "high", "low"])


def _chain(pivots: np.ndarray) -> np.ndarray:
    """Rows of a sample in an order in which each is the nearest to the one before that is left."""
    left, order = np.arange(1, len(pivots)), [0]
    while len(left):
        near = ((pivots[left] - pivots[order[-1]]) ** 2).sum(axis=1).argmin()
        order.append(int(left[near]))
        left = np.delete(left, near)
    return pivots[order]


def _nearest(pivots: np.ndarray):
    """The number of the pivot nearest to each vector."""

    @F.pandas_udf("int")
    def nearest(vectors: pd.Series) -> pd.Series:
        terms = _matrix(list(vectors)).astype(np.float64)
        dims = max(terms.shape[1], pivots.shape[1])
        own = _wide(pivots, dims)
        far = (own**2).sum(axis=1)[None, :] - 2 * (_wide(terms, dims) @ own.T)
        return pd.Series(far.argmin(axis=1), dtype="int32")

    return nearest


def with_neighbourhood(vectors: DataFrame, size: int, most: int = PIVOTS) -> DataFrame:
    """Staged (vec_id, terms) with `near`: where a row stands among similar ones, one number for about `size` rows.

    It decides only which rows share a block, so the sample has no say in the result.
    """
    wanted = min(most, -(-vectors.count() // size))
    if wanted < 2:
        return vectors.withColumn("near", F.lit(0))
    # at most `most` rows
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "terms").limit(wanted).select("terms").collect()
    pivots = _chain(_matrix([np.asarray(r["terms"], dtype=np.int64) for r in sample]).astype(np.float64))
    return vectors.withColumn("near", _nearest(pivots)("terms"))


def forward_index(vectors: DataFrame, size: int = BLOCK) -> DataFrame:
    """Staged blocks of (vec_id, terms, near), each of `size` rows that follow each other by similarity, then id."""
    ordered = staging.rows_in_order(vectors, [F.col("near"), F.col("vec_id")], "vectors-in-order")
    numbered = staging.ranked(ordered).select(F.floor(F.col("rank") / size).alias("block"), "row.vec_id", "row.terms")
    return staging.staged(numbered.groupBy("block").applyInPandas(_block, BLOCKS), "blocks")


def _wide(a: np.ndarray, dims: int) -> np.ndarray:
    return a if a.shape[1] == dims else np.pad(a, ((0, 0), (0, dims - a.shape[1])))


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T exactly: in floating point where no sum can leave its whole numbers.

    Products beyond a long come out as the largest or smallest long.
    """
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    reach = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if reach < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if reach < 2**62:
        return a @ b.T
    exact = a.astype(object) @ b.T.astype(object)
    return np.clip(exact, -LARGEST, LARGEST).astype(np.int64)


class Searcher:
    """The k best of a chunk of queries while blocks are scored."""

    def __init__(self, ids: np.ndarray, terms: np.ndarray, floor: np.ndarray, k: int):
        self.ids, self.terms, self.k = ids, terms, k
        self.floor = floor  # k-th score so far: lower ones cannot count
        self.query = np.empty(0, dtype=np.int64)
        self.vec = np.empty(0, dtype=np.int64)
        self.score = np.empty(0, dtype=np.int64)

    def bounds(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        up, down = _product(np.maximum(self.terms, 0), high), _product(np.minimum(self.terms, 0), low)
        # a sum that leaves a long bounds nothing
        return np.where((np.maximum(up, down) > LARGEST // 2), LARGEST, up + np.maximum(down, -LARGEST // 2))

    def add(self, who: np.ndarray, ids: np.ndarray, terms: np.ndarray) -> None:
        """Score one block for queries `who`."""
        scores = _product(self.terms[who], terms)
        own = self.ids[who][:, None] == ids[None, :]
        if own.any():
            scores[own] = np.iinfo(np.int64).min
        if scores.shape[1] >= self.k:
            best = np.partition(scores, -self.k, axis=1)[:, -self.k]
            self.floor[who] = np.maximum(self.floor[who], best)
        row, col = np.nonzero((scores >= self.floor[who][:, None]) & ~own)
        query, vec, score = who[row], ids[col], scores[row, col]
        # only the queries that gained something are ranked anew
        again = np.isin(self.query, query)
        query = np.concatenate([self.query[again], query])
        vec = np.concatenate([self.vec[again], vec])
        score = np.concatenate([self.score[again], score])
        order = np.lexsort((vec, -score, query))
        query, vec, score = query[order], vec[order], score[order]
        starts = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else np.empty(0, dtype=np.int64)
        rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(query)]])))
        kth = rank == self.k - 1
        self.floor[query[kth]] = np.maximum(self.floor[query[kth]], score[kth])
        kept = rank < self.k
        self.query = np.concatenate([self.query[~again], query[kept]])
        self.vec = np.concatenate([self.vec[~again], vec[kept]])
        self.score = np.concatenate([self.score[~again], score[kept]])


def search_blocks(searcher: Searcher, blocks: list[tuple[np.ndarray, np.ndarray]], bounds: np.ndarray) -> int:
    """Visit blocks (ids, terms), each query from its highest bound down; returns how many (query, block) were scored."""
    order = np.argsort(-bounds, axis=1, kind="stable")
    live = np.arange(len(bounds))
    scored = 0
    for turn in range(bounds.shape[1]):
        block = order[live, turn]
        # at the k-th score itself a smaller id could still win
        fit = bounds[live, block] >= searcher.floor[live]
        live, block = live[fit], block[fit]
        if not len(live):
            break
        by = np.argsort(block, kind="stable")
        for at in np.split(by, np.flatnonzero(np.diff(block[by])) + 1):
            searcher.add(live[at], *blocks[block[at[0]]])
            scored += len(at)
    return scored


def _searcher(queries: pd.DataFrame, blocks: pd.DataFrame, k: int) -> tuple[Searcher, np.ndarray, int]:
    """The queries of a chunk, and the bounds of their scores in each of the blocks."""
    terms = _matrix([np.asarray(v, dtype=np.int64) for v in queries["terms"]])
    dims = max(terms.shape[1], *[len(h) // n for h, n in zip(blocks["high"], blocks["bytes"])])
    searcher = Searcher(queries["query_id"].to_numpy(np.int64), _wide(terms, dims), queries["floor"].to_numpy(np.int64).copy(), k)
    high, low = (np.concatenate([_stored(x, 1, b, dims) for x, b in zip(blocks[side], blocks["bytes"])]) for side in ("high", "low"))
    return searcher, searcher.bounds(high, low), dims


def _stored(raw: bytes, rows: int, size: int, dims: int) -> np.ndarray:
    found = np.frombuffer(raw, dtype=f"<i{size}").astype(np.int64).reshape(rows, -1) if raw else np.zeros((rows, 0), np.int64)
    return _wide(found, dims)


def _forward(blocks: pd.DataFrame, dims: int) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(np.frombuffer(i, dtype=np.int64), _stored(t, n, b, dims)) for i, t, n, b in zip(blocks["ids"], blocks["terms"], blocks["rows"], blocks["bytes"])]


def _highest(queries: pd.DataFrame, blocks: pd.DataFrame, k: int) -> pd.DataFrame:
    """Of a group of blocks the one with the highest bound for each query."""
    if not len(queries) or not len(blocks):
        return pd.DataFrame({"query_id": [], "block": [], "bound": []}, dtype="int64")
    searcher, bounds, _ = _searcher(queries, blocks, k)
    best = bounds.argmax(axis=1)
    return pd.DataFrame({"query_id": searcher.ids, "block": blocks["block"].to_numpy(np.int64)[best], "bound": bounds[np.arange(len(best)), best]})


def _floors(queries: pd.DataFrame, blocks: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k-th score of each query in one block, if it has so many."""
    if not len(queries) or not len(blocks):
        return pd.DataFrame({"query_id": [], "floor": []}, dtype="int64")
    searcher, _, dims = _searcher(queries, blocks, k)
    searcher.add(np.arange(len(searcher.ids)), *_forward(blocks, dims)[0])
    return pd.DataFrame({"query_id": searcher.ids, "floor": searcher.floor})


def _search(queries: pd.DataFrame, blocks: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of each query in one group of blocks."""
    if not len(queries) or not len(blocks):
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
    searcher, bounds, dims = _searcher(queries, blocks, k)
    search_blocks(searcher, _forward(blocks, dims), bounds)
    if len(searcher.score) and np.abs(searcher.score).max() >= LARGEST:
        raise OverflowError("a score does not fit a long")
    return pd.DataFrame({"query_id": searcher.ids[searcher.query], "vec_id": searcher.vec, "score": searcher.score})


def _work(queries: pd.DataFrame, blocks: pd.DataFrame, k: int) -> pd.DataFrame:
    """How many pairs of a query and a block there are in a group, and how many are scored."""
    if not len(queries) or not len(blocks):
        return pd.DataFrame({"pairs": [], "scored": []}, dtype="int64")
    searcher, bounds, dims = _searcher(queries, blocks, k)
    return pd.DataFrame({"pairs": [bounds.size], "scored": [search_blocks(searcher, _forward(blocks, dims), bounds)]})


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")) if n else F.array().cast("array<bigint>")


def top_k(df: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 20, scale: int = 64, block: int = BLOCK, group_blocks: int = GROUP_BLOCKS, chunk: int = CHUNK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of every query row.

    Vectors become floor(scale * x). Candidates are all rows but those with the query's own
    key; ties go to the smaller key, and with fewer candidates all are returned. Rows whose
    key or vector is null, or whose vector holds null or non-finite components, take no
    part. A score beyond a long fails the search. Vectors of different lengths are compared over the components both have. Repeated
    candidate rows count each; repeated query keys ask once, with their smallest vector.
    """
    asks, offers = _chunks_and_groups(df, is_query, key, vector, k, scale, block, group_blocks, chunk)
    hits = asks.groupBy("chunk", "group").cogroup(offers.groupBy("chunk", "group")).applyInPandas(lambda q, b: _search(q, b, k), HITS)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).alias("rank")
    return hits.select("query_id", rank, "vec_id", "score").where(F.col("rank") <= k)


def scored_pairs(df: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 20, scale: int = 64, block: int = BLOCK, group_blocks: int = GROUP_BLOCKS, chunk: int = CHUNK) -> DataFrame:
    """(pairs, scored): of all pairs of a query and a block, how many top_k() scores after its first pass. It tells whether bounds are of use on a table."""
    asks, offers = _chunks_and_groups(df, is_query, key, vector, k, scale, block, group_blocks, chunk)
    work = asks.groupBy("chunk", "group").cogroup(offers.groupBy("chunk", "group")).applyInPandas(lambda q, b: _work(q, b, k), "pairs long, scored long")
    return work.agg(F.sum("pairs").alias("pairs"), F.sum("scored").alias("scored"))


def _chunks_and_groups(df: DataFrame, is_query: Column, key: str, vector: str, k: int, scale: int, block: int, group_blocks: int, chunk: int) -> tuple[DataFrame, DataFrame]:
    """Queries with their floors, once for each group of blocks, and blocks, once for each chunk of queries."""
    if k < 1:
        raise ValueError("k must be at least 1")
    clean = df.select(F.col(key).cast("long").alias("vec_id"), scaled(F.col(vector), scale).alias("terms"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    clean = staging.staged(clean.where("vec_id is not null and terms is not null"), "vectors")
    blocks = forward_index(with_neighbourhood(clean.select("vec_id", "terms"), block), block).withColumn("group", F.floor(F.col("block") / group_blocks))
    asked = clean.where("asks").groupBy(F.col("vec_id").alias("query_id")).agg(F.min("terms").alias("terms"))
    asked = staging.ranked(staging.rows_in_order(asked, [F.col("query_id")], "queries"))
    queries = staging.staged(asked.select("row.query_id", "row.terms", F.floor(F.col("rank") / chunk).alias("chunk"), F.lit(-(1 << 63)).alias("floor")), "chunks")
    chunks = queries.agg(F.coalesce(F.max("chunk"), F.lit(-1))).first()[0] + 1
    groups = blocks.agg(F.coalesce(F.max("group"), F.lit(-1))).first()[0] + 1
    # every chunk meets every group: the query set against all rows, in blocks
    asks = queries.withColumn("group", F.explode(_numbers(groups)))
    offers = blocks.withColumn("chunk", F.explode(_numbers(chunks)))
    bounds = asks.groupBy("chunk", "group").cogroup(offers.drop("ids", "terms").groupBy("chunk", "group"))
    first = bounds.applyInPandas(lambda q, b: _highest(q, b, k), "query_id long, block long, bound long").groupBy("query_id").agg(F.max_by("block", F.struct("bound", "block")).alias("block"))
    first = staging.staged(queries.join(first, "query_id"), "first-blocks")
    # a block that many queries begin with comes to each of their chunks
    begun = blocks.join(first.select("block", F.col("chunk").alias("asked_by")).distinct(), "block").select("*", (F.col("asked_by") + 0).alias("of"))
    floors = first.groupBy("block", "chunk").cogroup(begun.groupBy("block", "of")).applyInPandas(lambda q, b: _floors(q, b, k), "query_id long, floor long")
    floors = staging.staged(floors, "floors")
    raised = queries.drop("floor").join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(-(1 << 63))))
    return raised.withColumn("group", F.explode(_numbers(groups))), offers

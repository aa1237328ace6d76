"""Exact top-k inner products by branch and bound over a vertical layout.

Candidates are laid out in blocks of ``BLOCK_ROWS`` rows, one array per dimension; queries in
blocks of ``QUERY_ROWS``. Every block of queries meets every block of candidates (that is
the stated job: all given queries against all rows). The dimensions with the most mass come
first. What the remaining dimensions can add is bounded by the product of the remaining norms, so
a candidate whose bound is below the k-th best that is already certain goes. Over the first
dimensions scores and bounds of a block are one product of matrices in 32-bit floats, with room for
their rounding; a sample tells how many dimensions that takes. The scores of the pairs that
stay grow by ``STEP`` dimensions at a time, exactly, and are compacted after each step. A task
keeps the best k of each query over all its blocks, whose k-th bounds the later ones; the best k
of the tasks are the result.

Components are turned into floor(scale * x), so scores are whole numbers. They are computed
in 64-bit floats while those are exact, in Python integers beyond; a score that doesn't fit
a long raises.

Blocks meet by one exchange, not by a join: Spark's estimates know nothing of the copies that the
grid of slots needs, so it would broadcast them.

Defined results: rows with a null id, a null vector or a null or non-finite component take
no part; shorter vectors count as padded with zeros; a candidate with the query's own id is
left out; repeated rows of one id and vector count once; fewer than k candidates give fewer
rows; an empty table gives none. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import ship_package
from .common import staged

BLOCK_ROWS, QUERY_ROWS, STEP = 4096, 512, 8
#: Queries of a slot at most (a task keeps their cells and their best), queries of one product.
SLOT_QUERIES, TILE = 32_768, 64
#: Dimensions of a product that take as long as one pair on its own.
PAIR_COST = 10_000
_BLOCK = "block long, ids binary, cells binary, dims int"
_NARROW = (("<i2", 2.0 ** 15), ("<i4", 2.0 ** 31))
_CELLS = {2: "<i2", 4: "<i4", 8: "<f8"}


def _matrix(vectors: pa.ListArray, scale: float) -> np.ndarray:
    """(dims, rows) of scaled whole numbers, in the narrowest type that holds them."""
    sizes = pc.list_value_length(vectors).to_numpy()
    out = np.zeros((len(vectors), sizes.max(initial=0)))
    out[np.arange(out.shape[1]) < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    out = np.floor(out * scale).T
    most = np.abs(out).max(initial=0)
    return out.astype(next((kind for kind, end in _NARROW if most < end), "<f8"))


def _block_task(rows: int, scale: float):
    """(vec_id, vector) to blocks in vertical layout."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        number = n = 0

        def block() -> pa.RecordBatch:
            nonlocal number, n
            ids, vectors = (pa.concat_arrays([x.column(i) for x in held]) for i in (0, 1))
            m = _matrix(vectors, scale)
            out = pa.RecordBatch.from_pydict({
                "block": pa.array([number], pa.int64()),
                "ids": pa.array([ids.to_numpy().astype("<i8").tobytes()], pa.binary()),
                "cells": pa.array([m.tobytes()], pa.binary()), "dims": pa.array([len(m)], pa.int32())})
            held.clear()
            number, n = number + 1, 0
            return out

        for batch in batches:
            while batch.num_rows:
                held.append(batch.slice(0, rows - n))
                batch = batch.slice(rows - n)
                n += held[-1].num_rows
                if n == rows:
                    yield block()
        if held:
            yield block()
    return run


def _padded(m: np.ndarray, dims: int) -> np.ndarray:
    return np.vstack([m, np.zeros((dims - len(m), m.shape[1]))]) if len(m) < dims else m.astype(float)


def _rest(m: np.ndarray) -> np.ndarray:
    """Norms of what is left of each column of ``m`` after 0, 1, 2 ... steps."""
    sums = [np.square(m[s:s + STEP]).sum(axis=0) for s in range(0, len(m), STEP)] + [np.zeros(m.shape[1])]
    return np.sqrt(np.cumsum(sums[::-1], axis=0)[::-1]) * (1 + 1e-9)


class Candidates:
    """A block of candidates; ``x`` is (dims, rows)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, dims: int = 0):
        self.ids, self.plain = ids, _padded(x, max(dims, len(x)))
        self.most = np.abs(self.plain).max(initial=0)

    @cached_property
    def order(self) -> np.ndarray:
        return np.argsort(-np.square(self.plain).sum(axis=1), kind="stable")

    @cached_property
    def x(self) -> np.ndarray:
        return self.plain[self.order]

    @cached_property
    def x32(self) -> np.ndarray:
        return self.x.astype(np.float32)

    @cached_property
    def rows(self) -> np.ndarray:
        return np.ascontiguousarray(self.x.T)

    @cached_property
    def rest(self) -> np.ndarray:
        return _rest(self.x)

    @cached_property
    def seeds(self) -> np.ndarray:
        """Places of some different ids."""
        return np.unique(self.ids, return_index=True)[1][:1024]


def best_of_block(q_ids: np.ndarray, q: np.ndarray, block: Candidates, k: int,
                  least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of queries, candidates and exact scores of one block, the best k of each query among them.

    q is (dims, rows); scores under ``least``, by query, are not asked for and may be left out.
    """
    dims = max(len(q), len(block.plain))
    if dims > len(block.plain):
        block = Candidates(block.ids, block.plain, dims)
    q = _padded(q, dims)
    if np.abs(q).max(initial=0) * block.most * dims >= 2.0 ** 53:
        return _best_slowly(q_ids, q, block, k)
    q = q[block.order]
    rows, q_rest, x_rest = np.ascontiguousarray(q.T), _rest(q), block.rest
    if np.isneginf(least).any() and len(block.seeds) >= k:
        some = rows @ block.x[:, block.seeds]
        some[q_ids[:, None] == block.ids[block.seeds]] = -np.inf
        least = np.maximum(least, np.partition(some, len(block.seeds) - k, axis=1)[:, len(block.seeds) - k])
    step = _steps_at_once(q, block.x, q_rest, x_rest, least)
    head = min(step * STEP, dims)
    # Scores over the head, what the rest can add and the rounding of 32 bits, all in one product.
    room = (dims + 8) * 2.0 ** -22
    left = np.hstack([rows[:, :head], q_rest[step][:, None], room * q_rest[0][:, None]]).astype(np.float32)
    right = np.vstack([block.x32[:head], x_rest[[step, 0]].astype(np.float32)])
    bar = np.nextafter(least.astype(np.float32), np.float32(-np.inf))[:, None]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for lo in range(0, len(q_ids), TILE):
        pairs = np.flatnonzero(left[lo:lo + TILE] @ right >= bar[lo:lo + TILE])
        for some in np.array_split(pairs, max(1, len(pairs) * dims >> 20)):
            i, j = np.divmod(some, len(block.ids))
            i += lo
            other = q_ids[i] != block.ids[j]
            i, j = i[other], j[other]
            score = np.einsum("pd,pd->p", rows[i, :head], block.rows[j, :head])
            for n, s in enumerate(range(head, dims, STEP), step):
                stay = score + q_rest[n][i] * x_rest[n][j] + 1e-6 >= least[i]
                i, j, score = i[stay], j[stay], score[stay]
                score += np.einsum("pd,pd->p", rows[i, s:s + STEP], block.rows[j, s:s + STEP])
            stay = score >= least[i]
            found.append((i[stay], block.ids[j[stay]], score[stay].astype(np.int64)))
    return tuple(map(np.concatenate, zip(*found)))


def _steps_at_once(q, x, q_rest, x_rest, least) -> int:
    """After how many steps to look at the bounds, as a sample of pairs tells; any number gives the same results."""
    i, j = (slice(None, None, -(-m.shape[1] // 64)) for m in (q, x))
    score, costs = 0.0, []
    for n in range(len(q_rest)):
        if n:
            s = (n - 1) * STEP
            score = score + q[s:s + STEP, i].T @ x[s:s + STEP, j]
        costs.append(n * STEP + PAIR_COST * (score + q_rest[n, i, None] * x_rest[n, j] >= least[i, None]).mean())
    return int(np.argmin(costs))


def _best_slowly(q_ids, q, block, k):
    """The same in Python integers, for components whose products floats can't hold."""
    out: tuple[list[int], list[int], list[int]] = ([], [], [])
    columns = [[int(c) for c in col] for col in block.plain.T]
    for at, (q_id, v) in enumerate(zip(q_ids.tolist(), q.T)):
        v = [int(c) for c in v]
        found = sorted({(-sum(a * b for a, b in zip(v, c)), i) for c, i in zip(columns, block.ids.tolist()) if i != q_id})
        for score, i in found[:k]:
            if not -(1 << 63) <= -score < 1 << 63:
                raise OverflowError(f"the score of {q_id} and {i} doesn't fit a long")
            for column, value in zip(out, (at, i, -score)):
                column.append(value)
    return tuple(np.array(column, np.int64) for column in out)


class Best:
    """A block of queries and the best k of each so far. Vectors of one id and equal score are one result."""

    def __init__(self, q_ids: np.ndarray, q: np.ndarray, k: int):
        self.q_ids, self.q, self.k = q_ids, q, k
        self.best = (np.zeros(0, np.int64),) * 3
        self.least = np.full(len(q_ids), -np.inf)
        self.new: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def meet(self, block: Candidates) -> None:
        self.new.append(best_of_block(self.q_ids, self.q, block, self.k, self.least))
        if 4 * sum(len(x[0]) for x in self.new) >= len(self.q_ids) * self.k:
            self.settle()

    def settle(self) -> None:
        at, ids, scores = map(np.concatenate, zip(self.best, *self.new))
        self.new.clear()
        order = np.lexsort((ids, ~scores, at))
        at, ids, scores = at[order], ids[order], scores[order]
        other = np.append(True, (np.diff(at) != 0) | (np.diff(ids) != 0) | (scores[1:] != scores[:-1]))[:len(at)]
        at, ids, scores = at[other], ids[other], scores[other]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        last = rank == self.k - 1
        self.least[at[last]] = scores[last]
        self.best = tuple(x[rank < self.k] for x in (at, ids, scores))

    def result(self) -> pa.RecordBatch:
        self.settle()
        at, ids, scores = self.best
        return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (self.q_ids[at], ids, scores)],
                                          ["query_id", "vec_id", "score"])


def _search_task(k: int):
    """Blocks by slot, in a slot those of queries first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, best = None, []
        for batch in batches:
            for at in range(batch.num_rows):
                r = {name: batch.column(name)[at] for name in batch.schema.names}
                if r["slot"].as_py() != slot:
                    yield from (x.result() for x in best)
                    slot, best = r["slot"].as_py(), []
                ids, dims, raw = np.frombuffer(r["ids"].as_buffer(), "<i8"), r["dims"].as_py(), r["cells"].as_buffer()
                cells = np.frombuffer(raw, _CELLS[raw.size // (dims * len(ids)) if dims else 8]).reshape(dims, len(ids))
                if r["side"].as_py() == 0:
                    best.append(Best(ids.copy(), cells.copy(), k))
                elif best:
                    block = Candidates(ids, cells, max(len(x.q) for x in best))
                    for x in best:
                        x.meet(block)
        yield from (x.result() for x in best)
    return run


def top_k(vectors: DataFrame, is_query: Column, *, k: int = 10, scale: float = 1024.0,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per query: query_id, rank (int, from 1), vec_id, score (long); ties to the smaller id.

    ``is_query``: which rows of ``vectors`` are queries.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    finite = F.forall(vector_col, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"),
        is_query.alias("is_query"))
    # Before the blocks are built, as copies would take the k places of a block. Vectors that
    # differ in zeros at their end only are copies too.
    ends = F.array_position(F.reverse(F.transform("vector", lambda v: v != 0)), True)
    rows = rows.withColumn("vector", F.when(ends == 0, F.array().cast("array<double>")).otherwise(
        F.slice("vector", 1, (F.size("vector") - ends + 1).cast("int"))))
    rows = staged(rows.groupBy("vec_id", "vector").agg(F.max("is_query").alias("is_query")), "vectors")
    queries = rows.filter("is_query").select("vec_id", "vector")
    n_queries, n_rows = queries.count(), rows.count()
    n_blocks = max(1, -(-n_queries // QUERY_ROWS))
    # A grid of slots: a query block goes to all slots of its row, a candidate block to all of its
    # column. Rows and columns are such that both sides are copied alike; few rows at first.
    slots = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    across = min(n_blocks, max(1, round(math.sqrt(slots * n_queries / max(n_rows, 1))), -(-n_queries // SLOT_QUERIES)))
    down = max(1, slots // across)

    def dealt(n: int) -> Column:
        return F.pmod(F.xxhash64("ids"), F.lit(n)).cast("int")

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    x = (rows.select("vec_id", "vector").mapInArrow(_block_task(BLOCK_ROWS, scale), _BLOCK)
         .select("*", F.lit(1).alias("side"), dealt(down).alias("column"), each(across).alias("row")))
    q = (queries.repartition(n_blocks).mapInArrow(_block_task(QUERY_ROWS, scale), _BLOCK)
         .select("*", F.lit(0).alias("side"), dealt(across).alias("row"), each(down).alias("column")))
    met = (q.unionByName(x).select((F.col("row") * down + F.col("column")).alias("slot"), "side", "ids", "cells", "dims")
           .repartition(across * down, "slot").sortWithinPartitions("slot", "side"))
    best = met.mapInArrow(_search_task(k), "query_id long, vec_id long, score long")
    by_score = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.repartition("query_id").dropDuplicates().withColumn("rank", F.row_number().over(by_score))
            .filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))

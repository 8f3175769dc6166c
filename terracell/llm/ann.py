"""Nearest neighbours by largest inner product, as a block matrix join.

Queries are dealt into blocks of bounded size and candidates into a fixed number of strips; each
pair of a block and a strip is one task's work. The task holds the block and lets the strip
stream by in tiles, however long it is: int8 tiles give every product with a bound on its
quantisation error; pairs whose upper bound reaches the k-th best known lower bound survive, are
recomputed in double precision from the original vectors and enter a heap per query. What
leaves a task is its heaps, so the lists to merge are queries times strips, in proportion to the
queries; the strips' copies, one a block of queries, are what a search of every pair has to move.
The result is exact.

Edge cases: vectors that are null, zero or hold null or non-finite components, and rows without
vec_id, take no part; vectors of different dimension do not meet; a query id that has several
rows asks once, with its smallest vector; every candidate row counts, so repeated rows may
repeat; ties go to the smaller vec_id; fewer candidates than k are all returned; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappush, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK, STRIPS, QUERY_TILE, TILE = 16_384, 16, 256, 2048  # rows but for STRIPS; a task holds a block of queries and a tile
FOUND = "query_id long, vec_id long, score double"


def usable(vector: str) -> Column:
    """Not null, all components finite, not all zero."""
    return F.expr(f"{vector} is not null and not exists({vector}, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists({vector}, x -> x <> 0)")


def matrix(vectors: pa.Array) -> np.ndarray:
    """The rows of a list column whose lists have one length."""
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, the scale of each row, and the sum of each row's absolute values."""
    scale = np.abs(x).max(axis=1).astype(np.float64) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    return q, scale, np.abs(q.astype(np.float64)).sum(axis=1)


class Block:
    """Queries of one dimension, their heaps, and the k-th best score that each is known to reach."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int):
        self.ids, self.k, self.dim = ids, k, x.shape[1]
        self.kind = np.float32 if self.dim * 127 * 127 < 1 << 24 else np.float64  # holds the integer products exactly
        q8, self.scale, self.sum = quantised(x)
        self.q8, self.wide = q8.astype(self.kind), x.astype(np.float64)
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in ids]
        self.floor = np.full(len(ids), -np.inf)

    def meet(self, ids: np.ndarray, tile: np.ndarray) -> None:
        c8, scale, total = quantised(tile)
        c8, wide = c8.astype(self.kind).T, tile.astype(np.float64)
        for at in range(0, len(self.ids), QUERY_TILE):
            self._meet(slice(at, at + QUERY_TILE), ids, wide, c8, scale, total)

    def _meet(self, rows_: slice, ids: np.ndarray, wide: np.ndarray, c8: np.ndarray, c_scale: np.ndarray, c_sum: np.ndarray) -> None:
        heaps, floor = self.heaps[rows_], self.floor[rows_]
        scale = self.scale[rows_, None] * c_scale
        product = (self.q8[rows_] @ c8) * scale
        error = scale * (0.5 * self.sum[rows_, None] + 0.5 * c_sum + 0.25 * self.dim) * (1 + 1e-6)
        own, low, high = self.ids[rows_, None] == ids, product - error, product + error
        if not np.isfinite(error).all():  # products beyond the range of doubles say nothing: such pairs survive
            low, high = np.where(np.isfinite(low), low, -np.inf), np.where(np.isnan(high), np.inf, high)
        if len(ids) > self.k:
            low = np.where(own, -np.inf, low)
            floor = np.maximum(floor, np.partition(low, len(ids) - self.k, axis=1)[:, len(ids) - self.k])
        rows, columns = np.nonzero((high >= floor[:, None]) & ~own)
        for start in range(0, len(rows), 1 << 16):
            r, s = rows[start : start + (1 << 16)], columns[start : start + (1 << 16)]
            exact = np.zeros(len(r))
            for d in range(self.dim):  # one order of summation for every pair
                exact += self.wide[rows_][r, d] * wide[s, d]
            for i, score, vec in zip(r.tolist(), exact.tolist(), ids[s].tolist(), strict=True):
                heap = heaps[i]
                if len(heap) < self.k:
                    heappush(heap, (score, -vec))
                elif (score, -vec) > heap[0]:
                    heapreplace(heap, (score, -vec))
        self.floor[rows_] = np.maximum(floor, [h[0][0] if len(h) == self.k else -np.inf for h in heaps])

    def found(self) -> pa.RecordBatch:
        rows = [(int(i), -v, s) for i, h in zip(self.ids, self.heaps, strict=True) for s, v in h]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 3, (pa.int64(), pa.int64(), pa.float64()), strict=True)], ["query_id", "vec_id", "score"])


def meet_in_order(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Heaps of each run of rows (cell, dim, asks, vec_id, embedding) with equal cell and dim; those that ask come first."""
    key, block, asked, waiting = None, None, [], []

    def flush() -> None:
        if waiting and block:
            block.meet(np.concatenate([i for i, _ in waiting]), np.concatenate([x for _, x in waiting]))
        waiting.clear()

    for batch in batches:
        cell, dim, asks = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
        ids = batch.column(3).to_numpy()
        edges = np.flatnonzero(np.concatenate(([True], (cell[1:] != cell[:-1]) | (dim[1:] != dim[:-1]) | (asks[1:] != asks[:-1]), [True]))) if len(ids) else []
        for a, b in zip(edges, edges[1:], strict=False):
            if (now := (int(cell[a]), int(dim[a]))) != key:
                flush()
                if block:
                    yield block.found()
                key, block, asked = now, None, []
            vectors = matrix(batch.column(4).slice(a, b - a))
            if not asks[a]:  # sorts behind
                if asked:
                    block, asked = Block(np.concatenate([i for i, _ in asked]), np.concatenate([x for _, x in asked]), k), []
                if block:
                    for at in range(0, len(vectors), TILE):
                        waiting.append((ids[a:b][at : at + TILE], vectors[at : at + TILE]))
                        if sum(len(i) for i, _ in waiting) >= TILE:
                            flush()
            else:
                asked.append((ids[a:b].copy(), vectors.copy()))
    flush()
    if block:
        yield block.found()


def search(rows: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """For each query row of (vec_id, embedding): query_id, rank (from 1), vec_id, score."""
    rows = rows.select("vec_id", "embedding").where(usable("embedding") & F.col("vec_id").isNotNull()).withColumn("dim", F.size("embedding"))
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min(F.struct("embedding", "dim")).alias("e")).select("vec_id", "e.embedding", "e.dim")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    dealt = lambda m: F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = asked.select(dealt(blocks).alias("j"), every(STRIPS).alias("i"), "dim", F.lit(True).alias("asks"), "vec_id", "embedding")
    right = rows.select(every(blocks).alias("j"), dealt(STRIPS).alias("i"), "dim", F.lit(False).alias("asks"), "vec_id", "embedding")
    cell = F.col("j") * STRIPS + F.col("i")
    met = left.unionByName(right).select(cell.alias("cell"), "dim", "asks", "vec_id", "embedding").repartitionByRange(blocks * STRIPS, "cell")
    found = met.sortWithinPartitions("cell", "dim", F.col("asks").desc()).mapInArrow(lambda batches: meet_in_order(batches, k), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

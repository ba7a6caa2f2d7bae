"""Exact top-k by inner product: one KD-tree per shard, best-first under a propagated k-th score."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import materialize

SCALE = 1024
TREE_BYTES = 1 << 24  # of the vectors in one tree
LEAF = 256            # vectors per leaf
QUERIES = 1024        # queries whose bounds are held at once
# Doubles hold sums of whole numbers exactly below this.
EXACT = 2.0 ** 52
LONG = 1 << 63


class KDTree:
    """Median splits on the widest side, with tight bounding boxes.

    Components are multiples of ``1 / scale``, a power of two; scores are inner products times ``scale ** 2``, so whole
    numbers. They are exact at any size: where doubles can't hold them they only pick the rows worth counting with
    Python's integers, by bounds wide enough for their errors.
    """

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF, scale: int = 1) -> None:
        self.ids, self.points, self.scale = ids, points, scale
        self.low, self.high, self.children, self.rows = [], [], [], []
        self._build(np.arange(len(ids)), leaf)
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.far = np.maximum(np.abs(self.low), np.abs(self.high))

    def _build(self, rows: np.ndarray, leaf: int) -> int:
        inside = self.points[rows]
        low, high = inside.min(0), inside.max(0)
        node = len(self.low)
        self.low.append(low)
        self.high.append(high)
        self.children.append(None)
        self.rows.append(rows)
        if len(rows) > leaf and (high > low).any():
            with np.errstate(over="ignore"):
                side, half = int(np.argmax(high - low)), len(rows) // 2
            order = np.argpartition(inside[:, side], half)
            self.children[node] = (self._build(rows[order[:half]], leaf), self._build(rows[order[half:]], leaf))
        return node

    def _error(self, reach: np.ndarray) -> np.ndarray:
        """How far a score of at most ``reach``, summed in doubles, can be off."""
        return np.where(reach < EXACT, 0.0, reach * ((2 * self.points.shape[1] + 8) / EXACT))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """At least the largest score that any point of each box can have with each query."""
        with np.errstate(over="ignore", invalid="ignore"):
            most = (np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T) * self.scale ** 2
            most += self._error(np.abs(queries) @ self.far.T * self.scale ** 2)
        return np.where(np.isnan(most), np.inf, most)

    def search(self, query: np.ndarray, own: int, k: int, bounds: np.ndarray, kth: float) -> list[tuple[int, int]]:
        """The best ``k`` as (score, -id), best first. Boxes below ``kth``, or the own k-th score, are skipped."""
        bounds = bounds.tolist()  # Python compares them with whole numbers of any size exactly
        digits = [_whole(v, self.scale) for v in query.tolist()]
        best: list[tuple[int, int]] = []
        queue = [(-bounds[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            # equal bounds are still opened: a tie can go to a smaller id
            if -bound < kth:
                break
            if self.children[node]:
                for child in self.children[node]:
                    if bounds[child] >= kth:
                        heapq.heappush(queue, (-bounds[child], child))
                continue
            rows = self.rows[node]
            with np.errstate(over="ignore", invalid="ignore"):
                scores = self.points[rows] @ query * self.scale ** 2
                reach = np.abs(query) @ self.far[node] * self.scale ** 2
                possible = ~(scores + self._error(reach) < _below(kth))
            for i in np.flatnonzero(possible):
                row = rows[i]
                if self.ids[row] == own:
                    continue
                score = int(scores[i]) if reach < EXACT else self._score(row, digits)
                item = (score, -int(self.ids[row]))
                if score < kth or item in best:
                    continue
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
                if len(best) == k:
                    kth = max(kth, best[0][0])
        return sorted(best, reverse=True)

    def _score(self, row: int, digits: list[int]) -> int:
        return sum(_whole(v, self.scale) * d for v, d in zip(self.points[row].tolist(), digits))


def _whole(value: float, scale: int) -> int:
    """``value * scale``, which is whole, also where a double doesn't hold it."""
    return int(value // 1) * scale + int(value % 1 * scale)


def _below(kth: float) -> float:
    """A double not above ``kth``, a whole number of any size or minus infinity."""
    if -EXACT < kth < EXACT or kth == -np.inf:
        return float(kth)
    most = float(np.finfo(np.float64).max)
    return float(np.nextafter(float(min(kth, int(most))), -np.inf)) if kth > -most else -np.inf


def sortable(number: int) -> bytes:
    """Bytes that sort, and differ, as the whole numbers do."""
    size = (abs(number).bit_length() + 7) // 8
    if number < 0:
        return (0x8000 - size).to_bytes(2) + ((1 << 8 * size) + number).to_bytes(size)
    return (0x8000 + size).to_bytes(2) + number.to_bytes(size)


def from_sortable(key: bytes) -> int:
    """The number of :func:`sortable` bytes."""
    size = int.from_bytes(key[:2]) - 0x8000
    return int.from_bytes(key[2:]) - (1 << -8 * size if size < 0 else 0)


def quantized(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, x)`` with components rounded down to multiples of ``1 / scale``, a power of two, as doubles.

    Vectors that are null or not wholly finite are left out, and rows without an id or without components.
    Exact repeats of a row count once.
    """
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    # from 2 ** 53 on every double is whole
    down = lambda v: F.when(F.abs(v) < 2.0 ** 53 / scale, F.floor(v * scale).cast("double") / scale).otherwise(v)
    kept = vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite)
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(F.col("embedding").cast("array<double>"), down).alias("x")).distinct()


def _searched(batches: Iterator[pa.RecordBatch], k: int, scale: int) -> Iterator[pa.RecordBatch]:
    """Rows ``(width, shard, query, vec_id, x, kth)`` in that order: a shard's vectors make its tree, its queries pass it."""
    at, tree, ids, points = None, None, [], []
    for batch in batches:
        width, shard, query, ids_ = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 3))
        changes = np.flatnonzero((width[1:] != width[:-1]) | (shard[1:] != shard[:-1]) | (query[1:] != query[:-1])) + 1
        for start, end in zip([0, *changes], [*changes, batch.num_rows]):
            if at != (at := (width[start], shard[start])):
                tree, ids, points = None, [], []
            x = batch.column(4).slice(start, end - start).flatten().to_numpy(zero_copy_only=False).reshape(-1, width[start])
            if not query[start]:
                ids.append(ids_[start:end])
                points.append(x)
                continue
            if tree is None:
                if not points:
                    continue
                tree = KDTree(np.concatenate(ids), np.concatenate(points), LEAF, scale)
                ids, points = [], []
            kths = [-np.inf if v is None else from_sortable(v) for v in batch.column(5).slice(start, end - start).to_pylist()]
            for first in range(0, len(x), QUERIES):
                part = x[first:first + QUERIES]
                found = []
                for i, bounds in enumerate(tree.bounds(part)):
                    own = int(ids_[start + first + i])
                    found += [(own, -i_, max(min(s, LONG - 1), -LONG), sortable(s)) for s, i_ in tree.search(part[i], own, k, bounds, kths[first + i])]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], ["query_id", "vec_id", "score", "key"])


def top_k(vectors: DataFrame, is_query, k: int = 10, scale: int = SCALE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query row the ``k`` best other rows by inner product.

    Rows are dealt at random to shards of about :data:`TREE_BYTES`, one KD-tree each. A query first searches its
    own shard; its k-th score there is propagated to all other shards, whose boxes must beat it. Each tree is
    shuffled and built once for the first pass and once for the second; queries stream past it, so a task holds one
    tree and a batch of queries however many there are. Ties go to the smaller id.

    Scores are products of whole numbers ``floor(scale * x)``, exact at any finite size, and ranks follow them;
    ``score``, a long, stands at the long's limit where the exact score lies beyond. Only vectors of the same number
    of components are compared. A query without other rows has no result; rows of one id are one query and never each
    other's results, and their equal scores count once.
    """
    points = materialize(quantized(vectors, scale), "vectors")
    total = points.agg(F.sum(F.size("x").cast("long"))).first()[0] or 0
    shards = max(1, round(total * 8 / TREE_BYTES))
    fields = ["width", "shard", "query", "vec_id", "x", "kth"]
    none = F.lit(None).cast("binary")
    # by the vector too: many rows of one id don't meet in a shard
    dealt = points.select(F.size("x").alias("width"), F.pmod(F.xxhash64("vec_id", "x"), F.lit(shards)).cast("int").alias("shard"), "vec_id", "x")
    trees = dealt.withColumns({"query": F.lit(False), "kth": none}).select(fields)
    asked = dealt.where(is_query).withColumn("query", F.lit(True))

    def answer(asks: DataFrame) -> DataFrame:
        both = trees.unionByName(asks.select(fields)).repartitionById(shards, F.col("shard"))
        both = both.sortWithinPartitions("width", "shard", "query")
        return both.mapInArrow(lambda batches: _searched(batches, k, scale), "query_id long, vec_id long, score long, key binary")

    first = materialize(answer(asked.withColumn("kth", none)), "home")
    kth = first.distinct().groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("key")).alias("kth"))
    onward = asked.withColumnRenamed("shard", "home").join(kth, F.col("vec_id") == F.col("query_id"), "left")
    onward = onward.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> home")
    found = first.unionByName(answer(onward)).distinct()
    best = Window.partitionBy("query_id").orderBy(F.desc("key"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


"""Best-fit packing: planned over the histogram of lengths, slots taken by rank within a length."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import PART, map_batches, materialize, texts
from .pretokens import CACHE, encode

CAPACITY = 2048
# Rows of one length that are ranked in one task.
SLICE = 20_000


def token_pieces(docs: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY, remembered: int = CACHE) -> DataFrame:
    """``(row, doc_id, piece, start, length, ids_crc32)``: each document's ids and an end, cut if too long.

    A document longer than ``capacity`` is cut into full pieces but for the first, which takes the rest.
    ``row`` tells repeated rows of one id apart. A worker remembers the ids of ``remembered`` pre-tokens.
    """
    tail = np.array([end_id], "<u4").tobytes()

    def cut(rows: pa.RecordBatch) -> pa.RecordBatch:
        doc, piece, start, length, crc = [], [], [], [], []
        for i, ids in enumerate(encode([b.decode() for b in rows.column(1).to_pylist()], path, remembered)):
            ids += tail
            n = len(ids) // 4
            cuts = [0, *range(n % capacity or min(n, capacity), n + 1, capacity)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                doc.append(i)
                piece.append(k)
                start.append(a)
                length.append(b - a)
                crc.append(zlib.crc32(ids[4 * a:4 * b]))
        take = pa.array(doc, pa.int64())
        return pa.RecordBatch.from_arrays(
            [rows.column(2).take(take), rows.column(0).take(take), pa.array(piece, pa.int32()),
             *(pa.array(x, pa.int64()) for x in (start, length, crc))],
            ["row", "doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    source = texts(docs).withColumn("row", F.monotonically_increasing_id())
    schema = f"row long, doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return map_batches(source, cut, schema, PART)


def best_fit_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Slots ``(length, first_rank, end_rank, first_sequence, offset)`` for a histogram of lengths.

    Best-fit decreasing over counts: from the longest length down, the documents of a length fill the
    sequences with the least room that still holds them, as many at a time as there are equal sequences; the
    rest open new ones, each taking as many documents of that length as it holds. The plan's size depends on
    the number of lengths, not of documents.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> [(first sequence, number of sequences)]
    rooms: list[int] = []
    plan, opened = [], 0

    def give(left: int, first: int, count: int) -> None:
        if left and count:
            if left not in room:
                room[left] = []
                insort(rooms, left)
            room[left].append((first, count))

    for length in sorted(histogram, reverse=True):
        rank, todo = 0, histogram[length]
        while todo:
            k = bisect_left(rooms, length)
            if k == len(rooms):
                fit = capacity // length
                full, rest = divmod(todo, fit)
                for j in range(fit if full else 0):
                    plan.append((length, rank + j * full, rank + (j + 1) * full, opened, j * length))
                for j in range(rest):
                    plan.append((length, rank + fit * full + j, rank + fit * full + j + 1, opened + full, j * length))
                give(capacity - fit * length, opened, full)
                give(capacity - rest * length, opened + full, 1 if rest else 0)
                opened += full + (1 if rest else 0)
                break
            left = rooms[k]
            first, count = room[left].pop()
            if not room[left]:
                del room[left], rooms[k]
            used = min(count, todo)
            plan.append((length, rank, rank + used, first, capacity - left))
            give(left, first + used, count - used)
            give(left - length, first, used)
            rank, todo = rank + used, todo - used
    return plan


def pack(docs: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY, remembered: int = CACHE) -> DataFrame:
    """Token pieces of all ``docs`` with the sequence and the offset each is packed at.

    ``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``. Null and empty texts are the end
    token alone; very long texts are many pieces; repeated rows are packed once each; equal lengths share
    slots by rank in an order by hash and id. An empty table gives an empty result. Other columns are
    ignored. Only the histogram of at most ``capacity`` lengths reaches the driver. ``remembered`` pre-tokens a worker
    keeps the ids of, which changes no result.
    """
    spark = docs.sparkSession
    pieces = token_pieces(docs, path, end_id, capacity, remembered)
    pieces = materialize(pieces.withColumn("hash", F.xxhash64("row", "piece")), "pieces")
    histogram = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = best_fit_plan(histogram, capacity)
    slots = spark.createDataFrame(plan or [(0, 0, 0, 0, 0)], "slot_length long, low long, high long, first long, offset long")

    # a length that many documents share is ranked in slices: rows of the slices before, plus the place within
    slices = max(1, -(-sum(histogram.values()) // SLICE))
    pieces = pieces.withColumn("slice", F.pmod("hash", F.lit(slices)))
    counts = pieces.groupBy("length", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start_rank"))
    place = F.row_number().over(Window.partitionBy("length", "slice").orderBy("hash", "row", "piece")) - 1
    ranked = pieces.withColumn("place", place).join(counts, ["length", "slice"])
    ranked = ranked.withColumn("rank", F.col("start_rank") + F.col("place"))
    # a few slots per length, whatever the number of documents
    on = (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    packed = ranked.join(F.broadcast(slots), on)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32",
                         (F.col("first") + F.col("rank") - F.col("low")).alias("sequence_id"), "offset")

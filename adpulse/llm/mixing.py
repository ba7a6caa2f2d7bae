"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Only DataFrame functions: no Python runs on the executors.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialize

WEIGHTS = (3, 1, 2)
WORD = r"[^\x20\x09-\x0D]+"
# Documents in one slice of a source, whose running sum is formed in one task.
SLICE = 20_000


def word_count(text: str = "text") -> Column:
    """Number of words of a text column; null: 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: int = 2) -> DataFrame:
    """``(source, source_size, target)`` of ``sizes(source, size, ...)``.

    Sources take the weights in turn, by code point, null last, and share ``share`` times all sizes by
    weight. A source above ``cap`` times its size is clamped there, and the excess goes to the others by
    weight, until none is above. Each round reduces the small table of sources to two sums.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # rank without one sorted partition: place in its range partition plus the rows of those before
    ranged = per_source.withColumn("last", F.col("source").isNull())
    ranged = ranged.repartitionByRange(F.col("last"), F.col("source")).withColumn("range", F.spark_partition_id())
    ranged = materialize(ranged, "sources")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("range").agg(F.count("*").alias("n"))
    starts = starts.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("range").orderBy("last", "source")) - 1
    ranked = ranged.withColumn("place", place).join(starts, "range").withColumn("place", F.col("start") + F.col("place"))
    weight = F.element_at(F.lit(list(weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("long")
    table = materialize(ranked.select("source", "source_size", weight.alias("weight")), "weights")

    total = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    clamped, free = 0, table.agg(F.sum("weight")).first()[0] or 0
    ceiling = F.col("source_size") * cap
    while free:
        # the level rises from round to round, so what was above its ceiling once stays above it
        level = F.lit(float(total - clamped)) * F.col("weight") / F.lit(float(free))
        above = level > ceiling
        sums = table.agg(F.sum(F.when(above, ceiling)), F.sum(F.when(~above, F.col("weight")))).first()
        if (sums[0] or 0, sums[1] or 0) == (clamped, free):
            break
        clamped, free = sums[0] or 0, sums[1] or 0
    target = F.least(level, ceiling.cast("double")) if free else ceiling.cast("double")
    return table.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: int = 2, seed: str = "mix",
        row: str | None = None) -> DataFrame:
    """``(doc_id, source, size, source_size, target, repeats)`` per row of ``docs``, and ``row`` if it is named.

    A source whose target is r times its size takes every document floor(r) times, and once more those that
    come first in an order by MD5 of the seed and the id, as long as half of a document still fits. So a
    source misses its target by less than one document, reruns agree, and no document is taken more than
    ceil(r) <= ``cap`` times.

    Null texts and texts without words have size 0. Ties and repeated rows are ordered by the size and then
    arbitrarily among equals, which changes no sum. ``row`` names a column of ``docs`` that tells rows apart; the
    order is then by MD5 of the seed, the id and it, so rows of one id are ordered and dealt like others. A null source is a source of its own. No rows, or no
    words at all: targets are 0. Columns of ``docs`` other than these three are ignored.
    """
    more = [row] if row else []
    sizes = materialize(docs.select("doc_id", "source", word_count().alias("size"), *more), "sizes")
    targets = source_targets(sizes, weights, share, cap)
    # slices follow the order, so a source of any size is summed by many tasks
    digits = max(1, ceil(log(max(sizes.count() / SLICE, 1), 16)))
    told = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), *(F.concat(F.lit(":"), F.col(c).cast("string")) for c in more)]
    order = F.md5(F.concat(F.lit(f"{seed}:"), *told).cast("binary"))
    drawn = sizes.withColumn("draw", order).withColumn("slice", F.substring("draw", 1, digits))
    slices = drawn.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    upto = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("start", F.coalesce(F.sum("slice_size").over(upto), F.lit(0)))
    facts = slices.alias("s").join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
    facts = facts.select(F.col("s.source").alias("of"), F.col("slice").alias("at"), "start", "source_size", "target")
    within = Window.partitionBy("source", "slice").orderBy("draw", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = drawn.withColumn("sum", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(facts, F.col("source").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("at")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    extra = F.col("target") - F.col("whole") * F.col("source_size")
    once_more = (F.col("size") > 0) & (F.col("start") + F.col("sum") + F.col("size") / 2 <= extra)
    placed = placed.withColumn("whole", whole).withColumn("repeats", F.col("whole") + once_more.cast("long"))
    return placed.select("doc_id", "source", "size", "source_size", "target", "repeats", *more)

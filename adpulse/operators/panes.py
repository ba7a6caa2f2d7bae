"""Pane partials: mergeable pieces of the window metrics, kept as a table.

A pane is a short tumbling window, a minute say. Its partial rows are of two kinds: per dimensions the counts, sums and
the earliest instant, and per key and user the panes the user was seen in, as bits of a word of 60 panes. Rows of one
kind merge by adding and or-ing, in any order and any number of times, so a table of them can be appended to by every
load, and any window made of whole panes, tumbling or sliding, is rolled up from it, exact users included, without
reading the events again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import Side, side_of
from .metrics import BLOCK, _batch_blocks, _check, _dims, _keys, _unpacked, finish

_DAY_MICROS = 86_400_000_000


def pane_partials(events: DataFrame, side: str | Side, pane_ms: int = 60_000) -> DataFrame:
    """Partial rows of valid events for panes of ``pane_ms``: one shuffle, both kinds combined before it."""
    side = side_of(side)
    _check(pane_ms, pane_ms, "action", "exact")
    rows = _batch_blocks(events, side, pane_ms, pane_ms, "action", "exact")
    return rows.drop("_bits").withColumnsRenamed({"_block": "block", "_windows": "panes"})


def merge_panes(panes: DataFrame, side: str | Side) -> DataFrame:
    """One row where several loads left one each: sums add, panes of a user are joined, the earliest instant stays."""
    side = side_of(side)
    # a row of sums belongs to its pane, a user's row to the whole block
    pane = F.when(F.col("is_user"), F.lit(0)).otherwise(F.col("panes")).alias("pane")
    merged = panes.groupBy("block", pane, *_dims(side), "user_id", "is_user").agg(
        F.bit_or("panes").alias("panes"), F.sum("n").alias("n"),
        *[F.sum(f"sum_{c}").alias(f"sum_{c}") for c in side.price_columns], F.min("first_ts").alias("first_ts"),
    )
    return merged.select([c for c in panes.columns if c in merged.columns])


def _either(word: str, shift: str, count: int) -> str:
    """``word`` or-ed with itself shifted by 1 to ``count - 1`` places."""
    have = 1
    while have < count:
        step = min(have, count - have)
        word, have = f"({word} | {shift}({word}, {step}))", have + step
    return word


def _roll_check(pane_ms: int, size_ms: int, slide_ms: int) -> tuple[int, int]:
    size, slide = size_ms // pane_ms, slide_ms // pane_ms
    if size_ms % pane_ms or slide_ms % pane_ms or not 1 <= size <= BLOCK or BLOCK % slide:
        raise ValueError(
            f"a window of {size_ms} ms every {slide_ms} ms is not made of at most {BLOCK} panes of {pane_ms} ms, or "
            f"its slide does not divide {BLOCK} panes")
    return size, slide


def window_partials(panes: DataFrame, side: str | Side, pane_ms: int, size_ms: int, slide_ms: int, grain: str = "action") -> DataFrame:
    """Pane partials as partial rows per window, as :func:`adpulse.operators.finish` takes them."""
    side = side_of(side)
    _check(size_ms, slide_ms, grain, "exact")
    size, slide = _roll_check(pane_ms, size_ms, slide_ms)
    keys, dims = _keys(side, grain), _dims(side)
    # sums: a copy per window over the pane, of which there are few rows
    at = f"block * {BLOCK} + bit_count(panes - 1)"
    starts = f"sequence(_at - {size} - pmod(_at - {size}, {slide}L) + {slide}, _at - pmod(_at, {slide}L), {slide}L)"
    sums = panes.where("NOT is_user").selectExpr("*", f"{at} AS _at").selectExpr(
        f"explode({starts}) AS _start", *dims, "user_id", "n", *[f"sum_{c}" for c in side.price_columns], "first_ts", "is_user")
    sums = sums.withColumn("window_start", F.col("_start") * F.lit(pane_ms * 1000)).drop("_start")
    # users: bit m of a word says that a window which starts at pane m of the block holds the user; windows that
    # start in the block before reach over its end
    first = sum(1 << m for m in range(0, BLOCK, slide))
    words = [f"struct(block AS block, {_either('panes', 'shiftright', size)} & {first}L AS word)"]
    if size > 1:
        before = _either(f"shiftleft(panes, {BLOCK + 1 - size})", "shiftleft", size - 1)
        words.append(f"struct(block - 1 AS block, {before} & {first}L AS word)")
    users = panes.where("is_user").selectExpr(*keys, "user_id", f"inline(array({', '.join(words)}))").where("word <> 0")
    users = users.groupBy("block", *keys, "user_id").agg(F.bit_or("word").alias("_windows"))
    users = _unpacked(users.withColumnRenamed("block", "_block"), pane_ms).select(
        "window_start", *keys, "user_id", F.lit(True).alias("is_user"))
    return sums.unionByName(users, allowMissingColumns=True)


def roll_up(
    panes: DataFrame, side: str | Side, pane_ms: int, size_ms: int, slide_ms: int | None = None, grain: str = "action",
    labels: str = "reference", budget_exhausted: bool = False, windows: str | None = None,
) -> DataFrame:
    """Metrics per window out of a table of pane partials, equal to :func:`adpulse.operators.windowed_metrics`.

    Windows are made of 1 to 60 panes; the slide divides 60 panes. Rows need not be merged first. ``windows`` is an SQL
    condition on ``window_start`` (epoch micros) for only some of them.
    """
    slide_ms = slide_ms or size_ms
    partials = window_partials(panes, side, pane_ms, size_ms, slide_ms, grain)
    if windows:
        partials = partials.where(windows)
    return finish(partials, side, size_ms, slide_ms, grain, "exact", labels, budget_exhausted)


def write_panes(panes: DataFrame, path: str, pane_ms: int = 60_000, mode: str = "append") -> None:
    """Store partial rows by the UTC day of their block, few files a day however many tasks there are."""
    micros = F.col("block") * F.lit(BLOCK * pane_ms * 1000)
    day = F.date_from_unix_date(F.floor(micros / _DAY_MICROS).cast("int")).cast("string")
    panes.withColumn("day", day).hint("rebalance", "day").write.mode(mode).partitionBy("day").parquet(path)


def read_panes(spark: SparkSession, path: str) -> DataFrame:
    """The table of :func:`write_panes`; a filter on ``day`` (text) prunes folders."""
    return spark.read.option("basePath", path).parquet(path).withColumn("day", F.col("day").cast("string"))

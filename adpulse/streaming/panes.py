"""All windows of a side from one read of its events.

One stateless streaming query reads, decodes and validates each event once. Per micro-batch it hands rejected rows to
one sink and late rows to another, appends the pane partials of the rest (:mod:`adpulse.operators.panes`) to a store, and
publishes the windows that the watermark has passed, rolled up from the store. So tumbling and sliding windows share
one read and one state, which is a table of a few columns on shared storage.

What a batch does depends on its rows and on what the batch before wrote, and it writes folders named by its number,
so a batch repeated after a failure replaces what it left. A small row per batch tells how far each source has got and
which folders still belong to an open window; only those are read, however long the query has run.
"""

from __future__ import annotations

import json
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from math import gcd
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from ..operators import observe_rejects, pane_partials, rejected, roll_up, valid, validate
from ..schemas import Side, side_of
from ..session import require_utc
from .queries import AsOf, Sink, _start

POLICIES = ("max", "min")


@dataclass(frozen=True)
class Progress:
    """What a batch leaves to the next: per source the latest instant (micros) and when it last moved (epoch ms), the
    stored batches with the end of their last pane, and the watermark."""

    latest: Mapping[str, tuple[int, int]]
    live: Sequence[tuple[int, int]]
    mark: int | None = None

    def moved(self, seen: Mapping[str, int], now_ms: int, delay_ms: int, policy: str, idle_ms: int | None) -> Progress:
        """After a batch whose sources had these latest instants. The watermark never goes back.

        It is the delay behind the furthest source, or with ``min`` behind the one that lags most among those that
        moved within ``idle_ms``.
        """
        latest = dict(self.latest)
        for source, instant in seen.items():
            if source not in latest or instant > latest[source][0]:
                latest[source] = (instant, now_ms)
        if policy == "max":
            held = [t for t, _ in latest.values()]
        else:
            held = [t for t, at in latest.values() if idle_ms is None or now_ms - at <= idle_ms]
        marks = [m for m in (self.mark, (max if policy == "max" else min)(held) - delay_ms * 1000 if held else None) if m is not None]
        return Progress(latest, self.live, max(marks) if marks else None)


def _file(spark: SparkSession, path: str) -> tuple[Any, Any]:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _load(spark: SparkSession, store: str, batch_id: int) -> Progress:
    """What a batch has left, nothing before the first."""
    system, path = _file(spark, f"{store}/progress/{batch_id}.json")
    if not system.exists(path):
        return Progress({}, ())
    source = system.open(path)
    try:
        held = json.loads(bytes(source.readAllBytes()))
    finally:
        source.close()
    return Progress({k: tuple(v) for k, v in held["latest"].items()}, [tuple(x) for x in held["live"]], held["mark"])


def _save(spark: SparkSession, store: str, batch_id: int, progress: Progress) -> None:
    system, path = _file(spark, f"{store}/progress/{batch_id}.json")
    target = system.create(path, True)
    try:
        target.write(bytearray(json.dumps({"latest": dict(progress.latest), "live": list(progress.live), "mark": progress.mark}).encode()))
    finally:
        target.close()


def _delete(spark: SparkSession, path: str) -> None:
    system, target = _file(spark, path)
    system.delete(target, True)


def panes_query(
    events: DataFrame,
    side: str | Side,
    metrics: Sink,
    checkpoint: str,
    name: str = "windows",
    windows: Sequence[tuple[int, int | None]] = ((60_000, None), (300_000, 60_000)),
    delay_ms: int = 30_000,
    lateness_ms: int = 30_000,
    early: bool = False,
    dead_letters: Sink | None = None,
    late: Sink | None = None,
    grain: str = "action",
    labels: str = "reference",
    source: Column | None = None,
    policy: str = "max",
    idle_ms: int | None = None,
    as_of: AsOf = None,
    trigger: Mapping[str, Any] | None = None,
) -> StreamingQuery:
    """Validate a stream of events and publish all ``windows``, pairs of size and slide in milliseconds.

    The watermark is the latest accepted event's instant less ``delay_ms``, of the batches before. A window is published
    when the watermark reaches its end, with all rows read until then, and again, corrected, by every batch that brings
    rows for it before the watermark has passed its end by ``lateness_ms``; with a lateness of 0 it is published once.
    ``early`` also publishes windows that are still open, whenever a batch touches them. Users are always exact.
    Consumers take the last row per window and key.

    ``source`` tells the partitions or topics of a row apart, and ``policy="min"`` lets the one that lags most hold the
    watermark of all, so that none of its rows are late; by default the furthest one moves it. A source without news
    for ``idle_ms`` holds nothing.

    ``dead_letters`` gets rejected rows with code and reason; ``late`` gets accepted rows that came after all their
    windows of some size had closed, with those sizes (milliseconds) in ``late_for``. Such a row still counts in
    windows of other sizes that are open. Both are lists of their batch; counts per batch are observed as ``name``.
    """
    side = side_of(side)
    spark = events.sparkSession
    require_utc(spark)
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")
    kinds = [(size, slide or size) for size, slide in windows]
    pane_ms = gcd(*(x for kind in kinds for x in kind))
    longest, store = max(size for size, _ in kinds) * 1000, f"{checkpoint.rstrip('/')}-panes"
    origin = (F.lit("") if source is None else F.coalesce(source.cast("string"), F.lit(""))).alias("_source")
    annotated = observe_rejects(validate(events.select("*", origin), side, as_of), name)

    def run(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        before = _load(session, store, batch_id - 1)
        batch.persist(StorageLevel.DISK_ONLY)
        try:
            if dead_letters:
                dead_letters(rejected(batch).drop("_source"), batch_id)
            closed = None if before.mark is None else before.mark - lateness_ms * 1000
            good = valid(batch)
            at = F.unix_micros("timestamp")
            if closed is not None:
                good = good.withColumn("late_for", F.filter(F.array(*[
                    F.when(at - F.pmod(at, F.lit(slide * 1000)) + size * 1000 <= closed, F.lit(size)) for size, slide in kinds
                ]), lambda x: x.isNotNull()))
                if late:
                    late(good.where("size(late_for) > 0").drop("_source"), batch_id)
                good = good.where(F.size("late_for") < len(kinds)).drop("late_for")
            elif late:
                late(good.withColumn("late_for", F.array().cast("array<int>")).where("false").drop("_source"), batch_id)
            folder = f"{store}/panes/batch_id={batch_id}"
            pane_partials(good.drop("_source"), side, pane_ms).write.mode("overwrite").parquet(folder)
            written = session.read.parquet(folder)
            # what was late moves no watermark, since the watermark is past it
            seen = {r._source: r.t for r in good.groupBy("_source").agg(F.max(at).alias("t")).collect()}
            now = before.moved(seen, int(time.time() * 1000), delay_ms, policy, idle_ms)
            live = [(b, t) for b, t in before.live if b < batch_id]
            if seen:
                live.append((batch_id, max(seen.values()) + pane_ms * 1000))
            now = replace(now, live=live)
            metrics(_due(session, written, now, before.mark), batch_id)
            # a batch is needed until the last window over its last pane has closed for good
            done = None if now.mark is None else now.mark - lateness_ms * 1000
            _save(session, store, batch_id, replace(now, live=[(b, t) for b, t in live if done is None or t + longest > done]))
            # what the batch before has dropped is needed by no repetition any more
            gone = {b for b, _ in _load(session, store, batch_id - 2).live} - {b for b, _ in before.live}
            for b in gone:
                _delete(session, f"{store}/panes/batch_id={b}")
            _delete(session, f"{store}/progress/{batch_id - 3}.json")
        finally:
            batch.unpersist()

    def _due(session: SparkSession, written: DataFrame, progress: Progress, then: int | None) -> DataFrame:
        """Rows of the windows to publish: newly passed ones, and touched ones that are not closed for good."""
        panes = session.read.schema(written.schema).parquet(*[f"{store}/panes/batch_id={b}" for b, _ in progress.live]) if progress.live else written
        now, parts = progress.mark, []
        for size, slide in kinds:
            end = f"(window_start + {size * 1000}L)"
            if now is None:
                parts.append(roll_up(written.where("false"), side, pane_ms, size, slide, grain, labels))
                continue
            just = f"{end} <= {now}L" + (f" AND {end} > {then}L" if then is not None else "")
            kept = "true" if then is None else f"{end} > {then - lateness_ms * 1000}L"
            rows = roll_up(
                panes, side, pane_ms, size, slide, grain, labels, windows=kept if early else f"{end} <= {now}L AND {kept}" if lateness_ms else just)
            if early or lateness_ms:
                touched = written.where("NOT is_user").selectExpr("(block * 60 + bit_count(panes - 1)) AS _at").distinct().selectExpr(
                    f"explode(sequence((_at * {pane_ms}L - {size}L) - pmod(_at * {pane_ms}L - {size}L, {slide}L) + {slide}L, "
                    f"_at * {pane_ms}L - pmod(_at * {pane_ms}L, {slide}L), {slide}L)) AS _start").distinct()
                touched = touched.select(F.timestamp_millis("_start").alias("window_start"), F.lit(True).alias("_touched"))
                passed = F.unix_micros("window_start") + size * 1000 > (then if then is not None else -(1 << 62))
                if early:  # windows just passed were published as they are, unless touched
                    passed = F.lit(False)
                rows = rows.join(touched, "window_start", "left").where(passed | F.col("_touched")).drop("_touched")
            parts.append(rows)
        return reduce(DataFrame.unionByName, parts)

    writer = annotated.writeStream.outputMode("append").foreachBatch(run)
    return _start(writer, name, checkpoint, trigger or {"processingTime": "60 seconds"})

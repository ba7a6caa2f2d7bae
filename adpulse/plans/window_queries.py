"""Registered queries of sessions, pane tables and streams of several batches.

The streams read the events table dealt into parts by event time, a part a micro-batch. With ``late`` every tenth event
arrives one part later than its time says.
"""

from __future__ import annotations

from collections.abc import Callable
from os.path import basename

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import evaluate_once, pane_partials, read_panes, roll_up, session_metrics, windowed_metrics, write_panes
from ..session import configure, shared_folder
from ..sinks import batch_files, read_batches, read_latest
from ..streaming import dedup_query, mapping_query, panes_query, session_query
from .adapter import AS_OF, BASE_MICROS, SQUEEZE, adapt, read_events
from .queries import (
    _UNUSED, _as_of, _flat_letters, _flushed_stream, FIVE_MINUTES, FLUSH, FLUSH_ID, HOUR, MINUTE, Query, good_events, present, table_stream,
)

GAP = 30_000
BOTH = ((MINUTE, None), (FIVE_MINUTES, MINUTE))
PARTS, PART_MICROS = 4, 900_000_000
NOW_ONLY = {"availableNow": True}
KEYS = {"ssp": ["campaign_id", "action"], "dsp": ["campaign_id", "advertiser_id", "action"]}
MESSAGE_PARTS = 6


def _session(side: str) -> Query:
    return lambda spark, sf_dir: present(session_metrics(good_events(spark, sf_dir, side), side, GAP))


def _stream_session(side: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        out = shared_folder(spark, f"session-{side}")
        session_query(
            _flushed_stream(spark, sf_dir, side, f"{out}/flush"), side, batch_files(f"{out}/rows"), f"{out}/checkpoint",
            basename(out), GAP, as_of=_as_of(), trigger=NOW_ONLY,
        ).awaitTermination()
        return present(read_batches(spark, f"{out}/rows"))

    return run


def _stream_sliding(side: str) -> Query:
    """Sliding windows of a stream, rolled up from panes."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        out = shared_folder(spark, f"sliding-{side}")
        panes_query(
            _flushed_stream(spark, sf_dir, side, f"{out}/flush"), side, batch_files(f"{out}/rows"), f"{out}/checkpoint", basename(out),
            ((FIVE_MINUTES, MINUTE),), lateness_ms=0, as_of=_as_of(), trigger=NOW_ONLY,
        ).awaitTermination()
        return present(read_batches(spark, f"{out}/rows").where(F.col("campaign_id") != FLUSH_ID))

    return run


def _panes(side: str, size_ms: int, slide_ms: int | None = None) -> Query:
    """Two loads, each of half the events, leave pane partials in one table, from which the windows are rolled up."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = shared_folder(spark, f"panes-{side}")
        events = good_events(spark, sf_dir, side)
        first = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0
        for load in (events.where(first), events.where(~first)):
            write_panes(pane_partials(load, side, MINUTE), path, MINUTE)
        return present(roll_up(read_panes(spark, path), side, MINUTE, size_ms, slide_ms))

    return run


def _part(late: bool, sources: bool):
    slot = F.expr(f"least(greatest((unix_micros(cast(ts AS timestamp)) - {BASE_MICROS}) div {SQUEEZE} div {PART_MICROS}L, 0), {PARTS - 1})")
    if late:
        return slot + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    if sources:  # the second source lags one part behind, but for its first
        return slot + F.when((F.col("event_id") % 2 == 1) & (slot > 0), 1).otherwise(0)
    return slot


def _files(spark: SparkSession) -> int:
    """Files of a part, all of one micro-batch."""
    return max(4, spark.sparkContext.defaultParallelism)


class Arrivals:
    """The adapted events as files that arrive part by part, each part as :func:`_files` files."""

    def __init__(self, spark: SparkSession, sf_dir: str, side: str, path: str, late: bool = False, sources: bool = False) -> None:
        self.spark, self.path = spark, path
        table = read_events(spark, sf_dir).withColumns({"part": _part(late, sources).cast("int"), "source": (F.col("event_id") % 2).cast("string")})
        self.rows = adapt(table, side, ("part", "source")).drop(*_UNUSED)
        self.schema = self.rows.schema

    def write(self, parts) -> None:
        for p in parts:
            rows = self.rows.where(F.col("part") == p).repartition(_files(self.spark))
            rows.write.parquet(f"{self.path}/at={p}")

    def flush(self) -> None:
        """An event late enough to close all windows, of either source."""
        fixed = {"timestamp": FLUSH, "action": "CLICK", "part": PARTS + 1}
        texts = {f.name: FLUSH_ID for f in self.schema.fields if isinstance(f.dataType, T.StringType)}
        row = self.spark.range(2).select(*[
            F.col("id").cast("string").alias(f.name) if f.name == "source"
            else F.lit({**texts, **fixed}.get(f.name, 1.0)).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        row.coalesce(1).write.parquet(f"{self.path}/at=9")

    def stream(self) -> DataFrame:
        reader = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", _files(self.spark)).option("recursiveFileLookup", "true")
        return evaluate_once(reader.parquet(self.path))


def _arriving(side: str, result: Callable, late: bool = False, sources: bool = False, restart: bool = False, **options) -> Query:
    """Run the windows of a side over arriving parts to the end; ``result`` reads what they left."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        out = shared_folder(spark, f"windows-{side}")
        arrivals = Arrivals(spark, sf_dir, side, f"{out}/in", late, sources)
        progress = []

        def go() -> None:
            query = panes_query(
                arrivals.stream(), side, batch_files(f"{out}/rows"), f"{out}/checkpoint", basename(out), as_of=_as_of(), trigger=NOW_ONLY,
                dead_letters=batch_files(f"{out}/dead") if result is _dead else None, late=batch_files(f"{out}/late") if result is _late else None,
                source=F.col("source") if sources else None, **options)
            query.awaitTermination()
            progress.extend(query.recentProgress)

        arrivals.write(range(2))
        if restart:  # stopped after these, and started again from its checkpoint
            go()
        arrivals.write(range(2, PARTS + 1))
        arrivals.flush()
        go()
        return result(spark, out, side, progress)

    return run


def _latest(spark: SparkSession, out: str, side: str, progress: list) -> DataFrame:
    rows = read_latest(spark, f"{out}/rows", ["window_type", "window_start", *KEYS[side]])
    return present(rows.where(F.col("campaign_id") != FLUSH_ID))


def _late(spark: SparkSession, out: str, side: str, progress: list) -> DataFrame:
    rows = read_batches(spark, f"{out}/late")
    return present(rows.select("event_id", "timestamp", "part", F.array_join(F.col("late_for").cast("array<string>"), ",").alias("late_for")))


def _dead(spark: SparkSession, out: str, side: str, progress: list) -> DataFrame:
    return present(read_batches(spark, f"{out}/dead").select("event_id", "user_id", "timestamp", "action", "part", "reject_code"))


def _observed(spark: SparkSession, out: str, side: str, progress: list) -> DataFrame:
    """What Spark reported per batch; batches without an event in the table aside."""
    rows = [(p["batchId"], m["processed"], m["rejected"], m["rejection_rate"]) for p in progress for m in [p["observedMetrics"].get(basename(out))] if m and m["processed"]]
    return present(spark.createDataFrame(rows, "batch long, processed long, rejected long, rejection_rate double").where(F.col("batch") < PARTS))


def stream_mapping_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of events joined to a table with several mappings per id, read anew for every batch."""
    configure(spark)
    out = shared_folder(spark, "stream-mapping")

    def mappings(session: SparkSession) -> DataFrame:
        lines = session.read.parquet(f"{sf_dir}/lineitem.parquet")
        return lines.select(F.col("l_orderkey").cast("string").alias("event_id"), F.col("l_returnflag").alias("mapping"))

    events = table_stream(spark, sf_dir).select(F.col("event_id").cast("string").alias("event_id"), "user_id")
    mapping_query(events, mappings, batch_files(f"{out}/rows"), f"{out}/checkpoint", basename(out), NOW_ONLY).awaitTermination()
    return read_batches(spark, f"{out}/rows")


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in six parts, 15 minutes apart, of which repeats within the next two parts are dropped."""
    configure(spark)
    out = shared_folder(spark, "stream-dedup")
    part = (F.col("event_id") % MESSAGE_PARTS).cast("int")
    messages = read_events(spark, sf_dir).select(
        F.col("props").alias("value"), part.alias("part"), F.timestamp_micros(F.lit(BASE_MICROS) + part.cast("long") * PART_MICROS).alias("seen"))
    for p in range(MESSAGE_PARTS):
        messages.where(F.col("part") == p).repartition(_files(spark)).write.parquet(f"{out}/in/at={p}")
    reader = spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", _files(spark)).option("recursiveFileLookup", "true")
    dedup_query(
        reader.parquet(f"{out}/in"), batch_files(f"{out}/rows"), f"{out}/checkpoint", "seen", "5 minutes", name=basename(out), trigger=NOW_ONLY,
    ).awaitTermination()
    return read_batches(spark, f"{out}/rows").select("value", "hash", "part")


def registry() -> dict[str, Query]:
    """The queries of this module by name."""
    out: dict[str, Query] = {}
    for side in ("ssp", "dsp"):
        out |= {
            f"session_{side}": _session(side),
            f"stream_session_{side}": _stream_session(side),
            f"{side}_panes_1hour": _panes(side, HOUR),
            f"{side}_panes_sliding_5min": _panes(side, FIVE_MINUTES, MINUTE),
            f"stream_panes_{side}": _arriving(side, _latest),
            f"stream_update_{side}": _arriving(side, _latest, late=True, windows=BOTH[:1], early=True, lateness_ms=HOUR),
            f"stream_late_{side}": _arriving(side, _late, late=True),
            f"stream_late_metrics_{side}": _arriving(side, _latest, late=True),
            f"stream_sliding_{side}": _stream_sliding(side),
        }
    return out | {
        "stream_restart_ssp": _arriving("ssp", _latest, restart=True),
        "stream_observed_rejects_ssp": _arriving("ssp", _observed),
        "stream_job_dead_letters_ssp": _arriving("ssp", _dead),
        "stream_lagging_source_max": _arriving("ssp", _latest, sources=True, policy="max"),
        "stream_lagging_source_min": _arriving("ssp", _latest, sources=True, policy="min"),
        "stream_mapping_join": stream_mapping_join,
        "stream_dedup": stream_dedup,
    }

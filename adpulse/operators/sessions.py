"""Session windows: per key, events that follow each other within a gap.

A hot key must not be walked through event by event. Two events of one key in the same slot of ``gap`` length are
always in one session, so a table's events are first reduced, per key and slot, to the first and the last instant; the
gaps are then found between the slots of a key, of which there are no more than its time span holds. The metrics are
the same partial rows as those of :mod:`adpulse.operators.metrics`, grouped by slot, which then take the slot's session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import Side, side_of
from .metrics import GRAINS, _dims, _direct_totals, _keys, _measures, _record, _totals

LABEL = "SESSION"


def _check(gap_ms: int, grain: str) -> None:
    if gap_ms <= 0:
        raise ValueError(f"bad gap: {gap_ms} ms")
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")


def _slots(events: DataFrame, gap: int) -> DataFrame:
    return events.filter("timestamp IS NOT NULL").withColumn("_us", F.unix_micros("timestamp")).withColumn(
        "_slot", F.expr(f"(_us - pmod(_us, {gap}L)) div {gap}L")
    )


def session_bounds(events: DataFrame, keys: list[str], gap_ms: int) -> DataFrame:
    """``(*keys, _slot, window_start, window_end)``: the session of every slot of ``gap_ms`` that holds events of a key.

    Bounds are epoch micros. A session ends ``gap_ms`` after its last event; an event just at that end still joins it.
    """
    gap = gap_ms * 1000
    slots = _slots(events.select("timestamp", *keys), gap).groupBy(*keys, "_slot").agg(
        F.min("_us").alias("first"), F.max("_us").alias("last")
    )
    by_time = Window.partitionBy(*keys).orderBy("_slot")
    opens = F.coalesce(F.col("first") - F.lag("last").over(by_time) > gap, F.lit(True))
    numbered = slots.withColumn("opens", opens).withColumn("session", F.sum(F.col("opens").cast("long")).over(by_time))
    whole = Window.partitionBy(*keys, "session")
    return numbered.select(
        *keys, "_slot", F.min("first").over(whole).alias("window_start"), (F.max("last").over(whole) + gap).alias("window_end")
    )


def session_metrics(events: DataFrame, side: str | Side, gap_ms: int = 1_800_000, grain: str = "action") -> DataFrame:
    """Metrics of valid events per session of a key (campaign, advertiser on the demand side, and action), for a table.

    The columns are those of :func:`adpulse.operators.windowed_metrics`; ``window_start`` is the first event,
    ``window_end`` the last one plus the gap. Null timestamps take no part. Null keys are keys of their own.
    """
    side = side_of(side)
    _check(gap_ms, grain)
    if events.isStreaming:
        raise ValueError("on a stream use session_updates()")
    keys, dims = _keys(side, grain), _dims(side)
    slotted = _slots(events.select("timestamp", "user_id", *dims, *side.price_columns), gap_ms * 1000)
    by_dims, by_user = ["_slot", *dims], ["_slot", *keys, "user_id"]
    partials = slotted.groupingSets([by_dims, by_user], *by_dims, "user_id").agg(
        *_measures(side, F.col("timestamp"), "exact"), (F.grouping("user_id") == 0).alias("is_user")
    )
    bounds = session_bounds(events, keys, gap_ms)
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*keys, "_slot"]]
    placed = partials.alias("p").join(bounds.alias("b"), same).select("p.*", "b.window_start", "b.window_end")
    # a user counts once per session, however many slots they are seen in
    once = [c for c in placed.columns if c not in (*side.price_columns, "_slot")]
    users = placed.where("is_user").groupBy("window_start", "window_end", *keys, "user_id").agg(F.lit(True).alias("is_user"))
    parts = placed.where("NOT is_user").select(once).unionByName(users, allowMissingColumns=True)
    totals = _totals(parts, side, grain, "exact", also=("window_end",))
    return _record(totals, side, LABEL, "window_end", grain, False)


def session_updates(events: DataFrame, side: str | Side, gap_ms: int = 1_800_000, grain: str = "action") -> DataFrame:
    """:func:`session_metrics` of a watermarked stream, for append mode: a session's row when no event can join it.

    Spark merges the state of sessions that an event connects. A session can't be split over tasks by user, so its
    users are held as a set in its one state row, and a key's sessions are in one task.
    """
    side = side_of(side)
    _check(gap_ms, grain)
    window = F.session_window("timestamp", f"{gap_ms} milliseconds").alias("_window")
    totals = _direct_totals(events, side, [window, *_keys(side, grain)], "size(collect_set(user_id))").selectExpr(
        "*", "unix_micros(_window.start) AS window_start", "unix_micros(_window.end) AS window_end"
    )
    return _record(totals, side, LABEL, "window_end", grain, False)

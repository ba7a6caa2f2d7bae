from __future__ import annotations

from datetime import timedelta

import pytest

from adpulse.operators import session_metrics
from adpulse.streaming import session_query
from adpulse.sinks import batch_files, read_batches
from adpulse.operators.sessions import session_bounds
from tests.build import at, event
from tests.test_streaming import AS_OF, NOW_ONLY, stream, wire, write_batches


def frame(spark, side, rows):
    from adpulse.schemas import side_of

    return spark.createDataFrame([event(side, **r) for r in rows], side_of(side).event)


def spans(df):
    return sorted((r.window_start.minute * 60 + r.window_start.second, (r.window_end - r.window_start) // timedelta(seconds=1), r.event_count, r.unique_users) for r in df.collect())


def test_gaps_split_and_touching_events_join(spark):
    seconds = [0, 9, 19, 20, 31, 100, 110, 120.5]
    rows = [{"event_id": str(s), "timestamp": at(s), "user_id": f"u{i % 2}"} for i, s in enumerate(seconds)]
    assert spans(session_metrics(frame(spark, "ssp", rows), "ssp", 10_000)) == [
        (0, 30, 4, 2), (31, 10, 1, 1), (100, 20, 2, 2), (120, 10, 1, 1)]


def test_a_user_counts_once_over_many_slots(spark):
    rows = [{"event_id": str(s), "timestamp": at(s), "user_id": "u"} for s in range(0, 300, 5)]
    out = session_metrics(frame(spark, "dsp", rows), "dsp", 10_000).collect()
    assert [(r.window_type, r.event_count, r.unique_users, r.duration_seconds) for r in out] == [("SESSION", 60, 1, 305)]


def test_keys_and_grains(spark):
    rows = [{"event_id": f"{a}{s}", "timestamp": at(s), "action": a} for a, s in (("CLICK", 0), ("VIEW", 8), ("CLICK", 16))]
    events = frame(spark, "ssp", rows)
    assert spans(session_metrics(events, "ssp", 10_000)) == [(0, 10, 1, 1), (8, 10, 1, 1), (16, 10, 1, 1)]
    assert spans(session_metrics(events, "ssp", 10_000, grain="campaign")) == [(0, 26, 3, 1)]
    assert session_metrics(events.where("false"), "ssp", 10_000).collect() == []
    for bad in ({"gap_ms": 0}, {"grain": "minute"}):
        with pytest.raises(ValueError):
            session_metrics(events, "ssp", **bad)


def test_the_gaps_are_found_between_slots_not_events(spark):
    """A key with very many events is reduced before its events are put in order."""
    from pyspark.sql import functions as F

    events = spark.range(200_000).select(F.timestamp_millis(F.col("id") * 5).alias("timestamp"), F.lit("c").alias("campaign_id"))
    bounds = session_bounds(events, ["campaign_id"], 10_000)
    assert bounds.count() == 100 and bounds.select("window_start", "window_end").distinct().count() == 1
    plan = bounds._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.index("HashAggregate")  # printed from the top


def test_stream_merges_sessions_that_an_event_connects(spark, tmp_path):
    batches = [[wire("ssp", event_id=str(s), timestamp=at(s))] for s in (10, 28, 19, 60, 400)]
    write_batches(str(tmp_path / "in"), batches)
    session_query(stream(spark, str(tmp_path / "in"), "ssp"), "ssp", batch_files(str(tmp_path / "out")), str(tmp_path / "cp"), gap_ms=10_000,
                  as_of=AS_OF, trigger=NOW_ONLY).awaitTermination()
    assert spans(read_batches(spark, str(tmp_path / "out"))) == [(10, 28, 3, 1), (60, 10, 1, 1)]

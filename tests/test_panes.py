from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from adpulse.operators import merge_panes, pane_partials, read_panes, roll_up, windowed_metrics, write_panes
from adpulse.sinks import batch_files, read_batches, read_latest
from adpulse.streaming import panes_query
from adpulse.streaming.panes import Progress
from tests.build import at
from tests.test_sessions import frame
from tests.test_streaming import AS_OF, NOW_ONLY, stream, wire, write_batches

KEYS = ["window_type", "window_start", "campaign_id", "action"]


def shape(df):
    df = df.drop("created_at")
    return sorted(map(str, df.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in df.dtypes]).collect()))


def some(side, n=400):
    actions = {"ssp": ["IMPRESSION", "CLICK", "VIEW"], "dsp": ["BID_WIN", "BID_RESPONSE", "CLICK"]}[side]
    return [{"event_id": str(i), "timestamp": at(i * 37 % 9000), "user_id": f"u{i % 11}", "action": actions[i % 3], "campaign_id": f"c{i % 2}",
             "advertiser_id": f"a{i % 3}"} for i in range(n)]


@pytest.mark.parametrize("side", ["ssp", "dsp"])
def test_windows_rolled_up_from_a_table_of_two_loads(spark, tmp_path, side):
    events = frame(spark, side, some(side))
    for load in (events.where("int(event_id) < 150"), events.where("int(event_id) >= 150")):
        write_panes(pane_partials(load, side), str(tmp_path / "panes"))
    assert [f for f in os.listdir(tmp_path / "panes") if f.startswith("day=")] == ["day=2024-03-15"]
    panes = read_panes(spark, str(tmp_path / "panes"))
    merged = merge_panes(panes, side)
    assert merged.count() < panes.count()
    for size, slide, grain in ((1, 1, "action"), (5, 1, "campaign"), (60, 60, "action"), (7, 2, "action"), (60, 1, "campaign"), (3, 3, "action")):
        want = shape(windowed_metrics(events, side, size * 60_000, slide * 60_000, grain))
        for table in (panes, merged):
            assert shape(roll_up(table, side, 60_000, size * 60_000, slide * 60_000, grain)) == want


def test_windows_that_panes_cannot_make(spark):
    panes = pane_partials(frame(spark, "ssp", some("ssp", 3)), "ssp")
    for size, slide in ((90_000, 60_000), (3_660_000, 60_000), (420_000, 420_000)):
        with pytest.raises(ValueError):
            roll_up(panes, "ssp", 60_000, size, slide)
    assert roll_up(panes.where("false"), "ssp", 60_000, 60_000).collect() == []


def run(spark, tmp_path, seconds, **options):
    """A batch per list of seconds; the rows published per batch as (batch, minute, count), and the late ones."""
    batches = [[wire("ssp", event_id=str(s), timestamp=at(s), user_id=f"u{s}") for s in batch] for batch in seconds]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_batches(source, batches)
    query = panes_query(
        stream(spark, source, "ssp"), "ssp", batch_files(out), str(tmp_path / "cp"), as_of=AS_OF, trigger=NOW_ONLY,
        late=batch_files(str(tmp_path / "late")), **options)
    query.awaitTermination()
    rows = spark.read.parquet(out).where("duration_seconds = 60").collect()
    late = read_batches(spark, str(tmp_path / "late")).collect()
    assert all(r.event_count == r.unique_users for r in rows)
    return sorted((r.batch_id, r.window_start.minute, r.event_count) for r in rows), sorted((r.event_id, tuple(r.late_for)) for r in late)


MINUTE_ONLY = ((60_000, None),)


def test_a_window_is_published_when_passed_and_again_when_corrected(spark, tmp_path):
    rows, late = run(spark, tmp_path, [[10], [95], [40], [125], [50], [400]], windows=MINUTE_ONLY)
    # passed at 60 + 30; 40 corrects it, 50 comes after 60 + 30 + 30
    assert rows == [(1, 0, 1), (2, 0, 2), (5, 1, 1), (5, 2, 1)] and late == [("50", (60_000,))]


def test_without_lateness_a_window_is_published_once(spark, tmp_path):
    rows, late = run(spark, tmp_path, [[10], [120], [40], [41], [500]], windows=MINUTE_ONLY, delay_ms=60_000, lateness_ms=0)
    assert rows == [(1, 0, 1), (4, 2, 1)] and [i for i, _ in late] == ["40", "41"]


def test_early_rows_of_open_windows(spark, tmp_path):
    rows, late = run(spark, tmp_path, [[10], [20], [70, 30], [75]], windows=MINUTE_ONLY, early=True)
    assert rows == [(0, 0, 1), (1, 0, 2), (2, 0, 3), (2, 1, 1), (3, 1, 2)] and not late


def test_a_row_late_for_one_size_counts_in_the_other(spark, tmp_path):
    rows, late = run(spark, tmp_path, [[10], [130], [20], [880]])
    assert late == [("20", (60_000,))] and (3, 2, 1) in rows and (2, 0, 2) not in rows
    five = read_latest(spark, str(tmp_path / "out"), KEYS).where("duration_seconds = 300").collect()
    counts = {r.window_start.minute: r.event_count for r in five if r.window_start.hour == 10}
    assert counts[0] == 3 and counts[2] == 1


def test_only_open_batches_are_kept(spark, tmp_path):
    run(spark, tmp_path, [[60 * i] for i in range(12)], windows=MINUTE_ONLY)
    kept = {int(d.split("=")[1]) for d in os.listdir(tmp_path / "cp-panes" / "panes")}
    assert kept and min(kept) >= 7 and len(os.listdir(tmp_path / "cp-panes" / "progress")) <= 8


def test_a_restart_goes_on_where_it_stopped(spark, tmp_path):
    run(spark, tmp_path, [[10]], windows=MINUTE_ONLY)
    for i, s in enumerate((20, 400)):
        path = tmp_path / "in" / f"9{i}.json"
        path.write_text(wire("ssp", event_id=str(s), timestamp=at(s), user_id=str(s)) + "\n")
        os.utime(path, (1_700_000_100 + i, 1_700_000_100 + i))
    panes_query(stream(spark, str(tmp_path / "in"), "ssp"), "ssp", batch_files(str(tmp_path / "out")), str(tmp_path / "cp"), windows=MINUTE_ONLY,
                as_of=AS_OF, trigger=NOW_ONLY).awaitTermination()
    assert [r.event_count for r in read_batches(spark, str(tmp_path / "out")).collect()] == [2]


def test_watermark_over_sources():
    start = Progress({}, ())
    a = start.moved({"a": 100_000_000, "b": 40_000_000}, 0, 30_000, "min", 1000)
    assert a.mark == 10_000_000 and start.moved({"a": 100_000_000, "b": 40_000_000}, 0, 30_000, "max", None).mark == 70_000_000
    assert a.moved({"a": 200_000_000}, 500, 30_000, "min", 1000).mark == 10_000_000
    idle = a.moved({"a": 200_000_000}, 2000, 30_000, "min", 1000)
    assert idle.mark == 170_000_000  # the lagging source has been silent for too long
    assert idle.moved({"b": 50_000_000}, 2100, 30_000, "min", 1000).mark == 170_000_000  # and can't set it back
    assert a.moved({}, 9000, 30_000, "min", 1000).mark == 10_000_000


def test_unknown_policy(spark):
    with pytest.raises(ValueError, match="policy"):
        panes_query(spark.readStream.format("rate").load(), "ssp", batch_files("x"), "y", policy="median")

from __future__ import annotations

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from adpulse.config import Settings
from adpulse.operators import valid_events, windowed_metrics
from adpulse.operators.dedup import deduplicate
from adpulse.sinks import batch_files, read_batches
from adpulse.sources import decode, read_archive, read_json_lines
from adpulse.streaming import Edges, metrics_query, start
from tests.build import at, event

AS_OF = datetime(2024, 3, 15, 10, 10)
NOW_ONLY = {"availableNow": True}


def wire(side, **changes):
    row = event(side, **changes)
    row["timestamp"] = row["timestamp"].strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    return json.dumps(row)


def write_batches(folder, batches):
    """One file of JSON lines per batch, with rising modification times."""
    os.makedirs(folder)
    for i, lines in enumerate(batches):
        path = f"{folder}/{i:03}.json"
        with open(path, "w") as out:
            out.write("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


def stream(spark, folder, side):
    return decode(read_json_lines(spark, folder, stream=True, max_files_per_trigger=1), side)


def run_metrics(spark, tmp_path, side, batches, **options):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_batches(source, batches)
    query = metrics_query(
        stream(spark, source, side), side, batch_files(out), str(tmp_path / "cp"), as_of=AS_OF, trigger=NOW_ONLY, **options
    )
    query.awaitTermination()
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    return read_batches(spark, out), dropped


def test_late_rows_are_dropped_exactly_at_the_watermark(spark, tmp_path):
    batches = [[wire("ssp", event_id=str(s), timestamp=at(s))] for s in (10, 120, 40, 41, 500)]
    rows, dropped = run_metrics(spark, tmp_path, "ssp", batches)
    counts = {r.window_start.minute: r.event_count for r in rows.collect()}
    assert counts == {0: 1, 2: 1}  # the window of second 500 is still open
    assert dropped == 4  # two late events, each on its way into a measure row and a user row
    assert spark.conf.get("spark.sql.streaming.statefulOperator.allowMultiple", "true") == "true"


def test_out_of_order_rows_within_the_delay_count(spark, tmp_path):
    batches = [[wire("ssp", event_id=str(s), timestamp=at(s))] for s in (10, 100, 40, 300)]
    rows, dropped = run_metrics(spark, tmp_path, "ssp", batches)
    assert {r.window_start.minute: r.event_count for r in rows.collect()} == {0: 2, 1: 1}
    assert dropped == 0


def test_rejected_future_event_does_not_advance_the_watermark(spark, tmp_path):
    batches = [
        [wire("ssp", event_id="far", timestamp=datetime(2025, 1, 1))],
        [wire("ssp", event_id="a", timestamp=at(10))], [wire("ssp", event_id="b", timestamp=at(20))],
        [wire("ssp", event_id="flush", timestamp=at(600))],
    ]
    rows, dropped = run_metrics(spark, tmp_path, "ssp", batches)
    assert [r.event_count for r in rows.collect()] == [2] and dropped == 0


@pytest.mark.parametrize("side", ["ssp", "dsp"])
@pytest.mark.parametrize("slide_ms, grain", [(None, "action"), (60_000, "campaign")])
def test_stream_over_many_batches_equals_the_table(spark, tmp_path, side, slide_ms, grain):
    actions = {"ssp": ["IMPRESSION", "CLICK", "VIEW"], "dsp": ["BID_WIN", "BID_RESPONSE", "CLICK"]}[side]
    lines = [
        wire(side, event_id=str(i), timestamp=at(i * 3 % 240 + i / 100), user_id=f"u{i % 7}", action=actions[i % 3],
             advertiser_id=f"a{i % 2}", campaign_id=f"c{i % 2}", metadata={})
        for i in sorted(range(80), key=lambda i: (i * 3 % 240) // 60)
    ]
    batches = [lines[i:i + 20] for i in range(0, 80, 20)] + [[wire(side, event_id="flush", timestamp=at(899), campaign_id="flush")]]
    size = 300_000 if slide_ms else 60_000
    rows, _ = run_metrics(spark, tmp_path, side, batches, size_ms=size, slide_ms=slide_ms, grain=grain, delay_ms=240_000)
    table = valid_events(decode(read_json_lines(spark, str(tmp_path / "in")), side), side, AS_OF)
    want = windowed_metrics(table.filter("campaign_id <> 'flush'"), side, size, slide_ms, grain)
    shape = lambda df: sorted(map(str, df.drop("created_at").filter("campaign_id <> 'flush'").select(
        *[F.round(c, 6).alias(c) if t == "double" else c for c, t in df.drop("created_at").dtypes]).collect()))
    assert shape(rows) == shape(want) and len(shape(want)) > 5


def test_update_mode_gives_refinements(spark, tmp_path):
    batches = [[wire("ssp", event_id=str(s), timestamp=at(s), user_id=f"u{s}")] for s in (10, 20, 30)]
    rows, _ = run_metrics(spark, tmp_path, "ssp", batches, output_mode="update", unique="approx")
    assert sorted((r.event_count, r.unique_users) for r in rows.collect()) == [(1, 1), (2, 2), (3, 3)]
    with pytest.raises(ValueError, match="approx"):
        metrics_query(stream(spark, str(tmp_path / "in"), "ssp"), "ssp", batch_files("x"), "y", output_mode="update")


def test_stream_dedup(spark, tmp_path):
    a, b = wire("ssp", event_id="a"), wire("ssp", event_id="b")
    write_batches(str(tmp_path / "in"), [[a, a], [b, a]])
    raw = read_json_lines(spark, str(tmp_path / "in"), stream=True, max_files_per_trigger=1)
    timed = raw.withColumn("seen", F.lit("2024-03-15 10:00:00").cast("timestamp"))
    with pytest.raises(ValueError):
        deduplicate(timed)
    out = str(tmp_path / "out")
    query = deduplicate(timed, event_time="seen", delay="1 minute").writeStream.foreachBatch(batch_files(out))
    query.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.value for r in read_batches(spark, out).collect()) == sorted([a, b])


@pytest.mark.parametrize("mode, names", [
    ("aggregation", ["windows"]), ("storage", ["archive"]), ("all", ["windows", "archive"]),
])
def test_job_end_to_end_on_files(spark, tmp_path, mode, names):
    source = str(tmp_path / "in")
    good = [wire("dsp", event_id=f"g{i}", timestamp=at(i), user_id=f"u{i % 3}") for i in range(10)]
    bad = [wire("dsp", event_id="b1", bid_price=9999.0, timestamp=at(5)), wire("dsp", event_id="", timestamp=at(5)), "junk"]
    write_batches(source, [good + bad, [wire("dsp", event_id="flush", timestamp=at(899))]])
    settings = Settings.from_mapping({
        "kafka.bootstrap.servers": "unused", "s3.output.bucket": str(tmp_path / "bucket"),
        "checkpoint.storage-path": str(tmp_path / "cp"),
    })
    reads = []
    edges = Edges(
        events=lambda storage: reads.append(storage) or stream(spark, source, "dsp"),
        metrics=batch_files(f"{tmp_path}/metrics"),
        dead_letters=batch_files(str(tmp_path / "dead")), as_of=AS_OF,
    )
    queries = start(spark, "dsp", settings, mode, edges, NOW_ONLY)
    assert [q.name for q in queries] == [f"dsp_{n}" for n in names]
    for query in queries:
        query.awaitTermination()
    assert reads == {"aggregation": [False], "storage": [True], "all": [False, True]}[mode]  # one read feeds all windows
    if mode != "storage":
        rows = read_batches(spark, f"{tmp_path}/metrics").where("event_count > 1")
        minute = rows.where("duration_seconds = 60").collect()
        assert [(r.event_count, r.unique_users, r.bid_wins) for r in minute] == [(10, 3, 10)]
        assert rows.where("duration_seconds = 300 AND event_count = 10").count() == 5
        dead = {r.event_id: r.reject_code for r in read_batches(spark, str(tmp_path / "dead")).collect()}
        assert dead == {"b1": "bid_price_above_max", "": "event_id_blank"}
        seen = [p["observedMetrics"]["dsp_windows"] for p in queries[0].recentProgress if p["observedMetrics"]]
        assert sum(m["rejected"] for m in seen) == 2 and sum(m["processed"] for m in seen) == 13
    if mode != "aggregation":
        stored = read_archive(spark, settings.archive_path("dsp"), "dsp")
        assert stored.count() == 12 and stored.filter("event_id = 'b1'").count() == 1
        assert {r.hour for r in stored.select("hour").distinct().collect()} == {"10"}


def test_job_resumes_from_its_checkpoint(spark, tmp_path):
    source, out, cp = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    write_batches(source, [[wire("ssp", event_id="a", timestamp=at(10))]])

    def run():
        metrics_query(stream(spark, source, "ssp"), "ssp", batch_files(out), cp, as_of=AS_OF, trigger=NOW_ONLY).awaitTermination()

    run()
    for i, s in enumerate((20, 400)):
        path = f"{source}/9{i}.json"
        with open(path, "w") as f:
            f.write(wire("ssp", event_id=str(s), timestamp=at(s)) + "\n")
        os.utime(path, (1_700_000_100 + i, 1_700_000_100 + i))
    run()
    assert [r.event_count for r in read_batches(spark, out).collect()] == [2]


def test_unknown_mode(spark):
    settings = Settings.from_mapping({"kafka.bootstrap.servers": "b", "s3.output.bucket": "o"})
    with pytest.raises(ValueError, match="unknown mode"):
        start(spark, "ssp", settings, "both")

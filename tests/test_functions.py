from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from adpulse import functions as fn
from adpulse.schemas import ACTIONS, DSP_ACTIONS, SSP_ACTIONS
from adpulse.session import require_utc


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def ts(text):
    return F.lit(text).cast("timestamp")


def text_of(spark, col):
    return one(spark, F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@pytest.mark.parametrize("value, blank", [
    ("", True), (" ", True), ("\t\n", True), (chr(0xA0), True), (chr(0x3000) + " ", True), ("\x1c", True),
    ("a", False), (" a ", False), (chr(0x85), False), (chr(0x200B), False), (chr(0xE9), False), ("~", False), (chr(0x7F), False),
    (None, True),
])
def test_blank_covers_unicode_white_space(spark, value, blank):
    assert spark.createDataFrame([(value,)], "v string").select(fn.is_blank("v")).first()[0] is blank


def test_action_sets():
    assert len(ACTIONS) == 15 and len(SSP_ACTIONS) == 9 and len(DSP_ACTIONS) == 9
    assert set(SSP_ACTIONS) & set(DSP_ACTIONS) == {"IMPRESSION", "CLICK", "CONVERSION"}
    assert "VIEW" in SSP_ACTIONS and "VIEW" not in DSP_ACTIONS
    assert set(SSP_ACTIONS) | set(DSP_ACTIONS) == set(ACTIONS)


def test_parse_action_ignores_case_and_refuses_unknown(spark):
    assert one(spark, fn.parse_action(F.lit("bid_Win"))) == "BID_WIN"
    assert one(spark, fn.parse_action(F.lit("nothing"))) is None
    with pytest.raises(Exception, match="unknown action"):
        one(spark, fn.parse_action(F.lit("nothing"), strict=True))


def test_action_membership(spark):
    assert one(spark, fn.is_action_of("ssp", F.lit("VIEW"))) is True
    assert one(spark, fn.is_action_of("dsp", F.lit("VIEW"))) is False
    assert one(spark, fn.is_action_of("dsp", F.lit(None).cast("string"))) is False


def test_truncation(spark):
    t = ts("2024-03-15 14:37:45.123456")
    assert text_of(spark, fn.truncate_to_minute(t)) == "2024-03-15 14:37:00.000000"
    assert text_of(spark, fn.truncate_to_hour(t)) == "2024-03-15 14:00:00.000000"
    assert text_of(spark, fn.truncate_to_day(t)) == "2024-03-15 00:00:00.000000"
    assert text_of(spark, fn.truncate_to_n_minutes(ts("2024-03-15 14:03:00"), 5)) == "2024-03-15 14:00:00.000000"
    assert text_of(spark, fn.truncate_to_n_minutes(ts("2024-03-15 14:07:59"), 5)) == "2024-03-15 14:05:00.000000"


def test_truncation_before_1970(spark):
    t = ts("1969-12-31 23:58:30")
    assert text_of(spark, fn.truncate_to_minute(t)) == "1969-12-31 23:58:00.000000"
    # the n-minute form rounds toward zero
    assert text_of(spark, fn.truncate_to_n_minutes(t, 5)) == "1970-01-01 00:00:00.000000"


@pytest.mark.parametrize("n", [0, 61, -1])
def test_n_minutes_is_bounded(n):
    with pytest.raises(ValueError):
        fn.truncate_to_n_minutes("t", n)


def test_partition_path(spark):
    t = ts("2024-03-05 04:59:59")
    assert one(spark, fn.partition_path(t)) == "year=2024/month=03/day=05/hour=04"
    assert one(spark, fn.partition_path(t, "SSP")) == "event_type=SSP/year=2024/month=03/day=05/hour=04"


def test_epoch_millis_and_current_window(spark):
    assert text_of(spark, fn.from_epoch_millis(F.lit(1710496800123))) == "2024-03-15 10:00:00.123000"
    row = spark.range(1).select(
        fn.current_minute_start_ms().alias("m"), fn.current_hour_start_ms().alias("h"),
        F.unix_millis(F.current_timestamp()).alias("now"),
    ).first()
    assert row.m % 60_000 == 0 and 0 <= row.now - row.m < 60_000
    assert row.h % 3_600_000 == 0 and 0 <= row.now - row.h < 3_600_000


@pytest.mark.parametrize("event, inside", [
    ("2024-03-15 10:00:00", True), ("2024-03-15 09:00:00", True), ("2024-03-15 08:59:59", False),
    ("2024-03-15 10:00:01", False), ("2024-03-15 10:00:00.9", True),
])
def test_processing_window(spark, event, inside):
    assert one(spark, fn.within_processing_window(ts(event), ts("2024-03-15 10:00:00.1"))) is inside


@pytest.mark.parametrize("value, text", [
    ("2024-03-15 10:00:00", "2024-03-15T10:00:00Z"),
    ("2024-03-15 10:00:00.25", "2024-03-15T10:00:00.250Z"),
    ("2024-03-15 10:00:00.000001", "2024-03-15T10:00:00.000001Z"),
])
def test_iso_instant(spark, value, text):
    assert one(spark, fn.iso_instant(ts(value))) == text


def test_fingerprint_and_envelope(spark):
    raw = '{"a": 1}'
    import hashlib
    import json

    digest = hashlib.md5(raw.encode()).hexdigest()
    assert one(spark, fn.fingerprint(F.lit(raw))) == digest
    assert json.loads(one(spark, fn.envelope(F.lit(raw)))) == {"hash": digest, "data": {"a": 1}, "version": "v2"}


def test_utc_is_required(spark):
    require_utc(spark)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Oslo")
    try:
        with pytest.raises(ValueError):
            require_utc(spark)
        # truncation does not depend on the zone
        t = F.timestamp_micros(F.lit(int(datetime(2024, 3, 15, 14, 0, tzinfo=timezone.utc).timestamp()) * 1_000_000))
        assert one(spark, F.unix_seconds(fn.truncate_to_day(t))) % 86400 == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

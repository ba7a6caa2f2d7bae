from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from adpulse.operators import (
    observe_rejects,
    reject_codes,
    reject_stats,
    rejected,
    valid,
    valid_events,
    validate,
)
from tests.build import NOW, events

AGE = timedelta(hours=24)
AHEAD = timedelta(minutes=5)
SECOND = timedelta(seconds=1)


def code(spark, side, **changes):
    return validate(events(spark, side, changes), side, NOW).first()["reject_code"]


@pytest.mark.parametrize("side, changes, expected", [
    ("ssp", {}, None), ("dsp", {}, None),
    ("ssp", {"event_id": ""}, "event_id_blank"), ("ssp", {"ad_id": " "}, "ad_id_blank"),
    ("ssp", {"campaign_id": "\t"}, "campaign_id_blank"), ("ssp", {"creative_id": ""}, "creative_id_blank"),
    ("ssp", {"advertiser_id": ""}, "advertiser_id_blank"), ("dsp", {"user_id": " "}, "user_id_blank"),
    ("ssp", {"timestamp": NOW - timedelta(hours=25)}, "too_old"),
    ("ssp", {"timestamp": NOW - AGE}, None), ("ssp", {"timestamp": NOW - AGE - SECOND}, "too_old"),
    ("ssp", {"timestamp": NOW + timedelta(seconds=600)}, "in_future"),
    ("dsp", {"timestamp": NOW + AHEAD}, None), ("dsp", {"timestamp": NOW + AHEAD + SECOND}, "in_future"),
    ("ssp", {"publisher_id": ""}, "publisher_id_blank"),
    ("ssp", {"action": "BID_WIN"}, "action_not_allowed"), ("dsp", {"action": "AD_RENDER"}, "action_not_allowed"),
    ("dsp", {"action": "VIEW"}, "action_not_allowed"),
    ("ssp", {"floor_price": -0.01}, "floor_price_negative"), ("ssp", {"floor_price": 500.0}, None),
    ("ssp", {"floor_price": 500.01}, "floor_price_above_max"),
    ("ssp", {"winning_bid": -1.0}, "winning_bid_negative"), ("ssp", {"winning_bid": 1e9}, None),
    ("dsp", {"bid_price": -1.0}, "bid_price_negative"), ("dsp", {"bid_price": 1001.0}, "bid_price_above_max"),
    ("dsp", {"bid_price": 1000.0}, None), ("dsp", {"clearing_price": -0.5}, "clearing_price_negative"),
    ("dsp", {"budget_remaining": -100.0}, "budget_remaining_negative"),
    ("ssp", {"floor_price": float("nan")}, None), ("dsp", {"bid_price": float("nan")}, None),
    ("ssp", {"event_id": "", "ad_id": "", "floor_price": -1.0}, "event_id_blank"),
    ("ssp", {"publisher_id": "", "timestamp": NOW + timedelta(hours=1)}, "in_future"),
])
def test_first_broken_rule(spark, side, changes, expected):
    assert code(spark, side, **changes) == expected


def test_rule_order(spark):
    assert reject_codes("ssp")[:8] == [
        "event_id_blank", "ad_id_blank", "campaign_id_blank", "creative_id_blank",
        "advertiser_id_blank", "user_id_blank", "too_old", "in_future",
    ]
    assert reject_codes("ssp")[8:] == [
        "publisher_id_blank", "action_not_allowed", "floor_price_negative", "floor_price_above_max", "winning_bid_negative",
    ]
    assert reject_codes("dsp")[8:] == [
        "action_not_allowed", "bid_price_negative", "bid_price_above_max",
        "clearing_price_negative", "budget_remaining_negative",
    ]


def test_split_keeps_every_event_once(spark):
    mixed = events(spark, "dsp", {}, {"event_id": ""}, {"bid_price": 9999.0}, {"action": "CLICK"})
    annotated = validate(mixed, "dsp", NOW)
    good, bad = valid(annotated), rejected(annotated)
    assert good.columns == mixed.columns
    assert good.count() == 2 and valid_events(mixed, "dsp", NOW).count() == 2
    rows = {r["reject_code"]: r["reject_reason"] for r in bad.collect()}
    assert set(rows) == {"event_id_blank", "bid_price_above_max"}
    assert "9999.0" in rows["bid_price_above_max"]


def test_reject_stats(spark):
    stats = reject_stats(validate(events(spark, "ssp", {}, {}, {}, {"ad_id": ""}), "ssp", NOW))
    rows = {r["reject_code"]: (r["events"], r["percent"]) for r in stats.collect()}
    assert rows == {"valid": (3, 75.0), "ad_id_blank": (1, 25.0)}


def test_observed_rates(spark):
    observation = Observation("seen")
    annotated = validate(events(spark, "ssp", {}, {}, {}, {"ad_id": ""}), "ssp", NOW)
    observe_rejects(annotated, observation).write.format("noop").mode("overwrite").save()
    assert observation.get == {"processed": 4, "rejected": 1, "rejection_rate": 25.0}


def test_wall_clock_is_the_default(spark):
    assert validate(events(spark, "ssp", {}), "ssp").first()["reject_code"] == "too_old"


def test_now_can_be_a_column(spark):
    df = events(spark, "ssp", {}, {"event_id": "late"})
    seen = F.when(F.col("event_id") == "late", F.lit("2024-03-17 00:00:00")).otherwise(F.lit("2024-03-15 10:00:00"))
    df = df.withColumn("ingest_time", seen.cast("timestamp"))
    codes = {r.event_id: r.reject_code for r in validate(df, "ssp", F.col("ingest_time")).collect()}
    assert codes == {"e1": None, "late": "too_old"}
    assert [r.event_id for r in valid_events(df, "ssp", F.col("ingest_time")).collect()] == ["e1"]


def test_quick_conditions_agree_with_the_rules(spark):
    """The plain conditions of valid_events reject nothing the rules accept."""
    df = events(
        spark, "ssp", {"timestamp": NOW - AGE}, {"timestamp": NOW + AHEAD}, {"timestamp": NOW - AGE - SECOND},
        {"timestamp": NOW + AHEAD + SECOND}, {"action": "BID_WIN"}, {"timestamp": None}, {"action": None},
    )
    annotated = validate(df, "ssp", NOW)
    assert sorted(map(str, valid_events(df, "ssp", NOW).collect())) == sorted(map(str, valid(annotated).collect()))
    assert valid(annotated).count() == 2


def test_unknown_side():
    with pytest.raises(ValueError):
        validate(None, "abc")

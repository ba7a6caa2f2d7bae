"""Small event frames for tests."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from adpulse.schemas import side_of

NOW = datetime(2024, 3, 15, 10, 0, 0, tzinfo=timezone.utc)

_COMMON = {
    "event_id": "e1", "timestamp": NOW - timedelta(seconds=30), "ad_id": "ad1", "campaign_id": "c1",
    "creative_id": "cr1", "advertiser_id": "adv1", "user_id": "u1",
}
_OWN = {
    "ssp": {
        "publisher_id": "p1", "action": "IMPRESSION", "floor_price": 1.5, "winning_bid": 2.0,
        "ad_slot": "top", "page_url": "/home", "metadata": {"country": "NO", "device": "tv"},
    },
    "dsp": {
        "action": "BID_WIN", "bid_price": 2.5, "clearing_price": 2.0, "budget_remaining": 500.0,
        "targeting_segments": ["sports", "news"], "metadata": {"exchange": "x1"},
    },
}


def event(side: str, **changes) -> dict:
    return {**_COMMON, **_OWN[side], **changes}


def events(spark, side: str, *changes: dict):
    """One valid event per dict, with the given fields changed."""
    schema = side_of(side).event
    rows = [event(side, **c) for c in changes]
    return spark.createDataFrame([tuple(r[n] for n in schema.names) for r in rows], schema)


def at(seconds: float) -> datetime:
    """An instant after 10:00:00."""
    return NOW + timedelta(seconds=seconds)

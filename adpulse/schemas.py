"""Fixed values and schemas of the event model.

Two event families share nine fields: supply-side events (``ssp``, sent by publishers) and
demand-side events (``dsp``, sent by bidders). A :class:`Side` gathers what differs between them, so
that validation, metrics, archive and jobs are each written once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: actions -------------------------------------------------------------------
ACTIONS = (
    "IMPRESSION", "CLICK", "CONVERSION", "VIEW",
    "AD_REQUEST", "AD_RESPONSE", "AD_RENDER", "AD_VIEWABLE", "AD_BLOCKED",
    "BID_REQUEST", "BID_RESPONSE", "BID_WIN", "BID_LOSS", "BID_TIMEOUT", "BUDGET_EXHAUSTED",
)
SSP_ACTIONS = (
    "IMPRESSION", "CLICK", "CONVERSION", "VIEW",
    "AD_REQUEST", "AD_RESPONSE", "AD_RENDER", "AD_VIEWABLE", "AD_BLOCKED",
)
DSP_ACTIONS = (
    "IMPRESSION", "CLICK", "CONVERSION",
    "BID_REQUEST", "BID_RESPONSE", "BID_WIN", "BID_LOSS", "BID_TIMEOUT", "BUDGET_EXHAUSTED",
)

# --- fixed values: limits of the validation rules ----------------------------------------------
MAX_AGE_HOURS = 24
MAX_FUTURE_MINUTES = 5
MAX_FLOOR_PRICE = 500.0
MAX_BID_PRICE = 1000.0

# --- fixed values: window labels ---------------------------------------------------------------
WINDOW_TYPES = (
    "TUMBLING_1MIN", "TUMBLING_5MIN", "TUMBLING_1HOUR", "SLIDING_5MIN_1MIN", "SESSION",
)


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def _doubles(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType()) for n in names]


_TIMESTAMP = [T.StructField("timestamp", T.TimestampType())]
_METADATA = [T.StructField("metadata", T.MapType(T.StringType(), T.StringType()))]
_SEGMENTS = [T.StructField("targeting_segments", T.ArrayType(T.StringType()))]
# archive columns that do not come straight from the event
_STORED = [
    T.StructField("partition_path", T.StringType()),
    T.StructField("processing_time", T.LongType()),
]

SSP_EVENT = T.StructType(
    _strings("event_id") + _TIMESTAMP
    + _strings("ad_id", "campaign_id", "creative_id", "publisher_id", "advertiser_id", "user_id", "action")
    + _doubles("floor_price", "winning_bid")
    + _strings("ad_slot", "page_url") + _METADATA
)

DSP_EVENT = T.StructType(
    _strings("event_id") + _TIMESTAMP
    + _strings("ad_id", "campaign_id", "creative_id", "advertiser_id", "user_id", "action")
    + _doubles("bid_price", "clearing_price", "budget_remaining")
    + _SEGMENTS + _METADATA
)


def _archive(event: T.StructType) -> T.StructType:
    """The flat stored form of an event: epoch-ms timestamp, no metadata map, two extra columns."""
    stored = []
    for field in event.fields:
        if field.name == "timestamp":
            stored.append(T.StructField("timestamp", T.LongType()))
        elif field.name != "metadata":
            stored.append(field)
    return T.StructType(stored + _STORED)


SSP_ARCHIVE = _archive(SSP_EVENT)
DSP_ARCHIVE = _archive(DSP_EVENT)

REQUIRED_COMMON = ("event_id", "ad_id", "campaign_id", "creative_id", "advertiser_id", "user_id")


@dataclass(frozen=True)
class PriceRule:
    """A price column that must not be negative and, where ``maximum`` is set, not above it."""

    column: str
    maximum: float | None = None


@dataclass(frozen=True)
class Money:
    """A sum of one price column over some actions; ``actions=None`` means over every action."""

    column: str
    actions: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Side:
    """What differs between the supply side and the demand side."""

    name: str
    event: T.StructType
    archive: T.StructType
    actions: tuple[str, ...]
    required: tuple[str, ...]  # text columns that may not be blank, in checking order
    prices: tuple[PriceRule, ...]  # in checking order
    keys: tuple[str, ...]  # grouping columns besides window and action
    first_seen: tuple[str, ...]  # columns taken from the earliest event of a group
    counters: dict[str, tuple[str, ...]]  # output column -> actions it counts
    money: dict[str, Money]  # sum name -> what it sums

    @property
    def price_columns(self) -> tuple[str, ...]:
        """Price columns some metric needs."""
        return tuple(dict.fromkeys(m.column for m in self.money.values()))


SSP = Side(
    name="ssp",
    event=SSP_EVENT,
    archive=SSP_ARCHIVE,
    actions=SSP_ACTIONS,
    required=("publisher_id",),
    prices=(PriceRule("floor_price", MAX_FLOOR_PRICE), PriceRule("winning_bid")),
    keys=("campaign_id",),
    first_seen=("advertiser_id", "publisher_id"),
    counters={
        "impressions": ("IMPRESSION",),
        "clicks": ("CLICK",),
        "conversions": ("CONVERSION",),
        "views": ("VIEW", "AD_VIEWABLE"),
        "ad_requests": ("AD_REQUEST",),
        "ad_responses": ("AD_RESPONSE", "AD_RENDER"),
    },
    money={
        "total_revenue": Money("winning_bid", ("IMPRESSION",)),
        "floor_price_sum": Money("floor_price"),
        "winning_bid_sum": Money("winning_bid"),
    },
)

DSP = Side(
    name="dsp",
    event=DSP_EVENT,
    archive=DSP_ARCHIVE,
    actions=DSP_ACTIONS,
    required=(),
    prices=(PriceRule("bid_price", MAX_BID_PRICE), PriceRule("clearing_price"), PriceRule("budget_remaining")),
    keys=("campaign_id", "advertiser_id"),
    first_seen=(),
    counters={
        "impressions": ("IMPRESSION",),
        "clicks": ("CLICK",),
        "conversions": ("CONVERSION",),
        "bid_requests": ("BID_REQUEST",),
        "bid_responses": ("BID_RESPONSE",),
        "bid_wins": ("BID_WIN",),
        "bid_losses": ("BID_LOSS",),
        "bid_timeouts": ("BID_TIMEOUT",),
        "budget_exhausted": ("BUDGET_EXHAUSTED",),
    },
    money={
        "total_spend": Money("clearing_price", ("IMPRESSION",)),
        "bid_price_sum": Money("bid_price", ("BID_RESPONSE",)),
        "clearing_price_sum": Money("clearing_price", ("BID_WIN",)),
        "total_budget_spent": Money("clearing_price", ("BID_WIN",)),
    },
)

SIDES = {"ssp": SSP, "dsp": DSP}


def side_of(side: str | Side) -> Side:
    """Look a side up by name (any case); a :class:`Side` passes through."""
    if isinstance(side, Side):
        return side
    try:
        return SIDES[side.lower()]
    except KeyError:
        raise ValueError(f"unknown side {side!r}: expected ssp or dsp") from None

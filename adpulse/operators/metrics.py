"""Windowed metrics per campaign.

How a batch job is planned, for a window that slides by ``slide``:

1. Every event sets one bit per window it falls in, inside a 64-bit word that covers a block of
   ``BLOCK`` consecutive windows. A tumbling window sets one bit, a 5 min / 1 min window five.
2. One pass groups the rows twice (grouping sets): by (block, bits, keys, dimensions), where counts
   and sums are kept, and by (block, keys, user), where only the bits are or-ed together. This is
   the one large shuffle. It moves about one narrow row per (user, block) however far the windows
   overlap, its keys contain the user, so a hot campaign spreads over all tasks, and equal rows are
   combined before it, so a hot user shrinks on the map side.
3. The bits are unpacked into windows next to a second aggregation that is combined before its
   shuffle too: a task sends one row per (window, key). A user counts once per window.

Counting users through ``count_distinct`` over ``F.window`` would instead copy every event once per
overlapping window before the shuffle. All aggregate buffers up to here are plain numbers, so Spark
uses hash aggregation; the only text minimum, the first-seen columns, runs on the final few rows.

A stream uses the same three steps, with step 1 and 2 replaced by a stateful aggregation on
``F.window`` (see :func:`window_state`), because a block of windows has no event time of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import Side, side_of

BLOCK = 60  # windows per 64-bit word

GRAINS = ("action", "campaign")
UNIQUE = ("exact", "approx")


def window_label(size_ms: int, slide_ms: int | None = None, labels: str = "reference") -> str:
    """Name of a window kind, from its size alone.

    With ``labels="reference"`` a sliding window is named like a tumbling one of its size;
    ``labels="accurate"`` names the 5 min / 1 min window for what it is.
    """
    if labels not in ("reference", "accurate"):
        raise ValueError(f"labels must be reference or accurate, not {labels!r}")
    if labels == "accurate" and (size_ms, slide_ms) == (300_000, 60_000):
        return "SLIDING_5MIN_1MIN"
    if size_ms <= 60_000:
        return "TUMBLING_1MIN"
    return "TUMBLING_5MIN" if size_ms <= 300_000 else "TUMBLING_1HOUR"


def _check(size_ms: int, slide_ms: int, grain: str, unique: str) -> None:
    if size_ms <= 0 or slide_ms <= 0 or slide_ms > size_ms:
        raise ValueError(f"bad window: size {size_ms} ms, slide {slide_ms} ms")
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")
    if unique not in UNIQUE:
        raise ValueError(f"unique must be one of {UNIQUE}, not {unique!r}")


def _keys(side: Side, grain: str) -> list[str]:
    return [*side.keys, "action"] if grain == "action" else list(side.keys)


def _dims(side: Side) -> list[str]:
    """Everything a sum is kept by: all keys, the action and the first-seen columns."""
    return list(dict.fromkeys([*side.keys, "action", *side.first_seen]))


def _measures(side: Side, ts: Column, unique: str) -> list[Column]:
    """Aggregates per dimension. The action is a grouping column, so a plain count and one sum per
    price are enough: every conditional counter is a choice among them later."""
    out = [F.count(F.lit(1)).alias("n")]
    out += [F.sum(c).alias(f"sum_{c}") for c in side.price_columns]
    out.append(F.min(ts).alias("first_ts"))
    if unique == "approx":
        out.append(F.hll_sketch_agg("user_id").alias("users_sketch"))
    return out


def _covered(events: DataFrame, size_ms: int, slide_ms: int) -> DataFrame:
    """Step 1: per event the block and the bits of the windows it falls in."""
    size, slide = size_ms * 1000, slide_ms * 1000

    def down(value: str, step: int) -> str:  # whole-number division that rounds down also below zero
        return f"({value} - pmod({value}, {step}L)) div {step}L"

    last = down("unix_micros(timestamp)", slide)
    events = events.filter("timestamp IS NOT NULL")
    if size == slide:
        return events.selectExpr("*", f"{last} AS _last").selectExpr(
            "*", f"{down('_last', BLOCK)} AS _block", f"shiftleft(1L, int(pmod(_last, {BLOCK}L))) AS _bits"
        )
    first = down(f"(unix_micros(timestamp) - {size}L)", slide) + " + 1"
    low = f"greatest(_first - _block * {BLOCK}, 0L)"
    high = f"least(_last - _block * {BLOCK}, {BLOCK - 1}L)"
    return (
        events.selectExpr("*", f"{first} AS _first", f"{last} AS _last")
        .selectExpr("*", f"explode(sequence({down('_first', BLOCK)}, {down('_last', BLOCK)})) AS _block")
        .selectExpr("*", f"shiftleft(shiftleft(1L, int({high} - {low} + 1)) - 1L, int({low})) AS _bits")
    )


def _batch_blocks(
    events: DataFrame, side: Side, size_ms: int, slide_ms: int, grain: str, unique: str
) -> DataFrame:
    """Steps 1 and 2: rows per block, whose ``_windows`` are the bits of the windows they belong to."""
    dims, keys = _dims(side), _keys(side, grain)
    columns = ["timestamp", "user_id", *dims, *side.price_columns]
    covered = _covered(events.select(*columns), size_ms, slide_ms)
    by_dims = ["_block", "_bits", *dims]
    measures = [F.bit_or("_bits").alias("_windows"), *_measures(side, F.col("timestamp"), unique)]
    if unique == "exact":
        by_user = ["_block", *keys, "user_id"]
        return covered.groupingSets([by_dims, by_user], *by_dims, "user_id").agg(
            *measures, (F.grouping("user_id") == 0).alias("is_user")
        )
    return covered.groupBy(*by_dims).agg(*measures, F.lit(False).alias("is_user")).withColumn("user_id", F.lit(None))


def _unpacked(blocks: DataFrame, slide_ms: int) -> DataFrame:
    """One row per window of a block's row, with ``window_start`` as epoch micros."""
    offsets = ", ".join(str(i) for i in range(BLOCK))
    return (
        blocks.selectExpr("*", f"explode(array({offsets})) AS _offset")
        .filter("getbit(_windows, _offset) = 1")
        .withColumn("window_start", F.expr(f"(_block * {BLOCK} + _offset) * {slide_ms * 1000}L"))
    )


def _batch_partials(
    events: DataFrame, side: Side, size_ms: int, slide_ms: int, grain: str, unique: str
) -> DataFrame:
    """Steps 1 and 2, then one row per window with ``window_start`` as epoch micros."""
    return _unpacked(_batch_blocks(events, side, size_ms, slide_ms, grain, unique), slide_ms)


def window_state(
    events: DataFrame,
    side: str | Side,
    size_ms: int = 60_000,
    slide_ms: int | None = None,
    grain: str = "action",
    unique: str = "exact",
) -> DataFrame:
    """The stateful part of the metrics on a watermarked stream; :func:`finish` is the rest.

    State holds one small fixed-width row per (window, dimensions) and one per (window, key, user),
    spread over all partitions by user, instead of one growing user set per key. In append mode all
    rows of a window leave the state in the same micro-batch, so ``finish`` inside ``foreachBatch``
    sees each window whole.
    """
    side, slide_ms = side_of(side), slide_ms or size_ms
    _check(size_ms, slide_ms, grain, unique)
    dims, keys = _dims(side), _keys(side, grain)
    windowed = events.select("timestamp", "user_id", *dims, *side.price_columns).withColumn(
        "_window", F.window("timestamp", f"{size_ms} milliseconds", f"{slide_ms} milliseconds")
    )
    measures = _measures(side, F.col("timestamp"), unique)
    if unique == "exact":
        by_dims, by_user = ["_window", *dims], ["_window", *keys, "user_id"]
        grouped = windowed.groupingSets([by_dims, by_user], *by_dims, "user_id").agg(
            *measures, (F.grouping("user_id") == 0).alias("is_user")
        )
    else:
        grouped = windowed.groupBy("_window", *dims).agg(*measures, F.lit(False).alias("is_user")).withColumn("user_id", F.lit(None))
    return grouped.withColumn("window_start", F.unix_micros("_window.start")).drop("_window")


def _totals(partials: DataFrame, side: Side, grain: str, unique: str, also: tuple[str, ...] = ()) -> DataFrame:
    """Step 3: add up per window and key. Columns in ``also`` belong to the window."""
    keys, dims = ["window_start", *also, *_keys(side, grain)], ["window_start", *also, *_dims(side)]
    # per dimension first: numeric buffers only, so this large step is a hash aggregation
    per_dim = partials.groupBy(*dims).agg(
        F.expr("sum(CASE WHEN is_user THEN 0 ELSE n END) AS n"),
        *[F.expr(f"sum(CASE WHEN NOT is_user THEN sum_{c} END) AS sum_{c}") for c in side.price_columns],
        F.expr("min(CASE WHEN NOT is_user THEN first_ts END) AS first_ts"),
        F.expr(
            "hll_union_agg(users_sketch) AS users_sketch" if unique == "approx"
            else "count_if(is_user AND user_id IS NOT NULL) AS users"
        ),
    )
    aggs = ["sum(n) AS event_count"]
    for name, actions in side.counters.items():
        aggs.append(f"sum(CASE WHEN action IN {_in(actions)} THEN n ELSE 0 END) AS {name}")
    for name, money in side.money.items():
        amount = f"sum_{money.column}"
        if money.actions is not None:
            amount = f"CASE WHEN action IN {_in(money.actions)} THEN {amount} END"
        aggs.append(f"coalesce(sum({amount}), 0D) AS {name}")
    if side.first_seen:
        aggs.append(f"min(CASE WHEN first_ts IS NOT NULL THEN struct(first_ts, {', '.join(side.first_seen)}) END) AS seen")
    aggs.append(
        "hll_sketch_estimate(hll_union_agg(users_sketch)) AS unique_users" if unique == "approx"
        else "sum(users) AS unique_users"
    )
    totals = per_dim.groupBy(*keys).agg(*[F.expr(a) for a in aggs])
    return totals.selectExpr("*", *[f"seen.{c} AS {c}" for c in side.first_seen])


def _in(actions: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{a}'" for a in actions) + ")"


def ratio_sql(numerator: str, denominator: str) -> str:
    """The quotient as a double, 0.0 when the denominator is not positive."""
    return f"CASE WHEN {denominator} > 0 THEN double({numerator}) / double({denominator}) ELSE 0D END"


def ratio(numerator: str, denominator: str) -> Column:
    """:func:`ratio_sql` as a column."""
    return F.expr(ratio_sql(numerator, denominator))


# derived columns of every metric row: name -> (numerator, denominator)
BASE_RATIOS = {
    "click_through_rate": ("clicks", "impressions"),
    "conversion_rate": ("conversions", "clicks"),
    "cost_per_click": ("total_spend", "clicks"),
    "cost_per_conversion": ("total_spend", "conversions"),
}


def base_ratios() -> dict[str, Column]:
    """Click-through rate, conversion rate and cost per click and per conversion."""
    return {name: ratio(*parts) for name, parts in BASE_RATIOS.items()}


# further columns per side: name -> (numerator, denominator), or None for a total as it is.
# An ad render counts as a response, so fill_rate can exceed 1 at campaign grain.
_OWN_COLUMNS = {
    "ssp": {
        "publisher_id": None, "ad_requests": None, "ad_responses": None,
        "fill_rate": ("ad_responses", "ad_requests"),
        "viewability_rate": ("views", "impressions"),
        "avg_floor_price": ("floor_price_sum", "event_count"),
        "avg_winning_bid": ("winning_bid_sum", "event_count"),
    },
    "dsp": {
        "bid_requests": None, "bid_responses": None, "bid_wins": None, "bid_losses": None, "bid_timeouts": None,
        "win_rate": ("bid_wins", "bid_requests"),
        "avg_bid_price": ("bid_price_sum", "bid_responses"),
        "avg_clearing_price": ("clearing_price_sum", "bid_wins"),
        "total_budget_spent": None,
    },
}


def _record(totals: DataFrame, side: Side, label: str, end_micros: str, grain: str, budget_exhausted: bool) -> DataFrame:
    """Lay totals out as a flat metric row. What a side does not keep is zero."""
    totals = totals.withColumns({
        name: F.expr(value)
        for name, value in {"views": "0L", "total_revenue": "0D", "total_spend": "0D"}.items()
        if name not in side.counters and name not in side.money
    })
    start, end = "timestamp_micros(window_start)", f"timestamp_micros({end_micros})"
    columns = [
        f"{start} AS window_start", f"{end} AS window_end",
        f"'{label}' AS window_type",
        # whole seconds of the end minus whole seconds of the start
        f"unix_seconds({end}) - unix_seconds({start}) AS duration_seconds",
        "campaign_id", "advertiser_id", *(["action"] if grain == "action" else []),
        "impressions", "clicks", "conversions", "views",
        "total_revenue", "total_spend", "unique_users", "event_count",
    ]
    for name, parts in {**BASE_RATIOS, **_OWN_COLUMNS[side.name]}.items():
        columns.append(name if parts is None else f"{ratio_sql(*parts)} AS {name}")
    if budget_exhausted and "budget_exhausted" in side.counters:
        columns.append("budget_exhausted")
    return totals.selectExpr(*columns, "current_timestamp() AS created_at")


def finish(
    partials: DataFrame,
    side: str | Side,
    size_ms: int = 60_000,
    slide_ms: int | None = None,
    grain: str = "action",
    unique: str = "exact",
    labels: str = "reference",
    budget_exhausted: bool = False,
) -> DataFrame:
    """Turn partial rows into one flat metric row per window and key."""
    side, slide_ms = side_of(side), slide_ms or size_ms
    _check(size_ms, slide_ms, grain, unique)
    totals = _totals(partials, side, grain, unique)
    return _record(totals, side, window_label(size_ms, slide_ms, labels), _end(size_ms), grain, budget_exhausted)


def _end(size_ms: int) -> str:
    return f"window_start + {size_ms * 1000}L"


def _direct_totals(events: DataFrame, side: Side, keys: list, users: str) -> DataFrame:
    """All counters and sums per key in one aggregation; ``users`` is the expression that counts users."""
    aggs = ["count(1) AS event_count"]
    for name, actions in side.counters.items():
        aggs.append(f"count_if(action IN {_in(actions)}) AS {name}")
    for name, money in side.money.items():
        amount = money.column
        if money.actions is not None:
            amount = f"CASE WHEN action IN {_in(money.actions)} THEN {amount} END"
        aggs.append(f"coalesce(sum({amount}), 0D) AS {name}")
    if side.first_seen:
        aggs.append(f"min(struct(timestamp, {', '.join(side.first_seen)})) AS seen")
    aggs.append(f"{users} AS unique_users")
    return events.groupBy(*keys).agg(*[F.expr(a) for a in aggs]).selectExpr("*", *[f"seen.{c} AS {c}" for c in side.first_seen])


def window_updates(
    events: DataFrame,
    side: str | Side,
    size_ms: int = 60_000,
    slide_ms: int | None = None,
    grain: str = "action",
    unique: str = "approx",
    labels: str = "reference",
) -> DataFrame:
    """Metric rows of a watermarked stream for update mode: early and corrected rows at every batch.

    Here one state row per window and key has to hold everything, so users are counted by a sketch
    of bounded size.
    """
    side, slide_ms = side_of(side), slide_ms or size_ms
    _check(size_ms, slide_ms, grain, unique)
    if unique != "approx":
        raise ValueError('update mode needs unique="approx"')
    window = F.window("timestamp", f"{size_ms} milliseconds", f"{slide_ms} milliseconds").alias("_window")
    users = "hll_sketch_estimate(hll_sketch_agg(user_id))"
    totals = _direct_totals(events, side, [window, *_keys(side, grain)], users).withColumn("window_start", F.unix_micros("_window.start"))
    return _record(totals, side, window_label(size_ms, slide_ms, labels), _end(size_ms), grain, False)


def windowed_metrics(
    events: DataFrame,
    side: str | Side,
    size_ms: int = 60_000,
    slide_ms: int | None = None,
    grain: str = "action",
    unique: str = "exact",
    labels: str = "reference",
    budget_exhausted: bool = False,
) -> DataFrame:
    """Metrics of valid events per window and key, for a batch frame.

    ``grain="action"`` groups by campaign (and advertiser on the demand side) and action, as the
    published records do. There each row sees one action only, so every ratio between two actions is
    0.0; ``grain="campaign"`` leaves the action out of the key and makes those ratios meaningful.

    The first-seen columns of the supply side (advertiser, publisher) come from the earliest event;
    among events of the same instant the smallest pair is taken. Arrival order has no meaning on a
    partitioned table, so this is the defined counterpart.

    ``unique="approx"`` replaces the exact user count by a mergeable sketch of bounded size.
    ``budget_exhausted=True`` adds that counter, which the demand side keeps but does not publish.
    """
    if events.isStreaming:
        raise ValueError("on a stream use window_state() and finish() inside foreachBatch; see adpulse.streaming")
    side, slide_ms = side_of(side), slide_ms or size_ms
    _check(size_ms, slide_ms, grain, unique)
    partials = _batch_partials(events, side, size_ms, slide_ms, grain, unique)
    return finish(partials, side, size_ms, slide_ms, grain, unique, labels, budget_exhausted)

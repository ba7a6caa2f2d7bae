"""The registered queries as SQL over the same tables, for checking in another engine."""

from __future__ import annotations

from .adapter import BASE_MICROS, SQUEEZE
from .queries import PROCESSING_MS

# Fixed values, written out here so that the SQL does not follow a mistake in the engine's own lists.
_ACTIONS = {
    "ssp": ("IMPRESSION", "CLICK", "CONVERSION", "VIEW", "AD_REQUEST", "AD_RESPONSE", "AD_RENDER", "AD_VIEWABLE", "AD_BLOCKED"),
    "dsp": (
        "IMPRESSION", "CLICK", "CONVERSION",
        "BID_REQUEST", "BID_RESPONSE", "BID_WIN", "BID_LOSS", "BID_TIMEOUT", "BUDGET_EXHAUSTED",
    ),
}
# The event's columns without its metadata, which the archive leaves out.
_COLUMNS = {
    "ssp": [
        "event_id", "timestamp", "ad_id", "campaign_id", "creative_id", "publisher_id", "advertiser_id", "user_id",
        "action", "floor_price", "winning_bid", "ad_slot", "page_url",
    ],
    "dsp": [
        "event_id", "timestamp", "ad_id", "campaign_id", "creative_id", "advertiser_id", "user_id", "action",
        "bid_price", "clearing_price", "budget_remaining", "targeting_segments",
    ],
}

_AS_OF_US = BASE_MICROS + 3_600_000_000
_HOUR_US = 3_600_000_000


def _case(col: str, rules: dict[int, str], otherwise: str) -> str:
    whens = " ".join(f"WHEN event_id % {m} = 0 THEN {value}" for m, value in rules.items())
    return f"CASE {whens} ELSE {otherwise} END AS {col}"


def _adapted(side: str) -> str:
    ssp = side == "ssp"
    actions = ", ".join(f"'{a}'" for a in _ACTIONS[side])
    foreign = "'BID_WIN'" if ssp else "'AD_RENDER'"
    squeezed = f"({BASE_MICROS} + (epoch_us(ts) - {BASE_MICROS}) // {SQUEEZE})"
    columns = [
        "event_id AS eid", "user_id AS uid", "event_type",
        _case("event_id", {101: "''"}, "cast(event_id AS varchar)"),
        _case("us", {103: f"{squeezed} - 25 * {_HOUR_US}", 107: f"{squeezed} + 2 * {_HOUR_US}"}, squeezed),
        _case("ad_id", {149: "''"}, "'ad-' || (user_id % 20)"),
        _case("campaign_id", {109: "'  '"}, "'camp-' || (user_id % 5)"),
        _case("creative_id", {151: "''"}, "'cr-' || (user_id % 7)"),
        _case("advertiser_id", {157: "''"}, "'adv-' || ((event_id // 9) % 3)"),
        _case("user_id", {163: "''"}, "'user-' || user_id"),
        _case("action", {127: foreign}, f"([{actions}])[(event_id % 9) + 1]"),
        "json_extract_string(props, '$.k') AS k", f"{squeezed} AS raw_us",
    ]
    if ssp:
        columns += [
            _case("publisher_id", {113: "''"}, "'pub-' || ((event_id // 27) % 4)"),
            _case("floor_price", {131: "-value"}, "value * 3"),
            _case("winning_bid", {137: "-value"}, "value"),
            "'slot-' || (user_id % 3) AS ad_slot", "'/p/' || (user_id % 11) AS page_url",
        ]
    else:
        columns += [
            _case("bid_price", {131: "-value"}, "value * 6"),
            _case("clearing_price", {137: "-value"}, "value"),
            _case("budget_remaining", {139: "-value"}, "500 - value"),
            "event_type AS targeting_segments",
        ]
    return f"adapted AS (SELECT {', '.join(columns)} FROM events)"


def _coded(side: str) -> str:
    def blank(c: str) -> str:
        return f"WHEN trim({c}) = '' THEN '{c}_blank'"

    rules = [blank(c) for c in ("event_id", "ad_id", "campaign_id", "creative_id", "advertiser_id", "user_id")]
    rules.append(f"WHEN us < {_AS_OF_US} - 24 * {_HOUR_US} THEN 'too_old'")
    rules.append(f"WHEN us > {_AS_OF_US} + 5 * 60000000 THEN 'in_future'")
    if side == "ssp":
        rules.append(blank("publisher_id"))
    allowed = ", ".join(f"'{a}'" for a in _ACTIONS[side])
    rules.append(f"WHEN action NOT IN ({allowed}) THEN 'action_not_allowed'")
    if side == "ssp":
        rules += [
            "WHEN floor_price < 0 THEN 'floor_price_negative'",
            f"WHEN floor_price > 500.0 THEN 'floor_price_above_max'",
            "WHEN winning_bid < 0 THEN 'winning_bid_negative'",
        ]
    else:
        rules += [
            "WHEN bid_price < 0 THEN 'bid_price_negative'",
            f"WHEN bid_price > 1000.0 THEN 'bid_price_above_max'",
            "WHEN clearing_price < 0 THEN 'clearing_price_negative'",
            "WHEN budget_remaining < 0 THEN 'budget_remaining_negative'",
        ]
    return f"{_adapted(side)}, coded AS (SELECT *, CASE {' '.join(rules)} END AS reject_code FROM adapted)"


def _round(value: str) -> str:
    return f"round(({value})::decimal(30, 9), 6)::double"


def _quotient(n: str, d: str) -> str:
    return _round(f"CASE WHEN {d} > 0 THEN ({n}) / ({d})::double ELSE 0.0 END")


def _count(*actions: str) -> str:
    return f"count(*) FILTER (WHERE action IN ({', '.join(repr(a) for a in actions)}))"


def _total(column: str, action: str) -> str:
    return f"coalesce(sum({column}) FILTER (WHERE action = '{action}'), 0.0)"


def _windowed(
    side: str, size_ms: int, slide_ms: int | None = None, campaign: bool = False, label: str | None = None,
    budget: bool = False, placed: str | None = None,
) -> str:
    """Metrics per window. ``placed`` gives other tables, of which ``windowed`` holds each row once per window it counts in,
    with ``start_us``, and ``end_us`` where windows are not all of one length."""
    slide_us, copies = (slide_ms or size_ms) * 1000, size_ms // (slide_ms or size_ms)
    label = label or ("TUMBLING_1MIN" if size_ms <= 60_000 else "TUMBLING_5MIN" if size_ms <= 300_000 else "TUMBLING_1HOUR")
    keys = ["campaign_id"] + (["advertiser_id"] if side == "dsp" else []) + ([] if campaign else ["action"])
    bounds = ["start_us", "end_us"] if placed and "end_us" in placed else ["start_us"]
    end = bounds[-1] if len(bounds) > 1 else f"(start_us + {size_ms * 1000})"
    shared = [
        "count(*) AS event_count", "count(DISTINCT user_id) AS unique_users",
        f"{_count('IMPRESSION')} AS impressions", f"{_count('CLICK')} AS clicks", f"{_count('CONVERSION')} AS conversions",
    ]
    if side == "ssp":
        sums = shared + [
            f"{_count('VIEW', 'AD_VIEWABLE')} AS views",
            f"{_count('AD_REQUEST')} AS ad_requests", f"{_count('AD_RESPONSE', 'AD_RENDER')} AS ad_responses",
            f"{_total('winning_bid', 'IMPRESSION')} AS total_revenue", "0.0::double AS total_spend",
            "sum(floor_price) AS floor_sum", "sum(winning_bid) AS bid_sum",
            "arg_min(advertiser_id, row(us, advertiser_id, publisher_id)) AS advertiser_id",
            "arg_min(publisher_id, row(us, advertiser_id, publisher_id)) AS publisher_id",
        ]
        own = [
            "publisher_id", "ad_requests", "ad_responses",
            f"{_quotient('ad_responses', 'ad_requests')} AS fill_rate",
            f"{_quotient('views', 'impressions')} AS viewability_rate",
            f"{_quotient('floor_sum', 'event_count')} AS avg_floor_price",
            f"{_quotient('bid_sum', 'event_count')} AS avg_winning_bid",
        ]
    else:
        sums = shared + [
            "0::bigint AS views", "0.0::double AS total_revenue",
            f"{_total('clearing_price', 'IMPRESSION')} AS total_spend",
            *[f"{_count(a.upper()[:-1] if a != 'bid_losses' else 'BID_LOSS')} AS {a}"
              for a in ("bid_requests", "bid_responses", "bid_wins", "bid_losses", "bid_timeouts")],
            f"{_count('BUDGET_EXHAUSTED')} AS budget_exhausted",
            f"{_total('bid_price', 'BID_RESPONSE')} AS bid_sum", f"{_total('clearing_price', 'BID_WIN')} AS clearing_sum",
        ]
        own = [
            "bid_requests", "bid_responses", "bid_wins", "bid_losses", "bid_timeouts",
            f"{_quotient('bid_wins', 'bid_requests')} AS win_rate",
            f"{_quotient('bid_sum', 'bid_responses')} AS avg_bid_price",
            f"{_quotient('clearing_sum', 'bid_wins')} AS avg_clearing_price",
            f"{_round('clearing_sum')} AS total_budget_spent",
        ] + (["budget_exhausted"] if budget else [])
    columns = [
        "make_timestamp(start_us) AS window_start", f"make_timestamp({end}) AS window_end",
        f"'{label}' AS window_type", f"({end} // 1000000 - start_us // 1000000)::bigint AS duration_seconds",
        "campaign_id", "advertiser_id", *([] if campaign else ["action"]),
        "impressions", "clicks", "conversions", "views",
        f"{_round('total_revenue')} AS total_revenue", f"{_round('total_spend')} AS total_spend",
        "unique_users", "event_count",
        f"{_quotient('clicks', 'impressions')} AS click_through_rate",
        f"{_quotient('conversions', 'clicks')} AS conversion_rate",
        f"{_quotient('total_spend', 'clicks')} AS cost_per_click",
        f"{_quotient('total_spend', 'conversions')} AS cost_per_conversion",
        *own,
    ]
    placed = placed or f"""{_coded(side)},
windowed AS (
  SELECT *, (us // {slide_us} - copy) * {slide_us} AS start_us
  FROM coded, range({copies}) AS copies(copy) WHERE reject_code IS NULL
)"""
    return f"""WITH {placed},
summed AS (SELECT {', '.join([*bounds, *keys])}, {', '.join(sums)} FROM windowed GROUP BY {', '.join([*bounds, *keys])})
SELECT {', '.join(columns)} FROM summed"""


def _present(columns: list[str]) -> str:
    doubles = {"floor_price", "winning_bid", "bid_price", "clearing_price", "budget_remaining"}
    text = []
    for c in columns:
        if c == "timestamp":
            text.append('make_timestamp(us) AS "timestamp"')
        else:
            text.append(f"{_round(c)} AS {c}" if c in doubles else c)
    return ", ".join(text)


def _dead_letters(side: str) -> str:
    messages = "".join(
        f"WHEN '{name}_{end}' THEN '{name} is {says}' "
        for end, says, names in (
            ("blank", "blank", ("event_id", "ad_id", "campaign_id", "creative_id", "advertiser_id", "user_id", "publisher_id")),
            ("negative", "negative", ("floor_price", "winning_bid", "bid_price", "clearing_price", "budget_remaining")),
            ("above_max", "above 500.0", ("floor_price",)), ("above_max", "above 1000.0", ("bid_price",)),
        ) for name in names
    )
    return f"""WITH {_coded(side)} SELECT {_present(_COLUMNS[side])}, k AS metadata, reject_code,
  CASE reject_code {messages} WHEN 'too_old' THEN 'event is older than 24 h'
    WHEN 'in_future' THEN 'event is too far in the future'
    WHEN 'action_not_allowed' THEN 'not a {side} action: ' || action END AS reject_reason
FROM coded WHERE reject_code IS NOT NULL"""


def _path(instant: str = "make_timestamp(us)") -> str:
    return f"strftime({instant}, 'year=%Y/month=%m/day=%d/hour=%H')"


def _archive_rows(side: str) -> str:
    columns = _present(_COLUMNS[side]).replace('make_timestamp(us) AS "timestamp"', 'us // 1000 AS "timestamp"')
    parts = ", ".join(
        f"strftime(make_timestamp(us), '{p}') AS {n}"
        for n, p in (("year", "%Y"), ("month", "%m"), ("day", "%d"), ("hour", "%H"))
    )
    return f"""WITH {_adapted(side)}
SELECT {columns}, 'event_type={side.upper()}/' || {_path()} AS partition_path,
  {PROCESSING_MS}::bigint AS processing_time, {parts}
FROM adapted WHERE trim(event_id) <> ''"""


def _enriched(side: str) -> str:
    extra = ", advertiser_id AS meta_advertiser_id" if side == "dsp" else ""
    return f"""WITH {_adapted(side)}
SELECT event_id, user_id, {3 if side == 'ssp' else 4}::integer AS entries, k AS meta_k,
  'event_type={side.upper()}/' || {_path()} AS meta_partition_path,
  '{PROCESSING_MS}' AS meta_processing_time{extra}
FROM adapted WHERE trim(event_id) <> ''"""


def _round_trip(side: str) -> str:
    price = "winning_bid" if side == "ssp" else "clearing_price"
    return f"""WITH {_adapted(side)}
SELECT strftime(make_timestamp(us), '%d') AS "day", strftime(make_timestamp(us), '%H') AS "hour",
  count(*) AS events, sum(us // 1000)::bigint AS timestamps, {_round(f'sum({price})')} AS amount
FROM adapted WHERE trim(event_id) <> '' AND strftime(make_timestamp(us), '%Y-%m') = '2024-01'
GROUP BY ALL"""


_DECODE_ERRORS = """CASE WHEN n % 11 = 0 THEN 'malformed' WHEN n % 13 = 0 THEN 'user_id_missing'
  WHEN n % 17 = 0 THEN 'action_unknown' WHEN n % 19 = 0 THEN '{price}_bad' WHEN n % 23 = 0 THEN '{nullable}_null' END"""


def _decoded(side: str) -> str:
    price, nullable = ("winning_bid", "ad_slot") if side == "ssp" else ("clearing_price", "targeting_segments")
    error = _DECODE_ERRORS.format(price=price, nullable=nullable)
    return f"""WITH {_adapted(side)}, numbered AS (SELECT *, coalesce(try_cast(k AS bigint), 0) AS n FROM adapted),
decoded AS (SELECT * REPLACE (CASE WHEN n % 29 = 0 THEN 1.5 ELSE {price} END AS {price}), {error} AS decode_error FROM numbered)"""


def _json_decode(side: str) -> str:
    return f"{_decoded(side)} SELECT {_present(_COLUMNS[side])}, k FROM decoded WHERE decode_error IS NULL"


def _mixed() -> str:
    parts = []
    for side in ("ssp", "dsp"):
        adapted = _adapted(side).replace("adapted AS", f"{side}_events AS", 1)
        parts.append((adapted, f"""SELECT '{side.upper()}' AS kind, event_id, make_timestamp(us) AS "timestamp",
  campaign_id, user_id, action FROM {side}_events WHERE NOT ends_with(user_id, '3')"""))
    return f"WITH {parts[0][0]}, {parts[1][0]} {parts[0][1]} UNION ALL {parts[1][1]}"


def _iso(micros: str) -> str:
    return f"""CASE WHEN {micros} % 1000000 = 0 THEN strftime(make_timestamp({micros}), '%Y-%m-%dT%H:%M:%SZ')
    WHEN {micros} % 1000 = 0 THEN strftime(make_timestamp({micros}), '%Y-%m-%dT%H:%M:%S.%gZ')
    ELSE strftime(make_timestamp({micros}), '%Y-%m-%dT%H:%M:%S.%fZ') END"""


_BASE = """window_type, duration_seconds, campaign_id, advertiser_id, action, impressions, clicks, conversions, views, total_revenue,
  total_spend, unique_users, event_count, click_through_rate, conversion_rate, cost_per_click, cost_per_conversion"""


def _encoded_metrics(side: str, size_ms: int, slide_ms: int | None = None, campaign: bool = False, base: bool = False) -> str:
    rows = f"SELECT *{', NULL::varchar AS action' if campaign else ''} FROM ({_windowed(side, size_ms, slide_ms, campaign)})"
    rows = f"SELECT * REPLACE ({', '.join(f'{_iso(f"epoch_us({c})")} AS {c}' for c in ('window_start', 'window_end'))}), true AS stamped FROM ({rows})"
    return f"SELECT window_start, window_end, {_BASE}, stamped FROM ({rows})" if base else rows


def _encoded_events(side: str) -> str:
    columns = _present(_COLUMNS[side]).replace('make_timestamp(us) AS "timestamp"', f'{_iso("us")} AS "timestamp"')
    return f"WITH {_adapted(side)} SELECT {columns}, k AS metadata FROM adapted"


def _n_minutes() -> str:
    columns = ", ".join(
        f"make_timestamp(epoch_us(ts) // {n * 60_000_000} * {n * 60_000_000}) AS every_{n}" for n in (1, 5, 7, 15, 60)
    )
    return f"SELECT event_id, {columns} FROM events"


def _base_ratios() -> str:
    return f"""WITH {_coded('dsp')}, summed AS (
  SELECT campaign_id, {_count('IMPRESSION')} AS impressions, {_count('CLICK')} AS clicks,
    {_count('CONVERSION')} AS conversions, {_total('clearing_price', 'IMPRESSION')} AS total_spend
  FROM coded WHERE reject_code IS NULL GROUP BY campaign_id)
SELECT campaign_id, impressions, clicks, conversions, {_round('total_spend')} AS total_spend,
  {_quotient('clicks', 'impressions')} AS click_through_rate, {_quotient('conversions', 'clicks')} AS conversion_rate,
  {_quotient('total_spend', 'clicks')} AS cost_per_click,
  {_quotient('total_spend', 'conversions')} AS cost_per_conversion,
  {_quotient('total_spend', 'impressions')} AS spend_per_impression
FROM summed"""


_NOON = "epoch(TIMESTAMP '2024-01-15 12:00:00')::bigint"
_AGE = f"({_NOON} - epoch_us(ts) // 1000000)"


def oracles() -> dict[str, str]:
    """SQL per registered query."""
    minute, five, hour = 60_000, 300_000, 3_600_000
    out: dict[str, str] = {}
    for side in ("ssp", "dsp"):
        out |= {
            f"{side}_tumbling_1min": _windowed(side, minute),
            f"{side}_sliding_5min": _windowed(side, five, minute),
            f"{side}_tumbling_5min": _windowed(side, five),
            f"{side}_tumbling_1hour": _windowed(side, hour),
            f"{side}_campaign_rollup": _windowed(side, five, minute, campaign=True, label="SLIDING_5MIN_1MIN"),
            f"{side}_validate_codes":
                f"WITH {_coded(side)} SELECT reject_code, count(*) AS events FROM coded GROUP BY reject_code",
            f"{side}_validate_rows":
                f"WITH {_coded(side)} SELECT event_id, make_timestamp(us) AS \"timestamp\", user_id, action, reject_code FROM coded",
            f"{side}_reject_stats":
                f"WITH {_coded(side)} SELECT coalesce(reject_code, 'valid') AS reject_code, count(*) AS events, "
                f"{_round('count(*) * 100.0::double / sum(count(*)) OVER ()')} AS percent FROM coded GROUP BY ALL",
            f"{side}_dead_letters": _dead_letters(side),
            f"{side}_archive_rows": _archive_rows(side),
            f"{side}_enriched_metadata": _enriched(side),
            f"{side}_archive_round_trip": _round_trip(side),
            f"json_decode_{side}": _json_decode(side),
            f"json_decode_errors_{side}":
                f"{_decoded(side)} SELECT decode_error, count(*) AS messages FROM decoded GROUP BY decode_error",
            f"stream_equals_batch_{side}": _windowed(side, minute),
            f"stream_dead_letters_{side}": _dead_letters(side),
            f"stream_archive_{side}": _archive_rows(side),
            f"json_encode_events_{side}": _encoded_events(side),
            f"json_encode_metrics_{side}": _encoded_metrics(side, minute),
            f"json_encode_campaign_metrics_{side}": _encoded_metrics(side, five, minute, campaign=True),
            f"json_encode_base_metrics_{side}": _encoded_metrics(side, hour, base=True),
        }
    mappings = "SELECT l_orderkey::varchar AS event_id, min(l_returnflag) AS mapping FROM lineitem GROUP BY 1"
    out |= {
        "dsp_budget_exhausted": _windowed("dsp", hour, campaign=True, budget=True),
        "json_decode_mixed": _mixed(),
        "json_encode_metrics": _encoded_metrics("ssp", minute),
        "json_encode_events": _encoded_events("dsp"),
        "current_starts":
            "SELECT event_id, epoch_ms(date_trunc('minute', ts)) AS minute_ms, epoch_ms(date_trunc('hour', ts)) AS hour_ms FROM events",
        "partition_path": f"SELECT event_id, {_path('ts')} AS path, 'event_type=SSP/' || {_path('ts')} AS typed_path FROM events",
        "truncate_units":
            "SELECT event_id, date_trunc('minute', ts) AS minute, date_trunc('hour', ts) AS hour, "
            "date_trunc('day', ts)::timestamp AS day, date_trunc('millisecond', ts) AS millis FROM events",
        "truncate_n_minutes": _n_minutes(),
        "within_processing_window":
            f"SELECT event_id, {_AGE} BETWEEN 0 AND 3600 AS within_hour, "
            f"{_AGE} BETWEEN 0 AND {5 * 86400} AS within_five_days FROM events",
        "action_parse":
            "SELECT event_id, CASE WHEN upper(event_type) IN ('CLICK', 'VIEW') THEN upper(event_type) END AS action, "
            "event_type IN ('click', 'view') AS is_ssp, event_type = 'click' AS is_dsp FROM events",
        "event_fingerprint":
            "SELECT event_id, props AS value, md5(props) AS hash, "
            "'{\"hash\": \"' || md5(props) || '\", \"data\": ' || props || ', \"version\": \"v2\"}' AS envelope FROM events",
        "dedup_fingerprint": "SELECT DISTINCT md5(props) AS hash, props AS value FROM events",
        "legacy_mapping_join":
            f"SELECT e.event_id::varchar AS event_id, e.user_id, m.mapping FROM events e "
            f"LEFT JOIN ({mappings}) m ON e.event_id::varchar = m.event_id",
        "base_ratios": _base_ratios(),
    }
    return out

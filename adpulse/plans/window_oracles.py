"""SQL for the queries of :mod:`adpulse.plans.window_queries`."""

from __future__ import annotations

from .adapter import BASE_MICROS
from .oracles import _coded, _round, _windowed

_GAP_US = 30_000_000
_DELAY_US = _LATENESS_US = 30_000_000
_PART_US = 900_000_000
_SLOT = f"least(greatest((raw_us - {BASE_MICROS}) // {_PART_US}, 0), 3)"
_LATE_PART = f"{_SLOT} + CASE WHEN eid % 10 = 0 THEN 1 ELSE 0 END"
_LAGGING_PART = f"{_SLOT} + CASE WHEN eid % 2 = 1 AND {_SLOT} > 0 THEN 1 ELSE 0 END"


def _session(side: str) -> str:
    """Gaps and islands: an event opens a session if the one before it, of its key, is further away than the gap."""
    keys = "campaign_id, advertiser_id, action" if side == "dsp" else "campaign_id, action"
    return _windowed(side, 0, 1, label="SESSION", placed=f"""{_coded(side)},
good AS (SELECT * FROM coded WHERE reject_code IS NULL),
opened AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY {keys} ORDER BY us) <= {_GAP_US} THEN 0 ELSE 1 END AS opens FROM good),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY {keys} ORDER BY us RANGE UNBOUNDED PRECEDING) AS session FROM opened),
windowed AS (
  SELECT *, min(us) OVER (PARTITION BY {keys}, session) AS start_us, max(us) OVER (PARTITION BY {keys}, session) + {_GAP_US} AS end_us
  FROM numbered)""")


def _closed(side: str, part: str, policy: str = "max", sources: str = "0") -> str:
    """Valid events with the part they arrive in and the instant before which a window has closed for good by then."""
    best = "max" if policy == "max" else "min"
    return f"""{_coded(side)},
arrived AS (SELECT *, {part} AS part, {sources} AS src FROM coded WHERE reject_code IS NULL),
sofar AS (
  SELECT p.part, a.src, max(a.us) AS latest FROM range(6) AS p(part) JOIN arrived a ON a.part < p.part GROUP BY ALL),
marks AS (SELECT part, {best}(latest) - {_DELAY_US + _LATENESS_US} AS closed FROM sofar GROUP BY part),
timely AS (SELECT a.*, m.closed FROM arrived a LEFT JOIN marks m ON a.part = m.part)"""


def _kept(side: str, size_ms: int, slide_ms: int, part: str, policy: str = "max", sources: str = "0") -> str:
    slide, size = slide_ms * 1000, size_ms * 1000
    return _windowed(side, size_ms, slide_ms, placed=f"""{_closed(side, part, policy, sources)},
windowed AS (
  SELECT * FROM (SELECT *, (us // {slide} - copy) * {slide} AS start_us FROM timely, range({size_ms // slide_ms}) AS copies(copy))
  WHERE closed IS NULL OR start_us + {size} > closed)""")


def _both(side: str, *more: str, part: str | None = None) -> str:
    if part is None:
        parts = [_windowed(side, 60_000), _windowed(side, 300_000, 60_000)]
    else:
        parts = [_kept(side, 60_000, 60_000, part, *more), _kept(side, 300_000, 60_000, part, *more)]
    return " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)


def _late(side: str) -> str:
    ends = {60_000: 60_000, 300_000: 60_000}
    late = ", ".join(
        f"CASE WHEN us // {slide * 1000} * {slide * 1000} + {size * 1000} <= closed THEN '{size}' END" for size, slide in ends.items())
    return f"""WITH {_closed(side, _LATE_PART)}
SELECT * FROM (SELECT event_id, make_timestamp(us) AS "timestamp", part::integer AS part, concat_ws(',', {late}) AS late_for FROM timely)
WHERE late_for <> ''"""


def _observed(side: str) -> str:
    return f"""WITH {_coded(side)}
SELECT {_SLOT} AS batch, count(*) AS processed, count(reject_code) AS rejected,
  {_round('count(reject_code) * 100.0::double / count(*)')} AS rejection_rate FROM coded GROUP BY 1"""


def _dead(side: str) -> str:
    return f"""WITH {_coded(side)} SELECT event_id, user_id, make_timestamp(us) AS "timestamp", action, {_SLOT}::integer AS part, reject_code
FROM coded WHERE reject_code IS NOT NULL"""


def _dedup() -> str:
    """A message is published in a part if it was not in either of the two parts before."""
    told = [f"bool_or(event_id % 6 = {p}) AS h{p}" for p in range(6)]
    steps, said = [], []
    for p in range(6):
        blocked = " OR ".join(f"e{q}" for q in (p - 1, p - 2) if q >= 0) or "false"
        steps.append(f"s{p} AS (SELECT *, h{p} AND NOT ({blocked}) AS e{p} FROM {f's{p - 1}' if p else 'had'})")
        said.append(f"SELECT value, hash, {p}::integer AS part FROM s5 WHERE e{p}")
    return f"""WITH had AS (SELECT props AS value, md5(props) AS hash, {', '.join(told)} FROM events GROUP BY props),
{', '.join(steps)} {' UNION ALL '.join(said)}"""


def oracles() -> dict[str, str]:
    out: dict[str, str] = {}
    for side in ("ssp", "dsp"):
        out |= {
            f"session_{side}": _session(side),
            f"stream_session_{side}": _session(side),
            f"{side}_panes_1hour": _windowed(side, 3_600_000),
            f"{side}_panes_sliding_5min": _windowed(side, 300_000, 60_000),
            f"stream_panes_{side}": _both(side),
            f"stream_update_{side}": _windowed(side, 60_000),
            f"stream_late_{side}": _late(side),
            f"stream_late_metrics_{side}": _both(side, part=_LATE_PART),
            f"stream_sliding_{side}": _windowed(side, 300_000, 60_000),
        }
    mappings = "SELECT l_orderkey::varchar AS event_id, min(l_returnflag) AS mapping FROM lineitem GROUP BY 1"
    return out | {
        "stream_restart_ssp": _both("ssp"),
        "stream_observed_rejects_ssp": _observed("ssp"),
        "stream_job_dead_letters_ssp": _dead("ssp"),
        "stream_lagging_source_max": _both("ssp", "max", "eid % 2", part=_LAGGING_PART),
        "stream_lagging_source_min": _both("ssp", "min", "eid % 2", part=_LAGGING_PART),
        "stream_mapping_join":
            f"SELECT e.event_id::varchar AS event_id, e.user_id, m.mapping FROM events e "
            f"LEFT JOIN ({mappings}) m ON e.event_id::varchar = m.event_id",
        "stream_dedup": _dedup(),
    }

"""Time functions.

Truncation works on the epoch, so it does not depend on the session time zone. Functions that print
a date (:func:`partition_path`, :func:`partition_columns`, :func:`iso_instant`) print it in UTC,
whatever the session's zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000
DAY_MICROS = 86_400 * MICROS
_MINUTE = 60 * MICROS
_HOUR = 60 * _MINUTE
_DAY = 24 * _HOUR


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _floor_to(ts: Column | str, micros: int) -> Column:
    us = F.unix_micros(_col(ts))
    return F.timestamp_micros(us - F.pmod(us, F.lit(micros)))


def truncate_to_minute(ts: Column | str) -> Column:
    return _floor_to(ts, _MINUTE)


def truncate_to_hour(ts: Column | str) -> Column:
    return _floor_to(ts, _HOUR)


def truncate_to_day(ts: Column | str) -> Column:
    """Start of the UTC day."""
    return _floor_to(ts, _DAY)


def truncate_to_n_minutes(ts: Column | str, n: int) -> Column:
    """Start of the n-minute interval, n from 1 to 60, counted from the epoch.

    Unlike the other truncations this one rounds toward zero, so instants before 1970 move up.
    """
    if not 1 <= n <= 60:
        raise ValueError(f"n must be from 1 to 60, not {n}")
    step = F.lit(60 * n)
    return F.timestamp_seconds(F.call_function("div", F.unix_seconds(_col(ts)), step) * step)


def _utc(ts: Column | str) -> tuple[Column, Column]:
    """The date in UTC as text and the microseconds of that day, whatever the session's zone.

    ``date_format`` prints in the session's zone, and a detour through local wall time is ambiguous when
    clocks go back, so both come from the epoch.
    """
    micros = F.unix_micros(_col(ts).cast("timestamp"))
    rest = F.pmod(micros, F.lit(DAY_MICROS))
    return F.date_from_unix_date(((micros - rest) / DAY_MICROS).cast("int")).cast("string"), rest


def _two_digits(micros: Column, unit: int, of: int) -> Column:
    return F.lpad(F.pmod(F.floor(micros / unit), F.lit(of)).cast("string"), 2, "0")


def partition_path(ts: Column | str, event_type: str | None = None) -> Column:
    """``year=YYYY/month=MM/day=DD/hour=HH`` in UTC, below ``event_type=T/`` when a type is given."""
    parts = partition_columns(ts)
    path = F.concat_ws("/", *[F.concat(F.lit(f"{name}="), part) for name, part in parts.items()])
    path = F.when(_col(ts).isNotNull(), path)
    return path if event_type is None else F.concat(F.lit(f"event_type={event_type}/"), path)


def partition_columns(ts: Column | str) -> dict[str, Column]:
    """The four archive partition columns in UTC as zero-padded text, so that paths read ``month=03``."""
    date, rest = _utc(ts)
    return {
        "year": F.substring(date, 1, 4), "month": F.substring(date, 6, 2), "day": F.substring(date, 9, 2),
        "hour": _two_digits(rest, 3600 * MICROS, 24),
    }


def from_epoch_millis(ms: Column | str) -> Column:
    return F.timestamp_millis(_col(ms))


def current_minute_start_ms(now: Column | str | None = None) -> Column:
    """Epoch milliseconds at which the current minute began, or that of the column ``now``."""
    return F.unix_millis(truncate_to_minute(F.current_timestamp() if now is None else now))


def current_hour_start_ms(now: Column | str | None = None) -> Column:
    """Epoch milliseconds at which the current hour began, or that of the column ``now``."""
    return F.unix_millis(truncate_to_hour(F.current_timestamp() if now is None else now))


def within_processing_window(
    ts: Column | str, reference: Column | str, max_lateness_seconds: int = 3600
) -> Column:
    """True when the event is 0 to ``max_lateness_seconds`` whole seconds older than ``reference``.

    Both instants lose their fraction first. An event after the reference is outside.
    """
    age = F.unix_seconds(_col(reference)) - F.unix_seconds(_col(ts))
    return age.between(0, max_lateness_seconds)


def iso_instant(ts: Column | str) -> Column:
    """ISO-8601 text in UTC with no, three or six fraction digits, as few as keep the value."""
    date, rest = _utc(ts)
    clock = [_two_digits(rest, unit * MICROS, of) for unit, of in ((3600, 24), (60, 60), (1, 60))]
    second = F.concat(date, F.lit("T"), F.concat_ws(":", *clock))
    fraction = F.pmod(rest, F.lit(MICROS))
    digits = F.lpad(fraction.cast("string"), 6, "0")
    return (
        F.when(fraction == 0, F.concat(second, F.lit("Z")))
        .when(fraction % 1000 == 0, F.concat(second, F.lit("."), F.substring(digits, 1, 3), F.lit("Z")))
        .otherwise(F.concat(second, F.lit("."), digits, F.lit("Z")))
    )

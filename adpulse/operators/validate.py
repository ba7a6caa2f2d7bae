"""Validation: annotate every event with the first rule it breaks, then split.

Everything here is a narrow projection. Nothing is shuffled, and the accepted and the rejected rows
are two filters over the same annotated frame.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_sql
from ..schemas import MAX_AGE_HOURS, MAX_FUTURE_MINUTES, REQUIRED_COMMON, Side, side_of


def _instant(as_of: Column | datetime | str | None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


_NOW = "_as_of"


def _names(names: tuple[str, ...]) -> str:
    return ", ".join(f"'{name}'" for name in names)


def _rules(side: Side) -> list[tuple[str, str, str]]:
    """(code, condition, message) as SQL in checking order."""

    def blank(name: str) -> tuple[str, str, str]:
        return (f"{name}_blank", blank_sql(name), f"'{name} is blank'")

    rules = [blank(name) for name in REQUIRED_COMMON]
    rules.append((
        "too_old",
        f"timestamp IS NULL OR timestamp < {_NOW} - INTERVAL {MAX_AGE_HOURS} HOURS",
        f"concat('event is older than {MAX_AGE_HOURS} h: ', timestampdiff(HOUR, timestamp, {_NOW}), ' h')",
    ))
    rules.append((
        "in_future",
        f"timestamp > {_NOW} + INTERVAL {MAX_FUTURE_MINUTES} MINUTES",
        "concat('event is too far in the future: ', timestamp)",
    ))
    rules += [blank(name) for name in side.required]
    rules.append((
        "action_not_allowed",
        f"action IS NULL OR action NOT IN ({_names(side.actions)})",
        f"concat('not a {side.name} action: ', coalesce(action, 'null'))",
    ))
    for rule in side.prices:
        price = rule.column
        rules.append((f"{price}_negative", f"{price} < 0", f"concat('{price} is negative: ', {price})"))
        if rule.maximum is not None:
            # Spark orders NaN above every number; a NaN price is accepted, so it is let through
            rules.append((
                f"{price}_above_max",
                f"{price} > {rule.maximum}D AND NOT isnan({price})",
                f"concat('{price} is above {rule.maximum}: ', {price})",
            ))
    return rules


def reject_codes(side: str | Side) -> list[str]:
    """All reject codes of a side, in checking order."""
    return [code for code, _, _ in _rules(side_of(side))]


def validate(
    events: DataFrame,
    side: str | Side,
    as_of: Column | datetime | str | None = None,
    reasons: bool = True,
) -> DataFrame:
    """Add ``reject_code`` and ``reject_reason``: the first broken rule, null for a valid event.

    Order: blank ids, age over 24 h, more than 5 min in the future, then the rules of the side. Both
    time bounds are strict.

    ``as_of`` is the "now" of the age rules. It defaults to the wall clock; give a literal for
    tables, or the broker's ingest time column for streams, so that queries reading the same topic
    independently judge an event alike.
    """
    rules = _rules(side_of(side))
    code = " ".join(f"WHEN {broken} THEN '{code}'" for code, broken, _ in rules)
    out = events.withColumn(_NOW, _instant(as_of)).withColumn("reject_code", F.expr(f"CASE {code} END"))
    if reasons:
        # chosen by code, so that the message is only built for rejected rows
        reason = " ".join(f"WHEN '{code}' THEN {message}" for code, _, message in rules)
        out = out.withColumn("reject_reason", F.expr(f"CASE reject_code {reason} END"))
    return out.drop(_NOW)


def valid(annotated: DataFrame) -> DataFrame:
    """The accepted events, without the reject columns."""
    return annotated.filter(F.col("reject_code").isNull()).drop("reject_code", "reject_reason")


def rejected(annotated: DataFrame) -> DataFrame:
    """The dead letters: rejected events with the code and the reason."""
    return annotated.filter(F.col("reject_code").isNotNull())


def valid_events(
    events: DataFrame, side: str | Side, as_of: Column | datetime | str | None = None
) -> DataFrame:
    """Only the accepted events.

    The time bounds and the action set are also given as plain conditions. They follow from the
    rules, but in this form they reach a Parquet scan, which skips row groups by them.
    """
    now, ts = _instant(as_of), F.col("timestamp")
    recent = events.filter(
        (ts >= now - F.expr(f"INTERVAL {MAX_AGE_HOURS} HOURS"))
        & (ts <= now + F.expr(f"INTERVAL {MAX_FUTURE_MINUTES} MINUTES"))
        & F.col("action").isin(*side_of(side).actions)
    )
    return valid(validate(recent, side, as_of, reasons=False))


def reject_stats(annotated: DataFrame) -> DataFrame:
    """Rows per reject code with the share of all rows in percent; accepted rows have code ``valid``.

    The counts are combined before the shuffle, so each task sends one row per code; the total is a
    window over those few rows.
    """
    from pyspark.sql import Window

    counts = (
        annotated.groupBy(F.coalesce("reject_code", F.lit("valid")).alias("reject_code"))
        .agg(F.count(F.lit(1)).alias("events"))
    )
    total = F.sum("events").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("percent", F.col("events") * 100.0 / total)


def observe_rejects(annotated: DataFrame, name: str = "rejects") -> DataFrame:
    """Attach running totals (processed, rejected, rate in percent) that Spark reports per batch.

    On a stream they appear in ``StreamingQueryProgress.observedMetrics``, on a batch query through
    :class:`pyspark.sql.Observation`. They cost no extra pass.
    """
    bad = F.count_if(F.col("reject_code").isNotNull())
    n = F.count(F.lit(1))
    return annotated.observe(
        name,
        n.alias("processed"),
        bad.alias("rejected"),
        F.when(n > 0, bad * 100.0 / n).otherwise(0.0).alias("rejection_rate"),
    )

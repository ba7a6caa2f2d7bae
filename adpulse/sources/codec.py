"""JSON on the wire: decode events, encode events and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import iso_instant
from ..operators.shape import evaluate_once
from ..schemas import ACTIONS, Side, side_of

_CORRUPT = "_corrupt"
# fixed values: text forms of an instant. ISO-8601 with seconds in UTC, or a number of epoch seconds
_ISO = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d{0,9})?([Zz]|\+00(:?00)?)$"
_NUMBER = r"^[+-]?\d+(\.\d*)?([eE][+-]?\d+)?$"


def wire_schema(side: str | Side) -> T.StructType:
    """The event schema with every scalar as text, plus the column for malformed input.

    Typed parsing would call a quoted number malformed; text lets :func:`decode` convert leniently.
    """
    fields = []
    for field in side_of(side).event.fields:
        nested = isinstance(field.dataType, (T.ArrayType, T.MapType))
        fields.append(field if nested else T.StructField(field.name, T.StringType()))
    return T.StructType([*fields, T.StructField(_CORRUPT, T.StringType())])


def parse_instant(text: Column) -> Column:
    """An ISO-8601 instant or a number of epoch seconds as a timestamp, null for anything else."""
    seconds = text.try_cast("decimal(24,9)")
    return F.when(text.rlike(_ISO), text.try_cast("timestamp")).when(
        text.rlike(_NUMBER), F.timestamp_micros((seconds * 1_000_000).try_cast("bigint"))
    )


def _has_key(value: Column, name: str) -> Column:
    return F.array_contains(F.json_object_keys(value), name)


def _variant_type(value: Column, name: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json(value), f"$.{name}", "variant"))


def _looks_nested(text: Column) -> Column:
    return text.startswith("{") | text.startswith("[")


def _errors(side: Side, value: Column) -> list[tuple[str, Column]]:
    """(code, condition) per way in which a message is not an event, in checking order.

    The rare conditions that need a second look at the message sit behind a ``when`` on a cheap one,
    so that ordinary messages are parsed once.
    """
    out = [("malformed", F.col(_CORRUPT).isNotNull())]
    for field in side.event.fields:
        name, col = field.name, F.col(field.name)
        if name in ("metadata", "targeting_segments"):
            items = F.map_values(col) if name == "metadata" else col
            deep = F.when(
                F.exists(items, _looks_nested), _variant_type(value, name).substr(2, 1 << 20).rlike("OBJECT<|ARRAY<")
            )
            out.append((f"{name}_null", F.when(col.isNull(), _has_key(value, name))))
            out.append((f"{name}_nested", deep))
            continue
        if name in ("ad_slot", "page_url"):
            out.append((f"{name}_null", F.when(col.isNull(), _has_key(value, name))))
        elif not isinstance(field.dataType, T.DoubleType):
            out.append((f"{name}_missing", col.isNull()))
        if isinstance(field.dataType, T.StringType):
            nested = F.when(_looks_nested(col), _variant_type(value, name).rlike("^(OBJECT|ARRAY)"))
            out.append((f"{name}_nested", nested))
        if name == "action":
            out.append(("action_unknown", ~col.isin(*ACTIONS)))
        elif isinstance(field.dataType, T.TimestampType):
            out.append((f"{name}_bad", F.col(_parsed(name)).isNull()))
        elif isinstance(field.dataType, T.DoubleType):
            out.append((f"{name}_bad", F.when(col.isNotNull() & (col != ""), F.col(_parsed(name)).isNull())))
    return out


def _parsed(name: str) -> str:
    """Name of the converted text of a timestamp or price, computed once and used for the value and
    for the error."""
    return f"_parsed_{name}"


def _conversions(side: Side) -> dict[str, Column]:
    out = {}
    for field in side.event.fields:
        if isinstance(field.dataType, T.TimestampType):
            out[_parsed(field.name)] = parse_instant(F.col(field.name))
        elif isinstance(field.dataType, T.DoubleType):
            out[_parsed(field.name)] = F.col(field.name).try_cast("double")
    return out


def _typed(field: T.StructField) -> Column:
    col = F.col(field.name)
    if isinstance(field.dataType, T.TimestampType):
        col = F.col(_parsed(field.name))
    elif isinstance(field.dataType, T.DoubleType):
        col = F.coalesce(F.col(_parsed(field.name)), F.lit(0.0))
    elif field.name in ("ad_slot", "page_url"):
        col = F.coalesce(col, F.lit(""))
    elif isinstance(field.dataType, T.ArrayType):
        col = F.coalesce(col, F.array().cast("array<string>"))
    elif isinstance(field.dataType, T.MapType):
        col = F.coalesce(col, F.create_map().cast("map<string,string>"))
    return col.alias(field.name)


def decode_with_errors(messages: DataFrame, side: str | Side, value: str = "value") -> DataFrame:
    """Decode every message and keep the failures: adds ``decode_error``, null for a good event.

    Columns of ``messages`` are kept, so the raw text stays at hand for a quarantine output.
    """
    side = side_of(side)
    text = F.col(value).cast("string")
    options = {"columnNameOfCorruptRecord": _CORRUPT, "mode": "PERMISSIVE", "allowNonNumericNumbers": "false"}
    parsed = F.from_json(text, wire_schema(side), options)
    rows = messages.select(*messages.columns, F.inline(F.array(parsed))).withColumns(_conversions(side))
    error = F.coalesce(*[F.when(broken, F.lit(code)) for code, broken in _errors(side, text)])
    return evaluate_once(
        rows.select(*messages.columns, *[_typed(f) for f in side.event.fields], error.alias("decode_error"))
    )


def decode(messages: DataFrame, side: str | Side, value: str = "value") -> DataFrame:
    """Decode JSON messages to events; a message that is not an event is dropped.

    Fields a side does not know are ignored. Required fields must be there; prices default to 0.0,
    texts to ``''``, list and map to empty. An explicit null is a missing number, but drops the
    message for a text, list or map. Numbers may be quoted. ``timestamp`` is ISO-8601 UTC or epoch
    seconds. ``action`` must be one of the 15 names in upper case; enum ordinals are not accepted.

    Other columns of ``messages`` (the broker's ingest time, say) are kept.
    """
    good = decode_with_errors(messages, side, value).filter(F.col("decode_error").isNull())
    return good.drop("decode_error", value)


def observe_decode(decoded: DataFrame, name: str = "decode") -> DataFrame:
    """Report how many messages were read and dropped, on a frame of :func:`decode_with_errors`."""
    return decoded.observe(
        name, F.count(F.lit(1)).alias("messages"), F.count_if(F.col("decode_error").isNotNull()).alias("dropped")
    )


def split_mixed(messages: DataFrame, value: str = "value") -> dict[str, DataFrame]:
    """The messages of a mixed topic per side, told apart by ``event_type`` in any case.

    Messages of any other or no type are dropped.
    """
    kind = F.upper(F.get_json_object(F.col(value).cast("string"), "$.event_type"))
    return {name: messages.filter(kind == name.upper()) for name in ("ssp", "dsp")}


def decode_mixed(messages: DataFrame, value: str = "value") -> dict[str, DataFrame]:
    """Decode a topic that carries both sides; gives one frame per side."""
    return {name: decode(part, name, value) for name, part in split_mixed(messages, value).items()}


_JSON = {"ignoreNullFields": "false"}


def event_json(side: str | Side) -> Column:
    """An event row as a JSON object with the wire names."""
    fields = [
        iso_instant(f.name).alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in side_of(side).event.fields
    ]
    return F.to_json(F.struct(*fields), _JSON)


def encode_events(events: DataFrame, side: str | Side) -> DataFrame:
    """Events as one JSON text column ``value``."""
    return events.select(event_json(side).alias("value"))


# fixed values: wire names of the derived ratios and the duration
DERIVED_NAMES = {
    "click_through_rate": "clickThroughRate",
    "conversion_rate": "conversionRate",
    "cost_per_click": "costPerClick",
    "cost_per_conversion": "costPerConversion",
}
DURATION_NAME = "durationSeconds"

_BASE = (
    "campaign_id", "advertiser_id", "action", "impressions", "clicks", "conversions", "views",
    "total_revenue", "total_spend", "unique_users", "event_count",
)
_WINDOW = ("window_start", "window_end", "window_type", "duration_seconds")


def base_struct(metrics: DataFrame) -> Column:
    """The side-independent part of a metric row as a nested record."""
    window = F.struct(
        iso_instant("window_start").alias("window_start"),
        iso_instant("window_end").alias("window_end"),
        F.col("window_type"),
        F.col("duration_seconds").alias(DURATION_NAME),
    )
    return F.struct(
        window.alias("window"),
        *[F.col(c) for c in _BASE if c in metrics.columns],
        iso_instant("created_at").alias("created_at"),
        *[F.col(c).alias(wire) for c, wire in DERIVED_NAMES.items()],
    )


def nest_metrics(metrics: DataFrame) -> DataFrame:
    """The published shape of metric rows: ``base`` (with ``base.window``) and the side's columns."""
    flat = {*_WINDOW, *_BASE, *DERIVED_NAMES, "created_at"}
    return metrics.select(base_struct(metrics).alias("base"), *[c for c in metrics.columns if c not in flat])


def encode_metrics(metrics: DataFrame) -> DataFrame:
    """Metric rows as one JSON text column ``value``."""
    nested = nest_metrics(metrics)
    return nested.select(F.to_json(F.struct(*nested.columns), _JSON).alias("value"))


def encode_base_metrics(metrics: DataFrame) -> DataFrame:
    """Only the side-independent record, as one JSON text column ``value``."""
    return metrics.select(F.to_json(base_struct(metrics), _JSON).alias("value"))

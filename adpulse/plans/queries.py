"""The query registry: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Results are rounded to six places, because the order of a double sum is not fixed, and window bounds
are given without a zone.
"""

from __future__ import annotations

from collections.abc import Callable
from os.path import basename

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as fn
from ..operators import (
    base_ratios,
    deduplicate,
    enrich,
    evaluate_once,
    ratio,
    reject_stats,
    rejected,
    storable,
    to_archive,
    valid_events,
    validate,
    windowed_metrics,
    with_fingerprint,
    with_mapping,
)
from ..schemas import side_of
from ..session import configure, shared_folder
from ..sinks import batch_files, read_batches, write_archive
from ..sources import (
    decode, decode_mixed, decode_with_errors, encode_base_metrics, encode_events, encode_metrics, event_json, read_archive,
)
from ..streaming import archive_query, dead_letter_query, metrics_query
from .adapter import AS_OF, adapt, read_events

Query = Callable[[SparkSession, str], DataFrame]

MINUTE, FIVE_MINUTES, HOUR = 60_000, 300_000, 3_600_000
_UNUSED = ("metadata", "ad_slot", "page_url", "targeting_segments")  # by validation and metrics
# the closing event, later than any window that an event accepted by the age rules can be in
FLUSH_ID, FLUSH = "flush", "2024-01-03 00:00:00"
PROCESSING_MS = 1_704_070_800_000  # a fixed processing time, in place of the wall clock


def events_of(spark: SparkSession, sf_dir: str, side: str, whole: bool = False) -> DataFrame:
    """Adapted events; unless ``whole``, only the columns validation and metrics use."""
    configure(spark)
    events = adapt(read_events(spark, sf_dir), side)
    return evaluate_once(events if whole else events.drop(*_UNUSED))


def good_events(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    return valid_events(events_of(spark, sf_dir, side), side, AS_OF)


def present(df: DataFrame) -> DataFrame:
    """Round doubles, drop zones, leave out the creation time."""
    out = []
    for field in df.schema.fields:
        name = f"`{field.name}`"
        if field.name == "created_at":
            continue
        if isinstance(field.dataType, T.DoubleType):
            # through decimals, so that exact ties round alike everywhere
            out.append(f"double(round(cast({name} AS decimal(30, 9)), 6)) AS {name}")
        elif isinstance(field.dataType, T.TimestampType):
            out.append(f"cast({name} AS timestamp_ntz) AS {name}")
        else:
            out.append(name)
    return df.selectExpr(*out)


def _windowed(side: str, size_ms: int, slide_ms: int | None = None, **options: object) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(windowed_metrics(good_events(spark, sf_dir, side), side, size_ms, slide_ms, **options))

    return run


def _validate_codes(side: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        annotated = validate(events_of(spark, sf_dir, side), side, AS_OF)
        return annotated.groupBy("reject_code").agg(F.count(F.lit(1)).alias("events"))

    return run


def _validate_rows(side: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        annotated = validate(events_of(spark, sf_dir, side), side, AS_OF)
        return present(annotated.select("event_id", "timestamp", "user_id", "action", "reject_code"))

    return run


def _reject_stats(side: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(reject_stats(validate(events_of(spark, sf_dir, side), side, AS_OF, reasons=False)))

    return run


def _dead_letters(side: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _flat_letters(rejected(validate(events_of(spark, sf_dir, side, whole=True), side, AS_OF)))

    return run


def _flat_letters(letters: DataFrame) -> DataFrame:
    """All columns of the dead letters; the map as its one entry, the list as text, and the reason without the
    number or instant at its end, which engines print differently and the event's own columns hold."""
    letters = letters.withColumn("metadata", F.col("metadata")["k"])
    letters = letters.withColumn("reject_reason", F.regexp_replace("reject_reason", r": -?[0-9][-0-9.:E ]*h?$", ""))
    return _flat_archive(letters)


def _archive_rows(side: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = to_archive(
            events_of(spark, sf_dir, side, whole=True), side, F.timestamp_millis(F.lit(PROCESSING_MS))
        )
        return _flat_archive(rows)

    return run


def _flat_archive(rows: DataFrame) -> DataFrame:
    if "targeting_segments" in rows.columns:
        rows = rows.withColumn("targeting_segments", F.array_join("targeting_segments", ","))
    return present(rows)


def _enriched_metadata(side: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = storable(events_of(spark, sf_dir, side, whole=True))
        meta = enrich(events, side, F.timestamp_millis(F.lit(PROCESSING_MS)))
        names = ["k", "partition_path", "processing_time"] + (["advertiser_id"] if side == "dsp" else [])
        return meta.select(
            "event_id", "user_id", F.size("metadata").alias("entries"),
            *[F.try_element_at("metadata", F.lit(n)).alias(f"meta_{n}") for n in names],
        )

    return run


def _archive_round_trip(side: str) -> Query:
    """Write the archive, then count one day part through partition pruning."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = shared_folder(spark, f"archive-{side}")
        rows = to_archive(
            events_of(spark, sf_dir, side, whole=True), side, F.timestamp_millis(F.lit(PROCESSING_MS))
        )
        write_archive(rows, path)
        return _day_part(read_archive(spark, path, side), side)

    return run


def _day_part(back: DataFrame, side: str) -> DataFrame:
    """Rows, instants and prices of January 2024 by hour. Six million epoch milliseconds add up to more than a long
    holds, so they are added as decimals; the sums are longs, unless one of them is too large for that."""
    price = "winning_bid" if side == "ssp" else "clearing_price"
    by_hour = back.filter((F.col("year") == "2024") & (F.col("month") == "01")).groupBy("day", "hour")
    instants = F.sum(F.col("timestamp").cast("decimal(20, 0)"))
    largest = by_hour.agg(instants.alias("sum")).agg(F.max(F.abs("sum"))).first()[0]
    if largest is None or largest < 1 << 63:
        instants = instants.cast("long")
    return present(
        by_hour.agg(F.count(F.lit(1)).alias("events"), instants.alias("timestamps"), F.sum(price).alias("amount"))
    )


def _messages(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    """Every event as wire JSON, with a broken message for some: text cut short, a required field
    renamed, an action in lower case, a price that is no number, a null text or list."""
    events = events_of(spark, sf_dir, side, whole=True).withColumn(
        "_n", F.coalesce(F.element_at("metadata", "k").try_cast("long"), F.lit(0))
    )
    n = F.col("_n")
    json = F.col("value")
    price = "winning_bid" if side == "ssp" else "clearing_price"
    nullable = "ad_slot" if side == "ssp" else "targeting_segments"
    return _encode_and(events, side, "_n").select(
        n,
        F.when(n % 11 == 0, F.substring(json, 1, 40))
        .when(n % 13 == 0, F.replace(json, F.lit('"user_id"'), F.lit('"visitor"')))
        .when(n % 17 == 0, F.replace(json, F.lit('"action":"'), F.lit('"action":"x')))
        .when(n % 19 == 0, F.replace(json, F.lit(f'"{price}":'), F.lit(f'"{price}":"low","x":')))
        .when(n % 23 == 0, F.replace(json, F.lit(f'"{nullable}":'), F.lit(f'"{nullable}":null,"x":')))
        .when(n % 29 == 0, F.replace(json, F.lit(f'"{price}":'), F.lit(f'"{price}":"1.5","x":')))
        .otherwise(json)
        .alias("value"),
    )


def _encode_and(events: DataFrame, side: str, *columns: str) -> DataFrame:
    """Events as JSON, next to some of their columns."""
    return events.select(*columns, event_json(side).alias("value"))


def _json_decode(side: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        decoded = decode(_messages(spark, sf_dir, side), side).drop("_n")
        decoded = decoded.withColumn("k", F.element_at("metadata", "k")).drop("metadata")
        return _flat_archive(decoded)

    return run


def _json_decode_errors(side: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = decode_with_errors(_messages(spark, sf_dir, side), side)
        return rows.groupBy("decode_error").agg(F.count(F.lit(1)).alias("messages"))

    return run


def json_decode_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for side, tag in (("ssp", "Ssp"), ("dsp", "DSP")):
        events = events_of(spark, sf_dir, side, whole=True)
        other = F.col("user_id").endswith("3")  # a type no decoder knows
        start = F.concat(F.lit('{"event_type":"'), F.when(other, "OTHER").otherwise(tag), F.lit('",'))
        json = _encode_and(events, side, "user_id")
        parts.append(json.select(F.concat(start, F.substr("value", F.lit(2))).alias("value")))
    decoded = decode_mixed(parts[0].unionByName(parts[1]))
    common = ["event_id", "timestamp", "campaign_id", "user_id", "action"]
    return present(
        decoded["ssp"].select(F.lit("SSP").alias("kind"), *common)
        .unionByName(decoded["dsp"].select(F.lit("DSP").alias("kind"), *common))
    )


# fixed values: wire names and types of published metrics
_BASE_WIRE = (
    "window struct<window_start: string, window_end: string, window_type: string, durationSeconds: bigint>, "
    "campaign_id string, advertiser_id string, action string, impressions bigint, clicks bigint, conversions bigint, views bigint, "
    "total_revenue double, total_spend double, unique_users bigint, event_count bigint, created_at string, "
    "clickThroughRate double, conversionRate double, costPerClick double, costPerConversion double"
)
_OWN_WIRE = {
    "ssp": "publisher_id string, ad_requests bigint, ad_responses bigint, fill_rate double, viewability_rate double, "
           "avg_floor_price double, avg_winning_bid double",
    "dsp": "bid_requests bigint, bid_responses bigint, bid_wins bigint, bid_losses bigint, bid_timeouts bigint, win_rate double, "
           "avg_bid_price double, avg_clearing_price double, total_budget_spent double",
}


def _json_encode_metrics(side: str, size_ms: int, slide_ms: int | None = None, grain: str = "action", base: bool = False) -> Query:
    """Published metric records, every field read back in one parse."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        metrics = windowed_metrics(good_events(spark, sf_dir, side), side, size_ms, slide_ms, grain)
        if base:
            rows = encode_base_metrics(metrics).select(F.from_json("value", _BASE_WIRE).alias("base"))
            own = []
        else:
            wire = f"base {T.StructType.fromDDL(_BASE_WIRE).simpleString()}, {_OWN_WIRE[side]}"
            rows = encode_metrics(metrics).select(F.from_json("value", wire).alias("r")).select("r.*")
            own = [c for c in rows.columns if c != "base"]
        rows = rows.select("base.window.*", "base.*", *own).drop("window").withColumnsRenamed({
            "durationSeconds": "duration_seconds", "clickThroughRate": "click_through_rate", "conversionRate": "conversion_rate",
            "costPerClick": "cost_per_click", "costPerConversion": "cost_per_conversion"})
        stamped = F.col("created_at").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?Z$")
        return present(rows.withColumn("stamped", stamped).drop("created_at"))

    return run


def _json_encode_events(side: str) -> Query:
    """Events as wire JSON, every field read back in one parse; the instant as its text."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        fields = [T.StructField(f.name, T.StringType()) if isinstance(f.dataType, T.TimestampType) else f for f in side_of(side).event.fields]
        rows = encode_events(events_of(spark, sf_dir, side, whole=True), side)
        rows = rows.select(F.inline(F.array(F.from_json("value", T.StructType(fields)))))
        return _flat_archive(rows.withColumn("metadata", F.element_at("metadata", "k")))

    return run


def current_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the current minute and hour began, with each event's instant as the present."""
    return _timestamps(spark, sf_dir).select(
        "event_id", fn.current_minute_start_ms("ts").alias("minute_ms"), fn.current_hour_start_ms("ts").alias("hour_ms")
    )


def _timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return read_events(spark, sf_dir).select("event_id", F.col("ts").cast("timestamp").alias("ts"))


def partition_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timestamps(spark, sf_dir).select(
        "event_id", fn.partition_path("ts").alias("path"), fn.partition_path("ts", "SSP").alias("typed_path")
    )


def truncate_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(_timestamps(spark, sf_dir).select(
        "event_id",
        fn.truncate_to_minute("ts").alias("minute"),
        fn.truncate_to_hour("ts").alias("hour"),
        fn.truncate_to_day("ts").alias("day"),
        fn.from_epoch_millis(F.unix_millis("ts")).alias("millis"),
    ))


def truncate_n_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(_timestamps(spark, sf_dir).select(
        "event_id", *[fn.truncate_to_n_minutes("ts", n).alias(f"every_{n}") for n in (1, 5, 7, 15, 60)]
    ))


def within_processing_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference = F.lit("2024-01-15 12:00:00").cast("timestamp")
    return _timestamps(spark, sf_dir).select(
        "event_id",
        fn.within_processing_window("ts", reference).alias("within_hour"),
        fn.within_processing_window("ts", reference, 5 * 86400).alias("within_five_days"),
    )


def action_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types of the table, most of which are no action, read as actions."""
    configure(spark)
    action = fn.parse_action("event_type")
    return read_events(spark, sf_dir).select(
        "event_id", action.alias("action"),
        fn.is_action_of("ssp", action).alias("is_ssp"), fn.is_action_of("dsp", action).alias("is_dsp"),
    )


def event_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return with_fingerprint(read_events(spark, sf_dir).select("event_id", F.col("props").alias("value")))


def dedup_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return deduplicate(read_events(spark, sf_dir).select(F.col("props").alias("value")))


def legacy_mapping_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events joined to a table with several mappings per id: the return flags of an order's lines."""
    configure(spark)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    mappings = lines.select(F.col("l_orderkey").cast("string").alias("event_id"), F.col("l_returnflag").alias("mapping"))
    events = read_events(spark, sf_dir).select(F.col("event_id").cast("string").alias("event_id"), "user_id")
    return with_mapping(events, mappings)


def base_ratio_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four base ratios over a campaign's whole hour, demand side."""
    rows = windowed_metrics(good_events(spark, sf_dir, "dsp"), "dsp", HOUR, grain="campaign")
    sums = rows.groupBy("campaign_id").agg(
        *[F.sum(c).alias(c) for c in ("impressions", "clicks", "conversions", "total_spend")],
    )
    return present(sums.withColumns(base_ratios()).withColumn("spend_per_impression", ratio("total_spend", "impressions")))


def table_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream, be it one file or a folder of part files.

    A single file can't be a stream's path, so then its folder is watched for that one name.
    """
    table = f"{sf_dir}/events.parquet"
    reader = spark.readStream.schema(spark.read.parquet(table).schema)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
    status = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path)
    if status.isDirectory():
        return reader.parquet(table)
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def _flushed_stream(spark: SparkSession, sf_dir: str, side: str, scratch: str) -> DataFrame:
    """The adapted table as a stream, and with it one event late enough to close every window that
    holds events of the table. The windows of that event itself stay open and are never written."""
    events = adapt(table_stream(spark, sf_dir), side).drop(*_UNUSED)
    texts = {f.name: FLUSH_ID for f in events.schema.fields if isinstance(f.dataType, T.StringType)}
    flush = spark.range(1).select(*[
        F.lit({**texts, "timestamp": FLUSH, "action": "CLICK"}.get(f.name, 1.0)).cast(f.dataType).alias(f.name)
        for f in events.schema.fields
    ])
    flush.write.parquet(scratch)
    late = spark.readStream.schema(events.schema).parquet(scratch)
    return evaluate_once(events).unionByName(late)


def _as_of() -> Column:
    """The "now" of the age rules: the fixed one, but for the closing event its own time."""
    return F.when(F.col("event_id") == FLUSH_ID, F.col("timestamp")).otherwise(F.lit(AS_OF).cast("timestamp"))


def _stream_metrics(side: str, size_ms: int, slide_ms: int | None = None) -> Query:
    """Window metrics computed by a streaming query over the table, run to its end."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        out = shared_folder(spark, f"stream-{side}")
        query = metrics_query(
            _flushed_stream(spark, sf_dir, side, f"{out}/flush"), side, batch_files(f"{out}/rows"), f"{out}/checkpoint",
            name=basename(out), size_ms=size_ms, slide_ms=slide_ms, as_of=_as_of(), trigger={"availableNow": True},
        )
        query.awaitTermination()
        return present(read_batches(spark, f"{out}/rows"))

    return run


def _stream_dead_letters(side: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        out = shared_folder(spark, f"dead-letters-{side}")
        events = evaluate_once(adapt(table_stream(spark, sf_dir), side))
        query = dead_letter_query(
            events, side, batch_files(f"{out}/rows"), f"{out}/checkpoint", basename(out), AS_OF, {"availableNow": True}
        )
        query.awaitTermination()
        return _flat_letters(read_batches(spark, f"{out}/rows"))

    return run


def _stream_archive(side: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        out = shared_folder(spark, f"stream-archive-{side}")
        events = evaluate_once(adapt(table_stream(spark, sf_dir), side))
        query = archive_query(
            events, side, f"{out}/rows", f"{out}/checkpoint", basename(out),
            processing_time=F.timestamp_millis(F.lit(PROCESSING_MS)), trigger={"availableNow": True},
        )
        query.awaitTermination()
        return _flat_archive(read_archive(spark, f"{out}/rows", side))

    return run


def registry() -> dict[str, Query]:
    """All queries by name."""
    out: dict[str, Query] = {}
    for side in ("ssp", "dsp"):
        out |= {
            f"{side}_tumbling_1min": _windowed(side, MINUTE),
            f"{side}_sliding_5min": _windowed(side, FIVE_MINUTES, MINUTE),
            f"{side}_tumbling_5min": _windowed(side, FIVE_MINUTES),
            f"{side}_tumbling_1hour": _windowed(side, HOUR),
            f"{side}_campaign_rollup": _windowed(side, FIVE_MINUTES, MINUTE, grain="campaign", labels="accurate"),
            f"{side}_validate_codes": _validate_codes(side),
            f"{side}_validate_rows": _validate_rows(side),
            f"{side}_reject_stats": _reject_stats(side),
            f"{side}_dead_letters": _dead_letters(side),
            f"{side}_archive_rows": _archive_rows(side),
            f"{side}_enriched_metadata": _enriched_metadata(side),
            f"{side}_archive_round_trip": _archive_round_trip(side),
            f"json_decode_{side}": _json_decode(side),
            f"json_decode_errors_{side}": _json_decode_errors(side),
            f"stream_equals_batch_{side}": _stream_metrics(side, MINUTE),
            f"stream_dead_letters_{side}": _stream_dead_letters(side),
            f"stream_archive_{side}": _stream_archive(side),
            f"json_encode_events_{side}": _json_encode_events(side),
            f"json_encode_metrics_{side}": _json_encode_metrics(side, MINUTE),
            f"json_encode_campaign_metrics_{side}": _json_encode_metrics(side, FIVE_MINUTES, MINUTE, "campaign"),
            f"json_encode_base_metrics_{side}": _json_encode_metrics(side, HOUR, base=True),
        }
    out |= {
        "dsp_budget_exhausted": _windowed("dsp", HOUR, grain="campaign", budget_exhausted=True),
        "json_decode_mixed": json_decode_mixed,
        # the names of the first round's narrower queries
        "json_encode_metrics": _json_encode_metrics("ssp", MINUTE),
        "json_encode_events": _json_encode_events("dsp"),
        "current_starts": current_starts,
        "partition_path": partition_path,
        "truncate_units": truncate_units,
        "truncate_n_minutes": truncate_n_minutes,
        "within_processing_window": within_processing_window,
        "action_parse": action_parse,
        "event_fingerprint": event_fingerprint,
        "dedup_fingerprint": dedup_fingerprint,
        "legacy_mapping_join": legacy_mapping_join,
        "base_ratios": base_ratio_query,
    }
    return out

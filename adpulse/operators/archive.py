"""Archive projection: what the storage job keeps of an event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import from_epoch_millis, is_blank, partition_columns, partition_path
from ..schemas import Side, side_of


def storable(events: DataFrame) -> DataFrame:
    """Events with an id. The archive keeps events that break other rules on purpose."""
    return events.filter(~is_blank("event_id"))


def enrich(events: DataFrame, side: str | Side, processing_time: Column | None = None) -> DataFrame:
    """Add the partition path and the processing time (epoch ms) to the metadata map.

    The demand side also gets its ``advertiser_id`` there. Entries of the same name are replaced:
    they are filtered out first, because ``map_concat`` refuses duplicate keys.
    """
    side = side_of(side)
    now = F.current_timestamp() if processing_time is None else processing_time
    added = {
        "partition_path": partition_path("timestamp", side.name.upper()),
        "processing_time": F.unix_millis(now).cast("string"),
    }
    if side.name == "dsp":
        added["advertiser_id"] = F.col("advertiser_id")
    kept = F.map_filter("metadata", lambda k, _: ~k.isin(*added))
    pairs = [part for name, value in added.items() for part in (F.lit(name), value)]
    return events.withColumn("metadata", F.map_concat(kept, F.create_map(*pairs)))


def archive_rows(enriched: DataFrame, side: str | Side) -> DataFrame:
    """The stored columns: timestamp as epoch ms, no map, two metadata entries as columns."""
    side = side_of(side)
    columns = {
        "timestamp": F.unix_millis("timestamp"),
        "partition_path": F.try_element_at("metadata", F.lit("partition_path")),
        "processing_time": F.try_element_at("metadata", F.lit("processing_time")).try_cast("bigint"),
    }
    return enriched.select(*[columns.get(f.name, F.col(f.name)).alias(f.name) for f in side.archive.fields])


def with_partitions(rows: DataFrame, partition_by: str = "event") -> DataFrame:
    """Add year, month, day and hour as text: of the event (default) or of its ingestion."""
    if partition_by not in ("event", "ingest"):
        raise ValueError(f"partition_by must be event or ingest, not {partition_by!r}")
    instant = from_epoch_millis("timestamp" if partition_by == "event" else "processing_time")
    return rows.withColumns(partition_columns(instant))


def to_archive(
    events: DataFrame,
    side: str | Side,
    processing_time: Column | None = None,
    partition_by: str = "event",
) -> DataFrame:
    """Filter, enrich and project events for the archive, with the partition columns."""
    return with_partitions(archive_rows(enrich(storable(events), side, processing_time), side), partition_by)

"""Left join of events to a mapping table by event id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_mapping(
    events: DataFrame, mappings: DataFrame, event_id: str = "event_id", mapping: str = "mapping"
) -> DataFrame:
    """Add ``mapping`` to every event, null where its id has none, the smallest where it has several.
    Also for a stream of events with a static table.

    Nothing is forced to be broadcast: Spark does so when the reduced table is measured to be below
    ``spark.sql.autoBroadcastJoinThreshold`` and sorts and merges otherwise.

    Events may share one id, such as an empty one. Adaptive execution splits the hot partition of a
    merge join, but only between two shuffles; the reduced table would be joined as it comes out of
    its aggregation. Grouping it by a second column that follows from the id leaves the groups as
    they are and makes Spark shuffle the (small, reduced) table once more, which allows the split.
    """
    follows = F.pmod(F.xxhash64(F.col(event_id)), F.lit(2))
    reduced = (
        mappings.groupBy(F.col(event_id).alias("event_id"), follows.alias("_half"))
        .agg(F.min(mapping).alias("mapping"))
        .drop("_half")
    )
    return events.join(reduced, "event_id", "left")

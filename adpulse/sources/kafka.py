"""Kafka topic source. Needs the ``spark-sql-kafka-0-10`` package on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..schemas import Side, side_of

INGEST_TIME = "ingest_time"
PARTITION = "topic_partition"


def source_options(settings: Settings, side: str | Side, storage: bool = False) -> dict[str, str]:
    """Reader options for the topic of a side.

    Every query keeps its own offsets in its own checkpoint, so the archive and the aggregation
    advance independently; ``storage`` also gives it a consumer group prefix of its own.
    """
    topic = {"ssp": settings.ssp_source_topic, "dsp": settings.dsp_source_topic}[side_of(side).name]
    options = {
        **settings.kafka_options(),
        "subscribe": topic,
        "groupIdPrefix": settings.group_id + ("-storage" if storage else ""),
        "startingOffsets": settings.starting_offsets,
    }
    if settings.source_parallelism:
        options["minPartitions"] = str(settings.source_parallelism)
    if settings.max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(settings.max_offsets_per_trigger)
    return options


def read_topic(spark: SparkSession, settings: Settings, side: str | Side, storage: bool = False) -> DataFrame:
    """The raw messages of a topic as a stream: ``value``, the broker's ``ingest_time`` and the ``topic_partition``."""
    raw = spark.readStream.format("kafka").options(**source_options(settings, side, storage)).load()
    return raw.select("value", F.col("timestamp").alias(INGEST_TIME), F.col("partition").alias(PARTITION))

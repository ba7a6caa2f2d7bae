"""Output in UTC under any session zone, tables in folder form, streamed archives with few files."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from adpulse.functions.time import iso_instant, partition_columns, partition_path
from adpulse.plans import registry
from adpulse.plans.adapter import adapt, read_events
from adpulse.streaming import archive_query
from tests.compare import difference

SF = "/root/testdata/sf0.001"


def test_printed_instants_do_not_depend_on_the_zone(spark):
    micros = [1_704_069_000_000_000, 1_710_054_000_000_001, 1_730_611_800_123_000, -1, 0]  # two of them near clock changes
    df = spark.createDataFrame([(m,) for m in micros], "m long").select(F.timestamp_micros("m").alias("t"))
    out = [iso_instant("t"), partition_path("t"), partition_path("t", "ssp"), *partition_columns("t").values()]
    want = df.select(*out).collect()
    assert want[0][0] == "2024-01-01T00:30:00Z" and want[1][0] == "2024-03-10T07:00:00.000001Z" and want[2][0] == "2024-11-03T05:30:00.123Z"
    assert want[3][0] == "1969-12-31T23:59:59.999999Z" and want[0][1] == "year=2024/month=01/day=01/hour=00"
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.select(*out).collect() == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The events table as part files, and with it events near the end of the accepted time."""
    path = str(tmp_path_factory.mktemp("sf"))
    events = spark.read.parquet(f"{SF}/events.parquet")
    late = events.limit(50).withColumn("ts", F.lit("2024-01-31 12:00:00").cast("timestamp_ntz")).withColumn("event_id", F.col("event_id") + 1_000_000)
    events.unionByName(late).repartition(3).write.parquet(f"{path}/events.parquet")
    return path


@pytest.mark.parametrize("stream,batch", [
    ("stream_equals_batch_ssp", "ssp_tumbling_1min"), ("stream_sliding_ssp", "ssp_sliding_5min"), ("stream_dead_letters_dsp", "dsp_dead_letters")])
def test_streams_over_a_folder_of_part_files(spark, folder, stream, batch):
    got, want = (registry()[n](spark, folder).toPandas() for n in (stream, batch))
    assert len(want) > 0 and difference(got, want) is None


def test_streamed_archive_has_few_files_per_hour(spark, tmp_path):
    events = adapt(read_events(spark, SF), "ssp").repartition(16)
    events.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in")
    try:  # small partitions would be merged into one task
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        query = archive_query(stream, "ssp", f"{tmp_path}/out", f"{tmp_path}/ck", "few", trigger={"availableNow": True}, writers_per_hour=2)
        query.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hours = glob.glob(f"{tmp_path}/out/year=*/month=*/day=*/hour=*")
    files = glob.glob(f"{tmp_path}/out/year=*/month=*/day=*/hour=*/*.parquet")
    assert hours and len(files) <= 2 * len(hours) and len(files) > len(hours)

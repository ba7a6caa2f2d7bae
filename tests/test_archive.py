from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from adpulse.operators import deduplicate, enrich, evaluate_once, to_archive, with_mapping
from adpulse.plans import queries
from adpulse.schemas import DSP_ARCHIVE, SSP_ARCHIVE
from adpulse.sinks import write_archive
from adpulse.sources import read_archive
from tests.build import at, events

def processed():
    return F.timestamp_millis(F.lit(1_710_500_000_123))


def test_enrichment_replaces_entries(spark):
    df = events(spark, "ssp", {"metadata": {"partition_path": "old", "k": "v"}})
    assert enrich(df, "ssp", processed()).first()["metadata"] == {
        "k": "v", "partition_path": "event_type=SSP/year=2024/month=03/day=15/hour=09", "processing_time": "1710500000123",
    }


def test_demand_side_enrichment_has_the_advertiser(spark):
    assert enrich(events(spark, "dsp", {}), "dsp", processed()).first()["metadata"]["advertiser_id"] == "adv1"


@pytest.mark.parametrize("side, schema", [("ssp", SSP_ARCHIVE), ("dsp", DSP_ARCHIVE)])
def test_rows(spark, side, schema):
    # broken in other ways, but stored; without an id, not stored
    df = events(spark, side, {"ad_id": "", "action": "VIEW"}, {"event_id": " "})
    rows = to_archive(df, side, processed())
    assert rows.columns == schema.names + ["year", "month", "day", "hour"]
    assert [f.dataType for f in rows.schema.fields][: len(schema)] == [f.dataType for f in schema.fields]
    (row,) = rows.collect()
    assert row["timestamp"] == 1_710_496_770_000 and row["processing_time"] == 1_710_500_000_123
    assert (row["year"], row["month"], row["day"], row["hour"]) == ("2024", "03", "15", "09")
    assert len(schema) == {"ssp": 15, "dsp": 14}[side]


def test_ingest_partitions(spark):
    row = to_archive(events(spark, "ssp", {}), "ssp", processed(), "ingest").first()
    assert (row["hour"], row["partition_path"][-7:]) == ("10", "hour=09")
    with pytest.raises(ValueError):
        to_archive(events(spark, "ssp", {}), "ssp", processed(), "user")


def test_layout_and_pruned_read(spark, tmp_path):
    path = str(tmp_path / "dsp")
    df = events(spark, "dsp", {"timestamp": at(0)}, {"timestamp": at(3600)}, {"timestamp": at(3601)})
    write_archive(to_archive(df, "dsp", processed()), path)
    assert os.path.isdir(f"{path}/year=2024/month=03/day=15/hour=11")
    back = read_archive(spark, path, "dsp")
    assert back.first()["month"] == "03" and back.first()["targeting_segments"] == ["sports", "news"]
    hour = back.filter("hour = '11'")
    assert hour.count() == 2
    plan = hour._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour" in plan


def test_dedup_keeps_one_of_each(spark):
    texts = ["a"] * 50 + ["b"] * 3 + ["c"]
    out = deduplicate(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert sorted(r.value for r in out.collect()) == ["a", "b", "c"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_mapping_join(spark):
    left = spark.createDataFrame([("1", "x"), ("2", "y"), ("3", "z"), ("", "w")], "event_id string, v string")
    right = spark.createDataFrame([("1", "m2"), ("1", "m1"), ("2", "n"), ("9", "q")], "event_id string, mapping string")
    got = {r.v: r.mapping for r in with_mapping(left, right).collect()}
    assert got == {"x": "m1", "y": "n", "z": None, "w": None}


def test_mapping_join_splits_a_hot_id(spark):
    """A third of the rows share one id; the merge join must split that partition."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        ids = F.when(F.col("id") % 3 == 0, F.lit("")).otherwise(F.col("id").cast("string"))
        left = spark.range(0, 30_000, 1, 8).select(ids.alias("event_id"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        right = spark.range(20_000).select(F.col("id").cast("string").alias("event_id"), F.lit("m").alias("mapping"))
        out = with_mapping(left, right)
        rows = out.groupBy().agg(F.count(F.lit(1)).alias("n"), F.count("mapping").alias("m"))
        assert out._jdf.count() == 30_000
        # an action whose plan ends in the join itself
        out.write.format("noop").mode("overwrite").save()
        got = out.collect()
        assert "isSkew=true" in out._jdf.queryExecution().executedPlan().toString() or (
            "skew=true" in out._jdf.queryExecution().executedPlan().toString()
        )
        assert len(got) == 30_000 and rows.first()["m"] == sum(1 for i in range(20_000) if i % 3)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_evaluate_once_stops_filters(spark):
    df = spark.range(100).select((F.rand(1) * 0 + F.col("id")).alias("a"), F.sha2(F.col("id").cast("string"), 256).alias("b"))
    out = evaluate_once(df).filter("b > '8' AND b < 'c'")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("sha2(") == 1
    assert sorted(r.a for r in evaluate_once(df).collect()) == [float(i) for i in range(100)]


@pytest.mark.parametrize("side, price", [("ssp", "winning_bid"), ("dsp", "clearing_price")])
def test_instants_of_an_hour_may_exceed_a_long(spark, side, price):
    """What some six million events of an hour add up to, in three rows, and an hour without instants."""
    rows = [("2024", "01", "01", "00", 1 << 62, 1.5)] * 3 + [("2024", "01", "01", "01", None, None), ("2024", "02", "01", "00", 1, 1.0)]
    back = spark.createDataFrame(rows, f"year string, month string, day string, hour string, timestamp long, {price} double")
    got = {tuple(r) for r in queries._day_part(back, side).collect()}
    assert got == {("01", "00", 3, 3 << 62, 4.5), ("01", "01", 1, None, None)}
    fitting = queries._day_part(back.where("timestamp IS NULL OR timestamp < 2").withColumn("month", F.lit("01")), side)
    assert fitting.schema["timestamps"].dataType.simpleString() == "bigint"
    assert {tuple(r) for r in fitting.collect()} == {("01", "01", 1, None, None), ("01", "00", 1, 1, 1.0)}

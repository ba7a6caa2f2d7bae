"""The physical plans that matter at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from adpulse.operators import to_archive, valid_events, windowed_metrics
from adpulse.plans import registry
from adpulse.sources import decode
from tests.build import NOW, events

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "events")
    events(spark, "ssp", {}, {"action": "CLICK"}).write.parquet(path)
    return path


def test_metrics_scan_only_needed_columns_and_push_filters(spark, stored):
    plan = plan_of(windowed_metrics(valid_events(spark.read.parquet(stored), "ssp", NOW), "ssp"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "metadata" not in schema and "page_url" not in schema and "ad_slot" not in schema
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    assert "GreaterThanOrEqual(timestamp" in pushed and "In(action" in pushed


@pytest.mark.parametrize("slide", [None, 60_000])
def test_the_large_aggregation_is_by_hash_and_keyed_by_user(spark, stored, slide):
    df = windowed_metrics(valid_events(spark.read.parquet(stored), "ssp", NOW), "ssp", 300_000 if slide else 60_000, slide)
    nodes = [line for line in plan_of(df).splitlines() if re.search(r"(Hash|Sort|Object\w+)Aggregate|Exchange", line)]
    kinds = [re.search(r"(HashAggregate|SortAggregate|ObjectHashAggregate|Exchange)", n).group(1) for n in nodes][::-1]
    # from the scan up: the user-keyed aggregation, the one per dimension, and the final small one
    assert kinds == [
        "HashAggregate", "Exchange", "HashAggregate", "HashAggregate", "Exchange", "HashAggregate",
        "SortAggregate", "Exchange", "SortAggregate",
    ]
    first = [n for n in nodes if "Exchange" in n][-1]
    assert "user_id" in first


@pytest.mark.parametrize("name", [n for n in registry() if not n.startswith("stream_")])
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(registry()[name](spark, SF))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_json_is_parsed_once(spark):
    messages = spark.range(10).select(F.lit("{}").alias("value")).union(spark.range(2).select(F.col("id").cast("string")))
    plan = plan_of(windowed_metrics(valid_events(decode(messages, "ssp"), "ssp", NOW), "ssp"))
    first_branch = plan.split("Union")[0]
    assert first_branch.count("from_json") + first_branch.count("JsonToStructs") == 1


def test_archive_projection_does_not_shuffle(spark):
    assert "Exchange" not in plan_of(to_archive(events(spark, "dsp", {}), "dsp"))

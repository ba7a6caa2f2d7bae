from __future__ import annotations

import pytest

from adpulse.config import Settings, parse_args, read_properties
from adpulse.sinks import sink_options
from adpulse.sources import source_options
from adpulse.streaming import checkpoint_root

NEEDED = {"kafka.bootstrap.servers": "broker:9092", "s3.output.bucket": "bucket"}


def test_defaults():
    s = Settings.from_mapping(NEEDED)
    assert (s.tumbling_size_ms, s.sliding_size_ms, s.sliding_slide_ms, s.allowed_lateness_ms) == (60_000, 300_000, 60_000, 30_000)
    assert (s.starting_offsets, s.ssl_enabled, s.sasl_mechanism, s.job_mode) == ("latest", False, "PLAIN", "all")
    assert (s.ssp_source_topic, s.dsp_metrics_topic, s.dead_letter_topic) == ("ad-events-ssp", "ad-metrics-dsp", "ad-events-dlq")
    assert (s.row_group_size, s.page_size, s.checkpoint_interval_ms) == (134_217_728, 1_048_576, 60_000)
    assert s.watermark_delay_ms == 60_000
    assert s.archive_path("ssp") == "s3a://bucket/ad-events/ssp"


@pytest.mark.parametrize("missing", list(NEEDED))
def test_required(missing):
    with pytest.raises(ValueError, match=missing):
        Settings.from_mapping({k: v for k, v in NEEDED.items() if k != missing})


def test_bad_number():
    with pytest.raises(ValueError, match="window.tumbling.size-ms"):
        Settings.from_mapping({**NEEDED, "window.tumbling.size-ms": "soon"})


def test_prefixed_and_unknown_keys():
    s = Settings.from_mapping({**NEEDED, "flink.checkpoint.interval-ms": "1000", "flink.parallelism.source": "6", "metrics.port": "1"})
    assert s.checkpoint_interval_ms == 1000 and s.source_parallelism == 6


def test_precedence(tmp_path):
    file = tmp_path / "job.properties"
    file.write_text("# comment\n\nkafka.bootstrap.servers = file:1\ns3.output.bucket=b\nkafka.group.id: g\n")
    conf = {"spark.adpulse.kafka.group.id": "conf", "spark.adpulse.s3.output.bucket": "c", "spark.other": "x"}
    s = Settings.from_args(["--config", str(file), "--kafka.bootstrap.servers", "arg:1"], conf)
    assert (s.bootstrap_servers, s.group_id, s.output_bucket) == ("arg:1", "g", "b")
    s = Settings.from_args(["--kafka.bootstrap.servers", "arg:1"], conf)
    assert (s.group_id, s.output_bucket) == ("conf", "c")
    assert read_properties(str(file))["s3.output.bucket"] == "b"


def test_arguments():
    assert parse_args(["--a", "1", "-b", "-2", "--flag", "--c", "x"]) == {"a": "1", "b": "-2", "flag": "true", "c": "x"}
    with pytest.raises(ValueError):
        parse_args(["stray"])


def test_kafka_options():
    s = Settings.from_mapping({**NEEDED, "kafka.ssl.enabled": "true", "kafka.group.id": "g", "parallelism.source": "4"})
    tls = {
        "kafka.bootstrap.servers": "broker:9092", "kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "PLAIN",
    }
    assert source_options(s, "ssp") == {
        **tls, "subscribe": "ad-events-ssp", "groupIdPrefix": "g", "startingOffsets": "latest", "minPartitions": "4",
    }
    storage = source_options(s, "dsp", storage=True)
    assert storage["subscribe"] == "ad-events-dsp" and storage["groupIdPrefix"] == "g-storage"
    assert sink_options(s, s.metrics_topic("dsp")) == {**tls, "topic": "ad-metrics-dsp"}
    assert "kafka.security.protocol" not in source_options(Settings.from_mapping(NEEDED), "ssp")


class FakeSession:
    def __init__(self, conf):
        self.conf = conf


def test_checkpoint_root():
    unset, named = FakeSession({}), FakeSession({"spark.checkpoint.dir": "hdfs://shared/"})
    stated = Settings.from_mapping({**NEEDED, "checkpoint.storage-path": "s3a://cp/x/"})
    assert checkpoint_root(named, stated) == "s3a://cp/x"
    assert checkpoint_root(named, Settings.from_mapping(NEEDED)) == "hdfs://shared"
    assert checkpoint_root(unset, Settings.from_mapping(NEEDED)) == "s3a://bucket/ad-events/_checkpoints"


def test_output_as_path():
    assert Settings.from_mapping({**NEEDED, "s3.output.bucket": "hdfs://h/x/"}).archive_path("dsp") == "hdfs://h/x/ad-events/dsp"

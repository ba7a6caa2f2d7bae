"""Job settings.

Keys are those of a properties file. Precedence: overrides (command line) over the file when one is
given, else over ``spark.adpulse.*`` entries of the Spark configuration.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from typing import Any

_PREFIX = "spark.adpulse."
_JOB_KEYS = ("config", "side")  # command line only


def _setting(key: str, default: Any = None, required: bool = False, kind: type = str) -> Any:
    return field(default=default, metadata={"key": key, "required": required, "kind": kind})


@dataclass(frozen=True)
class Settings:
    """All settings with their defaults; brokers and output bucket are required.

    Checkpoint keys may be written with or without a ``flink.`` prefix. Keys that have no meaning
    here (auto commit, the checkpoint switch, timeout and pause, sink parallelism, storage region, metrics
    reporter) are accepted and ignored, so an existing file can be used as it is.
    """

    # Kafka
    bootstrap_servers: str = _setting("kafka.bootstrap.servers", required=True)
    group_id: str = _setting("kafka.group.id", "adpulse")
    starting_offsets: str = _setting("kafka.auto.offset.reset", "latest")
    ssl_enabled: bool = _setting("kafka.ssl.enabled", False, kind=bool)
    sasl_mechanism: str = _setting("kafka.sasl.mechanism", "PLAIN")
    max_offsets_per_trigger: int | None = _setting("kafka.max-offsets-per-trigger", None, kind=int)

    # topics
    ssp_source_topic: str = _setting("kafka.topic.ssp.source", "ad-events-ssp")
    dsp_source_topic: str = _setting("kafka.topic.dsp.source", "ad-events-dsp")
    ssp_metrics_topic: str = _setting("kafka.topic.ssp.aggregated", "ad-metrics-ssp")
    dsp_metrics_topic: str = _setting("kafka.topic.dsp.aggregated", "ad-metrics-dsp")
    dead_letter_topic: str = _setting("kafka.topic.dead-letter", "ad-events-dlq")

    # archive
    output_bucket: str = _setting("s3.output.bucket", required=True)
    output_prefix: str = _setting("s3.output.prefix", "ad-events")
    output_scheme: str = _setting("s3.output.scheme", "s3a")
    partition_by: str = _setting("archive.partition-by", "event")
    row_group_size: int = _setting("parquet.row-group-size", 134_217_728, kind=int)
    page_size: int = _setting("parquet.page-size", 1_048_576, kind=int)

    # checkpoints
    checkpoint_interval_ms: int = _setting("checkpoint.interval-ms", 60_000, kind=int)
    checkpoint_path: str | None = _setting("checkpoint.storage-path", None)

    # windows
    tumbling_size_ms: int = _setting("window.tumbling.size-ms", 60_000, kind=int)
    sliding_size_ms: int = _setting("window.sliding.size-ms", 300_000, kind=int)
    sliding_slide_ms: int = _setting("window.sliding.slide-ms", 60_000, kind=int)
    allowed_lateness_ms: int = _setting("window.allowed-lateness-ms", 30_000, kind=int)

    # parallelism; unset leaves the choice to Spark
    default_parallelism: int | None = _setting("parallelism.default", None, kind=int)
    source_parallelism: int | None = _setting("parallelism.source", None, kind=int)

    job_mode: str = _setting("job.mode", "all")

    @classmethod
    def from_mapping(
        cls, base: Mapping[str, str] | None = None, overrides: Mapping[str, str] | None = None
    ) -> Settings:
        """Build settings from text values; ``overrides`` win over ``base``."""
        merged = {}
        for source in (base or {}, overrides or {}):
            merged.update({key.removeprefix("flink."): value for key, value in source.items()})
        values: dict[str, Any] = {}
        for f in fields(cls):
            key, kind = f.metadata["key"], f.metadata["kind"]
            if key in merged:
                values[f.name] = _parse(key, merged[key], kind)
            elif f.metadata["required"]:
                raise ValueError(f"setting {key} is required")
        return cls(**values)

    @classmethod
    def from_args(cls, args: list[str], spark_conf: Mapping[str, str] | None = None) -> Settings:
        """Settings from ``--key value`` arguments, with ``--config FILE`` or the Spark configuration."""
        overrides = parse_args(args)
        if "config" in overrides:
            base = read_properties(overrides["config"])
        else:
            base = {k.removeprefix(_PREFIX): v for k, v in (spark_conf or {}).items() if k.startswith(_PREFIX)}
        return cls.from_mapping(base, {k: v for k, v in overrides.items() if k not in _JOB_KEYS})

    def kafka_options(self) -> dict[str, str]:
        """Connection options shared by readers and writers."""
        options = {"kafka.bootstrap.servers": self.bootstrap_servers}
        if self.ssl_enabled:
            options["kafka.security.protocol"] = "SASL_SSL"
            options["kafka.sasl.mechanism"] = self.sasl_mechanism
        return options

    def parquet_options(self) -> dict[str, str]:
        return {"parquet.block.size": str(self.row_group_size), "parquet.page.size": str(self.page_size)}

    @property
    def output_root(self) -> str:
        """Root folder of the archive; a bucket given as a full path or URL is taken as it is."""
        bucket = self.output_bucket.rstrip("/")
        base = bucket if "://" in bucket or bucket.startswith("/") else f"{self.output_scheme}://{bucket}"
        return f"{base}/{self.output_prefix}"

    def archive_path(self, side: str) -> str:
        return f"{self.output_root}/{side}"

    def metrics_topic(self, side: str) -> str:
        return {"ssp": self.ssp_metrics_topic, "dsp": self.dsp_metrics_topic}[side]

    @property
    def watermark_delay_ms(self) -> int:
        """Out-of-orderness bound plus allowed lateness, both set by the one lateness setting."""
        return 2 * self.allowed_lateness_ms


def _parse(key: str, value: Any, kind: type) -> Any:
    if not isinstance(value, str):
        return value
    if kind is bool:
        return value.strip().lower() == "true"
    if kind is int:
        try:
            return int(value)
        except ValueError:
            raise ValueError(f"setting {key} must be a whole number, not {value!r}") from None
    return value


def parse_args(args: list[str]) -> dict[str, str]:
    """``--key value`` or ``-key value`` pairs; a key without a value is ``true``."""
    out: dict[str, str] = {}
    key = None
    for arg in args:
        name = arg.lstrip("-")
        is_key = arg.startswith("-") and not name.replace(".", "", 1).isdigit()
        if is_key:
            key = name
            out[key] = "true"
        elif key is None:
            raise ValueError(f"expected --key before {arg!r}")
        else:
            out[key] = arg
            key = None
    return out


def read_properties(path: str) -> dict[str, str]:
    """A ``key=value`` properties file; blank lines and lines starting with ``#`` or ``!`` are skipped."""
    out = {}
    with open(path, encoding="utf-8") as lines:
        for line in lines:
            text = line.strip()
            if text and text[0] not in "#!":
                ends = [i for i in (text.find("="), text.find(":")) if i >= 0]
                cut = min(ends) if ends else len(text)
                out[text[:cut].strip()] = text[cut + 1:].strip()
    return out

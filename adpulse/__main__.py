"""Run a job: ``spark-submit ... -m adpulse --side ssp --kafka.bootstrap.servers HOST --s3.output.bucket B``."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from .config import Settings, parse_args
from .streaming import start


def main(args: list[str]) -> None:
    spark = SparkSession.builder.appName("adpulse").getOrCreate()
    settings = Settings.from_args(args, dict(spark.sparkContext.getConf().getAll()))
    start(spark, parse_args(args).get("side", ""), settings)
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main(sys.argv[1:])

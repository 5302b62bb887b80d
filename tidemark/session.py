"""A session with what the operators assume: UTC, ANSI, adaptive plans."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """On a cluster leave master and shuffle_partitions to spark-submit; adaptive execution fits partitions to the data."""
    b = SparkSession.builder.appName("tidemark")
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    } | ({"spark.sql.shuffle.partitions": str(shuffle_partitions)} if shuffle_partitions else {})
    for k, v in (settings | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()

"""The session the tests and the benchmark run on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution and skew handling stated.

    On a cluster leave ``master`` out and give the rest through spark-submit;
    ``spark.checkpoint.dir`` must name a folder that every executor can reach.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName("millrace")
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

"""Spark session settings shared by jobs, tests and the bench."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that change results or keep the driver safe; set once per session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}
STATIC_CONF = {
    "spark.driver.maxResultSize": "3g",
    "spark.scheduler.mode": "FAIR",
}


def open_session(app: str = "headway", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**STATIC_CONF, **RUNTIME_CONF}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created.

    Service dates are session-zone dates, so the zone is part of the result.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark

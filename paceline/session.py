"""Session defaults for batch and streaming jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults; ``conf`` overrides them (underscores for dots)."""
    builder = SparkSession.builder.appName("paceline")
    if master:
        builder = builder.master(master)
    for k, v in (DEFAULTS | {k.replace("_", "."): v for k, v in conf.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()

"""Session settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# caseSensitive: keys of records differ by case; lineSep and JSON options are set by the sources.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.caseSensitive": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build(app: str = "siltstone", master: str | None = None, **settings: str) -> SparkSession:
    """A session with SETTINGS; further settings override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

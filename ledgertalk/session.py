"""Spark session with the settings the operators count on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Hot join keys are split over tasks even where that costs one more shuffle.
AGAINST_SKEW = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
SETTINGS = {
    **AGAINST_SKEW,
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Spark itself checks a side against this size before it broadcasts.
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    # Files are compressed; rows in memory are several times as large.
    "spark.sql.sources.fileCompressionFactor": "5.0",
    # Recording the Python call site of every column expression triples the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def tuned(spark: SparkSession) -> SparkSession:
    """An existing session with the settings against hot keys."""
    for name, value in AGAINST_SKEW.items():
        spark.conf.set(name, value)
    return spark


def session(app: str, settings: Mapping[str, str] | None = None) -> SparkSession:
    """Master, memory and ``spark.sql.shuffle.partitions`` belong to the submit command."""
    builder = SparkSession.builder.appName(app)
    for name, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()

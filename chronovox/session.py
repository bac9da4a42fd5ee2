"""A Spark session with the settings that these plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: AQE joins skewed keys in parts and coalesces small partitions; times are UTC.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "chronovox", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **{k.replace("_", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

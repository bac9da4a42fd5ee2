"""Seeded synthetic scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scans(spark: SparkSession, number: int, shape: tuple[int, int, int] = (6, 6, 6), frames: int = 15, priors: int = 2, seed: int = 0) -> DataFrame:
    """Scans of a bright ball plus prior maps times noise traces plus noise; the same for the same seed."""
    nx, ny, nz = shape
    n = nx * ny * nz
    rows = spark.range(number * frames * n)
    v = F.col("id") % n
    t = (F.floor(F.col("id") / n) % frames).cast("int")
    s = F.floor(F.col("id") / (n * frames))
    out = rows.select(F.concat(F.lit("sub-"), s).alias("scan_id"), t.alias("t"), v.alias("voxel_id"), (v % nx).cast("int").alias("x"), (F.floor(v / nx) % ny).cast("int").alias("y"), F.floor(v / (nx * ny)).cast("int").alias("z"))
    noise = lambda *c: F.pmod(F.xxhash64(*c, F.lit(seed)), F.lit(2_000_001)) / 1_000_000.0 - 1.0  # noqa: E731  uniform
    r2 = sum(((F.col(a) - (m - 1) / 2.0) / (m / 2.0)) * ((F.col(a) - (m - 1) / 2.0) / (m / 2.0)) for a, m in zip("xyz", shape))
    value = F.exp(-r2) * 100
    for p in range(priors):
        value = value + noise(F.col("voxel_id"), F.lit(p)) * noise(F.col("scan_id"), F.col("t"), F.lit(p))
    return out.withColumn("value", value + noise(F.col("scan_id"), F.col("t"), F.col("voxel_id")))

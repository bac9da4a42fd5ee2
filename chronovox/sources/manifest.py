"""Scan manifests: discovery, selection and look-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.options import ENTITIES, entity, stem


def from_paths(paths: DataFrame) -> DataFrame:
    """Entities of image files from their names; a file without a subject raises when read."""
    kept = paths.where(F.col("path").rlike(r"\.nii(\.gz)?$"))
    suffix = F.regexp_extract(F.col("path"), r"_([A-Za-z0-9]+)\.nii", 1)
    out = kept.select(stem("path").alias("scan_id"), *[entity("path", e).alias(e) for e in ENTITIES], suffix.alias("suffix"), "path")
    return out.withColumn("subject", F.coalesce("subject", F.raise_error(F.concat(F.lit("no subject in "), "path")).cast("string")))


def filtered(manifest: DataFrame, wanted: dict) -> DataFrame:
    """Rows whose entities are among the wanted values (one or a list)."""
    for key, value in wanted.items():
        manifest = manifest.where(F.col(key).isin(value if isinstance(value, list) else [value]))
    return manifest


def lookup(manifest: DataFrame, wanted: dict) -> str:
    """The one path with these entities; raises for none or several."""
    rows = filtered(manifest, wanted).select("path").limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"{'no' if not rows else 'more than one'} file for {wanted}")
    return rows[0]["path"]


def run_iterator(manifest: DataFrame) -> DataFrame:
    """Per subject and session, its runs in order (null for none)."""
    return manifest.groupBy("subject", "session").agg(F.count("*").alias("n_runs"), F.array_sort(F.collect_set(F.coalesce("run", F.lit("")))).alias("runs"))

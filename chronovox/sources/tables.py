"""Text and Parquet sources, and the sinks of every stage."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared


def read_csv(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, sep=sep)


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """One name per line, with its place; blank lines are skipped."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("ord", "name"))
    return lines.select("ord", F.trim("name").alias("name")).where("name <> ''")


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """row, col, value of a file of numbers between white space."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != "")).alias("row", "line"))
    return lines.select("row", F.posexplode(F.split(F.trim("line"), r"\s+")).alias("col", "v")).select("row", "col", F.col("v").cast("double").alias("value"))


def write_stage(df: DataFrame, folder: str, *by: str) -> None:
    df.write.mode("overwrite").partitionBy(*by).parquet(folder) if by else df.write.mode("overwrite").parquet(folder)


def read_stage(spark: SparkSession, folder: str, schema=None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(folder)


def write_csv(df: DataFrame, folder: str, sep: str = ",") -> None:
    df.write.mode("overwrite").csv(folder, header=True, sep=sep)


def write_frame_mask(mask: DataFrame, folder: str) -> None:
    """One column of booleans per scan; false frames are masked."""
    out = mask.select("scan_id", "t", F.col("keep").alias("False = Masked Frames"))
    out.repartition("scan_id").sortWithinPartitions("scan_id", "t").drop("t").write.mode("overwrite").partitionBy("scan_id").csv(folder, header=True)


def write_options(spark: SparkSession, options: dict, folder: str) -> None:
    """A stage's options as JSON, where the next stage finds them."""
    spark.createDataFrame([(json.dumps(options, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(folder)


def read_options(spark: SparkSession, folder: str) -> dict:
    return json.loads(spark.read.text(folder).first()["value"])


def write_outputs(outputs: dict[str, DataFrame], folder: str) -> None:
    """A stage's named outputs, one Parquet folder each."""
    for name, df in outputs.items():
        write_stage(df, f"{folder}/{name}")


def write_component_report(classified: DataFrame, folder: str) -> None:
    """Three texts: scores, numbers of the noise components (from 1), and an overview with headings.

    ``classified`` has a row per component (comp from 0, max_rp_corr,
    edge_fraction, hfc, csf_fraction, noise), few enough for one file.
    """
    scores = ["max_rp_corr", "edge_fraction", "hfc", "csf_fraction"]
    classified = shared.written(classified, "components")
    rows = classified.repartition(1).sortWithinPartitions("comp")
    rows.select(F.concat_ws(" ", *[F.format_string("%.18e", c) for c in scores])).write.mode("overwrite").text(f"{folder}/feature_scores")
    numbers = F.array_sort(F.collect_list(F.when(F.col("noise"), F.col("comp") + 1)))
    classified.agg(F.array_join(numbers.cast("array<string>"), ",")).write.mode("overwrite").text(f"{folder}/classified_motion_ICs")
    headings = ["maximum RP correlation", "Edge-fraction", "High-frequency content", "CSF-fraction"]
    overview = rows.select((F.col("comp") + 1).alias("IC"), F.when(F.col("noise"), "True").otherwise("False").alias("Motion/noise"), *[F.format_string("%.2f", c).alias(h) for c, h in zip(scores, headings)])
    write_csv(overview, f"{folder}/classification_overview", "\t")


def read_component_overview(spark: SparkSession, folder: str) -> DataFrame:
    """ic, noise, max_rp_corr, edge_fraction, hfc, csf_fraction."""
    return read_csv(spark, f"{folder}/classification_overview", "ic int, noise boolean, max_rp_corr double, edge_fraction double, hfc double, csf_fraction double", "\t")


def boilerplate(options: dict) -> str:
    """A paragraph of methods for the chosen options."""
    said = []
    if options.get("fd_threshold") is not None:
        said.append(f"Frames were censored where framewise displacement reached {options['fd_threshold']} mm, with one frame before and two after.")
    if options.get("use_dvars"):
        said.append("Frames with outlying DVARS values (2.5 standard deviations, iterated) were censored.")
    said.append({0: "Means were removed.", 1: "Linear trends were removed."}.get(options.get("order", 1), f"Polynomial trends of order {options.get('order')} were removed."))
    if options.get("high_pass") or options.get("low_pass"):
        said.append(f"Censored frames were simulated and a zero-phase third-order Butterworth filter was applied (high pass {options.get('high_pass')}, low pass {options.get('low_pass')} Hz).")
    if options.get("regressors"):
        said.append(f"Nuisance regressors were fitted by least squares and removed: {', '.join(options['regressors'])}.")
    if options.get("scaling"):
        said.append(f"Values were scaled ({options['scaling']}).")
    if options.get("fwhm"):
        said.append(f"Images were smoothed with a Gaussian of {options['fwhm']} mm full width at half maximum.")
    return " ".join(said)

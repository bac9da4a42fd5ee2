"""Views of the given tables as scans, written twice: as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import shared_dir as work_dir  # noqa: F401  for the queries



def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def emb(spark, d) -> DataFrame:
    """One scan: a voxel per vector, a frame per component."""
    e = table(spark, d, "embeddings")
    return e.select(F.lit("emb").alias("scan_id"), F.col("vec_id").alias("voxel_id"), "label", F.posexplode("embedding").alias("t", "value")).withColumn("value", F.col("value").cast("double"))


def emb_series(spark, d) -> DataFrame:
    e = table(spark, d, "embeddings")
    return e.select(F.lit("emb").alias("scan_id"), F.col("vec_id").alias("voxel_id"), F.transform("embedding", lambda x, i: i).alias("t"), F.col("embedding").cast("array<double>").alias("v"))


def bold(spark, d) -> DataFrame:
    return emb(spark, d).drop("label")


def atlas(spark, d) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("voxel_id"), "label")


def grid(spark, d) -> DataFrame:
    v = F.col("vec_id")
    return table(spark, d, "embeddings").select(v.alias("voxel_id"), (v % 10).cast("int").alias("x"), (F.floor(v / 10) % 10).cast("int").alias("y"), F.floor(v / 100).cast("int").alias("z"))


def cubes(spark, d) -> DataFrame:
    """scan_id, t, x, y, z, label, value: a scan of 5 x 5 x 5 voxels for every 125 vectors, a frame per component."""
    v = F.col("vec_id")
    at = [v % 5, F.floor(v / 5) % 5, F.floor(v / 25) % 5]
    e = table(spark, d, "embeddings").select(F.concat(F.lit("c"), F.floor(v / 125).cast("string")).alias("scan_id"), *[a.cast("int").alias(c) for a, c in zip(at, "xyz")], "label", F.posexplode("embedding").alias("t", "value"))
    return e.withColumn("value", F.col("value").cast("double"))


#: The grid of the view ``texture``: 500 vectors of 64 components are one volume.
TEXTURE = (40, 40, 20)


def texture(spark, d) -> DataFrame:
    """scan_id, x, y, z, value: a volume for every 500 vectors, each vector an 8 x 8 tile of a slice."""
    v = F.col("vec_id")
    e = table(spark, d, "embeddings").select(v, F.posexplode("embedding").alias("c", "value"))
    at = [(v % 5) * 8 + F.col("c") % 8, F.floor(v / 5) % 5 * 8 + F.floor(F.col("c") / 8), F.floor(v / 25) % 20]
    return e.select(F.concat(F.lit("v"), F.floor(v / 500).cast("string")).alias("scan_id"), *[a.cast("int").alias(c) for a, c in zip(at, "xyz")], F.col("value").cast("double").alias("value"))


#: Fixed value: labels that stand for tissues.
TISSUES = {1: "WM_signal", 2: "CSF_signal", 3: "vascular_signal"}


def tissues(spark, d) -> DataFrame:
    a = atlas(spark, d)
    name = F.when(F.col("label") == 1, "WM_signal").when(F.col("label") == 2, "CSF_signal").otherwise("vascular_signal")
    return a.where(F.col("label").isin(1, 2, 3)).select(name.alias("mask_name"), "voxel_id")


def label_mask(spark, d, *labels: int) -> DataFrame:
    return atlas(spark, d).where(F.col("label").isin(*labels)).select("voxel_id")


def quarter() -> F.Column:
    return ((F.year("l_shipdate") - 1995) * 4 + F.quarter("l_shipdate") - 1).cast("int")


def line_frames(spark, d) -> int:
    return table(spark, d, "lineitem").agg(F.max(quarter())).first()[0] + 1


def line(spark, d) -> DataFrame:
    """Six scans on a full grid: a voxel for every supplier that occurs, a frame for every quarter up to the last; cells without rows are 0."""
    li = table(spark, d, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("scan_id"), F.col("l_suppkey").alias("voxel_id"), quarter().alias("t"), "l_extendedprice")
    own = li.groupBy("scan_id", "voxel_id", "t").agg(F.avg("l_extendedprice").alias("value"))
    known = li.agg(F.max("t").alias("last"), F.array_sort(F.collect_set("scan_id")).alias("scans")).first()
    frames = F.explode(F.sequence(F.lit(0), F.lit(known["last"]))).alias("t")
    # each voxel of each scan, from one pass over the pairs that occur: those of any scan belong to all
    scans = F.array(*map(F.lit, known["scans"]))  # combinations of two flags
    cells = li.select("voxel_id").distinct().select("voxel_id", F.explode(scans).alias("scan_id")).select("scan_id", "voxel_id", frames)
    return cells.join(own, ["scan_id", "voxel_id", "t"], "left").select("scan_id", "t", "voxel_id", F.coalesce("value", F.lit(0.0)).alias("value"))


def motion(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem").withColumn("t", quarter())
    price = F.col("l_extendedprice")
    return li.groupBy(F.concat("l_returnflag", "l_linestatus").alias("scan_id"), "t").agg(
        F.avg("l_quantity").alias("mov1"), F.avg("l_discount").alias("mov2"), F.avg("l_tax").alias("mov3"),
        F.avg("l_linenumber").alias("rot1"), F.avg(price * F.col("l_discount") / 1e4).alias("rot2"), F.avg(price * F.col("l_tax") / 1e4).alias("rot3"),
    )


def traces(spark, d) -> DataFrame:
    """One trace per event type, in steps of six hours."""
    e = table(spark, d, "events")
    t = F.datediff("ts", F.lit("2024-01-01")) * 4 + F.floor(F.hour("ts") / 6)
    return e.groupBy(F.col("event_type").alias("scan_id"), t.cast("int").alias("t")).agg(F.avg("value").alias("fd"))


def manifest(spark, d) -> DataFrame:
    """A scan per order: subject from the customer, session from the priority, run from the order."""
    o = table(spark, d, "orders")
    subject, session, run = F.col("o_custkey").cast("string"), F.substring("o_orderpriority", 1, 1), F.col("o_orderkey").cast("string")
    name = F.concat(F.lit("sub-"), subject, F.lit("_ses-"), session, F.lit("_run-"), run, F.lit("_task-rest_bold"))
    return o.select(name.alias("scan_id"), subject.alias("subject"), session.alias("session"), run.alias("run"), F.concat(F.lit("data/sub-"), subject, F.lit("/func/"), name, F.lit(".nii.gz")).alias("path"))


SQL = {
    "emb": "SELECT 'emb' AS scan_id, vec_id AS voxel_id, label, unnest(range(len(embedding)))::INT AS t, unnest(embedding)::DOUBLE AS value FROM embeddings",
    "cubes": "SELECT 'c' || vec_id // 125 AS scan_id, (vec_id % 5)::INT AS x, (vec_id // 5 % 5)::INT AS y, (vec_id // 25 % 5)::INT AS z, label, unnest(range(len(embedding)))::INT AS t, unnest(embedding)::DOUBLE AS value FROM embeddings",
    "grid": "SELECT vec_id AS voxel_id, (vec_id % 10)::INT AS x, ((vec_id // 10) % 10)::INT AS y, (vec_id // 100)::INT AS z FROM embeddings",
    "atlas": "SELECT vec_id AS voxel_id, label FROM embeddings",
    "tissues": "SELECT CASE label WHEN 1 THEN 'WM_signal' WHEN 2 THEN 'CSF_signal' ELSE 'vascular_signal' END AS mask_name, vec_id AS voxel_id FROM embeddings WHERE label IN (1, 2, 3)",
    "cells": f"SELECT l_returnflag || l_linestatus AS scan_id, l_suppkey AS voxel_id, ((year(l_shipdate) - 1995) * 4 + quarter(l_shipdate) - 1)::INT AS t, l_extendedprice, l_discount, l_tax, l_quantity, l_linenumber FROM lineitem",
    "line": f"""SELECT scan_id, t, voxel_id, coalesce(value, 0.0) AS value
        FROM (SELECT DISTINCT scan_id FROM cells) CROSS JOIN (SELECT DISTINCT voxel_id FROM cells) CROSS JOIN (SELECT unnest(range((SELECT max(t) + 1 FROM cells)))::INT AS t)
        LEFT JOIN (SELECT scan_id, voxel_id, t, avg(l_extendedprice) AS value FROM cells GROUP BY ALL) USING (scan_id, voxel_id, t)""",
    "motion": f"""SELECT scan_id, t, avg(l_quantity) AS mov1, avg(l_discount) AS mov2, avg(l_tax) AS mov3, avg(l_linenumber) AS rot1,
        avg(l_extendedprice * l_discount / 1e4) AS rot2, avg(l_extendedprice * l_tax / 1e4) AS rot3 FROM cells GROUP BY ALL""",
    "traces": "SELECT event_type AS scan_id, (date_diff('day', DATE '2024-01-01', ts::DATE) * 4 + hour(ts) // 6)::INT AS t, avg(value) AS fd FROM events GROUP BY ALL",
    "manifest": """SELECT concat('sub-', o_custkey, '_ses-', o_orderpriority[1], '_run-', o_orderkey, '_task-rest_bold') AS scan_id, o_custkey::VARCHAR AS subject,
        o_orderpriority[1] AS session, o_orderkey::VARCHAR AS run FROM orders""",
}
NEEDS = {"line": ["cells"], "motion": ["cells"]}


def with_views(body: str, *more: tuple[str, str]) -> str:
    """The query after the views that it names."""
    texts = " ".join([body, *(t for _, t in more)])
    wanted: list[str] = []

    def add(name):
        for n in NEEDS.get(name, []):
            add(n)
        if name not in wanted:
            wanted.append(name)

    import re

    for name in SQL:
        if re.search(rf"\b{name}\b", texts):
            add(name)
    parts = [*((n, SQL[n]) for n in wanted), *more]
    return ("WITH " + ",\n".join(f"{n} AS ({t})" for n, t in parts) + "\n" if parts else "") + body

"""Quality control of scans and of data sets."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.guards import finite_or_zero, pearson, ratio, zero_if_null
from ..kernels import spatial, spectral
from ..sources.shared import dropped, written
from . import aggregates, frames, series

#: Rows of a block in sums over points.
BLOCK = 4096


def outliers(frame: DataFrame, column: str, threshold: float = 3.5, *keys: str) -> DataFrame:
    """Adds ``outlier``: abs of the modified z score over the threshold; null where the median deviation is 0."""
    keyed = frame if keys else frame.withColumn("__all", F.lit(1))
    by = list(keys) or ["__all"]
    center = keyed.groupBy(*by).agg(F.median(column).alias("__m"))
    spread = keyed.join(center, by).groupBy(*by).agg(F.median(F.abs(F.col(column) - F.col("__m"))).alias("__d"))
    z = F.abs(ratio((F.col(column) - F.col("__m")) * 0.6745, "__d"))
    return keyed.join(center, by).join(spread, by).withColumn("outlier", z > threshold).select(*frame.columns, "outlier")


def passing(scans: DataFrame, least_dice: float | None = None, most_conf: float | None = None, use_amplitude: bool = False, threshold: float = 3.5) -> DataFrame:
    """Adds ``included``. Amplitude outliers are taken out in turns until there are none, as each turn changes the distribution; the table has a row per scan."""
    ok = F.lit(True)
    if least_dice is not None:
        ok = ok & (F.col("dice") > least_dice)
    if most_conf is not None:
        ok = ok & (F.col("conf_corr") < most_conf)
    out = scans.withColumn("included", ok)
    if not use_amplitude:
        return out
    out = written(out, "included-scans")
    while True:
        bad = outliers(out.where("included"), "amplitude", threshold).where("outlier").select("scan_id", F.lit(True).alias("__bad"))
        new = written(out.join(bad, "scan_id", "left").withColumn("included", F.col("included") & F.col("__bad").isNull()).select(out.columns), "included-scans")
        same = new.where("included").count() == out.where("included").count()
        dropped(out)
        out = new
        if same:
            return out


def threshold_of(thresholds: dict, network: int) -> dict:
    """The numbers of one network from lists by network; None without any."""
    out = {}
    for name in ("Dice", "Conf"):
        values = thresholds.get(name) or []
        if values and not 0 <= network < len(values):
            raise ValueError(f"{len(values)} {name} thresholds; there is none for network {network}")
        out[name] = values[network] if values else None
    return out | {"Amp": bool(thresholds.get("Amp", False))}


def enough_scans(scans: DataFrame, least: int = 3) -> int:
    n = scans.count()
    if n < least:
        raise ValueError(f"{n} scans; the report takes {least}")
    return n


def covariates(scans: DataFrame) -> list[str]:
    """Columns to correlate maps with: tdof only if it varies."""
    varies = scans.agg(F.count_distinct("tdof").alias("n")).first()["n"] > 1
    return ["cr_sd", "mean_fd", *(["tdof"] if varies else [])]


def scan_report(scans: DataFrame, features: list[str], threshold: float = 3.5) -> DataFrame:
    """Every feature with an outlier flag among included scans; null for the others."""
    out = scans
    for f in features:
        flagged = outliers(scans.where("included").select("scan_id", f), f, threshold).select("scan_id", F.col("outlier").alias(f"{f}_outlier"))
        out = out.join(flagged, "scan_id", "left")
    return out


def group_maps(maps: DataFrame, prior: DataFrame, covariate: DataFrame, rank: bool = False) -> DataFrame:
    """Long (name, voxel_id, value): prior, average, variability and correlation with the covariate."""
    if rank:
        m = aggregates.median_mad(maps).select("voxel_id", F.col("median").alias("average"), F.col("mad").alias("variability"))
    else:
        m = aggregates.mean_std(maps).select("voxel_id", F.col("mean").alias("average"), F.col("std").alias("variability"))
    r = aggregates.correlation_across(maps, covariate, rank).select("voxel_id", F.col("r").alias("covariate"))
    wide = prior.select("voxel_id", F.col("value").alias("prior")).join(m, "voxel_id").join(r, "voxel_id")
    return wide.unpivot("voxel_id", ["prior", "average", "variability", "covariate"], "name", "value").select("name", "voxel_id", "value")


def group_statistics(maps: DataFrame, percent: float = 10) -> DataFrame:
    """Per map: Dice of its strongest voxels with the prior's, and its mean inside the prior's (over the covariate maps)."""
    top = frames.top_percent(maps, percent, "name")
    core = top.where("name = 'prior'").select("voxel_id", F.col("top").alias("core"))
    both = top.where("name <> 'prior'").join(core, "voxel_id")
    overlap = aggregates.dice(both, "core", "top", "name")
    return overlap.join(both.groupBy("name").agg(F.avg(F.when(F.col("core"), F.col("value"))).alias("mean")), "name")


def network_dice(maps: DataFrame, prior: DataFrame, percent: float = 10) -> DataFrame:
    """Per scan, Dice of the strongest voxels of its map and of the prior."""
    core = frames.top_percent(prior.withColumn("__k", F.lit(1)), percent, "__k").select("voxel_id", F.col("top").alias("core"))
    return aggregates.dice(frames.top_percent(maps, percent, "scan_id").join(core, "voxel_id"), "core", "top", "scan_id")


def scan_features(bold: DataFrame, masks: DataFrame) -> dict[str, DataFrame]:
    """Global and tissue traces, and each voxel's covariance and correlation with the global signal."""
    signal = aggregates.global_signal(bold).withColumnRenamed("value", "trace")
    return {
        "global": signal,
        "traces": aggregates.mask_traces(bold, masks),
        "covariance": aggregates.signal_covariance(bold, signal),
        "correlation": aggregates.correlation_with(bold, signal),
    }


def power_spectrum(data: DataFrame, tr: float) -> DataFrame:
    """Mean and deviation over voxels of the power at each frequency (Welch, window of a quarter of the frames or 130)."""

    def power(y):
        return spectral.welch(y, 1 / tr, max(len(y) // 4, 130))[1]

    per = series.per_voxel(data, power, "power array<double>")
    n = F.least(F.greatest(F.floor(F.size("v") / 4), F.lit(130)), F.size("v"))
    cell = per.select("scan_id", n.alias("n"), F.posexplode("power").alias("i", "p"))
    return cell.groupBy("scan_id", (F.col("i") / (F.col("n") * tr)).alias("frequency")).agg(F.avg("p").alias("mean"), F.stddev_pop("p").alias("std"))


def carpet(bold: DataFrame, frame_mask: DataFrame) -> DataFrame:
    """All frames, with null values at those not kept."""
    return bold.join(frame_mask, ["scan_id", "t"]).select("scan_id", "t", "voxel_id", F.when(F.col("keep"), F.col("value")).alias("value"))


def bounds(frame: DataFrame, column: str, edge: float = 1.5) -> DataFrame:
    """Plot limits: the range stretched about its centre."""
    half = (F.max(column) - F.min(column)) / 2
    centre = F.min(column) + half
    return frame.agg((centre - half * edge).alias("low"), (centre + half * edge).alias("high"))


def density(frame: DataFrame, column: str, points: int = 50) -> DataFrame:
    """Gaussian kernel density at evenly spaced points, by Scott's bandwidth; tasks sum their own rows over the points, in blocks."""
    schema = "x double, density double"
    own = frame.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    s = own.agg(F.count("v").alias("n"), F.min("v").alias("a"), F.max("v").alias("b"), F.stddev_samp("v").alias("s")).first()
    if not s["n"] or not s["s"]:
        return frame.sparkSession.createDataFrame([], schema)
    x, h = np.linspace(s["a"], s["b"], points), s["s"] * s["n"] ** (-1 / 5)
    size = s["n"] * h * np.sqrt(2 * np.pi)

    def sums(batches):
        import pandas as pd

        total = np.zeros(points)
        for batch in batches:
            v = batch["v"].to_numpy(float)
            for at in range(0, len(v), BLOCK):
                total += np.exp(-0.5 * ((x[:, None] - v[at : at + BLOCK]) / h) ** 2).sum(axis=1)
        yield pd.DataFrame({"x": x, "density": total / size})

    return own.mapInPandas(sums, schema).groupBy("x").agg(F.sum("density").alias("density"))


def density_2d(frame: DataFrame, x: str, y: str, points: int = 100, edge: float = 1.5, least: float = 0.2) -> DataFrame:
    """i, j, x, y, density: a Gaussian kernel density of two columns on a grid over their stretched ranges; null under ``least`` of the greatest.

    The kernel has the columns' sample covariance times n^(-1/3) (Scott).
    Tasks sum their own rows over the grid.  Rows with a null take no part; no
    density without a spread in both columns.
    """
    schema = "i int, j int, x double, y double, density double"
    both = frame.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    s = both.agg(F.count("*").alias("n"), *(f(c).alias(f"{n}{c}") for c in "xy" for n, f in (("min", F.min), ("max", F.max), ("var", F.var_samp))), F.covar_samp("x", "y").alias("cov")).first()
    if s["n"] < 2 or not s["varx"] * s["vary"] - s["cov"] ** 2 > 0:
        return frame.sparkSession.createDataFrame([], schema)
    cov = np.array([[s["varx"], s["cov"]], [s["cov"], s["vary"]]]) * s["n"] ** (-1 / 3)
    back, size = np.linalg.inv(cov), 2 * np.pi * np.sqrt(np.linalg.det(cov)) * s["n"]
    ends = [(s[f"min{c}"], s[f"max{c}"]) for c in "xy"]
    gx, gy = (np.linspace((a + b) / 2 - (b - a) / 2 * edge, (a + b) / 2 + (b - a) / 2 * edge, points) for a, b in ends)

    def sums(batches):
        import pandas as pd

        total = np.zeros((points, points))
        for batch in batches:
            p = batch.to_numpy(float)
            for at in range(0, len(p), max(1, BLOCK // points)):
                dx, dy = (g[:, None] - p[at : at + max(1, BLOCK // points), k] for k, g in enumerate((gx, gy)))
                total += np.exp(-0.5 * (back[0, 0] * dx[:, None] ** 2 + 2 * back[0, 1] * dx[:, None] * dy + back[1, 1] * dy**2)).sum(axis=2)
        i, j = np.indices(total.shape)
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "x": gx[i.ravel()], "y": gy[j.ravel()], "density": total.ravel() / size})

    cells = both.mapInPandas(sums, schema).groupBy("i", "j", "x", "y").agg(F.sum("density").alias("density"))
    top = written(cells, "density")
    most = top.agg(F.max("density")).first()[0]
    return top.withColumn("density", F.when(F.col("density") >= most * least, F.col("density")))


def motion_report(bold: DataFrame) -> dict[str, DataFrame]:
    """Temporal maps, distance of each frame to the reference, and its mean square error."""
    reference = aggregates.reference_map(bold)
    return {"maps": aggregates.temporal_maps(bold), "distance": aggregates.cosine_distance(bold, reference), "mse": aggregates.mse_to_reference(bold)}


def intensity_range(frame: DataFrame, column: str = "value", classes: int = 3, bins: int = 256) -> DataFrame:
    """Multi-Otsu thresholds of a map's histogram."""
    s = frame.agg(F.min(column).alias("a"), F.max(column).alias("b")).first()
    if s["a"] is None or s["a"] == s["b"]:
        return frame.sparkSession.createDataFrame([], "class int, threshold double")
    width = (s["b"] - s["a"]) / bins
    cell = F.least(F.floor((F.col(column) - s["a"]) / width), F.lit(bins - 1))
    counts = np.zeros(bins)
    for r in frame.groupBy(cell.alias("c")).count().collect():  # at most ``bins`` rows
        if r["c"] is not None:
            counts[int(r["c"])] = r["count"]
    cuts = spatial.otsu(counts, s["a"] + width * (np.arange(bins) + 0.5), classes)
    return frame.sparkSession.createDataFrame([(i, float(c)) for i, c in enumerate(cuts)], "class int, threshold double")


def seed_similarity(maps: DataFrame, other: DataFrame) -> DataFrame:
    """Per scan, the correlation over voxels of two maps, 0 where undefined."""
    both = maps.join(other.select("voxel_id", F.col("value").alias("x")), "voxel_id")
    return both.groupBy("scan_id").agg(zero_if_null(pearson(finite_or_zero("value"), "x")).alias("r"))

"""Features and classification of components as motion, and their removal."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.guards import ratio
from ..kernels import linear
from ..sources.shared import written
from . import frames, series

#: The classifier's plane and bounds.
PLANE = (-14.0, 9.95127547670627, 24.8333160239175)
MOST_CSF, MOST_HFC = 0.10, 0.60


def fractions(weights: DataFrame) -> DataFrame:
    """edge_fraction and csf_fraction from sums of absolute weights (comp, total, edge, csf, outside)."""
    rest = F.col("total") - F.col("csf")
    edge = F.when(F.col("total") == 0, 0.0).when(rest == 0, 1.0).otherwise(ratio(F.col("outside") + F.col("edge"), rest))
    csf = F.when(F.col("total") == 0, 0.0).when(rest == 0, 1.0).otherwise(ratio("csf", "total"))
    return weights.select("comp", edge.alias("edge_fraction"), csf.alias("csf_fraction"))


def high_frequency_content(power: DataFrame, tr: float, least: float = 0.01) -> DataFrame:
    """Per component (comp, frequency, power): where half its power above ``least`` Hz lies, from 0 there to 1 at Nyquist."""
    nyquist = 1 / (2 * tr)
    use = power.where(F.col("frequency") > least)
    upto = F.sum("power").over(Window.partitionBy("comp").orderBy("frequency").rowsBetween(Window.unboundedPreceding, 0))
    share = ratio(upto, F.sum("power").over(Window.partitionBy("comp")))
    near = use.select("comp", "frequency", F.abs(share - 0.5).alias("d"))
    at = near.groupBy("comp").agg(F.min(F.struct("d", "frequency"))["frequency"].alias("f"))
    return at.select("comp", ((F.col("f") - least) / (nyquist - least)).alias("hfc"))


def classified(features: DataFrame) -> DataFrame:
    """Adds ``noise``."""
    b, r, e = PLANE
    motion = F.lit(b) + r * F.col("max_rp_corr") + e * F.col("edge_fraction") > 0
    return features.withColumn("noise", motion | (F.col("csf_fraction") > MOST_CSF) | (F.col("hfc") > MOST_HFC))


def motion_model(motion: DataFrame) -> DataFrame:
    """Six parameters and their changes, each also a frame earlier and later: 36 columns beside scan_id and t."""
    base = ["mov1", "mov2", "mov3", "rot1", "rot2", "rot3"]
    out = motion.select("scan_id", "t", *[F.col(c) for c in base], *[frames.derivative(c, "scan_id").alias(f"{c}_der") for c in base])
    twelve = [*base, *(f"{c}_der" for c in base)]
    return out.select("*", *[frames.shifted(c, 1, "scan_id").alias(f"{c}_back") for c in twelve], *[frames.shifted(c, -1, "scan_id").alias(f"{c}_ahead") for c in twelve])


def max_motion_correlation(traces: DataFrame, model: DataFrame, splits: int = 1000, share: float = 0.9, seed: int = 0) -> DataFrame:
    """Mean over random subsets of frames of the greatest absolute correlation of a component with 72 motion columns (36 and their squares; the squares go with the squared component).

    Subsets follow a seed.  A group is one scan's traces and model.
    """
    columns = [c for c in model.columns if c not in ("scan_id", "t")]

    def one(pdf):
        import pandas as pd

        pdf = pdf.sort_values("t")
        x = pdf[columns].to_numpy(float)
        comps = [c for c in pdf.columns if c.startswith("c_")]
        y = pdf[comps].to_numpy(float)
        rng, total = np.random.default_rng(seed), np.zeros(len(comps))

        def corr(a, b):
            a, b = a - a.mean(axis=0), b - b.mean(axis=0)
            d = np.sqrt((a**2).sum(axis=0))[:, None] * np.sqrt((b**2).sum(axis=0))
            return np.abs(np.divide(a.T @ b, d, out=np.zeros_like(d), where=d > 0))

        n = int(round(share * len(pdf)))
        for _ in range(splits):
            pick = rng.permutation(len(pdf))[:n]
            a, b = y[pick], x[pick]
            total += np.concatenate([corr(a, b), corr(a**2, b**2)], axis=1).max(axis=1)
        return pd.DataFrame({"scan_id": pdf["scan_id"].iloc[0], "comp": [int(c[2:]) for c in comps], "max_rp_corr": total / splits})

    numbers = [r["comp"] for r in traces.select("comp").distinct().orderBy("comp").collect()]  # components of a decomposition
    wide = traces.groupBy("scan_id", "t").pivot("comp", numbers).agg(F.first("value"))
    wide = wide.select("scan_id", "t", *[F.col(str(n)).alias(f"c_{n}") for n in numbers])
    return series.per_scan(wide.join(model, ["scan_id", "t"]), one, "scan_id string, comp int, max_rp_corr double")


#: Bins of a standard deviation in the histograms of component maps, and rounds of the mixture's fit.
BINS_PER_DEVIATION, ROUNDS = 20, 500
MIXTURE = "scan_id string, comp int, mean double, deviation double, weights array<double>, centre double, spread double, up array<double>, down array<double>"


def mixture(counts: np.ndarray, centres: np.ndarray) -> dict:
    """A Gaussian and a Gamma to each side of 0, fitted by EM to a histogram of a standardised map.

    Gammas (shape, scale, logarithm of what they are divided by) are held at
    shapes of 1 or more; a side without values has weight 0.
    """
    from math import lgamma

    n = counts.sum()
    density = lambda x, g: np.where(x > 0, np.exp((g[0] - 1) * np.log(np.maximum(x, 1e-12)) - x / g[1] - norm(g)), 0.0)
    norm = lambda g: lgamma(g[0]) + g[0] * float(np.log(g[1]))
    gamma = lambda m, v: (max(1.0, m * m / v), min(m, v / m))  # noqa: E731  by moments
    order = np.cumsum(counts) / max(n, 1)
    low, high = (centres[min(len(centres) - 1, np.searchsorted(order, q))] for q in (0.25, 0.75))
    centre, spread = 0.5 * (low + high), max((high - low) / 1.349, 1 / BINS_PER_DEVIATION)
    weights, up, down = np.array([0.9, 0.05, 0.05]), gamma(3 * spread, spread**2), gamma(3 * spread, spread**2)
    for _ in range(ROUNDS):
        parts = weights[:, None] * np.stack([np.exp(-0.5 * ((centres - centre) / spread) ** 2) / (spread * np.sqrt(2 * np.pi)), density(centres, up), density(-centres, down)])
        share = counts * np.divide(parts, parts.sum(axis=0), out=np.zeros_like(parts), where=parts.sum(axis=0) > 0)
        before, total = weights, share.sum(axis=1)
        weights = total / max(total.sum(), 1e-300)
        if total[0] > 0:
            centre = (share[0] * centres).sum() / total[0]
            spread = max(np.sqrt((share[0] * (centres - centre) ** 2).sum() / total[0]), 1 / BINS_PER_DEVIATION)
        sides = []
        for k, (x, old) in enumerate(((centres, up), (-centres, down)), 1):
            m = (share[k] * x).sum() / total[k] if total[k] > 1e-9 * n else 0.0
            v = (share[k] * (x - m) ** 2).sum() / total[k] if m > 0 else 0.0
            sides.append(gamma(m, max(v, 1e-4)) if m > 0 else old)
        up, down = sides
        if np.abs(weights - before).max() < 1e-7:
            break
    return {"weights": weights.tolist(), "centre": float(centre), "spread": float(spread), "up": [*up, norm(up)], "down": [*down, norm(down)]}


def mixtures(maps: DataFrame) -> DataFrame:
    """Of each map (scan_id, comp, voxel_id, value): mean and deviation, and the mixture of its standardised values. Only histograms are gathered."""
    sizes = written(maps.groupBy("scan_id", "comp").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("deviation")), "map-sizes")
    place = F.floor(ratio(F.col("value") - F.col("mean"), F.col("deviation")) * BINS_PER_DEVIATION).cast("int")
    bins = maps.join(sizes, ["scan_id", "comp"]).where("deviation > 0").groupBy("scan_id", "comp", "mean", "deviation", place.alias("bin")).count()
    rows = bins.groupBy("scan_id", "comp", "mean", "deviation").agg(F.array_sort(F.collect_list(F.struct("bin", "count"))).alias("h"))

    def one(row):
        bins = np.array([h["bin"] for h in row["h"]])
        counts = np.zeros(bins.max() - bins.min() + 1)
        counts[bins - bins.min()] = [h["count"] for h in row["h"]]
        m = mixture(counts, (np.arange(bins.min(), bins.max() + 1) + 0.5) / BINS_PER_DEVIATION)
        yield row["scan_id"], row["comp"], row["mean"], row["deviation"], m["weights"], m["centre"], m["spread"], m["up"], m["down"]

    return series.per_row(rows, one, MIXTURE)


def active(maps: DataFrame, fitted: DataFrame, least: float = 0.5) -> DataFrame:
    """Maps with values standardised, and 0 where the Gammas together are less likely than ``least``; a flat map is 0 throughout."""
    z = ratio(F.col("value") - F.col("mean"), F.col("deviation"))
    both = maps.join(fitted, ["scan_id", "comp"], "left").withColumn("z", z)
    gauss = F.col("weights")[0] * F.exp(-0.5 * F.pow((F.col("z") - F.col("centre")) / F.col("spread"), 2)) / (F.col("spread") * np.sqrt(2 * np.pi))
    side = lambda k, x, g: F.when(x > 0, F.col("weights")[k] * F.exp((F.col(g)[0] - 1) * F.log(x) - x / F.col(g)[1] - F.col(g)[2])).otherwise(0.0)
    tails = F.when(F.col("z") > F.col("centre"), side(1, F.col("z"), "up")).otherwise(side(2, -F.col("z"), "down"))
    keep = F.coalesce(tails > least * (tails + gauss), F.lit(False))
    return both.select("scan_id", "comp", "voxel_id", F.when(keep, F.col("z")).otherwise(0.0).alias("value"))


def denoised(data: DataFrame, design: DataFrame, noise: list[int], aggressive: bool = False) -> DataFrame:
    """Series without the noise components' part of a fit of all components (aggressive: of the noise components alone)."""

    def fit(y, x):
        m = np.array(x, float).T
        part = m[:, noise]
        b = linear.solve(part, y) if aggressive else linear.solve(m, y)[noise]
        return y - part @ b

    out = series.per_voxel(data.join(design.select("scan_id", "x"), "scan_id"), fit, "clean array<double>", "x")
    return out.withColumn("v", F.col("clean")).drop("clean", "x")

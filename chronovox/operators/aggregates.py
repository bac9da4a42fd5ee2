"""Aggregates over voxels, frames and scans.  Variances are of the population throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.guards import norm, pearson, ratio, rms, trimean, zero_if_null
from .frames import difference


def roi_traces(bold: DataFrame, atlas: DataFrame) -> DataFrame:
    """Mean over each label's voxels, per frame."""
    return bold.join(atlas, "voxel_id").groupBy("scan_id", "label", "t").agg(F.avg("value").alias("value"))


def mask_traces(bold: DataFrame, masks: DataFrame) -> DataFrame:
    """Mean over each mask's voxels, per frame."""
    return bold.join(masks, "voxel_id").groupBy("scan_id", "mask_name", "t").agg(F.avg("value").alias("value"))


def weighted_sums(bold: DataFrame, maps: DataFrame) -> DataFrame:
    """Sum over voxels of value times each map's weight (comp, voxel_id, weight), per frame."""
    return bold.join(maps, "voxel_id").groupBy("scan_id", "comp", "t").agg(F.sum(F.col("value") * F.col("weight")).alias("value"))


def global_signal(bold: DataFrame) -> DataFrame:
    return bold.groupBy("scan_id", "t").agg(F.avg("value").alias("value"))


def temporal_maps(bold: DataFrame) -> DataFrame:
    """Mean, deviation and their ratio (0 where undefined) per voxel."""
    out = bold.groupBy("scan_id", "voxel_id").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    return out.withColumn("tsnr", zero_if_null(ratio("mean", "std")))


def global_std(bold: DataFrame) -> DataFrame:
    return bold.groupBy("scan_id").agg(F.stddev_pop("value").alias("std"))


def frame_rms(bold: DataFrame) -> DataFrame:
    return bold.groupBy("scan_id", "t").agg(rms("value").alias("rms"))


def dvars(bold: DataFrame) -> DataFrame:
    """Root mean square over voxels of the change since the frame before; null at the first frame."""
    return bold.withColumn("d", difference("value", "scan_id", "voxel_id")).groupBy("scan_id", "t").agg(rms("d").alias("dvars"))


def reference_map(bold: DataFrame) -> DataFrame:
    """Trimean over frames, per voxel."""
    return bold.groupBy("scan_id", "voxel_id").agg(trimean("value").alias("reference"))


def mse_to_reference(bold: DataFrame) -> DataFrame:
    """Mean square distance of each frame to the reference, over all voxels, also those outside the brain."""
    near = bold.join(reference_map(bold), ["scan_id", "voxel_id"])
    return near.groupBy("scan_id", "t").agg(F.avg(F.pow(F.col("value") - F.col("reference"), 2)).alias("mse"))


def correlation_with(bold: DataFrame, trace: DataFrame) -> DataFrame:
    """Each voxel's correlation with the scan's trace (scan_id, t, trace); null if either is constant."""
    return bold.join(trace, ["scan_id", "t"]).groupBy("scan_id", "voxel_id").agg(pearson("value", "trace").alias("r"))


def correlation_across(maps: DataFrame, covariate: DataFrame, rank: bool = False) -> DataFrame:
    """Per voxel, the correlation over scans of a map with a number of each scan (scan_id, x).

    rank: of ordinal ranks; equal values get different ranks, by scan_id.
    """
    both = maps.join(covariate, "scan_id").select("scan_id", "voxel_id", "value", "x")
    if rank:
        order = lambda c: F.row_number().over(Window.partitionBy("voxel_id").orderBy(c, "scan_id")).cast("double")
        both = both.select("voxel_id", order("value").alias("value"), order("x").alias("x"))
    return both.groupBy("voxel_id").agg(pearson("value", "x").alias("r"))


def map_correlation(a: DataFrame, b: DataFrame, rank: bool = False) -> DataFrame:
    """Per voxel, the correlation over scans of two maps."""
    both = a.select("scan_id", "voxel_id", "value").join(b.select("scan_id", "voxel_id", F.col("value").alias("x")), ["scan_id", "voxel_id"])
    if rank:
        order = lambda c: F.row_number().over(Window.partitionBy("voxel_id").orderBy(c, "scan_id")).cast("double")
        both = both.select("voxel_id", order("value").alias("value"), order("x").alias("x"))
    return both.groupBy("voxel_id").agg(pearson("value", "x").alias("r"))


def dice(pairs: DataFrame, a: str, b: str, *keys: str) -> DataFrame:
    """Twice the common part of two boolean columns over the sum of both."""
    return pairs.groupBy(*keys).agg(ratio(2.0 * F.count_if(F.col(a) & F.col(b)), (F.count_if(a) + F.count_if(b)).cast("double")).alias("dice"))


def fit_mse(fits: DataFrame, y: str, predicted: str, *keys: str) -> DataFrame:
    return fits.groupBy(*keys).agg(F.avg(F.pow(F.col(y) - F.col(predicted), 2)).alias("mse"))


def median_mad(maps: DataFrame) -> DataFrame:
    """Median and median absolute deviation over scans, per voxel."""
    center = maps.groupBy("voxel_id").agg(F.median("value").alias("median"))
    spread = maps.join(center, "voxel_id").groupBy("voxel_id").agg(F.median(F.abs(F.col("value") - F.col("median"))).alias("mad"))
    return center.join(spread, "voxel_id")


def mean_std(maps: DataFrame) -> DataFrame:
    return maps.groupBy("voxel_id").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def group_prior(maps: DataFrame) -> DataFrame:
    """Median over scans of each network's map (scan_id, network, voxel_id, value)."""
    return maps.groupBy("network", "voxel_id").agg(F.median("value").alias("value"))


def amplitude(maps: DataFrame, *keys: str) -> DataFrame:
    """Root of the sum of squares over all voxels."""
    return maps.groupBy(*keys).agg(norm("value").alias("amplitude"))


def confound_correlation(networks: DataFrame, confounds: DataFrame) -> DataFrame:
    """Mean over confounds (scan_id, confound, t, x) of the absolute correlation with each network's trace (scan_id, network, t, value)."""
    r = networks.join(confounds, ["scan_id", "t"]).groupBy("scan_id", "network", "confound").agg(F.abs(pearson("value", "x")).alias("r"))
    return r.groupBy("scan_id", "network").agg(F.avg("r").alias("conf_corr"))


def mean_within(maps: DataFrame, core: DataFrame, *keys: str) -> DataFrame:
    return maps.join(core.select("voxel_id"), "voxel_id", "left_semi").groupBy(*keys).agg(F.avg("value").alias("mean"))


def mean_fd(traces: DataFrame) -> DataFrame:
    """Over kept frames."""
    return traces.where("keep").groupBy("scan_id").agg(F.avg("fd").alias("mean_fd"))


def fd_dvars_correlation(traces: DataFrame) -> DataFrame:
    """Correlation of displacement and DVARS after correction, without the first kept frame."""
    kept = traces.where("keep").withColumn("__i", F.row_number().over(Window.partitionBy("scan_id").orderBy("t")))
    return kept.where("__i > 1").groupBy("scan_id").agg(pearson("dvars", "fd").alias("fd_dvars_corr"))


def variance_explained(fits: DataFrame, *keys: str) -> DataFrame:
    """1 - var(residual) / var(value), by the keys."""
    return fits.groupBy(*keys).agg((1 - ratio(F.var_pop("residual"), F.var_pop("value"))).alias("ve"))


def variance_explained_by(fits: DataFrame, *sets: list[str]) -> DataFrame:
    """The same for several sets of keys in one pass: all their columns (null where a set has none), ``level`` (a bit, from the last column up, for each that is missing) and ve."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    grouped = fits.groupingSets([[F.col(c) for c in s] for s in sets], *columns)
    return grouped.agg(F.grouping_id().alias("level"), (1 - ratio(F.var_pop("residual"), F.var_pop("value"))).alias("ve"))


def weighted_ve(by_slice: DataFrame) -> DataFrame:
    """Mean over slices (scan_id, slice, voxels, ve), weighted by voxels."""
    return by_slice.groupBy("scan_id").agg(ratio(F.sum(F.col("ve") * F.col("voxels")), F.sum("voxels").cast("double")).alias("ve"))


def signal_covariance(bold: DataFrame, trace: DataFrame) -> DataFrame:
    """Mean over frames of value times trace; not centred."""
    return bold.join(trace, ["scan_id", "t"]).groupBy("scan_id", "voxel_id").agg(F.avg(F.col("value") * F.col("trace")).alias("cov"))


def degrees_of_freedom(counts: DataFrame) -> DataFrame:
    """Frames less removed components and regressors, with randomly dropped frames put back."""
    return counts.withColumn("tdof", F.col("frames") - (F.col("aroma_removed") + F.col("regressors")) + F.col("dropped"))


def cosine_distance(bold: DataFrame, reference: DataFrame) -> DataFrame:
    """1 - cosine between each frame and the reference (scan_id, voxel_id, reference)."""
    both = bold.join(reference, ["scan_id", "voxel_id"])
    v, r = F.col("value"), F.col("reference")
    return both.groupBy("scan_id", "t").agg((1 - ratio(F.sum(v * r), F.sqrt(F.sum(v * v)) * F.sqrt(F.sum(r * r)))).alias("distance"))


def spacing_summary(headers: DataFrame) -> DataFrame:
    """Least spacing and the number of different ones."""
    return headers.groupBy().agg(F.min("spacing").alias("least"), F.count_distinct("spacing").alias("different"))


def one_spacing(headers: DataFrame) -> float:
    """The spacing that all headers share; raises if they differ."""
    row = spacing_summary(headers).first()
    if row["different"] != 1:
        raise ValueError(f"{row['different']} different spacings")
    return row["least"]


def fan_in(scans: DataFrame, column: str, *keys: str) -> DataFrame:
    """All scans' values in one sorted list; one row per key, for short lists of names only."""
    return scans.groupBy(*keys).agg(F.sort_array(F.collect_list(column)).alias("all"))


def network_activity(traces: DataFrame) -> DataFrame:
    """Mean over networks of the absolute trace, each divided by its root mean square."""
    scale = traces.groupBy("scan_id", "network").agg(rms("value").alias("rms"))
    return traces.join(scale, ["scan_id", "network"]).groupBy("scan_id", "t").agg(F.avg(F.abs(ratio("value", "rms"))).alias("activity"))


def mask_weights(components: DataFrame, tissue: DataFrame) -> DataFrame:
    """Sums of absolute weights of each component inside edge, CSF and outside masks (voxel_id, edge, csf, outside)."""
    both, w = components.join(tissue, "voxel_id"), F.abs("weight")
    return both.groupBy("comp").agg(F.sum(w).alias("total"), *(F.sum(F.when(F.col(m), w).otherwise(0.0)).alias(m) for m in ("edge", "csf", "outside")))

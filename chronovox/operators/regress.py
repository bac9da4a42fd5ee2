"""Censoring, detrending, regression, filtering and scaling: the cleaning of a scan."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import options
from ..functions.guards import ratio, zero_if_null
from ..kernels import linear, spectral
from ..sources.shared import written
from . import aggregates, bricks, frames, joins, series

MOTION_6 = ["mov1", "mov2", "mov3", "rot1", "rot2", "rot3"]
SIGNALS = ["WM_signal", "CSF_signal", "vascular_signal", "global_signal"]


def outlier_frames(trace: np.ndarray, threshold: float = 2.5) -> np.ndarray:
    """Frames within ``threshold`` deviations of the mean of those kept, until the set stays the same; a frame may come back.

    Sets can only be met again, not go on for ever; if they come round to an
    earlier one without staying, there is no answer, and that raises.
    """
    kept, before = np.ones(len(trace), bool), set()
    while kept.tobytes() not in before:
        before.add(kept.tobytes())
        own = trace[kept]
        with np.errstate(invalid="ignore", divide="ignore"):
            now = np.abs((trace - own.mean()) / own.std()) < threshold if len(own) else np.zeros(len(trace), bool)
        if (now == kept).all():
            return now
        kept = now
    raise ValueError("outlier censoring goes round in a circle")


def censor_outliers(traces: DataFrame, column: str, threshold: float = 2.5) -> DataFrame:
    """scan_id, t, keep. Null values are not kept and take no part. A group is one scan's trace."""

    def one(pdf):
        known = pdf[column].notna().to_numpy()
        keep = np.zeros(len(pdf), bool)
        if known.any():
            keep[known] = outlier_frames(pdf[column].to_numpy(float)[known], threshold)
        return pdf[["scan_id", "t"]].assign(keep=keep)

    return series.per_scan(traces.select("scan_id", "t", column), one, "scan_id string, t int, keep boolean")


def censor(traces: DataFrame, fd_threshold: float | None = None, use_dvars: bool = False, use_mse: bool = False, least: int = 3) -> DataFrame:
    """Frames that every chosen rule keeps, for scans that keep at least ``least``."""
    keep = traces.select("scan_id", "t", F.lit(True).alias("keep"))
    if fd_threshold is not None:
        keep = frames.censor_fd(traces, fd_threshold).select("scan_id", "t", "keep")
    for wanted, column in ((use_dvars, "dvars"), (use_mse, "mse")):
        if wanted:
            keep = joins.all_frame_masks(keep, censor_outliers(traces, column))
    return keep.join(frames.scans_with_enough_frames(keep, least), "scan_id", "left_semi")


def motion_24(motion: DataFrame) -> DataFrame:
    """Six parameters, their changes, and the squares of both."""
    out = motion
    for p in MOTION_6:
        out = out.withColumn(f"{p}_der", frames.derivative(p, "scan_id"))
    for p in MOTION_6:
        out = out.withColumn(f"{p}^2", F.pow(p, 2)).withColumn(f"{p}_der^2", F.pow(f"{p}_der", 2))
    return out


def motion_regressors(motion: DataFrame, wanted: list[str]) -> DataFrame:
    """Long regressors (scan_id, name, t, value) of mot_6 or mot_24."""
    if "mot_6" in wanted and "mot_24" in wanted:
        raise ValueError("mot_6 and mot_24 exclude each other")
    names = MOTION_6 if "mot_6" in wanted else [c for c in motion.columns if "mov" in c or "rot" in c] if "mot_24" in wanted else []
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"`{n}`").cast("double").alias("value")) for n in names]) if names else F.expr("array()").cast("array<struct<name:string,value:double>>")
    return motion.select("scan_id", "t", F.explode(pairs).alias("p")).select("scan_id", "p.name", "t", "p.value")


def signal_regressors(bold: DataFrame, masks: DataFrame, wanted: list[str]) -> DataFrame:
    """Long regressors: mean over each wanted mask (WM_signal, CSF_signal, vascular_signal, global_signal). An empty mask gives none."""
    use = masks.where(F.col("mask_name").isin([w for w in SIGNALS if w in wanted]))
    return aggregates.mask_traces(bold, use).select("scan_id", F.col("mask_name").alias("name"), "t", F.coalesce("value", F.lit(0.0)).alias("value"))


def detrend_line(bold: DataFrame, total_frames: int, interval: str = "0-end") -> DataFrame:
    """Residual and intercept after a line fitted over the interval, as an aggregate and a join back.

    The axis runs from -n/2 to n/2 over all n frames, so the intercept is the
    value in the middle.
    """
    first, last = options.parse_interval(interval, total_frames)
    axis = F.lit(-total_frames / 2) + F.col("t") * F.lit(total_frames / (total_frames - 1))
    inside = (F.col("t") >= first) & (F.col("t") < last)
    x, y = F.when(inside, axis), F.when(inside, F.col("value"))
    line = bold.groupBy("scan_id", "voxel_id").agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))
    return bold.join(line, ["scan_id", "voxel_id"]).withColumn("residual", F.col("value") - (F.col("intercept") + F.col("slope") * axis))


def detrend(data: DataFrame, total_frames: int, order: int = 1, interval: str = "0-end", remove_intercept: bool = True) -> DataFrame:
    """Series with ``v`` detrended and ``intercept`` added. Frames are the series' own, so censored ones are just absent."""
    first, last = options.parse_interval(interval, total_frames)

    def fit(y, t):
        t = np.array(t)
        x = linear.polynomial(total_frames, t, order)
        inside = (t >= first) & (t < last)
        b = linear.solve(x[inside], y[inside])
        return y - (x @ b if remove_intercept else x[:, :-1] @ b[:-1]), b[-1]

    out = series.per_voxel(data, fit, "residual array<double>, intercept double", "t")
    return out.withColumn("v", F.col("residual")).drop("residual")


def component_regressors(data: DataFrame, tissue: DataFrame, percent: bool = False, components: int = 5) -> DataFrame:
    """Design rows (scan_id, x) of principal component scores of the tissue voxels; scans with under five voxels or a lack of rank have none."""
    own = data.join(tissue.select("voxel_id").distinct(), "voxel_id", "left_semi").select(*data.columns)
    enough = own.groupBy("scan_id").count().where("count >= 5").select("scan_id")
    gram = series.frame_gram(own.join(enough, "scan_id", "left_semi").select(*data.columns))

    def scores(row):
        x = linear.principal_scores(series.square(row["gram"]), None if percent else components)
        if linear.full_rank(x):
            yield row["scan_id"], x.T.tolist()

    return series.per_row(gram, scores, "scan_id string, x array<array<double>>")


def checked_rank(design: DataFrame) -> DataFrame:
    """Designs without full rank become empty."""

    def check(row):
        x = np.array([list(r) for r in row["x"]], float).T if len(row["x"]) else np.zeros((0, 0))
        yield row["scan_id"], x.T.tolist() if linear.full_rank(x) else []

    return series.per_row(design.select("scan_id", "x"), check, "scan_id string, x array<array<double>>")


def fill_gaps(data: DataFrame, total_frames: int, tr: float) -> DataFrame:
    """Series at all frames; the frames present keep their values."""

    def fill(y, t):
        kept = np.zeros(total_frames, bool)
        kept[np.array(t)] = True
        return spectral.fill_gaps(y, tr, kept)

    out = series.per_voxel(data, fill, "filled array<double>", "t")
    return out.withColumn("v", F.col("filled")).withColumn("t", F.sequence(F.lit(0), F.lit(total_frames - 1))).drop("filled")


def band_filter(data: DataFrame, tr: float, high_pass: float | None = None, low_pass: float | None = None) -> DataFrame:
    out = series.per_voxel(data, lambda y: spectral.zero_phase(y, tr, high_pass, low_pass), "filtered array<double>")
    return out.withColumn("v", F.col("filtered")).drop("filtered")


def regress(data: DataFrame, design: DataFrame, subtract: bool = True, key: str = "scan_id") -> DataFrame:
    """Series with ``predicted`` and ``residual`` by least squares on the scan's design (scan_id, x); null where it is singular.

    subtract False: the fit is for statistics only, and v stays as it is.
    ``v`` becomes the residual otherwise.  Voxels with more than one NaN are
    set to 0 first.
    """

    def fit(y, x):
        y = np.where(np.isnan(y).sum(axis=0) > 1, 0.0, y)
        m = np.array(x, float).T
        if not m.size:
            return np.zeros_like(y), y
        p = m @ linear.solve(m, y)
        return p, y - p

    out = series.per_voxel(data.join(design.select(key, "x"), key), fit, "predicted array<double>, residual array<double>", "x").drop("x")
    return out.withColumn("y", F.col("v")).withColumn("v", F.col("residual") if subtract else F.col("v"))


def regress_one(bold: DataFrame, regressor: DataFrame) -> DataFrame:
    """Residual and prediction with one regressor (scan_id, t, x) and no intercept, as sums and a join; for the plain relational path."""
    both = bold.join(regressor, ["scan_id", "t"])
    beta = both.groupBy("scan_id", "voxel_id").agg(ratio(F.sum(F.col("x") * F.col("value")), F.sum(F.col("x") * F.col("x"))).alias("beta"))
    fit = both.join(beta, ["scan_id", "voxel_id"]).withColumn("predicted", zero_if_null(F.col("beta") * F.col("x")))
    return fit.withColumn("residual", F.col("value") - F.col("predicted"))


def regress_two(bold: DataFrame, regressors: DataFrame) -> DataFrame:
    """As regress_one, with two regressors (scan_id, t, x1, x2) by Cramer's rule; null where they are collinear."""
    both = bold.join(regressors, ["scan_id", "t"])
    s = lambda a, b: F.sum(F.col(a) * F.col(b))
    sums = both.groupBy("scan_id", "voxel_id").agg(s("x1", "x1").alias("a"), s("x1", "x2").alias("b"), s("x2", "x2").alias("c"), s("x1", "value").alias("p"), s("x2", "value").alias("q"))
    det = F.col("a") * F.col("c") - F.col("b") * F.col("b")
    beta = sums.select("scan_id", "voxel_id", ratio(F.col("c") * F.col("p") - F.col("b") * F.col("q"), det).alias("b1"), ratio(F.col("a") * F.col("q") - F.col("b") * F.col("p"), det).alias("b2"))
    fit = both.join(beta, ["scan_id", "voxel_id"]).withColumn("predicted", F.col("b1") * F.col("x1") + F.col("b2") * F.col("x2"))
    return fit.withColumn("residual", F.col("value") - F.col("predicted"))


def by_slice(data: DataFrame, grid: DataFrame, direction: str) -> DataFrame:
    """Series whose scan_id names scan and slice, so that every operator works per slice; ``scan`` and ``slice`` are added."""
    axis = {"RL": "x", "AP": "y", "SI": "z"}[direction]
    out = data.join(grid.select("voxel_id", F.col(axis).alias("slice")), "voxel_id").withColumn("scan", F.col("scan_id"))
    return out.withColumn("scan_id", F.concat_ws("/", "scan_id", "slice"))


def null_design(design: DataFrame, frame_mask: DataFrame, tr: float, seed: int = 0) -> DataFrame:
    """Phase-randomised regressors of each scan's design; the same for the same seed."""
    kept = frame_mask.groupBy("scan_id").agg(F.array_sort(F.collect_list(F.struct("t", "keep"))).alias("k")).select("scan_id", F.col("k.keep").alias("keep"))

    def one(row):
        x = np.array([list(r) for r in row["x"]], float).T
        yield row["scan_id"], spectral.null_regressors(x, tr, np.array(row["keep"], bool), seed).T.tolist()

    return series.per_row(design.select("scan_id", "x").join(kept, "scan_id"), one, "scan_id string, x array<array<double>>")


def corrected_std(predicted: DataFrame, randomized: DataFrame) -> DataFrame:
    """Per voxel, the root of the variance predicted beyond that of random regressors, 0 if there is none."""
    a = predicted.groupBy("scan_id", "voxel_id").agg(F.var_pop("value").alias("a"))
    b = randomized.groupBy("scan_id", "voxel_id").agg(F.var_pop("value").alias("b"))
    return a.join(b, ["scan_id", "voxel_id"]).select("scan_id", "voxel_id", F.sqrt(F.greatest(F.col("a") - F.col("b"), F.lit(0.0))).alias("value"))


def scaled(bold: DataFrame, how: str | None, intercept: DataFrame | None = None) -> DataFrame:
    """Values divided by the scan's or the voxel's factor; 0 where the factor is 0.

    None, global_variance, grand_mean_scaling, voxelwise_standardization or
    voxelwise_mean; the mean modes take the detrending's intercept (scan_id,
    voxel_id, intercept).
    """
    if how is None:
        return bold
    if how == "global_variance":
        factor, on = bold.groupBy("scan_id").agg(F.stddev_pop("value").alias("factor")), ["scan_id"]
    elif how == "grand_mean_scaling":
        factor, on = intercept.groupBy("scan_id").agg((F.avg("intercept") / 100).alias("factor")), ["scan_id"]
    elif how == "voxelwise_standardization":
        factor, on = bold.groupBy("scan_id", "voxel_id").agg(F.stddev_pop("value").alias("factor")), ["scan_id", "voxel_id"]
    elif how == "voxelwise_mean":
        factor, on = intercept.select("scan_id", "voxel_id", (F.col("intercept") / 100).alias("factor")), ["scan_id", "voxel_id"]
    else:
        raise ValueError(f"unknown scaling: {how}")
    return bold.join(factor, on).withColumn("value", zero_if_null(ratio("value", "factor"))).drop("factor").select(*bold.columns)


def homogenized(bold: DataFrame, how: str | None = None) -> DataFrame:
    """Every voxel with the same deviation, and the scan's total deviation as before."""
    if how in ("voxelwise_standardization", "voxelwise_mean"):
        raise ValueError(f"variance can't be evened out with {how}")
    own = bold.groupBy("scan_id", "voxel_id").agg(F.stddev_pop("value").alias("own"))
    total = aggregates.global_std(bold).withColumnRenamed("std", "total")
    even = bold.join(own, ["scan_id", "voxel_id"]).withColumn("value", zero_if_null(ratio("value", "own"))).drop("own")
    now = aggregates.global_std(even).withColumnRenamed("std", "now")
    return even.join(total, "scan_id").join(now, "scan_id").withColumn("value", zero_if_null(ratio(F.col("value") * F.col("total"), "now"))).select(*bold.columns)


def with_average(bold: DataFrame, intercept: DataFrame, sign: int = 1) -> DataFrame:
    """The voxel's average put back (sign 1) or taken away again (sign -1)."""
    return bold.join(intercept.select("scan_id", "voxel_id", "intercept"), ["scan_id", "voxel_id"]).withColumn("value", F.col("value") + sign * F.col("intercept")).select(*bold.columns)


def smoothed(bold: DataFrame, grid: DataFrame, fwhm: float, spacing: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> DataFrame:
    """Gaussian smoothing inside the grid's voxels. A group is a brick of one frame, with its halo."""
    ends = grid.agg(*[f(c).alias(f"{n}{c}") for c in "xyz" for n, f in (("least", F.min), ("most", F.max))]).first()
    if ends["mostx"] is None:
        return bold.limit(0).select("scan_id", "t", "voxel_id", "value")
    near = [F.col(c) - ends[f"least{c}"] for c in "xyz"]
    own = grid.select("voxel_id", *[n.cast("int").alias(c) for n, c in zip(near, "xyz", strict=True)])
    shape = tuple(ends[f"most{c}"] - ends[f"least{c}"] + 1 for c in "xyz")
    out = bricks.smoothed(bold.select("scan_id", "t", "voxel_id", "value").join(own, "voxel_id"), shape, fwhm, spacing)
    return out.join(own, ["x", "y", "z"]).select("scan_id", "t", "voxel_id", "value")


def clean(
    bold: DataFrame,
    mask: DataFrame,
    motion: DataFrame,
    fd: DataFrame,
    frames_total: int,
    tr: float = 1.0,
    interval: str = "0-end",
    fd_threshold: float | None = None,
    use_dvars: bool = False,
    use_mse: bool = False,
    least: int = 3,
    match_frames: bool = False,
    order: int = 1,
    high_pass: float | None = None,
    low_pass: float | None = None,
    edge_seconds: float = 0.0,
    regressors: tuple[str, ...] = (),
    tissue: DataFrame | None = None,
    scaling: str | None = None,
    even_variance: bool = False,
    fwhm: float | None = None,
    grid: DataFrame | None = None,
    keep_average: bool = False,
    seed: int = 0,
) -> dict[str, DataFrame]:
    """All steps in order: interval, censoring, matching, detrending, gap filling and filtering, regression, scaling, smoothing.

    Returns the cleaned series in long form (``bold``), the frame mask, the
    fit (``fit``: series with y, predicted, residual), and intercepts.
    """
    early = frames.in_interval(bold, interval, frames_total)
    mse = aggregates.mse_to_reference(early) if use_mse else None
    own = frames.in_mask(early, mask).select("scan_id", "t", "voxel_id", "value")
    traces = frames.in_interval(fd, interval, frames_total)
    if use_dvars:
        traces = traces.join(aggregates.dvars(own), ["scan_id", "t"])
    if use_mse:
        traces = traces.join(mse, ["scan_id", "t"])
    keep = censor(traces, fd_threshold, use_dvars, use_mse, least)
    filtered = high_pass is not None or low_pass is not None
    if match_frames:
        keep = frames.trim_edges(keep, frames_total, edge_seconds, tr) if filtered else keep
        keep = keep.join(frames.scans_with_enough_frames(keep, least), "scan_id", "left_semi")
        keep = frames.matched_frames(keep, least, seed)
    # used several times below, so written once
    keep = written(keep, "frame-mask")
    kept = frames.kept_frames(own, keep)
    trend = written(detrend(series.to_series(kept), frames_total, order), "detrended")
    intercepts = trend.select("scan_id", "voxel_id", "intercept")
    data = trend.drop("intercept")
    wanted = [r for r in regressors if r in ("mot_6", "mot_24")] or ([] if regressors else ["mot_6"])
    long = frames.kept_frames(motion_regressors(motion_24(motion) if "mot_24" in wanted else motion, wanted), keep)
    moves = series.to_series(long.select("scan_id", F.xxhash64("name").alias("voxel_id"), "t", "value", "name").select("scan_id", "voxel_id", "t", "value"))
    moves = detrend(moves, frames_total, order).drop("intercept")
    if filtered:
        data, moves = (band_filter(fill_gaps(s, frames_total, tr), tr, high_pass, low_pass) for s in (data, moves))
        keep = frames.trim_edges(keep, frames_total, edge_seconds, tr)
        enough = frames.scans_with_enough_frames(keep, least)
        data, moves = (written(series.to_series(frames.kept_frames(series.to_bold(s), keep)).join(enough, "scan_id", "left_semi"), "filtered") for s in (data, moves))
    design = moves.groupBy("scan_id").agg(F.array_sort(F.collect_list(F.struct("voxel_id", "v"))).alias("d")).select("scan_id", F.col("d.v").alias("x"))
    if tissue is not None and any(r in SIGNALS for r in regressors):
        signals = series.to_design(signal_regressors(series.to_bold(data), tissue, list(regressors))).select("scan_id", F.col("x").alias("s"))
        design = signals.join(design, "scan_id", "left").select("scan_id", F.concat(F.coalesce("x", F.expr("array()").cast("array<array<double>>")), "s").alias("x"))
    if tissue is not None and any(r.startswith("aCompCor") for r in regressors):
        scores = component_regressors(data, tissue.where(F.col("mask_name").isin("WM_signal", "CSF_signal")), "aCompCor_percent" in regressors).select("scan_id", F.col("x").alias("s"))
        design = design.join(scores, "scan_id", "full").select("scan_id", F.concat(F.coalesce("x", F.expr("array()").cast("array<array<double>>")), F.coalesce("s", F.expr("array()").cast("array<array<double>>"))).alias("x"))
    fit = written(regress(data, design, subtract=bool(regressors)), "fit")
    out = series.to_bold(fit)
    out = homogenized(out, scaling) if even_variance else out
    out = scaled(out, scaling, intercepts)
    if fwhm is not None:
        out = smoothed(out, grid, fwhm)
    out = with_average(out, intercepts) if keep_average else out
    return {"bold": out, "frame_mask": keep, "fit": fit, "intercept": intercepts}

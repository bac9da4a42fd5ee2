"""Filters over frames, voxels and scans, and window operators over frames.

A frame keeps its original number ``t`` through every filter, so an interval
on original frames never has to be shifted for censored ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import options
from ..sources.shared import dropped, written


def by_time(*keys: str):
    return Window.partitionBy(*keys).orderBy("t")


def in_mask(bold: DataFrame, mask: DataFrame) -> DataFrame:
    """Voxels of the mask."""
    return bold.join(mask.select("voxel_id"), "voxel_id", "left_semi")


def in_interval(bold: DataFrame, interval: str, frames: int) -> DataFrame:
    first, last = options.parse_interval(interval, frames)
    return bold.where((F.col("t") >= first) & (F.col("t") < last))


def kept_frames(bold: DataFrame, frame_mask: DataFrame) -> DataFrame:
    return bold.join(frame_mask.where("keep").select("scan_id", "t"), ["scan_id", "t"], "left_semi")


def scans_with_enough_frames(frame_mask: DataFrame, least: int) -> DataFrame:
    """scan_id of scans that keep at least so many frames."""
    return frame_mask.groupBy("scan_id").agg(F.count_if("keep").alias("n")).where(F.col("n") >= least).select("scan_id")


def trim_edges(frame_mask: DataFrame, frames: int, edge_seconds: float, tr: float) -> DataFrame:
    """Frames within ``edge_seconds`` of either end are not kept."""
    cut = int(edge_seconds / tr)
    if frames < 2 * cut:
        raise ValueError("the series is too short for its edges to be cut")
    return frame_mask.withColumn("keep", F.col("keep") & F.col("t").between(cut, frames - cut - 1))


def uniform_subset(bold: DataFrame, frames: int, most: int = 50) -> DataFrame:
    """At most ``most`` frames, evenly spread."""
    if frames <= most:
        return bold
    wanted = sorted({int(i * (frames - 1) / (most - 1)) for i in range(most)})
    return bold.where(F.col("t").isin(wanted))


def drop_dummies(bold: DataFrame, dummies: DataFrame) -> DataFrame:
    """Without a scan's first ``n`` frames; ``dummies`` has scan_id and n."""
    return bold.join(dummies, "scan_id", "left").where(F.col("t") >= F.coalesce("n", F.lit(0))).drop("n")


def count_dummies(trace: DataFrame, threshold: float = 3.5, first: int = 50) -> DataFrame:
    """Leading frames, among the first 50, that are outliers of the trace by modified z."""
    from . import qc

    flagged = qc.outliers(trace.where(F.col("t") < first), "value", threshold, "scan_id")
    lead = F.min(F.when(~F.coalesce("outlier", F.lit(False)), F.col("t")))
    return flagged.groupBy("scan_id").agg(F.coalesce(lead, F.count("*").cast("int")).alias("n"))


def nonzero_voxels(bold: DataFrame) -> DataFrame:
    """Voxels that vary in every scan."""
    by_scan = bold.groupBy("scan_id", "voxel_id").agg((F.stddev_pop("value") != 0).alias("varies"))
    return by_scan.groupBy("voxel_id").agg(F.bool_and("varies").alias("varies")).where("varies").select("voxel_id")


def registered_scans(maps: DataFrame) -> DataFrame:
    """Scans whose map (scan_id, voxel_id, value) has a median other than 0."""
    return maps.groupBy("scan_id").agg(F.median("value").alias("m")).where("m <> 0").select("scan_id")


def clip_negatives(value: Column) -> Column:
    return F.greatest(value, F.lit(0.0))


def log_scaled(value: Column) -> Column:
    """log10(x + 1); 0 where that is not finite or negative."""
    return F.when(value > -1, F.greatest(F.log10(value + 1), F.lit(0.0))).otherwise(0.0)


def non_binary(mask_values: DataFrame) -> DataFrame:
    """Rows whose value is neither 0 nor 1; a binary mask gives none."""
    return mask_values.where(~F.col("value").isin(0.0, 1.0) | F.col("value").isNull())


#: Cells of a key's histogram in a round of order_statistic().
CELLS = 1024


def order_statistic(frame: DataFrame, value: Column, index: Callable[[Column], Column], *keys: str) -> DataFrame:
    """keys and ``bound``: of each key's values, that at the (whole) index that ``index`` makes of their number, ascending from 0.

    No task sorts a key's values.  Rounds of histograms, for all keys at once,
    close in on the cell that holds the wanted place, until its least and
    greatest values are one; a round narrows the range at least a thousandfold.
    Nulls and NaN come last and give null; infinities count as the greatest
    doubles.
    """
    large = 1.7976931348623157e308
    v = value.cast("double")
    own = written(frame.select(*keys, F.when(v.isNotNull() & ~F.isnan(v), F.greatest(F.least(v, F.lit(large)), F.lit(-large))).alias("v")), "values")
    sizes = own.groupBy(*keys).agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("v").alias("m"), index(F.count(F.lit(1))).cast("long").alias("place"))
    state = written(sizes, "order-statistic")
    while (open_ := state.where((F.col("low") < F.col("high")) & (F.col("place") < F.col("m")))).head(1):
        near = own.join(open_.select(*keys, "low", "high", "place"), list(keys)).where(F.col("v").between(F.col("low"), F.col("high")))
        share = (F.col("v") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2)  # halves, as the whole range may overflow
        cell = F.least(F.floor(share * CELLS), F.lit(CELLS - 1)).alias("cell")
        counts = near.groupBy(*keys, "place", cell).agg(F.count(F.lit(1)).alias("m"), F.min("v").alias("low"), F.max("v").alias("high"))
        upto = F.sum("m").over(Window.partitionBy(*keys).orderBy("cell"))  # at most CELLS rows a key
        found = counts.withColumn("upto", upto).where((F.col("upto") > F.col("place")) & (F.col("upto") - F.col("m") <= F.col("place")))
        found = found.select(*keys, F.struct("low", "high", "m", (F.col("place") - F.col("upto") + F.col("m")).alias("place")).alias("new"))
        known = state.join(found, list(keys), "left")
        before, state = state, written(known.select(*keys, *[F.coalesce(f"new.{c}", c).alias(c) for c in ("low", "high", "m", "place")]), "order-statistic")
        dropped(before)
    dropped(own)
    return state.select(*keys, F.when(F.col("place") < F.col("m"), F.col("low")).alias("bound"))


def top_percent(maps: DataFrame, percent: float, *keys: str) -> DataFrame:
    """Adds ``top``: whether abs(value) reaches the value at index int((1 - percent/100) n) of all, ascending.

    The values are written once: sums of doubles that are made again may
    differ in the last digit from those that gave the bound.
    """
    maps = written(maps, "maps")
    bound = order_statistic(maps, F.abs("value"), lambda n: F.floor(F.lit(1 - percent / 100) * n), *keys)
    return maps.join(bound.withColumnRenamed("bound", "threshold"), list(keys)).withColumn("top", F.abs("value") >= F.col("threshold"))


def map_value_at(maps: DataFrame, share: float, *keys: str) -> DataFrame:
    """value_at() for keys with any number of rows."""
    return order_statistic(maps, F.col("value"), lambda n: F.floor(n * share), *keys)


def value_at(frame: DataFrame, share: float, *keys: str) -> DataFrame:
    """The value at index int(n share) of all, ascending; for short groups, such as a voxel's frames, which a task sorts."""
    size = frame.groupBy(*keys).agg(F.count("*").alias("__n"))
    ranked = frame.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.asc_nulls_last("value"))))
    return ranked.join(size, list(keys)).where(F.col("__rank") == F.floor(F.col("__n") * share) + 1).select(*keys, F.col("value").alias("bound"))


# windows


def censor_fd(traces: DataFrame, threshold: float) -> DataFrame:
    """A frame is not kept if displacement reaches the threshold there, one frame later, or up to two earlier."""
    near = by_time("scan_id").rowsBetween(-2, 1)
    return traces.withColumn("keep", ~F.max(F.col("fd") >= threshold).over(near))


def difference(column: str, *keys: str) -> Column:
    """Difference from the frame before; null at the first."""
    return F.col(column) - F.lag(column).over(by_time(*keys))


def derivative(column: str, *keys: str) -> Column:
    """Difference from the frame before; 0 at the first."""
    return F.coalesce(difference(column, *keys), F.lit(0.0))


def shifted(column: str, by: int, *keys: str) -> Column:
    """The value ``by`` frames earlier (later if negative), 0 beyond the ends."""
    w = by_time(*keys)
    return F.lag(column, by, 0.0).over(w) if by >= 0 else F.lead(column, -by, 0.0).over(w)


def page(t: Column, frames: int = 1000) -> Column:
    """The figure that a frame goes to."""
    return F.floor(t / frames).cast("int")


def matched_frames(frame_mask: DataFrame, number: int, seed: int = 0) -> DataFrame:
    """``keep`` for ``number`` of the kept frames of each scan, chosen by a seeded hash."""
    order = Window.partitionBy("scan_id", "keep").orderBy(F.xxhash64("scan_id", "t", F.lit(seed)), "t")
    return frame_mask.withColumn("__rank", F.row_number().over(order)).withColumn("keep", F.col("keep") & (F.col("__rank") <= number)).drop("__rank")


def convergence(fits: DataFrame, window: int = 5, least_corr: float = 0.5, most_diff: float = 0.03) -> DataFrame:
    """i of the first step (key, i, corr, diff with the worst of all priors) that passes and is followed by ``window`` small differences."""
    ahead = Window.partitionBy("key").orderBy("i").rowsBetween(1, window)
    checked = fits.withColumn("__n", F.count("*").over(ahead)).withColumn("__worst", F.max("diff").over(ahead))
    good = checked.where((F.col("corr") >= least_corr) & (F.col("__n") == window) & (F.col("__worst") <= most_diff))
    return good.groupBy("key").agg(F.min("i").alias("i"))

"""Aggregates, cleaning, connectivity, quality control, component features and volumes."""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates, aroma, connect, frames, qc, regress, series, volumes
from ..sources import tables
from ..sources.shared import written
from . import views
from .registry import corr, orthogonal, query
from .views import atlas, bold, emb, emb_series, grid, label_mask, line, motion, table, tissues, traces, work_dir

MAPS = ("maps", "SELECT scan_id, voxel_id, avg(value) AS value FROM line GROUP BY ALL")
GS = ("gs", "SELECT t, avg(value) AS trace FROM emb GROUP BY t")


def maps(spark, d):
    return line(spark, d).groupBy("scan_id", "voxel_id").agg(F.avg("value").alias("value"))


def prior(spark, d):
    return line(spark, d).where("t < 9").groupBy("voxel_id").agg(F.avg("value").alias("value"))


PRIOR = ("prior", "SELECT voxel_id, avg(value) AS value FROM line WHERE t < 9 GROUP BY ALL")


def covariate(spark, d):
    return motion(spark, d).groupBy("scan_id").agg(F.avg("mov1").alias("x"))


COVARIATE = ("covariate", "SELECT scan_id, avg(mov1) AS x FROM motion GROUP BY ALL")

MOTION = regress.MOTION_6
CENTRED = ("centred", "SELECT scan_id, t, " + ", ".join(f"{c} - avg({c}) OVER (PARTITION BY scan_id) AS {c}" for c in MOTION) + " FROM motion")
SHARE = " + ".join(f"coalesce(sum({c} * y) ** 2 / nullif(sum({c} * {c}), 0), 0)" for c in MOTION)

# aggregates


@query("A1_roi_mean", "label t", "value", "SELECT label, t, avg(value) AS value FROM emb GROUP BY ALL")
def a1(spark, d):
    return aggregates.roi_traces(bold(spark, d), atlas(spark, d))


@query("A2_seed_mean", "t", "value", "SELECT t, avg(value) AS value FROM emb WHERE label = 0 GROUP BY t")
def a2(spark, d):
    return aggregates.mask_traces(bold(spark, d), label_mask(spark, d, 0).withColumn("mask_name", F.lit("seed")))


@query("A3_tissue_traces", "mask_name t", "value", "SELECT mask_name, t, avg(value) AS value FROM emb JOIN tissues USING (voxel_id) GROUP BY ALL UNION ALL SELECT 'global', t, avg(value) FROM emb GROUP BY t")
def a3(spark, d):
    both = qc.scan_features(bold(spark, d), tissues(spark, d))
    return both["traces"].select("mask_name", "t", "value").union(both["global"].select(F.lit("global"), "t", "trace"))


@query("A4_temporal_maps", "voxel_id", "mean std tsnr", "SELECT voxel_id, avg(value) AS mean, stddev_pop(value) AS std, coalesce(avg(value) / nullif(stddev_pop(value), 0), 0) AS tsnr FROM emb GROUP BY voxel_id")
def a4(spark, d):
    return aggregates.temporal_maps(bold(spark, d))


@query("A5_global_std", "scan_id", "std", "SELECT scan_id, stddev_pop(value) AS std FROM line GROUP BY scan_id", digits=3)
def a5(spark, d):
    return aggregates.global_std(line(spark, d))


@query("A6_frame_rms", "t", "rms", "SELECT t, sqrt(avg(value * value)) AS rms FROM emb GROUP BY t")
def a6(spark, d):
    return aggregates.frame_rms(bold(spark, d))


@query("A7_dvars", "scan_id t", "dvars", "SELECT scan_id, t, sqrt(avg(x * x)) AS dvars FROM (SELECT scan_id, t, value - lag(value) OVER (PARTITION BY scan_id, voxel_id ORDER BY t) AS x FROM emb) GROUP BY ALL")
def a7(spark, d):
    return aggregates.dvars(bold(spark, d))


@query("A8_trimean", "voxel_id", "reference", "SELECT voxel_id, (quantile_cont(value, 0.2::DOUBLE) + quantile_cont(value, 0.5::DOUBLE) + quantile_cont(value, 0.8::DOUBLE)) / 3 AS reference FROM emb GROUP BY voxel_id")
def a8(spark, d):
    return aggregates.reference_map(bold(spark, d))


@query("A9_mse", "t", "mse", """
    SELECT t, avg((value - r) ** 2) AS mse FROM emb JOIN (SELECT voxel_id, (quantile_cont(value, 0.2::DOUBLE) + quantile_cont(value, 0.5::DOUBLE) + quantile_cont(value, 0.8::DOUBLE)) / 3 AS r FROM emb GROUP BY voxel_id) USING (voxel_id) GROUP BY t""")
def a9(spark, d):
    return aggregates.mse_to_reference(bold(spark, d))


@query("A10_voxel_correlation", "voxel_id", "r", f"SELECT voxel_id, {corr('value', 'trace')} AS r FROM emb JOIN gs USING (t) GROUP BY voxel_id", (GS,))
def a10(spark, d):
    b = bold(spark, d)
    return aggregates.correlation_with(b, aggregates.global_signal(b).withColumnRenamed("value", "trace"))


@query("A11_correlation_across_scans", "voxel_id", "r", f"SELECT voxel_id, {corr('value', 'x')} AS r FROM maps JOIN covariate USING (scan_id) GROUP BY voxel_id", (MAPS, COVARIATE))
def a11(spark, d):
    return aggregates.correlation_across(maps(spark, d), covariate(spark, d))


@query("A12_ordinal_spearman", "voxel_id", "r", f"""
    SELECT voxel_id, {corr('a', 'b')} AS r FROM (SELECT voxel_id, row_number() OVER (PARTITION BY voxel_id ORDER BY value, scan_id) AS a, row_number() OVER (PARTITION BY voxel_id ORDER BY x, scan_id) AS b FROM maps JOIN covariate USING (scan_id)) GROUP BY voxel_id""", (MAPS, COVARIATE))
def a12(spark, d):
    return aggregates.correlation_across(maps(spark, d), covariate(spark, d), rank=True)


@query("A13_dice", "", "dice", "SELECT 2.0 * count(*) FILTER (WHERE label IN (1, 2) AND label IN (2, 3)) / (count(*) FILTER (WHERE label IN (1, 2)) + count(*) FILTER (WHERE label IN (2, 3))) AS dice FROM atlas")
def a13(spark, d):
    return aggregates.dice(atlas(spark, d).select(F.col("label").isin(1, 2).alias("a"), F.col("label").isin(2, 3).alias("b")), "a", "b")


LINE_FIT = ("linefit", "SELECT voxel_id, regr_slope(value, -32 + t * 64.0::DOUBLE / 63) AS b, regr_intercept(value, -32 + t * 64.0::DOUBLE / 63) AS a FROM emb GROUP BY voxel_id")
RESIDUALS = ("residuals", "SELECT voxel_id, label, t, value, a, value - (a + b * (-32 + t * 64.0::DOUBLE / 63)) AS residual FROM emb JOIN linefit USING (voxel_id)")


@query("A14_fit_mse", "voxel_id", "mse", "SELECT voxel_id, avg(residual ** 2) AS mse FROM residuals GROUP BY voxel_id", (LINE_FIT, RESIDUALS))
def a14(spark, d):
    fit = regress.detrend_line(bold(spark, d), 64).withColumn("predicted", F.col("value") - F.col("residual"))
    return aggregates.fit_mse(fit, "value", "predicted", "voxel_id")


@query("A15_median_mad", "voxel_id", "median mad", """
    SELECT voxel_id, m AS median, mad FROM (SELECT voxel_id, any_value(m) AS m, median(abs(value - m)) AS mad FROM maps JOIN (SELECT voxel_id, median(value) AS m FROM maps GROUP BY voxel_id) USING (voxel_id) GROUP BY voxel_id)""", (MAPS,), digits=4)
def a15(spark, d):
    return aggregates.median_mad(maps(spark, d))


@query("A16_mean_std", "voxel_id", "mean std", "SELECT voxel_id, avg(value) AS mean, stddev_pop(value) AS std FROM maps GROUP BY voxel_id", (MAPS,), digits=4)
def a16(spark, d):
    return aggregates.mean_std(maps(spark, d))


@query("A17_group_prior", "network voxel_id", "value", "SELECT network, voxel_id, median(value) AS value FROM (SELECT scan_id, t % 3 AS network, voxel_id, avg(value) AS value FROM line GROUP BY ALL) GROUP BY ALL")
def a17(spark, d):
    m = line(spark, d).groupBy("scan_id", (F.col("t") % 3).alias("network"), "voxel_id").agg(F.avg("value").alias("value"))
    return aggregates.group_prior(m)


@query("A18_amplitude", "scan_id", "amplitude", "SELECT scan_id, sqrt(sum(value * value)) AS amplitude FROM maps GROUP BY scan_id", (MAPS,), digits=3)
def a18(spark, d):
    return aggregates.amplitude(maps(spark, d), "scan_id")


@query("A19_confound_correlation", "scan_id network", "conf_corr", f"""
    SELECT scan_id, network, avg(r) AS conf_corr FROM (SELECT scan_id, network, confound, abs({corr('value', 'x')}) AS r
    FROM (SELECT scan_id, (voxel_id % 3)::INT AS network, t, avg(value) AS value FROM line GROUP BY ALL) JOIN (SELECT scan_id, t, 'a' AS confound, mov1 AS x FROM motion UNION ALL SELECT scan_id, t, 'b', mov2 FROM motion) USING (scan_id, t) GROUP BY ALL) GROUP BY ALL""")
def a19(spark, d):
    n = line(spark, d).groupBy("scan_id", (F.col("voxel_id") % 3).cast("int").alias("network"), "t").agg(F.avg("value").alias("value"))
    m = motion(spark, d)
    c = m.select("scan_id", "t", F.lit("a").alias("confound"), F.col("mov1").alias("x")).union(m.select("scan_id", "t", F.lit("b"), "mov2"))
    return aggregates.confound_correlation(n, c)


@query("A20_mean_in_core", "scan_id", "mean", "SELECT scan_id, avg(value) AS mean FROM maps WHERE voxel_id < 10 GROUP BY scan_id", (MAPS,), digits=3)
def a20(spark, d):
    return aggregates.mean_within(maps(spark, d), prior(spark, d).where("voxel_id < 10"), "scan_id")


@query("A21_mean_fd", "scan_id", "mean_fd", "SELECT scan_id, avg(fd) AS mean_fd FROM (SELECT *, NOT bool_or(fd >= 52) OVER (PARTITION BY scan_id ORDER BY t ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS keep FROM traces) WHERE keep GROUP BY scan_id")
def a21(spark, d):
    return aggregates.mean_fd(frames.censor_fd(traces(spark, d), 52.0))


@query("A22_fd_dvars", "scan_id", "fd_dvars_corr", f"""
    SELECT scan_id, {corr('dvars', 'mov1')} AS fd_dvars_corr FROM (SELECT *, row_number() OVER (PARTITION BY scan_id ORDER BY t) AS i FROM motion JOIN (
        SELECT scan_id, t, sqrt(avg(x * x)) AS dvars FROM (SELECT scan_id, t, value - lag(value) OVER (PARTITION BY scan_id, voxel_id ORDER BY t) AS x FROM line) GROUP BY ALL) USING (scan_id, t)) WHERE i > 1 GROUP BY scan_id""")
def a22(spark, d):
    t = motion(spark, d).select("scan_id", "t", F.col("mov1").alias("fd"), F.lit(True).alias("keep")).join(aggregates.dvars(line(spark, d)), ["scan_id", "t"])
    return aggregates.fd_dvars_correlation(t)


@query("A23_variance_explained", "level voxel_id t", "ve", """
    SELECT 'total' AS level, NULL::BIGINT AS voxel_id, NULL::INT AS t, 1 - var_pop(residual) / var_pop(value) AS ve FROM residuals
    UNION ALL SELECT 'voxel', voxel_id, NULL, 1 - var_pop(residual) / nullif(var_pop(value), 0) FROM residuals GROUP BY voxel_id
    UNION ALL SELECT 'frame', NULL, t, 1 - var_pop(residual) / nullif(var_pop(value), 0) FROM residuals GROUP BY t""", (LINE_FIT, RESIDUALS))
def a23(spark, d):
    levels = aggregates.variance_explained_by(regress.detrend_line(bold(spark, d), 64), [], ["voxel_id"], ["t"])
    return levels.select(F.when(F.col("level") == 3, "total").when(F.col("level") == 1, "voxel").otherwise("frame").alias("level"), "voxel_id", "t", "ve")


@query("A24_weighted_ve", "scan_id", "ve", """
    SELECT 'emb' AS scan_id, sum(ve * n) / sum(n) AS ve FROM (SELECT z, count(DISTINCT voxel_id) AS n, 1 - var_pop(residual) / nullif(var_pop(value), 0) AS ve FROM residuals JOIN grid USING (voxel_id) GROUP BY z)""", (LINE_FIT, RESIDUALS))
def a24(spark, d):
    fit = regress.detrend_line(bold(spark, d), 64).join(grid(spark, d), "voxel_id")
    by = aggregates.variance_explained(fit, "scan_id", "z").join(grid(spark, d).groupBy("z").agg(F.count("*").alias("voxels")), "z")
    return aggregates.weighted_ve(by)


@query("A25_signal_covariance", "voxel_id", "cov", "SELECT voxel_id, avg(value * trace) AS cov FROM emb JOIN gs USING (t) GROUP BY voxel_id", (GS,))
def a25(spark, d):
    return qc.scan_features(bold(spark, d), tissues(spark, d))["covariance"]


@query("A26_signal_correlation", "voxel_id", "r", f"SELECT voxel_id, {corr('value', 'trace')} AS r FROM emb JOIN gs USING (t) GROUP BY voxel_id", (GS,))
def a26(spark, d):
    return qc.scan_features(bold(spark, d), tissues(spark, d))["correlation"]


@query("A27_tdof", "scan_id tdof", "", "SELECT scan_id, count(*) FILTER (WHERE mov1 < 25.5) - (count(*) FILTER (WHERE mov2 > 0.05) % 5 + 6) + count(*) FILTER (WHERE mov1 >= 25.5) % 4 AS tdof FROM motion GROUP BY scan_id")
def a27(spark, d):
    return tdof(spark, d)


def tdof(spark, d):
    kept = F.count_if(F.col("mov1") < 25.5)
    n = motion(spark, d).groupBy("scan_id").agg(kept.alias("frames"), (F.count_if(F.col("mov2") > 0.05) % 5).alias("aroma_removed"), (F.count_if(F.col("mov1") >= 25.5) % 4).alias("dropped"))
    return aggregates.degrees_of_freedom(n.withColumn("regressors", F.lit(6)))


@query("A28_display_bound", "voxel_id", "bound", "SELECT voxel_id, value AS bound FROM (SELECT *, row_number() OVER (PARTITION BY voxel_id ORDER BY value) AS r, count(*) OVER (PARTITION BY voxel_id) AS n FROM emb) WHERE r = floor(n * 0.99) + 1")
def a28(spark, d):
    return frames.value_at(bold(spark, d), 0.99, "voxel_id")


@query("A29_cosine_distance", "t", "distance", """
    SELECT t, 1 - sum(value * r) / nullif(sqrt(sum(value * value)) * sqrt(sum(r * r)), 0) AS distance FROM emb JOIN (SELECT voxel_id, (quantile_cont(value, 0.2::DOUBLE) + quantile_cont(value, 0.5::DOUBLE) + quantile_cont(value, 0.8::DOUBLE)) / 3 AS r FROM emb GROUP BY voxel_id) USING (voxel_id) GROUP BY t""")
def a29(spark, d):
    return qc.motion_report(bold(spark, d))["distance"]


def motion_design(spark, d, wanted=("mot_6",)):
    return series.to_design(regress.motion_regressors(motion(spark, d), list(wanted)))


@query("A30_motion_r2", "scan_id voxel_id", "r2", f"""
    SELECT scan_id, voxel_id, coalesce(({SHARE}) / nullif(sum(y * y), 0), 0) AS r2
    FROM (SELECT scan_id, t, voxel_id, value - avg(value) OVER (PARTITION BY scan_id, voxel_id) AS y FROM line) JOIN q USING (scan_id, t) GROUP BY scan_id, voxel_id""", (CENTRED, *orthogonal("centred", "scan_id", MOTION)), digits=5)  # fmt: skip
def a30(spark, d):
    return volumes.motion_r2(series.to_series(line(spark, d)), motion_design(spark, d))


@query("A31_spacing", "different", "least", "SELECT count(DISTINCT p_size) AS different, min(p_size)::DOUBLE AS least FROM part")
def a31(spark, d):
    return aggregates.spacing_summary(table(spark, d, "part").select(F.col("p_size").cast("double").alias("spacing")))


@query("A32_fan_in", "subject names", "", "SELECT subject, list_aggregate(list_sort(list(scan_id)), 'string_agg', ',') AS names FROM manifest GROUP BY subject")
def a32(spark, d):
    return aggregates.fan_in(views.manifest(spark, d), "scan_id", "subject").select("subject", F.array_join("all", ",").alias("names"))


@query("A33_network_activity", "scan_id t", "activity", """
    WITH n AS (SELECT scan_id, (voxel_id % 3)::INT AS network, t, avg(value) AS value FROM line GROUP BY ALL)
    SELECT scan_id, t, avg(abs(value / nullif(s, 0))) AS activity FROM n JOIN (SELECT scan_id, network, sqrt(avg(value * value)) AS s FROM n GROUP BY ALL) USING (scan_id, network) GROUP BY ALL""")
def a33(spark, d):
    n = line(spark, d).groupBy("scan_id", (F.col("voxel_id") % 3).cast("int").alias("network"), "t").agg(F.avg("value").alias("value"))
    return aggregates.network_activity(n)


WEIGHTS_SQL = """SELECT t AS comp, sum(abs(value)) AS total, sum(CASE WHEN label = 4 THEN abs(value) ELSE 0 END) AS edge, sum(CASE WHEN label = 2 THEN abs(value) ELSE 0 END) AS csf, sum(CASE WHEN label = 5 THEN abs(value) ELSE 0 END) AS outside FROM emb GROUP BY t"""


def weights(spark, d):
    tissue = atlas(spark, d).select("voxel_id", *[(F.col("label") == k).alias(n) for k, n in ((4, "edge"), (2, "csf"), (5, "outside"))])
    return aggregates.mask_weights(bold(spark, d).select(F.col("t").alias("comp"), "voxel_id", F.col("value").alias("weight")), tissue)


@query("A34_mask_weights", "comp", "total edge csf outside", WEIGHTS_SQL)
def a34(spark, d):
    return weights(spark, d)


# cleaning


@query("R1_ols_two_regressors", "voxel_id t", "residual", """
    SELECT voxel_id, t, value - ((c * p - b * q) / nullif(a * c - b * b, 0) * x1 + (a * q - b * p) / nullif(a * c - b * b, 0) * x2) AS residual FROM xy
    JOIN (SELECT voxel_id, sum(x1 * x1) AS a, sum(x1 * x2) AS b, sum(x2 * x2) AS c, sum(x1 * value) AS p, sum(x2 * value) AS q FROM xy GROUP BY voxel_id) USING (voxel_id)""",
    (("xy", "SELECT e.*, x1, x2 FROM emb e JOIN (SELECT t, avg(value) FILTER (WHERE label = 1) AS x1, avg(value) FILTER (WHERE label = 2) AS x2 FROM emb GROUP BY t) USING (t)"),))
def r1(spark, d):
    return regress.regress_two(bold(spark, d), two_signals(spark, d))


def two_signals(spark, d):
    return emb(spark, d).groupBy("scan_id", "t").agg(*[F.avg(F.when(F.col("label") == k, F.col("value"))).alias(f"x{k}") for k in (1, 2)])


@query("R1_ols_kernel", "voxel_id t", "residual", """
    SELECT voxel_id, t, value - ((c * p - b * q) / nullif(a * c - b * b, 0) * x1 + (a * q - b * p) / nullif(a * c - b * b, 0) * x2) AS residual FROM xy
    JOIN (SELECT voxel_id, sum(x1 * x1) AS a, sum(x1 * x2) AS b, sum(x2 * x2) AS c, sum(x1 * value) AS p, sum(x2 * value) AS q FROM xy GROUP BY voxel_id) USING (voxel_id)""",
    (("xy", "SELECT e.*, x1, x2 FROM emb e JOIN (SELECT t, avg(value) FILTER (WHERE label = 1) AS x1, avg(value) FILTER (WHERE label = 2) AS x2 FROM emb GROUP BY t) USING (t)"),))
def r1_kernel(spark, d):
    s = regress.signal_regressors(bold(spark, d), tissues(spark, d), ["WM_signal", "CSF_signal"])
    return series.to_bold(regress.regress(emb_series(spark, d), series.to_design(s))).withColumnRenamed("value", "residual")


def settled(source: str, keys: str, column: str, threshold: float = 2.5) -> str:
    """SQL of the frames kept once a trace's outliers no longer change: ``keys``, t, keep."""
    own = "list_transform(list_filter(list_zip(v, kept), lambda z: z[2]), lambda z: z[1])"
    return f"""WITH RECURSIVE per AS (SELECT {keys}, list(t ORDER BY t) AS ts, list({column} ORDER BY t) AS v FROM {source} WHERE {column} IS NOT NULL GROUP BY {keys}),
        turn AS (SELECT *, list_transform(v, lambda x: true) AS kept, 0 AS i FROM per UNION ALL
            SELECT {keys}, ts, v, now, i + 1 FROM (SELECT *, list_transform(v, lambda x: abs((x - m) / d) < {threshold}) AS now FROM (SELECT *, list_aggregate({own}, 'avg') AS m, list_aggregate({own}, 'stddev_pop') AS d FROM turn)) WHERE now <> kept)
        SELECT {keys}, unnest(ts) AS t, unnest(kept) AS keep FROM (SELECT * FROM turn QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY i DESC) = 1)"""


@query("R2_outlier_censoring", "scan_id t keep", "", settled("traces", "scan_id", "fd"))
def r2(spark, d):
    return regress.censor_outliers(traces(spark, d), "fd")


TRIMEAN = "(quantile_cont(value, 0.2::DOUBLE) + quantile_cont(value, 0.5::DOUBLE) + quantile_cont(value, 0.8::DOUBLE)) / 3"


@query("R3_combined_censoring", "scan_id t keep", "", """
    SELECT scan_id, t, keep FROM (SELECT scan_id, t, near.keep AND coalesce(d.keep, false) AND coalesce(m.keep, false) AS keep FROM (SELECT scan_id, t, NOT bool_or(mov1 >= 26.5) OVER (PARTITION BY scan_id ORDER BY t ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS keep FROM motion) near
        LEFT JOIN (SELECT * FROM outlying WHERE kind = 'dvars') d USING (scan_id, t) LEFT JOIN (SELECT * FROM outlying WHERE kind = 'mse') m USING (scan_id, t))
    QUALIFY count(*) FILTER (WHERE keep) OVER (PARTITION BY scan_id) >= 3""",
    (("changes", "SELECT 'dvars' AS kind, scan_id, t, sqrt(avg(c * c)) AS value FROM (SELECT scan_id, t, value - lag(value) OVER (PARTITION BY scan_id, voxel_id ORDER BY t) AS c FROM line) GROUP BY ALL"),
     ("distances", f"SELECT 'mse' AS kind, scan_id, t, avg((value - r) ** 2) AS value FROM line JOIN (SELECT scan_id, voxel_id, {TRIMEAN} AS r FROM line GROUP BY ALL) USING (scan_id, voxel_id) GROUP BY ALL"),
     ("both_kinds", "SELECT * FROM changes UNION ALL SELECT * FROM distances"), ("outlying", settled("both_kinds", "kind, scan_id", "value"))))
def r3(spark, d):
    b = line(spark, d)
    t = motion(spark, d).select("scan_id", "t", F.col("mov1").alias("fd")).join(aggregates.dvars(b), ["scan_id", "t"]).join(aggregates.mse_to_reference(b), ["scan_id", "t"])
    return regress.censor(t, 26.5, True, True)


@query("R4_match_after_trim", "scan_id kept", "", "SELECT scan_id, least(count(*) FILTER (WHERE t BETWEEN 5 AND 114), 50) AS kept FROM traces GROUP BY scan_id")
def r4(spark, d):
    keep = frames.trim_edges(traces(spark, d).withColumn("keep", F.lit(True)), 120, 5.0, 1.0)
    return frames.matched_frames(keep, 50).groupBy("scan_id").agg(F.count_if("keep").alias("kept"))


@query("R5_detrend_line", "voxel_id t", "residual intercept", "SELECT voxel_id, t, residual, a AS intercept FROM residuals", (LINE_FIT, RESIDUALS))
def r5(spark, d):
    return regress.detrend_line(bold(spark, d), 64)


@query("R5_detrend_interval", "voxel_id t", "value", """
    SELECT voxel_id, t, value - (a + b * (-32 + t * 64.0::DOUBLE / 63)) AS value FROM emb
    JOIN (SELECT voxel_id, regr_slope(value, -32 + t * 64.0::DOUBLE / 63) AS b, regr_intercept(value, -32 + t * 64.0::DOUBLE / 63) AS a FROM emb WHERE t BETWEEN 10 AND 49 AND t % 9 <> 0 GROUP BY voxel_id) USING (voxel_id) WHERE t % 9 <> 0""")
def r5_interval(spark, d):
    s = series.to_series(bold(spark, d).where("t % 9 <> 0"))
    return series.to_bold(regress.detrend(s, 64, 1, "10-50"))


@query("R5_detrend_quadratic", "voxel_id t", "value", """
    SELECT voxel_id, t, value - (s0 - c2 * s2) / 64 - a * s1 / s2 - c2 * a * a AS value FROM (SELECT *, (64 * sa - s2 * s0) / (64 * s4 - s2 * s2) AS c2 FROM (
        SELECT *, sum(value) OVER v AS s0, sum(a * value) OVER v AS s1, sum(a * a) OVER v AS s2, sum(a * a * value) OVER v AS sa, sum(a ** 4) OVER v AS s4 FROM (SELECT voxel_id, t, value, -32 + t * 64.0::DOUBLE / 63 AS a FROM emb) WINDOW v AS (PARTITION BY voxel_id)))""")
def r5_quadratic(spark, d):
    """The axis is symmetric, so its odd moments vanish and the line's slope is by itself."""
    return series.to_bold(regress.detrend(emb_series(spark, d), 64, 2))


@query("R6_motion_regressors", "scan_id name t", "value", " UNION ALL ".join(f"SELECT scan_id, '{c}' AS name, t, {c} AS value FROM motion" for c in ("mov1", "mov2", "mov3", "rot1", "rot2", "rot3")))
def r6(spark, d):
    return regress.motion_regressors(motion(spark, d), ["mot_6"])


@query("R7_motion_24", "scan_id name t", "value", " UNION ALL ".join(
    f"SELECT scan_id, '{c}{s}' AS name, t, {e} AS value FROM (SELECT scan_id, t, {c} AS v, coalesce({c} - lag({c}) OVER (PARTITION BY scan_id ORDER BY t), 0) AS w FROM motion)"
    for c in ("mov1", "mov2", "mov3", "rot1", "rot2", "rot3") for s, e in (("", "v"), ("_der", "w"), ("^2", "v * v"), ("_der^2", "w * w"))), digits=4)
def r7(spark, d):
    return regress.motion_regressors(regress.motion_24(motion(spark, d)), ["mot_24"])


@query("R8_signal_regressors", "name t", "value", "SELECT mask_name AS name, t, avg(value) AS value FROM emb JOIN tissues USING (voxel_id) GROUP BY ALL")
def r8(spark, d):
    return regress.signal_regressors(bold(spark, d), tissues(spark, d), ["WM_signal", "CSF_signal", "vascular_signal"])


def principal(source: str, most: int) -> tuple[tuple[str, str], ...]:
    """Views ending in ``parts``: scan_id, k, share, lev, the share of variance and each frame's leverage of the first k components of ``source``.

    A power of the frames' Gram matrix, squared fourteen times over, is the
    projection on its first component, whose diagonal is the leverage; the
    component is then taken off the matrix.
    """
    again = "list_transform(p, lambda r: list_transform(p, lambda s: list_inner_product(r, s) / tr))"
    less = "list_transform(m, lambda r, i: list_transform(r, lambda x, j: x - lam * p[i][j]))"
    return (
        ("shifted", f"SELECT scan_id, t, voxel_id, value - avg(value) OVER (PARTITION BY scan_id, voxel_id) AS c FROM {source}"),
        ("grams", "SELECT scan_id, list(r ORDER BY i) AS m, sum(r[n]) AS total FROM (SELECT scan_id, i, list(g ORDER BY j) AS r, row_number() OVER (PARTITION BY scan_id ORDER BY i) AS n FROM (SELECT a.scan_id, a.t AS i, b.t AS j, sum(a.c * b.c) AS g FROM shifted a JOIN shifted b USING (scan_id, voxel_id) GROUP BY ALL) GROUP BY scan_id, i) GROUP BY scan_id"),
        ("parts", f"""SELECT scan_id, k, share, lev FROM (WITH RECURSIVE pca AS (
            SELECT scan_id, m, list_transform(m, lambda r: list_transform(r, lambda x: x / total)) AS p, 0 AS n, 0 AS k, total, total AS rest, 0.0::DOUBLE AS share, list_transform(m, lambda r: 0.0::DOUBLE) AS lev FROM grams
            UNION ALL SELECT scan_id, CASE WHEN n < 14 THEN m ELSE {less} END, CASE WHEN n < 14 THEN {again} ELSE list_transform(m, lambda r, i: list_transform(r, lambda x, j: (x - lam * p[i][j]) / (rest - lam))) END,
                (n + 1) % 15, k + n // 14, total, CASE WHEN n < 14 THEN rest ELSE rest - lam END, CASE WHEN n < 14 THEN share ELSE share + lam / total END, CASE WHEN n < 14 THEN lev ELSE list_transform(lev, lambda x, i: x + p[i][i]) END
            FROM (SELECT *, list_sum(list_transform(p, lambda r: list_inner_product(r, r))) AS tr, list_sum(list_transform(m, lambda r, i: list_inner_product(r, p[i]))) AS lam FROM pca WHERE k < {most})) SELECT * FROM pca WHERE n = 0)"""),
    )


TISSUE_SCAN = ("tissue_scan", "SELECT 'emb' AS scan_id, t, voxel_id, value FROM emb WHERE voxel_id IN (SELECT voxel_id FROM tissues WHERE mask_name <> 'vascular_signal')")
LEVERAGE = "SELECT scan_id, unnest(range(len(lev)))::INT AS t, unnest(lev) AS value FROM parts WHERE "
HALF = "share > 0.5 AND k = (SELECT min(k) FROM parts q WHERE q.scan_id = parts.scan_id AND q.share > 0.5)"


def leverage(x):
    """scan_id, t and the diagonal of the projection on the regressors: as they have no common length or sign, only this is theirs."""
    def one(row):
        u = np.linalg.qr(np.array([list(r) for r in row["x"]], float).T)[0]
        yield from ((row["scan_id"], t, float(v)) for t, v in enumerate((u**2).sum(axis=1)))

    return series.per_row(x, one, "scan_id string, t int, value double")


@query("R9_component_regressors", "scan_id t", "value", LEVERAGE + "k = 5", (TISSUE_SCAN, *principal("tissue_scan", 5)))
def r9(spark, d):
    return leverage(regress.component_regressors(emb_series(spark, d), tissues(spark, d).where("mask_name <> 'vascular_signal'")))


@query("O3_first_components", "scan_id t", "value", LEVERAGE + "k = 3", principal("line", 3))
def o3(spark, d):
    """Over all voxels of each scan; those of ``line`` all have a label."""
    return leverage(regress.component_regressors(series.to_series(line(spark, d)), atlas(spark, d), components=3))


@query("R9_component_regressors_percent", "scan_id t", "value", LEVERAGE + HALF, (TISSUE_SCAN, *principal("tissue_scan", 20)))
def r9_percent(spark, d):
    return leverage(regress.component_regressors(emb_series(spark, d), tissues(spark, d).where("mask_name <> 'vascular_signal'"), percent=True))


@query("R10_rank_guard", "scan_id regressors", "", """
    SELECT scan_id || other AS scan_id, CASE WHEN 1 - sum(a * b) ** 2 / (sum(a * a) * sum(b * b)) > 1e-12 THEN 2 ELSE 0 END::INT AS regressors
    FROM (SELECT scan_id, '/twice' AS other, mov1 AS a, 2 * mov1 AS b FROM motion UNION ALL SELECT scan_id, '/free', mov1, mov2 FROM motion) GROUP BY ALL""")
def r10(spark, d):
    m = motion(spark, d)
    pair = lambda other, b: m.select(F.concat("scan_id", F.lit(other)).alias("scan_id"), "t", F.explode(F.array(F.struct(F.lit("a").alias("name"), F.col("mov1").alias("value")), F.struct(F.lit("b").alias("name"), b.alias("value")))).alias("p")).select("scan_id", "p.name", "t", "p.value")
    both = pair("/twice", F.col("mov1") * 2).union(pair("/free", F.col("mov2")))
    return regress.checked_rank(series.to_design(both)).select("scan_id", F.size("x").alias("regressors"))


@query("R11_gap_fill", "voxel_id t", "value", """
    SELECT voxel_id, t, coalesce(x, (m - mo) * sx / so + mx) AS value FROM (SELECT *, avg(m) FILTER (WHERE x IS NOT NULL) OVER v AS mo, stddev_pop(m) FILTER (WHERE x IS NOT NULL) OVER v AS so, avg(x) OVER v AS mx, stddev_pop(x) OVER v AS sx FROM (
        SELECT voxel_id, t, any_value(x) AS x, sum(c * pc + s * ps) AS m FROM waves JOIN parts USING (k) JOIN (SELECT voxel_id, t, CASE WHEN t NOT IN (5, 6, 20, 41, 42, 43) THEN value END AS x FROM emb) USING (voxel_id, t) GROUP BY voxel_id, t) WINDOW v AS (PARTITION BY voxel_id))""",
    (("harmonics", "SELECT k, w, atan2(sum(sin(2 * w * (t + 1))), sum(cos(2 * w * (t + 1)))) / (2 * w) AS shift FROM (SELECT k, k * pi() / 32 AS w, t FROM (SELECT unnest(range(1, 33)) AS k), (SELECT unnest(range(64)) AS t)) WHERE t NOT IN (5, 6, 20, 41, 42, 43) GROUP BY k, w"),
     ("waves", "SELECT k, t::INT AS t, cos(w * (t + 1) - w * shift) AS c, sin(w * (t + 1) - w * shift) AS s FROM harmonics, (SELECT unnest(range(64)) AS t)"),
     ("parts", "SELECT k, voxel_id, CASE WHEN sum(c * c) > 58e-9 THEN sum(c * value) / sum(c * c) ELSE 0 END AS pc, CASE WHEN sum(s * s) > 58e-9 THEN sum(s * value) / sum(s * s) ELSE 0 END AS ps FROM waves JOIN emb USING (t) WHERE t NOT IN (5, 6, 20, 41, 42, 43) GROUP BY ALL")))
def r11(spark, d):
    return series.to_bold(regress.fill_gaps(series.to_series(bold(spark, d).where("t NOT IN (5, 6, 20, 41, 42, 43)")), 64, 1.0))


def filtered(source: str) -> str:
    """SQL of lists x run through the band filter once and turned round: voxel_id, x.

    A low-pass of order three, 1 / ((s + 1)(s^2 + s + 1)), whose s becomes
    q / r, with q and r of degree two in z: r / (q + r), then
    r^2 / (q^2 + qr + r^2).  Before its start a list was always at its first
    value, to which the filter gives 0.
    """
    zeros = "[0.0::DOUBLE, 0, 0, 0]"
    return f"""SELECT voxel_id, list_reverse(b[5:]) AS x FROM (WITH RECURSIVE run AS (SELECT voxel_id, x, {zeros} AS a, {zeros} AS b, 0 AS n FROM {source} UNION ALL
        SELECT voxel_id, x, list_append(a, y), list_append(b, (r * r * (y - 2 * a[i + 2] + a[i]) - 2 * b[i + 3] * (q0 * q1 + r * q1 / 2) - b[i + 2] * (2 * q0 * q0 + q1 * q1 - 2 * r * r) - 2 * b[i + 1] * (q0 * q1 - r * q1 / 2) - b[i] * (q0 * q0 - q0 * r + r * r)) / (q0 * q0 + q0 * r + r * r)), i
        FROM (SELECT *, (r * (x[i] - x[greatest(i - 2, 1)]) - q1 * a[i + 3] - (q0 - r) * a[i + 2]) / (q0 + r) AS y FROM (SELECT *, n + 1 AS i FROM run, band WHERE n < len(x)))) SELECT * FROM run WHERE n = len(x))"""


BAND = ("band", "SELECT 16 + lo * hi AS q0, 2 * lo * hi - 32 AS q1, 4 * (hi - lo) AS r FROM (SELECT 4 * tan(pi() * 0.01) AS lo, 4 * tan(pi() * 0.1) AS hi)")
WIDE = ("wide", "SELECT voxel_id, list_concat(list_transform(range(21, 0, -1), lambda j: 2 * v[1] - v[j + 1]), v, list_transform(range(62, 41, -1), lambda j: 2 * v[64] - v[j + 1])) AS x FROM (SELECT voxel_id, list(value ORDER BY t) AS v FROM emb GROUP BY voxel_id)")


@query("R12_butterworth", "voxel_id t", "value", "SELECT voxel_id, unnest(range(64))::INT AS t, unnest(x[22:85]) AS value FROM back", (BAND, WIDE, ("forth", filtered("wide")), ("back", filtered("forth"))))
def r12(spark, d):
    return series.to_bold(regress.band_filter(emb_series(spark, d), 1.0, 0.01, 0.1))


REGRESSED = "SELECT voxel_id, t, value - coalesce(b, 0) * trace AS value FROM emb JOIN gs USING (t) JOIN (SELECT voxel_id, sum(trace * value) / nullif(sum(trace * trace), 0) AS b FROM emb JOIN gs USING (t) GROUP BY voxel_id) USING (voxel_id)"


@query("R13_nuisance_regression", "voxel_id t", "value", REGRESSED, (GS,))
def r13(spark, d):
    b = bold(spark, d)
    x = aggregates.global_signal(b).withColumnRenamed("value", "x")
    return regress.regress_one(b, x).select("voxel_id", "t", F.col("residual").alias("value"))


TREND = "(sum(a * {0}) OVER v - sum({0}) OVER v * avg(a) OVER v) / (sum(a * a) OVER v - sum(a) OVER v * avg(a) OVER v)"
DETRENDED = lambda columns, source, keys: "SELECT * EXCLUDE (a) REPLACE (" + ", ".join(f"{c} - avg({c}) OVER v - (a - avg(a) OVER v) * {TREND.format(c)} AS {c}" for c in columns) + f") FROM (SELECT *, t::DOUBLE AS a FROM {source}) WINDOW v AS (PARTITION BY {keys})"
PREDICTED = " + ".join(f"{c} * coalesce(sum({c} * value) OVER v / nullif(sum({c} * {c}) OVER v, 0), 0)" for c in MOTION)


@query("R13_motion_not_subtracted", "scan_id voxel_id t", "value predicted", f"SELECT scan_id, voxel_id, t, value, {PREDICTED} AS predicted FROM flat JOIN q USING (scan_id, t) WINDOW v AS (PARTITION BY scan_id, voxel_id)",
       (("flat", DETRENDED(["value"], "line", "scan_id, voxel_id")), ("moves", DETRENDED(MOTION, "motion", "scan_id")), *orthogonal("moves", "scan_id", MOTION)), digits=2)
def r13_motion(spark, d):
    """With no regressors asked for, motion is fitted for its share of variance, and the series stay as they are."""
    b, m = line(spark, d), motion(spark, d)
    fd = m.select("scan_id", "t", F.lit(0.0).alias("fd"))
    fit = regress.clean(b, b.select("voxel_id").distinct(), m, fd, views.line_frames(spark, d))["fit"]
    rows = fit.select("scan_id", "voxel_id", F.explode(F.arrays_zip("t", "v", "predicted")).alias("z"))
    return rows.select("scan_id", "voxel_id", "z.t", F.col("z.v").alias("value"), "z.predicted")


@query("R13_motion_subtracted", "scan_id voxel_id t", "value", f"SELECT scan_id, voxel_id, t, value - ({PREDICTED}) AS value FROM flat JOIN q USING (scan_id, t) WINDOW v AS (PARTITION BY scan_id, voxel_id)",
       (("flat", DETRENDED(["value"], "line", "scan_id, voxel_id")), ("moves", DETRENDED(MOTION, "motion", "scan_id")), *orthogonal("moves", "scan_id", MOTION)), digits=2)
def r13_subtracted(spark, d):
    b, m = line(spark, d), motion(spark, d)
    fd = m.select("scan_id", "t", F.lit(0.0).alias("fd"))
    return regress.clean(b, b.select("voxel_id").distinct(), m, fd, views.line_frames(spark, d), regressors=("mot_6",))["bold"]


@query("R14_slicewise", "voxel_id t", "value", """
    SELECT voxel_id, t, value - coalesce(b, 0) * x AS value FROM xy JOIN (SELECT voxel_id, sum(x * value) / nullif(sum(x * x), 0) AS b FROM xy GROUP BY voxel_id) USING (voxel_id)""",
    (("xy", "SELECT e.voxel_id, e.t, e.value, s.m AS x FROM emb e JOIN grid g USING (voxel_id) JOIN (SELECT z, t, avg(value) AS m FROM emb JOIN grid USING (voxel_id) GROUP BY ALL) s ON g.z = s.z AND e.t = s.t"),))
def r14(spark, d):
    sliced = regress.by_slice(emb_series(spark, d), grid(spark, d), "SI")
    own = sliced.select("scan_id", "voxel_id", "t", "v")
    x = aggregates.global_signal(series.to_bold(own)).select("scan_id", F.lit("global").alias("name"), "t", "value")
    return series.to_bold(regress.regress(own, series.to_design(x)))


@query("R15_null_regressors", "scan_id t", "value")
def r15(spark, d):
    m = motion(spark, d)
    keep = m.select("scan_id", "t", F.lit(True).alias("keep"))
    centred = regress.motion_regressors(m, ["mot_6"])
    mean = centred.groupBy("scan_id", "name").agg(F.avg("value").alias("m"))
    centred = centred.join(mean, ["scan_id", "name"]).select("scan_id", "name", "t", (F.col("value") - F.col("m")).alias("value"))
    return leverage(regress.null_design(series.to_design(centred), keep, 1.0))


@query("R16_corrected_std", "voxel_id", "value", """
    SELECT voxel_id, sqrt(greatest(var_pop(trace * b) - var_pop(other * c), 0)) AS value FROM null_traces JOIN (
        SELECT voxel_id, sum(trace * value) / sum(trace * trace) AS b, sum(other * value) / sum(other * other) AS c FROM emb JOIN null_traces USING (t) GROUP BY voxel_id) ON true GROUP BY voxel_id""",
    (GS, ("null_traces", "SELECT a.t, a.trace, b.trace AS other FROM gs a JOIN gs b ON a.t = 63 - b.t")))
def r16(spark, d):
    """Real: the global signal.  Random: the same backward in time."""
    b = bold(spark, d)
    x = aggregates.global_signal(b).withColumnRenamed("value", "x")
    fits = [regress.regress_one(b, g).select("scan_id", "voxel_id", F.col("predicted").alias("value")) for g in (x, x.withColumn("t", 63 - F.col("t")))]
    return regress.corrected_std(*fits)


SCALING = {
    "global_variance": "value / (SELECT nullif(stddev_pop(value), 0) FROM emb)",
    "grand_mean_scaling": "value / (SELECT nullif(avg(a) / 100, 0) FROM linefit)",
    "voxelwise_standardization": "coalesce(value / nullif(stddev_pop(value) OVER (PARTITION BY voxel_id), 0), 0)",
}


def _scaling(how, sql):
    @query(f"R17_{how}", "voxel_id t", "value", f"SELECT voxel_id, t, {sql} AS value FROM emb", (LINE_FIT,), digits=4)
    def r17(spark, d):
        b = bold(spark, d)
        return regress.scaled(b, how, regress.detrend_line(b, 64).select("scan_id", "voxel_id", "intercept").distinct())


for _how, _sql in SCALING.items():
    _scaling(_how, _sql)


@query("R17_voxelwise_mean", "scan_id voxel_id t", "value", "SELECT scan_id, voxel_id, t, coalesce(value / nullif(m / 100, 0), 0) AS value FROM line JOIN (SELECT scan_id, voxel_id, avg(value) AS m FROM line GROUP BY ALL) USING (scan_id, voxel_id)", digits=4)
def r17_mean(spark, d):
    b = line(spark, d)
    return regress.scaled(b, "voxelwise_mean", b.groupBy("scan_id", "voxel_id").agg(F.avg("value").alias("intercept")))


@query("R18_homogenized", "voxel_id t", "value", """
    SELECT voxel_id, t, e / (SELECT stddev_pop(e) FROM even) * (SELECT stddev_pop(value) FROM emb) AS value FROM even""",
    (("even", "SELECT voxel_id, t, coalesce(value / nullif(stddev_pop(value) OVER (PARTITION BY voxel_id), 0), 0) AS e FROM emb"),))
def r18(spark, d):
    return regress.homogenized(bold(spark, d))


@query("R19_smoothing", "voxel_id t", "value", """
    SELECT a.voxel_id, b.t, sum(w * b.value) / sum(w) AS value FROM (
        SELECT p.voxel_id, o.voxel_id AS other, exp(-0.5 * ((p.x - o.x) ** 2 + (p.y - o.y) ** 2 + (p.z - o.z) ** 2) * 8 * ln(2) / 4) AS w FROM grid p JOIN grid o ON abs(p.x - o.x) <= 3 AND abs(p.y - o.y) <= 3 AND abs(p.z - o.z) <= 3) a
    JOIN emb b ON b.voxel_id = a.other GROUP BY a.voxel_id, b.t""")
def r19(spark, d):
    return regress.smoothed(bold(spark, d), grid(spark, d), 2.0)


@query("R20_average_restored", "voxel_id t", "value", "SELECT voxel_id, t, residual + a AS value FROM residuals", (LINE_FIT, RESIDUALS))
def r20(spark, d):
    fit = regress.detrend_line(bold(spark, d), 64)
    return regress.with_average(fit.select("scan_id", "t", "voxel_id", F.col("residual").alias("value")), fit.select("scan_id", "voxel_id", "intercept").distinct())


@query("R21_clean", "voxel_id t", "value", """
    WITH signal AS (SELECT t, avg(residual) AS x FROM residuals WHERE voxel_id IN (SELECT voxel_id FROM tissues WHERE mask_name = 'WM_signal') GROUP BY t),
    fit AS (SELECT voxel_id, sum(x * residual) / sum(x * x) AS b FROM residuals JOIN signal USING (t) GROUP BY voxel_id),
    final AS (SELECT voxel_id, t, residual - b * x AS value FROM residuals JOIN signal USING (t) JOIN fit USING (voxel_id))
    SELECT voxel_id, t, value / (SELECT stddev_pop(value) FROM final) AS value FROM final""", (LINE_FIT, RESIDUALS), digits=4)
def r21(spark, d):
    b = bold(spark, d)
    fd = b.where("voxel_id = 0").select("scan_id", "t", F.lit(0.0).alias("fd"))
    moves = fd.select("scan_id", "t", *[F.lit(0.0).alias(c) for c in regress.MOTION_6])
    out = regress.clean(b, atlas(spark, d), moves, fd, 64, regressors=("WM_signal",), tissue=tissues(spark, d), scaling="global_variance")
    return out["bold"]


@query("R21_clean_filtered", "voxel_id t", "value")
def r21_filtered(spark, d):
    b = bold(spark, d)
    fd = b.where("voxel_id = 0").select("scan_id", "t", F.when(F.col("t") == 30, 1.0).otherwise(0.0).alias("fd"))
    moves = fd.select("scan_id", "t", *[F.sin(F.col("t") * (k + 1) * 0.21).alias(c) for k, c in enumerate(regress.MOTION_6)])
    out = regress.clean(b, atlas(spark, d), moves, fd, 64, fd_threshold=0.5, use_dvars=True, use_mse=True, low_pass=0.2, high_pass=0.01, edge_seconds=2.0, regressors=("mot_6", "aCompCor_5"), tissue=tissues(spark, d), even_variance=True, keep_average=True)
    return out["bold"]


# connectivity


@query("C1_seed_map", "seed_name voxel_id", "r", f"SELECT 'seed' AS seed_name, voxel_id, coalesce({corr('value', 's')}, 0) AS r FROM emb JOIN (SELECT t, avg(value) AS s FROM emb WHERE label = 0 GROUP BY t) USING (t) GROUP BY voxel_id")
def c1(spark, d):
    return connect.seed_maps(bold(spark, d), label_mask(spark, d, 0).select(F.lit("seed").alias("seed_name"), "voxel_id"))


@query("C2_roi_matrix", "roi_i roi_j", "r", f"""
    WITH roi AS (SELECT label, t, avg(value) AS value FROM emb GROUP BY ALL)
    SELECT a.label::VARCHAR AS roi_i, b.label::VARCHAR AS roi_j, {corr('a.value', 'b.value')} AS r FROM roi a JOIN roi b USING (t) GROUP BY ALL""")
def c2(spark, d):
    return connect.roi_matrix(bold(spark, d), atlas(spark, d))


@query("C3_voxel_matrix", "scan_id voxel_i voxel_j", "r", f"SELECT scan_id, a.voxel_id AS voxel_i, b.voxel_id AS voxel_j, {corr('a.value', 'b.value')} AS r FROM line a JOIN line b USING (scan_id, t) GROUP BY ALL", digits=5)
def c3(spark, d):
    return connect.voxel_matrix(series.to_series(line(spark, d)), 16)


TWO = ("two", "SELECT voxel_id, avg(value) FILTER (WHERE t < 32) AS w1, avg(value) FILTER (WHERE t >= 32) AS w2 FROM emb GROUP BY voxel_id")
DUAL = """
    g AS (SELECT sum(w1 * w1) AS a, sum(w1 * w2) AS b, sum(w2 * w2) AS c FROM two),
    p AS (SELECT t, sum(w1 * value) AS p, sum(w2 * value) AS q FROM emb JOIN two USING (voxel_id) GROUP BY t),
    raw AS (SELECT t, (c * p - b * q) / (a * c - b * b) AS u, (a * q - b * p) / (a * c - b * b) AS v FROM p, g),
    w AS (SELECT t, u / (SELECT sqrt(avg(u * u)) FROM raw) AS u, v / (SELECT sqrt(avg(v * v)) FROM raw) AS v FROM raw),
    h AS (SELECT sum(u * u) AS a, sum(u * v) AS b, sum(v * v) AS c FROM w),
    m AS (SELECT voxel_id, sum(u * value) AS p, sum(v * value) AS q FROM emb JOIN w USING (t) GROUP BY voxel_id),
    c AS (SELECT voxel_id, (c * p - b * q) / (a * c - b * b) AS m1, (a * q - b * p) / (a * c - b * b) AS m2 FROM m, h)"""


def dual(spark, d):
    two = emb(spark, d).groupBy("voxel_id").agg(F.avg(F.when(F.col("t") < 32, F.col("value"))).alias("w1"), F.avg(F.when(F.col("t") >= 32, F.col("value"))).alias("w2"))
    return connect.dual_regression(emb_series(spark, d), two.unpivot("voxel_id", ["w1", "w2"], "c", "weight").select(F.substring("c", 2, 1).cast("int").alias("comp"), "voxel_id", "weight"))


@query("C4_dual_regression_maps", "comp voxel_id", "value", f"WITH {DUAL.strip()} SELECT 1 AS comp, voxel_id, m1 / (SELECT sqrt(avg(m1 * m1)) FROM c) AS value FROM c UNION ALL SELECT 2, voxel_id, m2 / (SELECT sqrt(avg(m2 * m2)) FROM c) FROM c", (TWO,))
def c4_maps(spark, d):
    return dual(spark, d)["maps"]


@query("C4_dual_regression_traces", "comp t", "value", f"WITH {DUAL.strip()} SELECT 1 AS comp, t, u AS value FROM w UNION ALL SELECT 2, t, v FROM w", (TWO,))
def c4_traces(spark, d):
    return dual(spark, d)["traces"]


@query("C5_weighted_maps", "comp voxel_id", "value", f"WITH {DUAL.strip()} SELECT 1 AS comp, voxel_id, m1 AS value FROM c UNION ALL SELECT 2, voxel_id, m2 FROM c", (TWO,))
def c5(spark, d):
    f = dual(spark, d)
    return connect.weighted_maps(f["maps"], f["amplitudes"])


def one_prior(spark, d):
    return emb(spark, d).where("t < 32").groupBy("voxel_id").agg(F.avg("value").alias("weight")).select(F.lit(1).alias("comp"), "voxel_id", "weight")


@query("C6_alternating_fit", "scan_id kind comp idx", "value")
def c6(spark, d):
    return connect.alternating_fit(emb_series(spark, d), 2, one_prior(spark, d))


@query("C7_prior_recovery", "scan_id kind comp idx", "value")
def c7(spark, d):
    return connect.prior_recovery(emb_series(spark, d), one_prior(spark, d), 1, 1)


@query("C8_dimension_search", "scan_id i temporal spatial chosen", "corr diff")
def c8(spark, d):
    return connect.dimension_search(emb_series(spark, d), one_prior(spark, d))


@query("C9_group_components", "comp voxel_id", "value")
def c9(spark, d):
    return connect.group_components(series.to_series(line(spark, d)), 3)


@query("M1_scan_components", "scan_id kind comp idx", "value")
def m1(spark, d):
    return connect.scan_components(series.to_series(line(spark, d)), 3)


# Eigenvalues of a symmetric 3 x 3 matrix by the cosine formula; evidence of one and of two components.
SPECTRUM = (
    ("three", "SELECT label, voxel_id, " + ", ".join(f"avg(value) FILTER (WHERE t % 3 = {k}) AS f{k}" for k in range(3)) + " FROM emb GROUP BY ALL"),
    ("cov", "SELECT label, count(*) AS n, " + ", ".join(f"covar_pop(f{i}, f{j}) AS c{i}{j}" for i in range(3) for j in range(i, 3)) + " FROM three GROUP BY label"),
    ("mid", "SELECT *, (c00 + c11 + c22) / 3 AS q, sqrt(((c00 - (c00 + c11 + c22) / 3) ** 2 + (c11 - (c00 + c11 + c22) / 3) ** 2 + (c22 - (c00 + c11 + c22) / 3) ** 2 + 2 * (c01 ** 2 + c02 ** 2 + c12 ** 2)) / 6) AS p FROM cov"),
    ("turned", "SELECT *, acos(greatest(-1, least(1, ((c00 - q) * ((c11 - q) * (c22 - q) - c12 ** 2) - c01 * (c01 * (c22 - q) - c12 * c02) + c02 * (c01 * c12 - (c11 - q) * c02)) / (2 * p ** 3)))) / 3 AS phi FROM mid"),
    ("lam", "SELECT label, n, q + 2 * p * cos(phi) AS a, 3 * q - (q + 2 * p * cos(phi)) - (q + 2 * p * cos(phi + 2 * pi() / 3)) AS b, q + 2 * p * cos(phi + 2 * pi() / 3) AS c FROM turned"),
)
ONE = """-ln(2) + lgamma(1.5) - 1.5 * ln(pi()) - n / 2.0 * ln(a) - n * ln((b + c) / 2) + 1.5 * ln(2 * pi())
    - (ln((2 / (b + c) - 1 / a) * (a - b)) + ln((2 / (b + c) - 1 / a) * (a - c)) + 2 * ln(n)) / 2 - ln(n) / 2"""
TWO = """-2 * ln(2) + lgamma(1.5) - 2.5 * ln(pi()) - n / 2.0 * (ln(a) + ln(b) + ln(c)) + 2.5 * ln(2 * pi())
    - (ln((1 / b - 1 / a) * (a - b)) + ln((1 / c - 1 / a) * (a - c)) + ln((1 / c - 1 / b) * (b - c)) + 3 * ln(n)) / 2 - ln(n)"""


@query("C9_model_order", "scan_id components", "", f"SELECT label::VARCHAR AS scan_id, CASE WHEN {TWO} > {ONE} THEN 2 ELSE 1 END::INT AS components FROM lam", SPECTRUM)
def c9_model_order(spark, d):
    """Of the voxels of each label, over three frames that average all components of the vectors."""
    three = [F.avg(F.when(F.col("t") % 3 == k, F.col("value"))) for k in range(3)]
    data = emb(spark, d).groupBy(F.col("label").cast("string").alias("scan_id"), "voxel_id").agg(F.array(*three).alias("v"))
    return connect.model_orders(data)


@query("C9_group_components_by_evidence", "comp voxel_id", "value")
def c9_order(spark, d):
    return connect.group_components(series.to_series(line(spark, d)))


@query("M1_scan_components_by_evidence", "scan_id kind comp idx", "value")
def m1_order(spark, d):
    return connect.scan_components(series.to_series(line(spark, d)))


@query("M1_active_maps", "scan_id comp voxel_id", "value")
def m1_active(spark, d):
    """Every frame of the vectors as a map, cut to what the mixture calls active."""
    maps = bold(spark, d).select("scan_id", F.col("t").alias("comp"), "voxel_id", "value")
    return aroma.active(maps, aroma.mixtures(maps))


@query("M3_fractions_of_active_maps", "comp", "edge_fraction csf_fraction")
def m3_active(spark, d):
    tissue = atlas(spark, d).select("voxel_id", *[(F.col("label") == k).alias(n) for k, n in ((4, "edge"), (2, "csf"), (5, "outside"))])
    return aroma.fractions(aggregates.mask_weights(m1_active(spark, d).select("comp", "voxel_id", F.col("value").alias("weight")), tissue))


@query("C10_edge_mask", "voxel_id", "", """
    SELECT a.voxel_id FROM part a WHERE a.x > 0 AND a.y > 0 AND a.z > 0 AND EXISTS (
        SELECT 1 FROM (SELECT unnest(range((SELECT max(x) + 1 FROM part)))::INT AS x) JOIN (SELECT unnest(range((SELECT max(y) + 1 FROM part)))::INT AS y) ON true JOIN (SELECT unnest(range((SELECT max(z) + 1 FROM part)))::INT AS z) ON true
        LEFT JOIN part b USING (x, y, z) WHERE b.voxel_id IS NULL AND abs(a.x - x) <= 1 AND abs(a.y - y) <= 1 AND abs(a.z - z) <= 1)""",
    (("part", "SELECT * FROM grid WHERE (x - 5) ** 2 + (y - 5) ** 2 < 17"),))
def c10(spark, d):
    return volumes.edge_mask(grid(spark, d).where("pow(x - 5, 2) + pow(y - 5, 2) < 17"))


@query("C11_tissue_masks", "mask_name voxel_id", "", """
    SELECT tissue AS mask_name, voxel_id FROM own UNION ALL
    SELECT a.tissue || '_eroded', a.voxel_id FROM own a JOIN own b ON a.tissue = b.tissue AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 AND abs(a.z - b.z) <= 1 GROUP BY ALL HAVING count(*) = 27""",
    (("own", "SELECT CASE WHEN y < 6 THEN 'GM' ELSE 'WM' END AS tissue, voxel_id, x, y, z FROM grid"),))
def c11(spark, d):
    g = grid(spark, d)
    mapping = spark.createDataFrame([(0, "GM"), (1, "WM")], "label int, tissue string")
    return volumes.tissue_masks(g.select("voxel_id", (F.col("y") >= 6).cast("int").alias("label")), mapping, g)


# component features


@query("M2_motion_correlation", "scan_id comp", "max_rp_corr")
def m2(spark, d):
    parts = line(spark, d).groupBy("scan_id", (F.col("voxel_id") % 3).cast("int").alias("comp"), "t").agg(F.avg("value").alias("value"))
    return aroma.max_motion_correlation(parts, aroma.motion_model(motion(spark, d)))


FRACTIONS = "CASE WHEN total = 0 THEN 0 WHEN total = csf THEN 1 ELSE (outside + edge) / (total - csf) END AS edge_fraction, CASE WHEN total = 0 THEN 0 WHEN total = csf THEN 1 ELSE csf / total END AS csf_fraction"


@query("M3_fractions", "comp", "edge_fraction csf_fraction", f"SELECT comp, {FRACTIONS} FROM ({WEIGHTS_SQL})")
def m3(spark, d):
    return aroma.fractions(weights(spark, d))


HFC = """SELECT comp, (arg_min(frequency, (d, frequency)) - 0.01) / (0.5 - 0.01) AS hfc FROM (
    SELECT comp, frequency, abs(sum(power) OVER (PARTITION BY comp ORDER BY frequency ROWS UNBOUNDED PRECEDING) / sum(power) OVER (PARTITION BY comp) - 0.5) AS d FROM (
        SELECT voxel_id AS comp, (t + 1) / 128.0::DOUBLE AS frequency, value * value AS power FROM emb) WHERE frequency > 0.01) GROUP BY comp"""


def power(spark, d):
    return bold(spark, d).select(F.col("voxel_id").alias("comp"), ((F.col("t") + 1) / 128.0).alias("frequency"), (F.col("value") * F.col("value")).alias("power"))


@query("M4_high_frequency", "comp", "hfc", HFC)
def m4(spark, d):
    return aroma.high_frequency_content(power(spark, d), 1.0)


@query("W5_cumulative_power", "comp frequency", "share", "SELECT voxel_id AS comp, (t + 1) / 128.0::DOUBLE AS frequency, sum(value * value) OVER (PARTITION BY voxel_id ORDER BY t ROWS UNBOUNDED PRECEDING) / sum(value * value) OVER (PARTITION BY voxel_id) AS share FROM emb")
def w5(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("comp")
    return power(spark, d).withColumn("share", F.sum("power").over(w.orderBy("frequency").rowsBetween(Window.unboundedPreceding, 0)) / F.sum("power").over(w))


@query("W6_cumulative_variance", "scan_id components", "", f"SELECT scan_id, k::INT AS components FROM parts WHERE {HALF}", (TISSUE_SCAN, *principal("tissue_scan", 20)))
def w6(spark, d):
    x = regress.component_regressors(emb_series(spark, d), tissues(spark, d).where("mask_name <> 'vascular_signal'"), percent=True)
    return x.select("scan_id", F.size("x").alias("components"))


FEATURES = f"SELECT comp, edge_fraction, csf_fraction, hfc, (comp % 10) / 10.0::DOUBLE AS max_rp_corr FROM (SELECT comp, {FRACTIONS} FROM ({WEIGHTS_SQL})) JOIN ({HFC}) USING (comp)"


CLASSIFIED = f"SELECT comp, -14 + 9.95127547670627::DOUBLE * max_rp_corr + 24.8333160239175::DOUBLE * edge_fraction > 0 OR csf_fraction > 0.1 OR hfc > 0.6 AS noise, max_rp_corr FROM ({FEATURES})"


def classified_components(spark, d):
    f = aroma.fractions(weights(spark, d)).join(aroma.high_frequency_content(power(spark, d), 1.0), "comp")
    return aroma.classified(f.withColumn("max_rp_corr", (F.col("comp") % 10) / 10.0))


@query("M5_classifier", "comp noise", "", f"SELECT comp, noise FROM ({CLASSIFIED})")
def m5(spark, d):
    return classified_components(spark, d)


@query("K7_component_report", "ic noise", "max_rp_corr", f"SELECT (comp + 1)::INT AS ic, noise, max_rp_corr FROM ({CLASSIFIED})")
def k7(spark, d):
    folder = work_dir(spark, "components")
    tables.write_component_report(classified_components(spark, d), folder)
    return tables.read_component_overview(spark, folder)


@query("M6_denoise", "voxel_id t", "value", """
    SELECT voxel_id, t, value - (a * q - b * p) / nullif(a * c - b * b, 0) * x2 AS value FROM xy
    JOIN (SELECT voxel_id, sum(x1 * x1) AS a, sum(x1 * x2) AS b, sum(x2 * x2) AS c, sum(x1 * value) AS p, sum(x2 * value) AS q FROM xy GROUP BY voxel_id) USING (voxel_id)""",
    (("xy", "SELECT e.*, x1, x2 FROM emb e JOIN (SELECT t, avg(value) FILTER (WHERE label = 1) AS x1, avg(value) FILTER (WHERE label = 2) AS x2 FROM emb GROUP BY t) USING (t)"),))
def m6(spark, d):
    x = two_signals(spark, d)
    design = series.to_design(x.select("scan_id", F.lit("a").alias("name"), "t", F.col("x1").alias("value")).union(x.select("scan_id", F.lit("b"), "t", "x2")))
    return series.to_bold(aroma.denoised(emb_series(spark, d), design, [1]))


# quality control


@query("Q1_scan_features", "kind name place", "value", f"""
    SELECT 'trace' AS kind, mask_name AS name, t AS place, avg(value) AS value FROM emb JOIN tissues USING (voxel_id) GROUP BY ALL UNION ALL SELECT 'trace', 'global', t, trace FROM gs
    UNION ALL SELECT 'covariance', 'global', voxel_id, avg(value * trace) FROM emb JOIN gs USING (t) GROUP BY voxel_id UNION ALL SELECT 'correlation', 'global', voxel_id, {corr('value', 'trace')} FROM emb JOIN gs USING (t) GROUP BY voxel_id""", (GS,))
def q1(spark, d):
    f = qc.scan_features(bold(spark, d), tissues(spark, d))
    rows = lambda df, kind, name, place, value: df.select(F.lit(kind).alias("kind"), name.alias("name"), F.col(place).cast("long").alias("place"), F.col(value).alias("value"))
    whole = F.lit("global")
    parts = [rows(f["traces"], "trace", F.col("mask_name"), "t", "value"), rows(f["global"], "trace", whole, "t", "trace"), rows(f["covariance"], "covariance", whole, "voxel_id", "cov"), rows(f["correlation"], "correlation", whole, "voxel_id", "r")]
    return functools.reduce(DataFrame.union, parts)


@query("Q2_power_spectrum", "scan_id frequency", "mean std", """
    SELECT 'emb' AS scan_id, f / 64.0::DOUBLE AS frequency, avg(p) AS mean, stddev_pop(p) AS std FROM (
        SELECT voxel_id, f, (sum(y * cos(2 * pi() * f * t / 64)) ** 2 + sum(y * sin(2 * pi() * f * t / 64)) ** 2) / sum(h * h) * CASE WHEN f IN (0, 32) THEN 1 ELSE 2 END AS p
        FROM (SELECT voxel_id, t, 0.5 - 0.5 * cos(2 * pi() * t / 64) AS h, (value - avg(value) OVER (PARTITION BY voxel_id)) * (0.5 - 0.5 * cos(2 * pi() * t / 64)) AS y FROM emb), (SELECT unnest(range(33)) AS f) GROUP BY voxel_id, f) GROUP BY f""")
def q2(spark, d):
    return qc.power_spectrum(emb_series(spark, d), 1.0)


@query("Q3_carpet", "scan_id t voxel_id", "value", "SELECT scan_id, t, voxel_id, CASE WHEN mov1 < 25.5 THEN value END AS value FROM line JOIN motion USING (scan_id, t)")
def q3(spark, d):
    return qc.carpet(line(spark, d), motion(spark, d).select("scan_id", "t", (F.col("mov1") < 25.5).alias("keep")))


@query("Q4_outliers", "scan_id t outlier", "", """
    SELECT scan_id, t, abs(0.6745 * (fd - m) / nullif(mad, 0)) > 1.5 AS outlier FROM traces JOIN (SELECT scan_id, m, median(abs(fd - m)) AS mad FROM traces JOIN (SELECT scan_id, median(fd) AS m FROM traces GROUP BY ALL) USING (scan_id) GROUP BY ALL) USING (scan_id)""")
def q4(spark, d):
    return qc.outliers(traces(spark, d), "fd", 1.5, "scan_id")


def scan_table(spark, d):
    early = F.when(F.col("t") < 9, F.col("value"))
    # maps and prior from one pass over the cells
    m = written(line(spark, d).groupBy("scan_id", "voxel_id").agg(F.avg("value").alias("value"), F.sum(early).alias("early"), F.count(early).alias("n")), "scan-maps")
    p = m.groupBy("voxel_id").agg(F.try_divide(F.sum("early"), F.sum("n")).alias("value"))
    m = m.drop("early", "n")
    out = aggregates.amplitude(m, "scan_id").join(qc.network_dice(m, p, 20), "scan_id").join(covariate(spark, d).withColumnRenamed("x", "mean_fd"), "scan_id")
    return out.withColumn("conf_corr", F.abs(F.col("dice") - 0.3))


DICE = """SELECT scan_id, 2.0 * count(*) FILTER (WHERE top AND core) / nullif(count(*) FILTER (WHERE top) + count(*) FILTER (WHERE core), 0) AS dice FROM (
    SELECT scan_id, voxel_id, abs(value) >= bound AS top FROM maps JOIN (SELECT scan_id, abs(value) AS bound FROM (SELECT *, row_number() OVER (PARTITION BY scan_id ORDER BY abs(value)) AS r, count(*) OVER (PARTITION BY scan_id) AS n FROM maps) WHERE r = floor(0.8 * n) + 1) USING (scan_id))
    JOIN (SELECT voxel_id, abs(value) >= (SELECT abs(value) FROM (SELECT value, row_number() OVER (ORDER BY abs(value)) AS r, count(*) OVER () AS n FROM prior) WHERE r = floor(0.8 * n) + 1) AS core FROM prior) USING (voxel_id) GROUP BY scan_id"""


@query("Q5_thresholds", "scan_id included", "", f"SELECT scan_id, dice > 0.1 AND abs(dice - 0.3) < 0.25 AS included FROM ({DICE})", (MAPS, PRIOR))
def q5(spark, d):
    return qc.passing(scan_table(spark, d), 0.1, 0.25)


TURNS = (("turn0", f"SELECT scan_id, a AS amplitude, dice > 0.1 AS included FROM ({DICE}) JOIN (SELECT scan_id, sqrt(sum(value * value)) AS a FROM maps GROUP BY scan_id) USING (scan_id)"),
         *((f"turn{k + 1}", f"SELECT scan_id, amplitude, included AND NOT coalesce(abs(0.6745 * (amplitude - m) / nullif(d, 0)) > 1.2, false) AS included FROM turn{k}, (SELECT median(amplitude) AS m FROM turn{k} WHERE included), (SELECT median(abs(amplitude - (SELECT median(amplitude) FROM turn{k} WHERE included))) AS d FROM turn{k} WHERE included)") for k in range(6)))


@query("Q5_amplitude_loop", "scan_id included", "", "SELECT scan_id, included FROM turn6", (MAPS, PRIOR, *TURNS))
def q5_amplitude(spark, d):
    """Six scans, so that six turns are enough for the SQL."""
    return qc.passing(scan_table(spark, d), 0.1, use_amplitude=True, threshold=1.2)


@query("Q6_threshold_lookup", "p_partkey", "dice", "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 0.4::DOUBLE WHEN 1 THEN 0.5::DOUBLE END AS dice FROM part")
def q6(spark, d):
    """The threshold of the network that a part's size points at; null where the list is shorter."""
    from .frame_queries import by_part

    def row(k, n):
        try:
            yield qc.threshold_of({"Dice": [0.4, 0.5], "Conf": [], "Amp": True}, int(n % 3))["Dice"]
        except ValueError:
            yield None

    return by_part(spark, d, "dice double", row)


@query("Q7_scan_report", "scan_id included amplitude_outlier", "dice mean_fd", f"""
    WITH s AS (SELECT scan_id, dice, x AS mean_fd, a AS amplitude, dice > 0.1 AS included FROM ({DICE}) JOIN covariate USING (scan_id) JOIN (SELECT scan_id, sqrt(sum(value * value)) AS a FROM maps GROUP BY scan_id) USING (scan_id)),
    k AS (SELECT median(amplitude) AS m FROM s WHERE included), j AS (SELECT median(abs(amplitude - m)) AS d FROM s, k WHERE included)
    SELECT scan_id, included, CASE WHEN included THEN abs(0.6745 * (amplitude - m) / nullif(d, 0)) > 3.5 END AS amplitude_outlier, dice, mean_fd FROM s, k, j""", (MAPS, PRIOR, COVARIATE))
def q7(spark, d):
    return qc.scan_report(qc.passing(scan_table(spark, d), 0.1), ["amplitude"])


GROUP = ("grouped", f"""SELECT 'prior' AS name, voxel_id, value FROM prior UNION ALL SELECT 'average', voxel_id, avg(value) FROM maps GROUP BY voxel_id UNION ALL SELECT 'variability', voxel_id, stddev_pop(value) FROM maps GROUP BY voxel_id
    UNION ALL SELECT 'covariate', voxel_id, {corr('value', 'x')} FROM maps JOIN covariate USING (scan_id) GROUP BY voxel_id""")


@query("Q8_group_maps", "name voxel_id", "value", "SELECT * FROM grouped", (MAPS, PRIOR, COVARIATE, GROUP), digits=4)
def q8(spark, d):
    return qc.group_maps(maps(spark, d), prior(spark, d), covariate(spark, d))


@query("Q9_group_statistics", "name", "dice mean", """
    WITH top AS (SELECT name, voxel_id, value, abs(value) >= bound AS top FROM grouped JOIN (SELECT name, abs(value) AS bound FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY abs(value)) AS r, count(*) OVER (PARTITION BY name) AS n FROM grouped) WHERE r = floor(0.8 * n) + 1) USING (name))
    SELECT a.name, 2.0 * count(*) FILTER (WHERE a.top AND b.top) / (count(*) FILTER (WHERE a.top) + count(*) FILTER (WHERE b.top)) AS dice, avg(a.value) FILTER (WHERE b.top) AS mean
    FROM top a JOIN top b ON a.voxel_id = b.voxel_id AND b.name = 'prior' AND a.name <> 'prior' GROUP BY a.name""", (MAPS, PRIOR, COVARIATE, GROUP), digits=3)
def q9(spark, d):
    return qc.group_statistics(qc.group_maps(maps(spark, d), prior(spark, d), covariate(spark, d)), 20)


@query("Q10_dataset_guard", "data scans covariates", "", """
    SELECT data, count(*)::INT AS scans, CASE WHEN count(DISTINCT tdof) > 1 THEN 'cr_sd,mean_fd,tdof' ELSE 'cr_sd,mean_fd' END AS covariates
    FROM (SELECT 'own' AS data, scan_id, count(*) FILTER (WHERE mov1 < 25.5) AS tdof FROM motion GROUP BY scan_id UNION ALL SELECT 'same', scan_id, 20 FROM motion GROUP BY scan_id) GROUP BY data""")
def q10(spark, d):
    own = motion(spark, d).groupBy("scan_id").agg(F.count_if(F.col("mov1") < 25.5).alias("tdof"))
    both = {"own": own, "same": own.withColumn("tdof", F.lit(20))}
    return spark.createDataFrame([(name, qc.enough_scans(t), ",".join(qc.covariates(t))) for name, t in both.items()], "data string, scans int, covariates string")


@query("Q11_density", "", "x density", """
    SELECT x, sum(exp(-0.5 * ((x - fd) / h) ** 2)) / (total * h * sqrt(2 * pi())) AS density FROM traces, (SELECT a + (b - a) * k / 49 AS x, s * total ** (-1 / 5.0::DOUBLE) AS h, total FROM spread, (SELECT unnest(range(50)) AS k)) WHERE fd IS NOT NULL GROUP BY x, h, total""",
    (("spread", "SELECT count(fd) AS total, min(fd) AS a, max(fd) AS b, stddev_samp(fd) AS s FROM traces"),))
def q11(spark, d):
    return qc.density(traces(spark, d), "fd")


@query("Q11_density_2d", "i j", "x y density", """
    SELECT i, j, x, y, CASE WHEN f >= 0.2 * max(f) OVER () THEN f END AS density FROM (SELECT i, j, x, y, sum(exp(-0.5 * (vy * (x - mov1) ** 2 - 2 * c * (x - mov1) * (y - mov2) + vx * (y - mov2) ** 2) / (vx * vy - c * c))) / (2 * pi() * sqrt(vx * vy - c * c) * n) AS f FROM motion, points GROUP BY x, y, i, j, vx, vy, c, n)""",
    (("spread", "SELECT count(*) AS n, var_samp(mov1) * count(*) ** (-1 / 3.0::DOUBLE) AS vx, var_samp(mov2) * count(*) ** (-1 / 3.0::DOUBLE) AS vy, covar_samp(mov1, mov2) * count(*) ** (-1 / 3.0::DOUBLE) AS c, min(mov1) AS x0, max(mov1) AS x1, min(mov2) AS y0, max(mov2) AS y1 FROM motion"),
     ("points", "SELECT i::INT AS i, j::INT AS j, (x0 + x1) / 2 + (x1 - x0) * 0.75 * (2 * i / 39.0::DOUBLE - 1) AS x, (y0 + y1) / 2 + (y1 - y0) * 0.75 * (2 * j / 39.0::DOUBLE - 1) AS y, n, vx, vy, c FROM spread, (SELECT unnest(range(40)) AS i), (SELECT unnest(range(40)) AS j)")), digits=4)
def q11_2d(spark, d):
    return qc.density_2d(motion(spark, d), "mov1", "mov2", 40)


@query("Q11_bounds", "", "low high", "SELECT min(fd) + (max(fd) - min(fd)) / 2 - (max(fd) - min(fd)) / 2 * 1.5 AS low, min(fd) + (max(fd) - min(fd)) / 2 + (max(fd) - min(fd)) / 2 * 1.5 AS high FROM traces", digits=4)
def q11_bounds(spark, d):
    return qc.bounds(traces(spark, d), "fd")


@query("Q12_motion_report", "kind place", "value", f"""
    WITH r AS (SELECT voxel_id, {TRIMEAN} AS r FROM emb GROUP BY voxel_id), m AS (SELECT voxel_id, avg(value) AS mean, stddev_pop(value) AS std FROM emb GROUP BY voxel_id)
    SELECT 'mse' AS kind, t AS place, avg((value - r) ** 2) AS value FROM emb JOIN r USING (voxel_id) GROUP BY t UNION ALL SELECT 'distance', t, 1 - sum(value * r) / (sqrt(sum(value * value)) * sqrt(sum(r * r))) FROM emb JOIN r USING (voxel_id) GROUP BY t
    UNION ALL SELECT 'mean', voxel_id, mean FROM m UNION ALL SELECT 'std', voxel_id, std FROM m UNION ALL SELECT 'tsnr', voxel_id, coalesce(mean / nullif(std, 0), 0) FROM m""")
def q12(spark, d):
    f = qc.motion_report(bold(spark, d))
    rows = lambda df, kind, place, value: df.select(F.lit(kind).alias("kind"), F.col(place).cast("long").alias("place"), F.col(value).alias("value"))
    return functools.reduce(DataFrame.union, [rows(f["mse"], "mse", "t", "mse"), rows(f["distance"], "distance", "t", "distance"), *(rows(f["maps"], c, "voxel_id", c) for c in ("mean", "std", "tsnr"))])


@query("Q13_multi_otsu", "class", "threshold", """
    SELECT unnest([0, 1])::INT AS class, a + (b - a) / 256 * (unnest([i, j]) - 0.5) AS threshold FROM (SELECT p.i, q.i AS j, p.m ** 2 / p.w + (q.m - p.m) ** 2 / (q.w - p.w) + (q.tm - q.m) ** 2 / (q.tw - q.w) AS gain, q.a, q.b
        FROM below p JOIN below q ON p.i < q.i AND p.w > 0 AND q.w > p.w AND q.w < q.tw ORDER BY gain DESC, q.i, p.i LIMIT 1)""",
    (("spread", "SELECT min(value) AS a, max(value) AS b FROM emb"),
     ("bins", "SELECT least(floor((value - a) / ((b - a) / 256)), 255) AS c, count(*) AS n FROM emb, spread GROUP BY c"),
     ("below", "SELECT i, a, b, sum(n) FILTER (WHERE c < i) AS w, sum(n * (a + (b - a) / 256 * (c + 0.5))) FILTER (WHERE c < i) AS m, sum(n) AS tw, sum(n * (a + (b - a) / 256 * (c + 0.5))) AS tm FROM bins, spread, (SELECT unnest(range(1, 257)) AS i) GROUP BY ALL")))
def q13(spark, d):
    return qc.intensity_range(bold(spark, d))


# volumes


# A cubic spline through f has the coefficients sum of sqrt(3) z^|k| f[m + k], with z = sqrt(3) - 2 and f mirrored at its ends; z^28 is below 1e-15.
CUBIC = "CASE WHEN abs(d) < 1 THEN 2 / 3.0::DOUBLE - d * d + abs(d) ** 3 / 2 ELSE greatest(2 - abs(d), 0) ** 3 / 6 END"
MIRRORED = "CASE WHEN abs(m + k) % (2 * n - 2) < n THEN abs(m + k) % (2 * n - 2) ELSE 2 * n - 2 - abs(m + k) % (2 * n - 2) END"
SPLINE = f"SELECT n, i, {MIRRORED} AS j, sum(({CUBIC}) * sqrt(3.0::DOUBLE) * (sqrt(3.0::DOUBLE) - 2) ** abs(k)) AS w FROM taps, (SELECT unnest(range(-28, 29)) AS k) GROUP BY ALL"
SPACING = 1.6


@query("X1_respaced", "x y z", "value", """
    SELECT a.i::INT AS x, b.i::INT AS y, c.i::INT AS z, greatest(sum(a.w * b.w * c.w * v.value), 0) AS value FROM v
    JOIN w a ON a.n = 10 AND a.j = v.x JOIN w b ON b.n = 10 AND b.j = v.y JOIN w c ON c.n = (SELECT max(z) + 1 FROM grid) AND c.j = v.z GROUP BY ALL""",
    (("v", "SELECT x, y, z, avg(value) AS value FROM emb JOIN grid USING (voxel_id) GROUP BY ALL"), ("axes", "SELECT DISTINCT unnest([10, (SELECT max(z) + 1 FROM grid)]) AS n"),
     ("taps", f"SELECT n, i, floor(i * {SPACING})::INT + o AS m, floor(i * {SPACING}) + o - i * {SPACING}::DOUBLE AS d FROM (SELECT n, unnest(range(floor(n / {SPACING})::INT)) AS i FROM axes), (SELECT unnest([-1, 0, 1, 2]) AS o)"), ("w", SPLINE)))
def x1(spark, d):
    g = grid(spark, d)
    values = bold(spark, d).groupBy("voxel_id").agg(F.avg("value").alias("value")).join(g, "voxel_id").select("x", "y", "z", "value")
    source = (10, 10, g.agg(F.max("z")).first()[0] + 1)
    shape, matrix = volumes.respaced(source, (1.0, 1.0, 1.0), (SPACING,) * 3)
    return volumes.resampled_volumes(values, source, shape, matrix, clip=True)


@query("X2_interpolators", "kind t voxel_id", "value", """
    SELECT kind, t, voxel_id, sum(w * a.value) AS value FROM grid g JOIN w ON w.i = g.x JOIN (SELECT t, x, y, z, value FROM emb JOIN grid USING (voxel_id)) a ON a.y = g.y AND a.z = g.z AND a.x = w.j GROUP BY ALL""",
    (("taps", "SELECT 10 AS n, i, i + o AS m, o - 0.25::DOUBLE AS d FROM (SELECT unnest(range(10)) AS i), (SELECT unnest(range(-2, 4)) AS o)"), ("spline", SPLINE),
     ("sincs", "SELECT kind, i, greatest(0, least(9, m)) AS j, sin(pi() * d) / (pi() * d) * CASE kind WHEN 'cosine' THEN cos(pi() * d / 6) ELSE sin(pi() * d / 3) / (pi() * d / 3) END AS w FROM taps, (SELECT unnest(['cosine', 'lanczos']) AS kind)"),
     ("w", "SELECT kind, i, j, sum(w) AS w FROM sincs GROUP BY ALL UNION ALL SELECT 'bspline', i, j, w FROM spline UNION ALL SELECT 'linear', i, greatest(0, least(9, m)), sum(greatest(0, 1 - abs(d))) FROM taps GROUP BY ALL")))
def x2_kinds(spark, d):
    """A shift of a quarter of a voxel along x."""
    g = grid(spark, d)
    shape = (10, 10, g.agg(F.max("z")).first()[0] + 1)
    values = bold(spark, d).join(g, "voxel_id").select("t", "x", "y", "z", "value")
    move = [[1, 0, 0, 0.25], [0, 1, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1]]
    out = [volumes.resampled_volumes(values, shape, shape, move, kind).withColumn("kind", F.lit(kind)) for kind in ("bspline", "cosine", "lanczos", "linear")]
    return functools.reduce(DataFrame.union, out).join(g, ["x", "y", "z"])


@query("X2_transformed", "scan_id t voxel_id", "value", """
    SELECT 'emb' AS scan_id, a.t, g.voxel_id, sum(a.value * CASE WHEN a.x = g.x THEN 0.75 ELSE 0.25 END) AS value FROM grid g JOIN (SELECT t, x, y, z, value FROM emb JOIN grid USING (voxel_id)) a ON a.y = g.y AND a.z = g.z AND a.x IN (g.x, g.x + 1) GROUP BY ALL""")
def x2(spark, d):
    g = grid(spark, d)
    values = bold(spark, d).join(g, "voxel_id").select("scan_id", "t", "x", "y", "z", "value")
    shift = [[1, 0, 0, 0.5], [0, 1, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1]]
    back = [[1, 0, 0, 0.25], [0, 1, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1]]
    return volumes.resampled(values, g, volumes.chain([(shift, False), (back, True)]))


@query("X3_nearest_labels", "voxel_id label", "", "SELECT g.voxel_id, coalesce(a.label, 0) AS label FROM grid g LEFT JOIN (SELECT x, y, z, label FROM grid JOIN atlas USING (voxel_id)) a ON a.x = g.x + 1 AND a.y = g.y AND a.z = g.z")
def x3(spark, d):
    g = grid(spark, d)
    return volumes.nearest_labels(g.join(atlas(spark, d), "voxel_id"), g, [[1, 0, 0, 0.6], [0, 1, 0, 0.2], [0, 0, 1, -0.3], [0, 0, 0, 1]])


#: Scales and shifts that take points from native space to the anatomical, on to the template and to common space.
STEPS = {"a": (2.0, 1.0), "b": (0.5, -3.0), "c": (4.0, 0.25)}
GO = {k: f"({{0}} * {s} + ({b}))" for k, (s, b) in STEPS.items()} | {k.upper(): f"(({{0}} - ({b})) / {s})" for k, (s, b) in STEPS.items()}
PATHS = {"native_to_anat": "a", "native_to_template": "ab", "native_to_common": "abc", "anat_to_native": "A", "template_to_native": "BA", "common_to_native": "CBA"}


@query("X4_transform_chains", "chain voxel_id", "px py", " UNION ALL ".join(
    f"SELECT '{k}' AS chain, voxel_id, {functools.reduce(lambda e, step: GO[step].format(e), path, 'x::DOUBLE')} AS px, {functools.reduce(lambda e, step: GO[step].format(e), path, 'y::DOUBLE')} AS py FROM grid" for k, path in PATHS.items()))
def x4(spark, d):
    step = lambda k: [([[STEPS[k][0], 0, 0, STEPS[k][1]], [0, STEPS[k][0], 0, STEPS[k][1]], [0, 0, STEPS[k][0], STEPS[k][1]], [0, 0, 0, 1]], False)]
    found, point = volumes.between_spaces(step("a"), step("b"), step("c")), tuple(F.col(c).cast("double") for c in "xyz")
    moved = {k: volumes.transform(point, volumes.chain(v).tolist()) for k, v in found.items()}
    return functools.reduce(DataFrame.union, [grid(spark, d).select(F.lit(k).alias("chain"), "voxel_id", p[0].alias("px"), p[1].alias("py")) for k, p in moved.items()])


@query("X6_framewise_displacement", "scan_id t", "fd", """
    SELECT scan_id, t, coalesce(avg(sqrt((x2 - x) ** 2 + (y2 - y) ** 2 + (z2 - z) ** 2)), 0) AS fd FROM (SELECT scan_id, t, x, y, z, lead(x) OVER p AS x2, lead(y) OVER p AS y2, lead(z) OVER p AS z2 FROM (
        SELECT scan_id, t, k, cos(rot3) * v1 + sin(rot3) * v2 AS x, -sin(rot3) * v1 + cos(rot3) * v2 AS y, v3 AS z FROM (
            SELECT *, cos(rot2) * u1 - sin(rot2) * u3 AS v1, u2 AS v2, sin(rot2) * u1 + cos(rot2) * u3 AS v3 FROM (
                SELECT *, px - mov1 AS u1, cos(rot1) * (py - mov2) + sin(rot1) * (pz - mov3) AS u2, -sin(rot1) * (py - mov2) + cos(rot1) * (pz - mov3) AS u3
                FROM motion, (SELECT unnest([0, 1, 2]) AS k, unnest([0, 1, 5]) AS px, unnest([0, 2, 5]) AS py, unnest([0, 3, 5]) AS pz)))) WINDOW p AS (PARTITION BY scan_id, k ORDER BY t)) GROUP BY scan_id, t""")
def x6(spark, d):
    return volumes.framewise_displacement(motion(spark, d), [(0, 0, 0), (1, 2, 3), (5, 5, 5)])


@query("X7_reference_volume", "voxel_id", "reference", f"""
    SELECT g.voxel_id, {TRIMEAN} AS reference FROM grid g JOIN (SELECT t, x, y, z, value FROM emb JOIN grid USING (voxel_id) WHERE t IN (SELECT floor(i * 63 / 49.0)::INT FROM range(50) r(i))) e
    ON e.y = g.y AND e.z = g.z AND e.x = least(9, g.x + e.t % 3) GROUP BY g.voxel_id""")
def x7(spark, d):
    """Realignment by a motion that is known: frame t lies t % 3 voxels along x."""
    g = grid(spark, d)

    def realign(some, reference):
        # a source voxel goes t % 3 voxels back; that at the far edge also fills what would come from beyond it
        k = F.col("t") % 3
        to = F.explode(F.when(F.col("x") == 9, F.sequence(9 - k, F.lit(9))).otherwise(F.array(F.col("x") - k))).alias("to")
        moved = some.join(g, "voxel_id").select("scan_id", "t", to, "y", "z", "value").withColumnRenamed("to", "x")
        return moved.join(g, ["x", "y", "z"]).select("scan_id", "t", "voxel_id", "value")

    return volumes.reference_volume(bold(spark, d), 64, realign)


@query("X8_slice_timing", "voxel_id t", "value", """
    SELECT voxel_id, t, CASE WHEN o >= 0 THEN value + o * (coalesce(lead(value) OVER w, value) - value) ELSE value + o * (value - coalesce(lag(value) OVER w, value)) END AS value
    FROM (SELECT voxel_id, t, value, 0.5 - y / 10.0::DOUBLE AS o FROM emb JOIN grid USING (voxel_id)) WINDOW w AS (PARTITION BY voxel_id ORDER BY t)""")
def x8(spark, d):
    return volumes.slice_timed(bold(spark, d), grid(spark, d), 10, "y", "seq+z", "linear", 0.5)


@query("X13_template_spacing", "", "least", "SELECT min(p_size)::DOUBLE AS least FROM part")
def x13(spark, d):
    return aggregates.spacing_summary(table(spark, d, "part").select(F.col("p_size").cast("double").alias("spacing")))


@query("scan_similarity", "scan_id", "r", f"SELECT scan_id, coalesce({corr('m.value', 'p.value')}, 0) AS r FROM maps m JOIN prior p USING (voxel_id) GROUP BY scan_id", (MAPS, PRIOR))
def similarity(spark, d):
    return qc.seed_similarity(maps(spark, d), prior(spark, d))



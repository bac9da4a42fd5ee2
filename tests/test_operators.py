"""Operators on small frames: edges, errors and invariants."""

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chronovox.functions import options
from chronovox.operators import aggregates, aroma, connect, frames, joins, qc, regress, series, volumes
from chronovox.sources import images, manifest, synthetic, tables
from chronovox.sources.shared import BATCH_BYTES


def made(spark, values, scan="s"):
    """A matrix (frames, voxels) as a long frame."""
    return spark.createDataFrame([(scan, t, v, float(x)) for t, row in enumerate(values) for v, x in enumerate(row)], "scan_id string, t int, voxel_id long, value double")


def matrix(frame, value="value"):
    rows = frame.select("t", "voxel_id", value).collect()
    out = np.full((max(r[0] for r in rows) + 1, max(r[1] for r in rows) + 1), np.nan)
    for t, v, x in rows:
        out[t, v] = x
    return out


def test_options():
    assert options.parse_interval("2-end", 9) == (2, 9) and options.parse_interval("0-5", 9) == (0, 5)
    for bad in ("all", "1,2", "1", "1-2-3"):
        with pytest.raises(ValueError):
            options.parse_interval(bad, 9)
    assert options.parse_spacing("0.1x0.2x3") == (0.1, 0.2, 3.0) and options.parse_spacing("inputs_defined") is None
    with pytest.raises(ValueError):
        options.parse_spacing("1x2")
    assert options.parse_options("a=1,b=true", {"a": int, "b": bool}) == {"a": 1, "b": True}
    with pytest.raises(ValueError):
        options.parse_options("c=1", {"a": int})


def test_image_round_trip(spark, tmp_path):
    a = np.random.default_rng(0).normal(size=(3, 4, 5, 2)).astype("f4")
    (tmp_path / "sub-1_ses-2_bold.nii.gz").write_bytes(images.encoded(a, (0.1, 0.2, 0.3, 1.5)))
    got = images.read(spark, f"file://{tmp_path}")
    back = np.zeros(a.shape)
    for r in got.collect():
        assert r.scan_id == "sub-1_ses-2_bold" and r.voxel_id == r.x + 3 * r.y + 12 * r.z
        back[r.x, r.y, r.z, r.t] = r.value
    assert np.array_equal(back, a)
    h = images.headers(spark, f"file://{tmp_path}").first()
    assert list(h["shape"]) == [3, 4, 5, 2] and h.tr == pytest.approx(1.5) and h.kind == "f4"
    assert np.allclose(h["spacing"], [0.1, 0.2, 0.3, 1.5]) and np.allclose(h.direction, np.eye(3))


def test_tables_and_manifest(spark, tmp_path):
    (tmp_path / "names.txt").write_text("b\n\n a \n")
    assert [tuple(r) for r in tables.read_names(spark, f"file://{tmp_path}/names.txt").orderBy("ord").collect()] == [(0, "b"), (2, "a")]
    (tmp_path / "m.txt").write_text(" 1 2\n3  4.5\n")
    assert sorted(tuple(r) for r in tables.read_matrix(spark, f"file://{tmp_path}/m.txt").collect()) == [(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0), (1, 1, 4.5)]
    paths = spark.createDataFrame([("d/sub-01_ses-a_run-2_bold.nii.gz",), ("d/sub-02_bold.nii",), ("d/readme.txt",)], "path string")
    rows = {r.scan_id: r for r in manifest.from_paths(paths).collect()}
    assert set(rows) == {"sub-01_ses-a_run-2_bold", "sub-02_bold"} and rows["sub-02_bold"].session is None and rows["sub-01_ses-a_run-2_bold"].run == "2"
    assert manifest.lookup(manifest.from_paths(paths), {"subject": "02"}) == "d/sub-02_bold.nii"
    with pytest.raises(ValueError):
        manifest.lookup(manifest.from_paths(paths), {"suffix": "bold"})
    with pytest.raises(PySparkException):
        manifest.from_paths(spark.createDataFrame([("x_bold.nii",)], "path string")).collect()


def test_containment_sends_the_names_not_the_parts(spark, tmp_path):
    """A file says little about the size of its scans' parts; whoever goes by it sends them all to every task."""
    spark.range(2000).select(F.format_string("sub-%d_task-rest_bold", "id").alias("scan_id")).write.parquet(str(tmp_path / "scans"))
    scans = spark.read.parquet(str(tmp_path / "scans"))
    names = spark.createDataFrame([(0, "sub-7_"), (1, "b-7_"), (2, None), (3, "sub-7_"), (4, "a-")], "ord int, name string")
    for found in (joins.name_contains(scans, names), joins.include(scans, names), joins.exclude(scans, names)):
        plan = found._jdf.queryExecution().sparkPlan().toString()
        sent = [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "name" in line]
        assert all("BuildRight" in line for line in sent) and sent
    assert [tuple(r) for r in joins.name_contains(scans, names).select("scan_id", "name", "ord").collect()] == [("sub-7_task-rest_bold", "sub-7_", 0)]
    assert [tuple(r) for r in joins.include(scans, names).orderBy("ord").collect()] == [(0, "sub-7_", "sub-7_task-rest_bold", True), (1, "b-7_", "sub-7_task-rest_bold", True), (2, None, None, False), (3, "sub-7_", "sub-7_task-rest_bold", True), (4, "a-", None, False)]
    assert joins.exclude(scans, names).count() == 1999


def test_containment_and_cardinality(spark):
    scans = spark.createDataFrame([("sub-1_x",), ("sub-10_x",), ("sub-2",)], "scan_id string")
    names = spark.createDataFrame([(0, "sub-10"), (1, "sub-1")], "ord int, name string")
    assert {(r.scan_id, r.name) for r in joins.name_contains(scans, names).collect()} == {("sub-1_x", "sub-1"), ("sub-10_x", "sub-10")}
    with pytest.raises(PySparkException):
        joins.name_contains(scans, names.where("ord = 1"), unique=True).collect()
    assert [r.scan_id for r in joins.exclude(scans, names).collect()] == ["sub-2"]
    assert joins.name_contains(scans, names.where("false")).count() == 0
    two = spark.createDataFrame([(None, "a"), (None, "b")], "run string, found string")
    one = spark.createDataFrame([("s", None)], "scan_id string, run string")
    with pytest.raises(PySparkException):
        joins.check_one(joins.exactly_one(one, two, ["run"], "scan_id"), "scan_id").collect()


def test_censoring_against_a_loop(spark):
    rng = np.random.default_rng(1)
    fd = rng.random(40)
    frame = spark.createDataFrame([("s", t, float(x)) for t, x in enumerate(fd)], "scan_id string, t int, fd double")
    keep = np.ones(40, bool)
    for i in np.flatnonzero(fd >= 0.8):
        keep[max(0, i - 1) : i + 3] = False
    assert [r.keep for r in frames.censor_fd(frame, 0.8).orderBy("t").collect()] == keep.tolist()


def test_constant_series_do_not_raise(spark):
    b = made(spark, np.c_[np.arange(6.0), np.ones(6)])
    trace = aggregates.global_signal(b).withColumnRenamed("value", "trace")
    assert {r.voxel_id: r.r for r in aggregates.correlation_with(b, trace).collect()}[1] is None
    maps = {r.voxel_id: r.r for r in connect.seed_maps(b, spark.createDataFrame([("s", 0)], "seed_name string, voxel_id long")).collect()}
    assert maps[1] == 0.0 and maps[0] == pytest.approx(1)
    assert {r.voxel_id: r.tsnr for r in aggregates.temporal_maps(b).collect()}[1] == 0.0
    assert matrix(regress.scaled(b, "voxelwise_standardization"))[:, 1].tolist() == [0] * 6


def test_matrix_is_symmetric_with_unit_diagonal(spark):
    y = np.random.default_rng(2).normal(size=(20, 30))
    got = np.zeros((30, 30))
    for r in connect.voxel_matrix(series.to_series(made(spark, y)), 7).collect():
        got[r.voxel_i, r.voxel_j] += r.r
    assert np.allclose(got, np.corrcoef(y.T))


def test_matrix_parts_are_few_and_pairs_come_in_tiles(spark, monkeypatch):
    assert connect.parts_of(60_000, 28, 16) == 8 and connect.parts_of(30, 20, 7) == 5 and connect.parts_of(0, 1, 16) == 1
    assert connect.parts_of(1_000_000, 1000, 16) == -(-8_000_000_000 // connect.SIDE_BYTES)
    monkeypatch.setattr(connect, "TILE", 16)
    y = np.random.default_rng(2).normal(size=(20, 30))
    y[:, 3] = 1
    both = made(spark, y).union(made(spark, y[:, ::-1], "other"))
    found = connect.voxel_matrix(series.to_series(both), 4).collect()
    assert len(found) == 2 * 900 and len({tuple(r)[:3] for r in found}) == 2 * 900
    assert all((r.r is None) == ((3 if r.scan_id == "s" else 26) in (r.voxel_i, r.voxel_j)) for r in found)


def test_regression_kernel_and_singular_designs(spark):
    y, x = np.random.default_rng(3).normal(size=(20, 4)), np.random.default_rng(4).normal(size=(20, 3))
    design = spark.createDataFrame([("s", x.T.tolist())], "scan_id string, x array<array<double>>")
    fit = regress.regress(series.to_series(made(spark, y)), design)
    want = y - x @ np.linalg.lstsq(x, y, rcond=None)[0]
    assert np.allclose(matrix(series.to_bold(fit)), want)
    bad = spark.createDataFrame([("s", [[0.0] * 20])], "scan_id string, x array<array<double>>")
    assert all(r.residual is None for r in regress.regress(series.to_series(made(spark, y)), bad).collect())
    kept = regress.regress(series.to_series(made(spark, y)), design, subtract=False)
    assert np.allclose(matrix(series.to_bold(kept)), y)


def test_detrending_with_censored_frames(spark):
    y = np.random.default_rng(5).normal(size=(30, 3)) + np.arange(30)[:, None] * 0.4 + 5
    kept = np.setdiff1d(np.arange(30), [4, 5, 20])
    s = series.to_series(made(spark, y).where("t NOT IN (4, 5, 20)"))
    t = np.linspace(-15, 15, 30)[kept]
    inside = (kept >= 3) & (kept < 25)
    x = np.c_[t, t**2, np.ones(len(t))]
    b = np.linalg.lstsq(x[inside], y[kept][inside], rcond=None)[0]
    got = regress.detrend(s, 30, 2, "3-25")
    assert np.allclose(matrix(series.to_bold(got))[kept], y[kept] - x @ b)
    assert np.allclose([r.intercept for r in got.orderBy("voxel_id").collect()], b[-1])
    only = regress.detrend(s, 30, 2, "3-25", remove_intercept=False)
    assert np.allclose(matrix(series.to_bold(only))[kept], y[kept] - x[:, :2] @ b[:2])


def test_component_scores_match_svd(spark):
    y = np.random.default_rng(6).normal(size=(15, 12))
    tissue = spark.createDataFrame([(v,) for v in range(12)], "voxel_id long")
    got = regress.component_regressors(series.to_series(made(spark, y)).repartition(3), tissue).collect()
    c = y - y.mean(axis=0)
    u, s, _ = np.linalg.svd(c, full_matrices=False)
    assert np.allclose(np.abs(np.array(got[0].x).T), np.abs(u[:, :5] * s[:5]))
    assert regress.component_regressors(series.to_series(made(spark, y)), tissue.where("voxel_id < 4")).count() == 0


def test_dual_regression_against_numpy(spark):
    rng = np.random.default_rng(7)
    y, p = rng.normal(size=(16, 40)), rng.normal(size=(40, 3))
    priors = spark.createDataFrame([(c, v, float(p[v, c])) for c in range(3) for v in range(40)], "comp int, voxel_id long, weight double")
    got = connect.dual_regression(series.to_series(made(spark, y)), priors)
    w = np.linalg.lstsq(p, y.T, rcond=None)[0].T
    w /= np.sqrt((w**2).mean(axis=0))
    c = np.linalg.lstsq(w, y, rcond=None)[0].T
    s = np.sqrt((c**2).mean(axis=0))
    for r in got["traces"].collect():
        assert r.value == pytest.approx(w[r.t, r.comp])
    for r in got["maps"].collect():
        assert r.value == pytest.approx(c[r.voxel_id, r.comp] / s[r.comp])
    assert {r.comp: r.amplitude for r in got["amplitudes"].collect()} == pytest.approx(dict(enumerate(s)))


def two_scans(spark, seed=11):
    """Scans of 14 and 18 frames over 60 voxels, and two priors."""
    rng = np.random.default_rng(seed)
    maps = rng.laplace(size=(4, 60))
    data = {f"s{n}": rng.normal(size=(n, 4)) * [4, 3, 2, 1] @ maps + 0.05 * rng.normal(size=(n, 60)) for n in (14, 18)}
    p = maps[:2].T + 0.3 * rng.normal(size=(60, 2))
    priors = spark.createDataFrame([(c, v, float(p[v, c])) for c in range(2) for v in range(60)], "comp int, voxel_id long, weight double")
    frame = None
    for scan, y in data.items():
        frame = made(spark, y, scan) if frame is None else frame.union(made(spark, y, scan))
    return series.to_series(frame).repartition(5), priors, data, p


def fitted(rows, scan, kind, shape):
    out = np.full(shape, np.nan)
    for r in rows:
        if (r.scan_id, r.kind) == (scan, kind):
            out[(r.idx, r.comp) if len(shape) > 1 else r.comp] = r.value
    assert not np.isnan(out).any()
    return out


def test_frame_gram_over_tasks(spark, monkeypatch):
    data, _, y, _ = two_scans(spark)
    for centre in (True, False):
        for r in series.frame_gram(data, centre).collect():
            x = y[r.scan_id] - (y[r.scan_id].mean(axis=0) if centre else 0)
            assert np.allclose(series.square(r.gram), x @ x.T)


def test_voxels_without_a_scan_are_kept(spark):
    rows = spark.createDataFrame([("a", 1, [1.0, 3.0]), (None, 2, [2.0, 2.0]), ("a", 3, [0.0, 4.0])], "scan_id string, voxel_id long, v array<double>").coalesce(1)
    got = {r.voxel_id: (r.m, r.w) for r in series.per_voxel(rows, lambda y: (y.mean(axis=0), y * 2), "m double, w array<double>").collect()}
    assert got == {1: (2.0, [2.0, 6.0]), 2: (2.0, [4.0, 4.0]), 3: (2.0, [0.0, 8.0])}


def test_alternating_fit_beside_priors(spark):
    data, priors, y, p = two_scans(spark)
    rows = connect.alternating_fit(data, 1, priors).collect()
    for scan, x in y.items():
        own, w = fitted(rows, scan, "map", (60, 1)), fitted(rows, scan, "trace", (len(x), 1))
        both = np.concatenate([own, p], axis=1)
        traces = np.linalg.lstsq(both, x.T, rcond=None)[0].T
        assert np.allclose(traces[:, :1], w, atol=1e-2 * np.abs(w).max())
        back = np.linalg.lstsq(traces, x, rcond=None)[0][0]
        assert abs(back / np.linalg.norm(back) @ own[:, 0]) > 1 - 1e-4


def test_prior_recovery_over_scans(spark):
    data, priors, y, p = two_scans(spark)
    rows = connect.prior_recovery(data, priors, 1, 1).collect()
    for scan, x in y.items():
        maps, w = fitted(rows, scan, "map", (60, 4)), fitted(rows, scan, "trace", (len(x), 4))
        s, r = fitted(rows, scan, "amplitude", (4,)), fitted(rows, scan, "prior_corr", (2,))
        assert np.allclose((maps**2).mean(axis=0), 1) and np.allclose((w**2).mean(axis=0), 1)
        assert np.allclose(np.linalg.lstsq(w, x, rcond=None)[0].T, maps * s)
        assert r == pytest.approx([np.corrcoef(maps[:, i], p[:, i])[0, 1] for i in range(2)]) and r.min() > 0.8


def test_dimension_search_stops_where_it_is_stable(spark):
    data, priors, _, _ = two_scans(spark)
    whole = connect.dimension_search(data, priors, most=9, window=3, most_diff=0.2, whole=True).collect()
    short = connect.dimension_search(data, priors, most=9, window=3, most_diff=0.2).collect()
    assert {r.scan_id for r in whole} == {"s14", "s18"}
    for scan in ("s14", "s18"):
        a, b = (sorted((r for r in rows if r.scan_id == scan), key=lambda r: r.i) for rows in (whole, short))
        assert [r.i for r in a] == list(range(9)) and [(r.temporal, r.spatial) for r in a[:4]] == [(0, 0), (1, 0), (1, 1), (2, 1)]
        found = [i for i in range(6) if a[i]["corr"] >= 0.5 and all(r["diff"] <= 0.2 for r in a[i + 1 : i + 4])]
        assert {r.chosen for r in a} == {r.chosen for r in b} == {found[0] if found else 8}
        assert len(b) == (found[0] + 4 if found else 9)
    none = connect.dimension_search(data, priors, most=3, window=5).collect()
    assert {r.chosen for r in none} == {2}  # never stable: the last step


def test_scan_components_are_white_and_fit(spark):
    data, _, y, _ = two_scans(spark)
    rows = connect.scan_components(data, 3).collect()
    for scan, x in y.items():
        maps, w = fitted(rows, scan, "map", (60, 3)), fitted(rows, scan, "trace", (len(x), 3))
        assert np.allclose(maps.mean(axis=0), 0, atol=1e-6) and np.allclose(maps.T @ maps / 60, np.eye(3), atol=1e-6)
        assert np.allclose(w, (x - x.mean(axis=1, keepdims=True)) @ maps / 60)


def test_amplitude_outliers_leave_in_turns(spark):
    rng = np.random.default_rng(0)
    a = [*rng.normal(10, 0.5, 30).tolist(), 14.0, 30.0, 80.0, 500.0]
    scans = spark.createDataFrame([(f"s{i}", x, 0.5) for i, x in enumerate(a)], "scan_id string, amplitude double, dice double")
    kept, x = {r.scan_id for r in qc.passing(scans, 0.1, use_amplitude=True).where("included").collect()}, np.array(a)
    while True:
        m = np.median(x)
        stay = np.abs(0.6745 * (x - m) / np.median(np.abs(x - m))) <= 3.5
        if stay.all():
            break
        x = x[stay]
    assert kept == {f"s{i}" for i, v in enumerate(a) if v in x} and len(kept) <= 31


def test_images_keep_their_grid_and_place(spark, tmp_path):
    affine = images.affine_of((2.0, 3.0, 4.0), (-5.0, 7.5, 11.0), ((0, -1, 0), (1, 0, 0), (0, 0, 1)))
    rows = spark.createDataFrame([("s", 0, 1, 0, 2, 9.0)], "scan_id string, t int, x int, y int, z int, value double")
    images.write(rows, f"file://{tmp_path}/maps", (2.0, 3.0, 4.0, 1.0), (4, 5, 6), affine)
    h = images.headers(spark, f"file://{tmp_path}/maps").first()
    assert list(h["shape"]) == [4, 5, 6] and np.allclose(h.spacing, [2, 3, 4]) and np.allclose(h.origin, [-5, 7.5, 11])
    assert np.allclose(h.direction, [[0, -1, 0], [1, 0, 0], [0, 0, 1]])
    back = {(r.x, r.y, r.z): r.value for r in images.read(spark, f"file://{tmp_path}/maps").collect()}
    assert len(back) == 120 and back.pop((1, 0, 2)) == 9.0 and set(back.values()) == {0.0}


def test_density_in_two_dimensions(spark):
    rng = np.random.default_rng(4)
    p = rng.normal(size=(80, 2)) @ [[1, 0.5], [0, 2]]
    frame = spark.createDataFrame([(float(a), float(b)) for a, b in p] + [(None, 1.0)], "a double, b double").repartition(3)
    cov = np.cov(p.T) * 80 ** (-1 / 3)
    rows = qc.density_2d(frame, "a", "b", 12).collect()
    full = []
    for r in rows:
        d = p - [r.x, r.y]
        full.append(np.exp(-0.5 * (d @ np.linalg.inv(cov) * d).sum(axis=1)).sum() / (80 * 2 * np.pi * np.sqrt(np.linalg.det(cov))))
    for r, f in zip(rows, full):
        assert r.density == pytest.approx(f) if f >= 0.2 * max(full) else r.density is None
    assert len(rows) == 144 and qc.density_2d(frame.where("a > 100"), "a", "b").count() == 0


def test_clean_runs_every_step(spark):
    b = synthetic.scans(spark, 2, (4, 4, 4), 40)
    assert b.exceptAll(synthetic.scans(spark, 2, (4, 4, 4), 40)).count() == 0
    grid = b.select("voxel_id", "x", "y", "z").distinct()
    moves = b.select("scan_id", "t").distinct().select("scan_id", "t", *[F.sin(F.col("t") * (k + 1.3)).alias(c) for k, c in enumerate(regress.MOTION_6)])
    fd = moves.select("scan_id", "t", F.when(F.col("t") == 20, 1.0).otherwise(0.01).alias("fd"))
    masks = grid.select(F.when(F.col("voxel_id") % 2 == 0, "WM_signal").otherwise("CSF_signal").alias("mask_name"), "voxel_id")
    out = regress.clean(
        b.select("scan_id", "t", "voxel_id", "value"), grid, moves, fd, 40, fd_threshold=0.5, use_dvars=True, use_mse=True, least=20, match_frames=True,
        order=2, low_pass=0.2, edge_seconds=1.0, regressors=("mot_6", "WM_signal", "aCompCor_percent"), tissue=masks, scaling="grand_mean_scaling", even_variance=True, fwhm=1.5, grid=grid,
    )
    kept = out["frame_mask"].where("keep").groupBy("scan_id").count().collect()
    assert len(kept) == 2 and all(r["count"] == 20 for r in kept)
    assert not out["frame_mask"].where("keep AND t IN (0, 19, 20, 21, 22, 39)").count()
    rows = out["bold"].collect()
    assert len(rows) == 2 * 20 * 64 and all(np.isfinite(r.value) for r in rows)


def test_scaling_errors(spark):
    b = made(spark, np.ones((3, 2)))
    with pytest.raises(ValueError):
        regress.scaled(b, "other")
    with pytest.raises(ValueError):
        regress.homogenized(b, "voxelwise_mean")
    with pytest.raises(ValueError):
        regress.motion_regressors(b, ["mot_6", "mot_24"])
    with pytest.raises(ValueError):
        volumes.overlapping((0, 0), (1, 0), (1,), (1,))
    with pytest.raises(ValueError):
        qc.enough_scans(b.limit(2))
    with pytest.raises(ValueError):
        qc.threshold_of({"Dice": [0.1]}, 1)


def test_amplitude_outliers_go_in_turns(spark):
    values = [1.0, 1.1, 0.9, 1.05, 0.95, 1.02, 3.0, 100.0]
    scans = spark.createDataFrame([(f"s{i}", v) for i, v in enumerate(values)], "scan_id string, amplitude double")
    got = {r.scan_id: r.included for r in qc.passing(scans, use_amplitude=True).collect()}
    assert not got["s7"] and not got["s6"] and got["s0"]


def test_classifier_special_cases(spark):
    w = spark.createDataFrame([(0, 0.0, 0.0, 0.0, 0.0), (1, 2.0, 0.0, 2.0, 0.0), (2, 4.0, 1.0, 1.0, 1.0)], "comp int, total double, edge double, csf double, outside double")
    got = {r.comp: (r.edge_fraction, r.csf_fraction) for r in aroma.fractions(w).collect()}
    assert got[0] == (0, 0) and got[1] == (1, 1) and got[2] == (pytest.approx(2 / 3), 0.25)


def test_component_report(spark, tmp_path):
    f = spark.createDataFrame([(1, 0.9, 0.8, 0.2, 0.0), (0, 0.1, 0.2, 0.3, 0.05), (2, 0.0, 0.0, 0.1, 0.5)], "comp int, max_rp_corr double, edge_fraction double, hfc double, csf_fraction double")
    tables.write_component_report(aroma.classified(f), str(tmp_path))
    read = lambda name: [r.value for r in spark.read.text(f"{tmp_path}/{name}").collect()]
    assert read("classified_motion_ICs") == ["2,3"]
    assert [float(x) for x in read("feature_scores")[0].split()] == [0.1, 0.2, 0.3, 0.05]
    assert read("classification_overview")[1:3] == ["1\tFalse\t0.10\t0.20\t0.30\t0.05", "2\tTrue\t0.90\t0.80\t0.20\t0.00"]
    assert [r.noise for r in tables.read_component_overview(spark, str(tmp_path)).orderBy("ic").collect()] == [False, True, True]
    # none is noise: an empty line
    tables.write_component_report(aroma.classified(f.where("comp = 0")), str(tmp_path))
    assert read("classified_motion_ICs") == [""]


def test_edge_mask_against_slices(spark):
    mask = np.random.default_rng(8).random((5, 6, 7)) < 0.9
    ids = {}
    rows = []
    for n, (x, y, z) in enumerate(zip(*np.nonzero(mask))):
        ids[n] = (x, y, z)
        rows.append((n, int(x), int(y), int(z)))
    rows_top = [r for r in rows]
    assert max(r[1] for r in rows_top) == 4 and max(r[2] for r in rows_top) == 5 and max(r[3] for r in rows_top) == 6
    want = {n for n, (x, y, z) in ids.items() if x and y and z and not mask[x - 1 : x + 2, y - 1 : y + 2, z - 1 : z + 2].all()}
    assert {r.voxel_id for r in volumes.edge_mask(spark.createDataFrame(rows, "voxel_id long, x int, y int, z int")).collect()} == want


def test_resampling_by_identity_and_chain(spark):
    grid = spark.createDataFrame([(x + 3 * y + 9 * z, x, y, z) for x in range(3) for y in range(3) for z in range(3)], "voxel_id long, x int, y int, z int")
    values = grid.withColumn("value", F.col("voxel_id").cast("double")).drop("voxel_id")
    assert all(r.value == r.voxel_id for r in volumes.resampled(values, grid, np.eye(4)).collect())
    shift = [[1, 0, 0, 2], [0, 1, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1]]
    assert np.allclose(volumes.chain([(shift, False), (shift, True)]), np.eye(4))
    shape, m = volumes.respaced((10, 10, 5), (1, 1, 1), (2, 3, 1))
    assert shape == (5, 3, 5) and m[0, 0] == 2


def test_group_components_recover_shared_maps(spark):
    rng = np.random.default_rng(9)
    maps = rng.laplace(size=(2, 300))
    frame = None
    for s in range(3):
        b = made(spark, rng.normal(size=(12, 2)) @ maps + 0.01 * rng.normal(size=(12, 300)), f"s{s}")
        frame = b if frame is None else frame.union(b)
    got = np.zeros((2, 300))
    for r in connect.group_components(series.to_series(frame), 2).collect():
        got[r.comp, r.voxel_id] = r.value
    assert np.abs(np.corrcoef(got, maps))[:2, 2:].max(axis=1).min() > 0.97


@pytest.mark.parametrize("frames", [64, 3])
def test_kernels_get_bounded_parts(spark, frames):
    rows = 2 * series.KERNEL_CELLS // 64
    data = spark.range(rows, numPartitions=1).select(F.lit("s").alias("scan_id"), F.col("id").alias("voxel_id"), F.expr(f"transform(sequence(0, {frames - 1}), i -> double(id + i))").alias("v"))
    out = series.per_voxel(data, lambda y: (2 * y, np.full(y.shape[1], float(y.size))), "twice array<double>, cells double")
    wrong = out.where(f"NOT twice = transform(v, x -> 2 * x) OR size(twice) != {frames}").count()
    assert wrong == 0 and out.count() == rows and out.agg(F.max("cells")).first()[0] <= series.KERNEL_CELLS
    assert series.per_voxel(data.limit(0), lambda y: 2 * y, "twice array<double>").count() == 0


def test_rows_with_a_matrix_come_in_small_batches(spark):
    rows = spark.range(3000, numPartitions=1).select(F.lit("s").alias("scan_id"), F.col("id").alias("voxel_id"), F.expr("array(double(id), 1D)").alias("v"), F.expr("array(transform(sequence(0, 999), i -> double(i)))").alias("x"))
    out = series.per_voxel(rows, lambda y, x: np.full(y.shape[1], float(y.shape[1])), "together double", "x")
    assert out.agg(F.max("together")).first()[0] * 8000 < 1.1 * BATCH_BYTES

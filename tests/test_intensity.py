"""Planted fields of intensity."""

import numpy as np
import pytest

from chronovox.kernels import spatial
from chronovox.operators import intensity

SHAPE = (26, 24, 20)


def tissue(seed=5):
    rng = np.random.default_rng(seed)
    noise = spatial.smooth(rng.normal(size=SHAPE), np.ones(SHAPE, bool), 3.0, (1.0, 1.0, 1.0))
    return np.where(noise > 0, 200.0, 100.0) * np.exp(0.02 * rng.normal(size=SHAPE))


def planted():
    x, y, z = (np.linspace(-1, 1, n) for n in SHAPE)
    f = 0.3 * x[:, None, None] - 0.2 * y[None, :, None] ** 2 + 0.15 * (z[None, None, :] * x[:, None, None])
    return f - f.mean()


def frame(spark, **images):
    return spark.createDataFrame([(s, *map(int, i), float(v)) for s, a in images.items() for i, v in np.ndenumerate(a)], "scan_id string, x int, y int, z int, value double")


def field_of(rows):
    out = np.full(SHAPE, np.nan)
    for r in rows:
        out[r["x"], r["y"], r["z"]] = r["field"]
    return out


def test_control_points_by_a_loop_over_voxels():
    rng = np.random.default_rng(2)
    rest = np.where(rng.random((5, 4, 3)) < 0.8, rng.normal(size=(5, 4, 3)), np.nan)
    axes = [intensity.basis(n, 2, np.arange(n)) for n in rest.shape]
    top, bottom = np.zeros((5, 5, 5)), np.zeros((5, 5, 5))
    for i, r in np.ndenumerate(rest):
        if np.isfinite(r):
            w = np.einsum("a,b,c->abc", *(a[k] for a, k in zip(axes, i, strict=True)))
            assert w.sum() == pytest.approx(1.0)
            top, bottom = top + w**3 * r / (w**2).sum(), bottom + w**2
    assert np.allclose(intensity.control_sums(rest, axes), [top, bottom])


def test_sharpening_draws_intensities_to_their_tissue():
    centres = np.linspace(0, 2, intensity.BINS)
    h = sum(np.exp(-0.5 * ((centres - c) / 0.064) ** 2) for c in (0.5, 1.5))
    wanted = intensity.sharpened(h, 0.0, 2.0)
    for c in (0.5, 1.5):
        for off in (-0.08, 0.08):
            assert abs(np.interp(c + off, centres, wanted) - c) < 0.05


@pytest.mark.parametrize("side", [9, 16])
def test_a_planted_field_is_found(spark, side):
    plain, field = tissue(), planted()
    found = field_of(intensity.corrected(frame(spark, s=plain * np.exp(field)), SHAPE, levels=(1, 2), side=side).collect())
    assert ((found - field) ** 2).mean() < 0.05 * field.var()


def test_scans_apart_voxels_without_a_logarithm_and_empty_tables(spark):
    plain, field = tissue(), planted()
    holes = np.where(np.arange(plain.size).reshape(SHAPE) % 7 == 0, 0.0, plain)
    rows = intensity.corrected(frame(spark, a=plain * np.exp(field), b=holes), SHAPE, levels=(1, 2), rounds=8).collect()
    a, b = (field_of([r for r in rows if r["scan_id"] == s]) for s in "ab")
    assert ((a - field) ** 2).mean() < 0.5 * field.var() and np.abs(b).max() < 0.1 and (b[holes == 0] == 0).all()
    assert all(r["value"] == 0 for r in rows if r["scan_id"] == "b" and holes[r["x"], r["y"], r["z"]] == 0)
    assert len(rows) == 2 * plain.size
    assert intensity.corrected(frame(spark, a=plain).limit(0), SHAPE, levels=(1,), rounds=1).count() == 0


def test_a_task_whose_last_sums_have_left_it(spark, monkeypatch):
    """257 scans in one task: what it holds is passed on with the last one, and nothing is left."""
    monkeypatch.setattr(intensity, "BINS", 8)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        images = spark.range(257 * 8).selectExpr("concat('s', id div 8) AS scan_id", "int(id % 2) AS x", "int(id div 2 % 2) AS y", "int(id div 4 % 2) AS z", "double(1 + id % 8) AS value")
        found = intensity.corrected(images, (2, 2, 2), levels=(1,), rounds=1)
        assert found.groupBy("scan_id").count().collect() and found.count() == 257 * 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)

"""The number of components, maps cut to what is active, and components that do not settle."""

import numpy as np
import pytest

from chronovox.kernels import linear
from chronovox.operators import aroma, connect

RNG = np.random.default_rng(4)


def planted(k, frames=20, voxels=600, noise=0.5, seed=0):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(frames, k)) @ rng.laplace(size=(k, voxels)) + noise * rng.normal(size=(frames, voxels))


@pytest.mark.parametrize("k", [1, 3, 7, 12])
def test_the_planted_order_is_found(k):
    for seed in range(5):
        y = planted(k, seed=seed)
        assert linear.model_order(np.linalg.eigvalsh(np.cov(y, bias=True)), y.shape[1]) == k


def test_order_of_small_and_flat_spectra():
    assert linear.model_order(np.array([1.0]), 10) == 1 and linear.model_order(np.array([2.0, 1.0]), 10) == 1
    assert linear.model_order(np.zeros(4), 10) == 1
    assert linear.model_order(np.array([5.0, 4.0, 1.0, 0.95, 0.9, 0.0]), 1000) == 2


def series_of(spark, **scans):
    rows = [(s, v, [float(x) for x in y[:, v]]) for s, y in scans.items() for v in range(y.shape[1])]
    return spark.createDataFrame(rows, "scan_id string, voxel_id long, v array<double>")


def test_orders_and_components_of_scans(spark):
    data = series_of(spark, a=planted(2, seed=1), b=planted(4, seed=2))
    assert {r["scan_id"]: r["components"] for r in connect.model_orders(data).collect()} == {"a": 2, "b": 4}
    found = connect.scan_components(data).where("kind = 'map'").select("scan_id", "comp").distinct().collect()
    assert sorted(map(tuple, found)) == [("a", 0), ("a", 1), *(("b", c) for c in range(4))]
    # both scans share their two sources
    rng = np.random.default_rng(3)
    sources = rng.laplace(size=(2, 600))
    both = series_of(spark, **{s: rng.normal(size=(20, 2)) @ sources + 0.3 * rng.normal(size=(20, 600)) for s in "ab"})
    maps = connect.group_components(both).collect()
    assert {r["comp"] for r in maps} == {0, 1}
    found = np.zeros((2, 600))
    for r in maps:
        found[r["comp"], r["voxel_id"]] = r["value"]
    r = np.abs(np.corrcoef(found, sources)[:2, 2:])
    assert (r.max(axis=0) > 0.95).all()


def test_components_that_do_not_settle_raise():
    # Gaussian variables: their fourth moments single out no direction, up to noise
    with pytest.raises(ValueError, match="settle"):
        linear.independent_turn(np.eye(6), 3, most=1, starts=2)


def mixed(n=20_000, seed=1):
    rng = np.random.default_rng(seed)
    kind = rng.choice(3, n, p=[0.9, 0.07, 0.03])
    x = np.where(kind == 0, rng.normal(0, 1, n), np.where(kind == 1, rng.gamma(16, 0.35, n), -rng.gamma(25, 0.25, n)))
    return x, kind


def test_a_planted_mixture_is_recovered(spark):
    x, kind = mixed()
    rows = [("s", 0, i, float(v)) for i, v in enumerate(x)] + [("s", 1, i, 7.0) for i in range(10)]
    maps = spark.createDataFrame(rows, "scan_id string, comp int, voxel_id long, value double")
    fitted = aroma.mixtures(maps)
    (row,) = fitted.collect()
    assert np.allclose(row["weights"], [0.9, 0.07, 0.03], atol=0.01)
    scale = row["deviation"]
    assert abs(row["centre"] * scale + row["mean"]) < 0.05 and abs(row["spread"] * scale - 1) < 0.05
    cut = {(r["comp"], r["voxel_id"]): r["value"] for r in aroma.active(maps, fitted).collect()}
    on = np.array([cut[0, i] != 0 for i in range(len(x))])
    assert (on == (kind > 0)).mean() > 0.98
    assert np.allclose([cut[0, i] for i in np.flatnonzero(on)], (x[on] - x.mean()) / x.std())
    assert all(cut[1, i] == 0 for i in range(10))  # a flat map


def test_a_map_of_noise_has_little_that_is_active(spark):
    x = np.random.default_rng(6).normal(size=20_000)
    maps = spark.createDataFrame([("s", 0, i, float(v)) for i, v in enumerate(x)], "scan_id string, comp int, voxel_id long, value double")
    cut = aroma.active(maps, aroma.mixtures(maps))
    assert cut.where("value <> 0").count() < 0.02 * len(x)
    assert aroma.active(maps.limit(0), aroma.mixtures(maps.limit(0))).count() == 0

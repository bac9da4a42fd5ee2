"""Slice timing by phases, slice orders, and spikes."""

import numpy as np
import pytest

from chronovox.kernels import spectral
from chronovox.operators import volumes


def test_phases_shift_waves_and_leave_lines():
    t = np.arange(30)
    wave = lambda s: np.sin(2 * np.pi * 3 * (t + s) / 30 + 0.4) + 0.5 * np.cos(2 * np.pi * 7 * (t + s) / 30)
    rows = np.stack([wave(0)] * 3)
    # the waves have no line to speak of: what the fit takes is put back unmoved
    line = lambda r: r.mean() + np.polyfit(t, r, 1)[0] * (t - t.mean())
    got = spectral.phase_shifted(rows, np.array([0.0, 0.3, -1.0]))
    assert np.allclose(got[0], rows[0])
    rest = rows[0] - line(rows[0])
    assert np.allclose(got[2] - line(rows[0]), np.roll(rest, 1))
    assert np.abs(got[1] - wave(0.3))[4:-4].max() < 0.1
    assert np.allclose(spectral.phase_shifted(5.0 + 2.0 * t[None], np.array([0.5])), 5.0 + 2.0 * t)


@pytest.mark.parametrize(
    ("pattern", "order"),
    [("seq+z", [0, 1, 2, 3, 4]), ("seq-z", [4, 3, 2, 1, 0]), ("alt+z", [0, 2, 4, 1, 3]), ("alt+z2", [1, 3, 0, 2, 4]), ("alt-z", [4, 2, 0, 3, 1]), ("alt-z2", [3, 1, 4, 2, 0])],
)
def test_slice_orders(pattern, order):
    times = volumes.acquisition(5, pattern)
    assert sorted(range(5), key=times.__getitem__) == order and sorted(times) == [0.0, 0.2, 0.4, 0.6, 0.8]
    with pytest.raises(ValueError, match="pattern"):
        volumes.acquisition(5, "up")


def test_slices_of_one_wave_come_together(spark):
    t, times = np.arange(40), volumes.acquisition(4, "alt-z")
    rows = [("s", int(k), z, float(np.sin(2 * np.pi * 4 * (k + times[z]) / 40))) for z in range(4) for k in t]
    bold = spark.createDataFrame(rows, "scan_id string, t int, voxel_id long, value double")
    grid = spark.createDataFrame([(z, z) for z in range(4)], "voxel_id long, z int")
    want = np.sin(2 * np.pi * 4 * (t + np.mean(times)) / 40)
    for method, near in (("Fourier", 0.1), ("linear", 0.2)):
        found = volumes.slice_timed(bold, grid, 4, method=method).collect()
        assert len(found) == 160 and max(abs(r["value"] - want[r["t"]]) for r in found if 2 < r["t"] < 37) < near
    with pytest.raises(ValueError, match="time"):
        volumes.slice_timed(bold, grid, 4, method="none")


def test_least_absolute_residuals():
    rng = np.random.default_rng(1)
    y = rng.normal(size=(21, 5))
    assert np.allclose(spectral.least_absolute(np.ones((21, 1)), y), np.median(y, axis=0), atol=1e-4)
    x = spectral.slow_curves(60, 2)
    y = x @ rng.normal(size=(7, 8))
    y[::6] += rng.normal(0, 50, (10, 8))  # most frames lie on the curve, which is then the fit
    assert np.allclose(spectral.least_absolute(x, y)[1], y[1], atol=1e-3)


def test_planted_spikes_are_damped_and_other_frames_kept(spark):
    rng = np.random.default_rng(2)
    t = np.arange(90)
    y = 100 + 0.1 * t[:, None] + 3 * np.sin(2 * np.pi * t / 90)[:, None] + rng.uniform(-1, 1, (90, 6))
    spiked = y.copy()
    at = [(10, 0), (40, 1), (41, 1), (70, 3)]
    for i, j in at:
        spiked[i, j] += 30
    found = spectral.despiked(spiked)
    same = np.ones_like(y, bool)
    for i, j in at:
        same[i, j] = False
        assert abs(found[i, j] - y[i, j]) < 6
    assert np.abs(found - spiked)[same].max() < 0.1 and (found == spiked)[same].mean() > 0.97
    data = spark.createDataFrame([("s", v, t.tolist(), spiked[:, v].tolist()) for v in range(6)] + [("s", 9, [0, 1], [1.0, 5.0]), ("s", 10, [], [])], "scan_id string, voxel_id long, t array<int>, v array<double>")
    rows = {r["voxel_id"]: r["v"] for r in volumes.despiked(data).collect()}
    assert np.allclose([rows[v] for v in range(6)], found.T) and len(rows[9]) == 2 and rows[10] == []
    assert np.allclose(spectral.despiked(np.full((40, 2), 3.0)), 3.0)


def test_boxes_around_what_is_there(spark):
    rows = [("a", x, y, 0, 1.0 if 3 <= x <= 4 and y == 5 else 0.0) for x in range(8) for y in range(8)] + [("b", 0, 0, 0, 2.0), ("c", 0, 0, 0, 0.0)]
    found = volumes.autobox(spark.createDataFrame(rows, "scan_id string, x int, y int, z int, value double")).collect()
    a = {(r["x"], r["y"]): r["value"] for r in found if r["scan_id"] == "a"}
    assert sorted(a) == [(x, y) for x in range(4) for y in range(3)] and [k for k, v in a.items() if v] in ([(1, 1), (2, 1)], [(2, 1), (1, 1)])
    assert [tuple(r)[:4] for r in found if r["scan_id"] != "a"] == [("b", 0, 0, 0)]

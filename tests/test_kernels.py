"""Numeric kernels against plain restatements of their formulas and invariants."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chronovox.kernels import linear, spatial, spectral
from chronovox.operators.regress import outlier_frames

RNG = np.random.default_rng(0)


@settings(max_examples=25, deadline=None)
@given(st.integers(4, 40), st.integers(1, 3), st.integers(0, 10**6))
def test_residuals_are_orthogonal_to_regressors(n, k, seed):
    rng = np.random.default_rng(seed)
    x, y = rng.normal(size=(n, k)), rng.normal(size=(n, 5))
    assert np.abs(x.T @ (y - x @ linear.solve(x, y))).max() < 1e-8 * n


def test_singular_design_raises():
    x = np.ones((5, 2))
    with pytest.raises(np.linalg.LinAlgError):
        linear.solve(x * np.array([1.0, 0.0]), np.ones((5, 1)))
    assert not linear.full_rank(x) and linear.full_rank(np.eye(3))


def test_polynomial_axis():
    x = linear.polynomial(10, np.array([0, 3, 9]), 2)
    assert np.allclose(x, [[-5, 25, 1], [-5 + 30 / 9, (-5 + 30 / 9) ** 2, 1], [5, 25, 1]])


def test_principal_scores_match_svd():
    y = RNG.normal(size=(12, 30)) * np.linspace(1, 3, 30)
    c = y - y.mean(axis=0)
    u, s, _ = np.linalg.svd(c, full_matrices=False)
    got = linear.principal_scores(c @ c.T, 5)
    assert np.allclose(np.abs(got), np.abs(u[:, :5] * s[:5]))
    share = np.cumsum(s**2 / (s**2).sum())
    want, total = 0, 0.0
    while total <= 0.5:
        total += s[want] ** 2 / (s**2).sum()
        want += 1
    assert linear.principal_scores(c @ c.T, None).shape[1] == want and share[want - 1] > 0.5


def coordinates(data, priors=None):
    """As of a scan (frames, voxels) and maps (voxels, given)."""
    priors = np.zeros((data.shape[1], 0)) if priors is None else priors
    everything = np.concatenate([data, priors.T, np.ones((1, data.shape[1]))])
    return linear.Coordinates(everything @ everything.T, priors.shape[1]), everything


def test_coordinates_keep_inner_products():
    data, priors = RNG.normal(size=(12, 200)) + 5, RNG.normal(size=(200, 2))
    at, everything = coordinates(data, priors)
    own = np.concatenate([at.frames, at.maps.T, at.one[None]])
    assert np.allclose(own @ own.T, everything @ everything.T)
    c = RNG.normal(size=(own.shape[1], 3))
    over_voxels = everything.T @ at.weights(c)
    assert np.allclose(over_voxels.T @ everything.T, c.T @ own.T)
    assert np.allclose(at.rms(c), np.sqrt((over_voxels**2).mean(axis=0)))
    assert at.correlation(c[:, 0], c[:, 1]) == pytest.approx(np.corrcoef(over_voxels.T)[0, 1])


def test_standard_form_has_unit_rms_and_reproduces_data():
    maps = RNG.normal(size=(50, 3))
    data = RNG.normal(size=(20, 3)) @ maps.T
    at, everything = coordinates(data, maps)
    f = linear.standard(at, at.maps)
    c = everything.T @ at.weights(f["maps"])
    assert np.allclose((f["traces"] ** 2).mean(axis=0), 1) and np.allclose((c**2).mean(axis=0), 1)
    assert np.allclose(f["traces"] @ (c * f["amplitudes"]).T, data)


def test_fit_finds_the_leading_pattern():
    u, v = RNG.normal(size=(30, 1)), RNG.normal(size=(80, 1))
    data = 5 * u @ v.T + 0.1 * RNG.normal(size=(30, 80))
    at, everything = coordinates(data)
    own = everything.T @ at.weights(linear.Fit(at.frames, 1, np.random.default_rng(1)).maps)
    assert abs((own[:, 0] * np.linalg.svd(data)[2][0]).sum()) > 1 - 1e-5


@pytest.mark.parametrize("new, maps, traces", [(1, 1, 0), (1, 0, 1), (1, 2, 1), (2, 1, 1)])
def test_fit_is_a_fixed_point_of_both_regressions(new, maps, traces):
    """Over all voxels: new traces regress frames on all maps, and new maps regress voxels on all traces."""
    truth = RNG.normal(size=(25, 6)) * [9, 7, 5, 3, 2, 1]
    data = truth @ RNG.normal(size=(6, 90)) + 0.1 * RNG.normal(size=(25, 90))
    fixed, priors = RNG.normal(size=(25, traces)), RNG.normal(size=(90, maps))
    at, everything = coordinates(data, priors)
    f = linear.Fit(at.frames, new, np.random.default_rng(2), maps=at.maps, traces=fixed, tolerance=1e-13, most=5000)
    own, implied = everything.T @ at.weights(f.maps), everything.T @ at.weights(f.implied)
    w = np.linalg.lstsq(np.concatenate([own, priors, implied], axis=1), data.T, rcond=None)[0].T
    assert np.allclose(w[:, :new], f.traces, rtol=1e-4, atol=1e-4 * np.abs(f.traces).max())
    c = np.linalg.lstsq(np.concatenate([w[:, : new + maps], fixed], axis=1), data, rcond=None)[0].T
    assert np.allclose(linear.unit(c[:, :new]), own, atol=1e-4) and np.allclose(linear.unit(c[:, new + maps :]), implied, atol=1e-4)


def test_prior_recovery_follows_the_prior():
    truth = RNG.normal(size=(120, 3))
    data = RNG.normal(size=(40, 3)) * [3, 2, 1] @ truth.T + 0.05 * RNG.normal(size=(40, 120))
    prior = truth[:, :1] + 0.3 * RNG.normal(size=(120, 1))
    for sign in (1, -1):  # the map's sign follows the prior
        at, everything = coordinates(data, sign * prior)
        f = linear.recover_priors(at, 1, 1)
        maps = everything.T @ at.weights(f["maps"])
        assert f["prior_corr"][0] > 0.85 and maps.shape == (120, 3) and f["traces"].shape == (40, 3)
        assert np.allclose((maps**2).mean(axis=0), 1) and np.allclose((f["traces"] ** 2).mean(axis=0), 1)
        assert f["prior_corr"][0] == pytest.approx(np.corrcoef(maps[:, 0], sign * prior[:, 0])[0, 1])


def test_independent_components_separate_sources():
    s = np.stack([np.sign(RNG.normal(size=2000)) * RNG.random(2000) ** 3, RNG.laplace(size=2000), RNG.uniform(size=2000)])
    data = RNG.normal(size=(10, 3)) @ s + 4
    everything = np.concatenate([data, np.ones((1, 2000))])
    white = linear.whitening(everything @ everything.T, 3)
    z = (white @ everything).T
    assert np.allclose(z.mean(axis=0), 0, atol=1e-8) and np.allclose(z.T @ z / 2000, np.eye(3), atol=1e-8)
    p = linear.pairs(z)
    turn = linear.independent_turn(p.T @ p / 2000, 3)
    maps = z @ turn.T
    c = np.abs(np.corrcoef(maps.T, s))[:3, 3:]
    assert c.max(axis=1).min() > 0.97 and len(set(c.argmax(axis=1))) == 3
    # a fixed point of the step over all voxels
    step = np.stack([(z * (maps[:, k] ** 3)[:, None]).mean(axis=0) - 3 * turn[k] for k in range(3)])
    u, _, v = np.linalg.svd(step)
    assert np.allclose(np.abs((u @ v * turn).sum(axis=1)), 1, atol=1e-6)


def test_gap_fill_against_one_frequency_at_a_time():
    tr, n = 1.5, 61
    t = tr * np.arange(1, n + 1)
    kept = np.ones(n, bool)
    kept[[10, 11, 40, 55]] = False
    x = np.stack([np.sin(2 * np.pi * t / 15) + 0.1 * RNG.normal(size=n), RNG.normal(size=n)], axis=1)[kept]
    got = spectral.fill_gaps(x, tr, kept)
    assert np.array_equal(got[kept], x)
    good, model = t[kept], np.zeros((n, 2))
    step = 2 * np.pi / (good.max() - good.min() + tr)
    for k in range(1, int(np.pi / tr / step) + 1):
        w = k * step
        theta = np.arctan2(np.sin(2 * w * good).sum(), np.cos(2 * w * good).sum()) / (2 * w)
        for wave in (np.cos, np.sin):
            b = wave(w * (good - theta))
            model += np.outer(wave(w * (t - theta)), b @ x / (b @ b))
    own = model[kept]
    want = (model - own.mean(axis=0)) * x.std(axis=0) / own.std(axis=0) + x.mean(axis=0)
    assert np.allclose(got[~kept], want[~kept])
    assert np.isfinite(spectral.fill_gaps(x[:50], tr, np.ones(50, bool))).all()  # an even number of frames meets the Nyquist frequency


@pytest.mark.parametrize("kind", ["low", "high", "band"])
def test_filter_gain_is_the_butterworth_formula(kind):
    tr, n = 1.0, 4000
    low, high = 0.08, 0.2
    args = {"low": (None, high), "high": (low, None), "band": (low, high)}[kind]
    warp = lambda f: np.tan(np.pi * f * tr)
    for f in (0.02, 0.06, 0.12, 0.19, 0.3):
        x = np.sin(2 * np.pi * f * np.arange(n))[:, None]
        y = spectral.zero_phase(x, tr, *args)[n // 4 : -n // 4]
        ratio = {
            "low": warp(f) / warp(high),
            "high": warp(low) / warp(f),
            "band": (warp(f) ** 2 - warp(low) * warp(high)) / (warp(f) * (warp(high) - warp(low))),
        }[kind]
        want = 1 / (1 + ratio**6)  # the squared gain, as the filter runs both ways
        assert np.allclose(y, want * x[n // 4 : -n // 4], atol=2e-3)


def test_filter_passes_constants_without_edges():
    x = np.full((50, 2), 3.0)
    assert np.allclose(spectral.zero_phase(x, 1.0, None, 0.1), 3.0)
    assert np.allclose(spectral.zero_phase(x, 1.0, 0.1, None), 0.0)


@pytest.mark.parametrize("n", [31, 32])
def test_scrambled_keeps_the_power_spectrum(n):
    x = RNG.normal(size=n)
    y = spectral.scrambled(x, np.random.default_rng(1))
    assert np.allclose(np.abs(np.fft.fft(x)), np.abs(np.fft.fft(y))) and not np.allclose(x, y)


def test_null_regressors_are_orthogonal():
    x, kept = RNG.normal(size=(55, 3)), np.ones(60, bool)
    kept[[3, 20, 21, 40, 41]] = False
    y = spectral.null_regressors(x, 1.0, kept, seed=5)
    assert np.abs(x.T @ y).max() < 1e-8 and np.array_equal(y, spectral.null_regressors(x, 1.0, kept, seed=5))


def test_welch_finds_power_and_frequency():
    x = np.sin(2 * np.pi * 0.1 * np.arange(1000))[:, None]
    f, p = spectral.welch(x, 1.0, 250)
    assert f[p[:, 0].argmax()] == pytest.approx(0.1) and p[:, 0].sum() * (f[1] - f[0]) == pytest.approx(0.5, rel=0.01)


def test_high_frequency_content_at_half_power():
    power = np.ones((100, 1))
    assert spectral.high_frequency_content(power, 1.0)[0] == pytest.approx(0.5, abs=0.02)


def test_outlier_frames_are_a_fixed_point():
    trace = np.concatenate([RNG.normal(size=60), [9.0, 9.5, 30.0]])
    kept = outlier_frames(trace)
    assert not kept[-3:].any() and kept.sum() > 50
    # the set of frames kept is the one that it gives rise to
    assert np.array_equal(kept, np.abs(trace - trace[kept].mean()) < 2.5 * trace[kept].std())
    assert not outlier_frames(np.ones(5)).any()  # no deviation: no frame is within it
    for seed in range(200):  # a fixed point, or sets that follow one another for ever
        x = np.random.default_rng(seed).standard_t(2, size=20)
        try:
            kept = outlier_frames(x, 1.2)
        except ValueError:
            continue
        assert not kept.any() or np.array_equal(kept, np.abs(x - x[kept].mean()) < 1.2 * x[kept].std())


def test_smoothing_keeps_a_constant_and_the_mask():
    mask = np.zeros((9, 9, 9), bool)
    mask[2:8, 1:7, 3:9] = True
    out = spatial.smooth(np.where(mask, 7.0, -3.0), mask, 2.5, (1.0, 1.0, 0.5))
    assert np.allclose(out[mask], 7.0) and not out[~mask].any()


def test_rigid_motion_and_displacement():
    m = np.zeros((3, 6))
    m[1, :3] = (3, 4, 0)
    points = RNG.normal(size=(5, 3))
    assert np.allclose(spatial.displacement(points, m), [5, 5, 0])
    r = spatial.rigid(np.array([1, 2, 3, 0.1, 0.2, 0.3]))
    assert np.allclose(r[:3, :3] @ r[:3, :3].T, np.eye(3))


def test_otsu_splits_separate_groups():
    centres = np.arange(60.0)
    h = np.zeros(60)
    h[2:8], h[25:32], h[50:57] = 10, 7, 5
    a, b = spatial.otsu(h, centres, 3)
    assert 7 <= a < 25 and 31 <= b < 50


def test_reorder_uses_each_axis_once():
    axes, signs = spatial.reorder(np.array([[0, -1, 0], [1, 0, 0], [0, 0, 1]]))
    assert axes.tolist() == [1, 0, 2] and signs.tolist() == [-1, 1, 1]


def splined(v):
    """Coefficients of the spline through a whole volume."""
    for axis, n in enumerate(v.shape):
        v = np.moveaxis(np.linalg.solve(spatial.spline_matrix(n), np.moveaxis(v, axis, 0).reshape(n, -1)).reshape(n, *np.delete(v.shape, axis)), 0, axis)
    return v


@pytest.mark.parametrize("kind", sorted(spatial.INTERPOLATORS))
def test_interpolators_run_through_the_values(kind):
    v = RNG.normal(size=(5, 1, 7))
    at = np.stack(np.meshgrid(*map(range, v.shape), indexing="ij"), axis=-1).reshape(-1, 3).astype(float)
    box = splined(v) if kind == "bspline" else v
    assert np.allclose(spatial.interpolated(box, at, kind, v.shape, np.zeros(3, int)), v.ravel(), atol=1e-12)
    out = np.array([[-0.6, 0, 0], [4.6, 0, 0], [0, 0, 7.2], [0, 0.6, 0]])
    assert not spatial.interpolated(box, out, kind, v.shape, np.zeros(3, int)).any()


def test_splines_reproduce_cubics_inside():
    x = np.arange(40.0)
    v = (0.01 * (x - 20) ** 3 - x)[:, None, None]
    p = np.stack([np.linspace(15, 25, 33), np.zeros(33), np.zeros(33)], axis=1)
    assert np.allclose(spatial.interpolated(splined(v), p, "bspline", v.shape, np.zeros(3, int)), 0.01 * (p[:, 0] - 20) ** 3 - p[:, 0], atol=1e-4)

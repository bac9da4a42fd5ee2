"""Frequency-domain kernels along frames (first axis)."""

from __future__ import annotations

import numpy as np

from . import linear


def fill_gaps(x: np.ndarray, tr: float, kept: np.ndarray, rescale: bool = True) -> np.ndarray:
    """Values at all frames from those at the kept ones, by a fit of shifted cosines and sines at each harmonic.

    Kept frames stay as they are.  The time shift of a frequency makes its
    cosine and sine orthogonal over the kept frames.
    """
    t = tr * np.arange(1, len(kept) + 1)
    good = t[kept]
    step = 2 * np.pi / (good.max() - good.min() + tr)
    w = step * np.arange(1, int(np.pi / tr / step) + 1)
    shift = np.arctan2(np.sin(2 * np.outer(w, good)).sum(axis=1), np.cos(2 * np.outer(w, good)).sum(axis=1)) / (2 * w)
    fit, everywhere = (times[:, None] * w - w * shift for times in (good, t))
    c, s = np.cos(fit), np.sin(fit)
    # at the Nyquist frequency one of the two may be 0 at every kept frame: then it says nothing
    part = lambda b: np.where((size := (b**2).sum(axis=0)) > 1e-9 * len(good), 1 / np.maximum(size, 1e-300), 0.0)[:, None] * (b.T @ x)
    model = np.cos(everywhere) @ part(c) + np.sin(everywhere) @ part(s)
    if rescale:
        own = model[kept]
        with np.errstate(invalid="ignore", divide="ignore"):
            model = (model - own.mean(axis=0)) * (x.std(axis=0) / own.std(axis=0)) + x.mean(axis=0)
    out = model.copy()
    out[kept] = x
    return out


def butterworth(order: int, cutoff: float | tuple[float, float], kind: str) -> tuple[np.ndarray, np.ndarray, float]:
    """Zeros, poles and gain of a digital Butterworth filter; cutoffs are shares of the Nyquist frequency.

    Analogue prototype, frequency transform, then the bilinear map.
    """
    warped = 4 * np.tan(np.pi * np.atleast_1d(cutoff) / 2)  # at a sampling rate of 2
    p = -np.exp(1j * np.pi * np.arange(-order + 1, order, 2) / (2 * order))
    z, k = np.zeros(0, complex), 1.0
    if kind == "low":
        p, k = p * warped[0], warped[0] ** order
    elif kind == "high":
        k = np.real(1 / np.prod(-p))
        p, z = warped[0] / p, np.zeros(order, complex)
    else:
        width, centre = warped[1] - warped[0], np.sqrt(warped[0] * warped[1])
        half = p * width / 2
        root = np.sqrt(half**2 - centre**2)
        p, z, k = np.concatenate([half + root, half - root]), np.zeros(order, complex), width**order
    k = k * np.real(np.prod(4 - z) / np.prod(4 - p))
    z = np.concatenate([(4 + z) / (4 - z), -np.ones(len(p) - len(z))])
    return z, (4 + p) / (4 - p), k


def sections(z: np.ndarray, p: np.ndarray, k: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Second-order sections (b, a): poles in conjugate pairs, each with the nearest zeros."""
    z, p = list(z), list(p)
    out = []
    while p:
        a = p.pop(int(np.argmax(np.abs(p))))
        pair = [a]
        if abs(a.imag) > 1e-12:
            pair.append(p.pop(int(np.argmin(np.abs(np.array(p) - np.conj(a))))))
        elif p and (real := [i for i, x in enumerate(p) if abs(x.imag) <= 1e-12]):
            pair.append(p.pop(max(real, key=lambda i: abs(p[i]))))
        near = [z.pop(int(np.argmin(np.abs(np.array(z) - a)))) for _ in range(min(len(pair), len(z)))]
        pad = lambda v: np.concatenate([np.real(v), np.zeros(3 - len(v))])
        out.append((pad(np.poly(near)), pad(np.poly(pair))))
    out[0] = (out[0][0] * k, out[0][1])
    return out[::-1]


def _run(x: np.ndarray, b: np.ndarray, a: np.ndarray, state: np.ndarray) -> np.ndarray:
    """One section in transposed direct form II."""
    y = np.empty_like(x)
    s1, s2 = state
    for i, v in enumerate(x):
        y[i] = b[0] * v + s1
        s1 = b[1] * v - a[1] * y[i] + s2
        s2 = b[2] * v - a[2] * y[i]
    return y


def zero_phase(x: np.ndarray, tr: float, high_pass: float | None = None, low_pass: float | None = None, order: int = 3) -> np.ndarray:
    """Butterworth filter forward and backward, with odd extension at both ends and steady initial states."""
    nyquist = 0.5 / tr
    if high_pass is not None and low_pass is not None:
        parts = sections(*butterworth(order, (high_pass / nyquist, low_pass / nyquist), "band"))
    elif high_pass is not None:
        parts = sections(*butterworth(order, high_pass / nyquist, "high"))
    else:
        parts = sections(*butterworth(order, low_pass / nyquist, "low"))
    short = min(sum(abs(b[2]) < 1e-14 for b, _ in parts), sum(abs(a[2]) < 1e-14 for _, a in parts))
    edge = min(3 * (2 * len(parts) + 1 - short), len(x) - 1)
    wide = np.concatenate([2 * x[0] - x[edge:0:-1], x, 2 * x[-1] - x[-2 : -edge - 2 : -1]])

    def once(y):
        level = np.ones(1) * y[0]
        for b, a in parts:
            # the state in which a constant input of this level gives a constant output
            gain = b.sum() / a.sum()
            s2 = b[2] - a[2] * gain
            s1 = b[1] - a[1] * gain + s2
            y = _run(y, b, a, (s1 * level, s2 * level))
            level = level * gain
        return y

    return once(once(wide)[::-1])[::-1][edge : edge + len(x)]


def scrambled(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Same power spectrum with phases of the half spectrum shuffled and mirrored."""
    n = len(x)
    f = np.fft.fft(x)
    phase = np.angle(f)
    half = rng.permutation(phase[1 : (n + 1) // 2])
    phase[1 : (n + 1) // 2] = half
    phase[n - len(half) :] = -half[::-1]
    return np.fft.ifft(np.abs(f) * np.exp(1j * phase)).real


def null_regressors(x: np.ndarray, tr: float, kept: np.ndarray, seed: int = 0, most_corr: float = 0.1, most: int = 100) -> np.ndarray:
    """Phase-randomised versions of each regressor, orthogonal to all regressors."""
    rng, out = np.random.default_rng(seed), np.zeros_like(x)
    for i in range(x.shape[1]):
        whole = fill_gaps(x[:, i : i + 1], tr, kept)[:, 0]
        for _ in range(most + 1):
            y = scrambled(whole, rng)[kept]
            if abs(np.corrcoef(x[:, i], y)[0, 1]) <= most_corr:
                break
        out[:, i] = y - x @ linear.solve(x, y)
    return out


def welch(x: np.ndarray, rate: float, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Power density of each column: Hann windows that overlap by half, each with its mean removed."""
    window = min(window, len(x))
    hann = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(window) / window)
    step = window - window // 2
    total, n = 0.0, 0
    for at in range(0, len(x) - window + 1, step):
        part = x[at : at + window]
        f = np.fft.rfft((part - part.mean(axis=0)) * hann[:, None], axis=0)
        total, n = total + np.abs(f) ** 2, n + 1
    power = total / n / (rate * (hann**2).sum())
    power[1 : None if window % 2 else -1] *= 2
    return np.fft.rfftfreq(window, 1 / rate), power


def high_frequency_content(power: np.ndarray, tr: float, least: float = 0.01) -> np.ndarray:
    """Where half of each column's power lies between ``least`` Hz (0) and Nyquist (1); rows are evenly spaced frequencies above 0."""
    nyquist = 1 / (2 * tr)
    f = nyquist * np.arange(1, len(power) + 1) / len(power)
    power, f = power[f > least], f[f > least]
    share = np.cumsum(power, axis=0) / power.sum(axis=0)
    return ((f - least) / (nyquist - least))[np.argmin(np.abs(share - 0.5), axis=0)]


def phase_shifted(rows: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Rows of frames at ``shift`` frames later, by the phases of their Fourier series; each row's straight line is left where it is."""
    n = rows.shape[1]
    t = np.arange(n) - (n - 1) / 2
    mean = rows.mean(axis=1, keepdims=True)
    line = mean + (rows @ t / max((t**2).sum(), 1e-300))[:, None] * t
    turn = np.exp(2j * np.pi * np.arange(n // 2 + 1) * np.asarray(shift, float)[:, None] / n)
    return line + np.fft.irfft(np.fft.rfft(rows - line) * turn, n)


def slow_curves(frames: int, waves: int) -> np.ndarray:
    """Columns: a constant, a line, a parabola, and sines and cosines of 1 to ``waves`` turns."""
    u = np.linspace(-1, 1, frames)
    angle = 2 * np.pi * np.arange(frames) / frames
    turns = [f(k * angle) for k in range(1, waves + 1) for f in (np.sin, np.cos)]
    return np.stack([np.ones(frames), u, u**2, *turns], axis=1)


def least_absolute(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Fitted values (frames, voxels) of the least sum of absolute residuals, by reweighted least squares whose floor falls with the rounds."""
    size = np.maximum(np.abs(y - np.median(y, axis=0)).mean(axis=0), 1e-300)
    w = np.ones_like(y)
    for k in range(rounds):
        normal = np.einsum("tp,tv,tq->vpq", x, w, x, optimize=True) + 1e-12 * np.eye(x.shape[1])
        fitted = x @ np.linalg.solve(normal, np.einsum("tp,tv->vp", x, w * y)[..., None])[..., 0].T
        w = size / np.maximum(np.abs(y - fitted), size * max(1e-9, 0.5**k))
        w /= w.max(axis=0)
    return fitted


#: From how many deviations a frame is squashed, and where it ends at most.
SQUASH_FROM, SQUASH_TO = 2.5, 4.0


def despiked(y: np.ndarray, waves: int | None = None) -> np.ndarray:
    """Series (frames, voxels) whose outliers from a slow curve (fitted by least absolute residuals) are drawn towards it; the other frames stay."""
    n = len(y)
    waves = n // 30 if waves is None else waves
    curve = least_absolute(slow_curves(n, waves)[:, : max(1, min(3 + 2 * waves, n - 1))], y)
    rest = y - curve
    deviation = 1.4826 * np.median(np.abs(rest), axis=0)
    s = np.divide(np.abs(rest), deviation, out=np.zeros_like(rest), where=deviation > 0)
    reach = SQUASH_TO - SQUASH_FROM
    near = SQUASH_FROM + reach * np.tanh((s - SQUASH_FROM) / reach)
    return np.where(s > SQUASH_FROM, curve + np.sign(rest) * near * deviation, y)

"""Signal processing per (episode, stream): zero-phase low-pass filter, spectral retention, lags.

These need whole series at once and run as grouped Arrow functions; a group is one episode's stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def butterworth(order: int, cutoff: float, rate: float) -> np.ndarray:
    """Low-pass sections (b0, b1, b2, 1, a1, a2) of an even-order Butterworth filter, from the analog
    poles by the bilinear transform with a prewarped cutoff."""
    if order < 2 or order % 2:
        raise ValueError("the order must be even and positive")
    if not 0 < cutoff < rate / 2:
        raise ValueError("the cutoff must lie below half the sampling rate")
    w = 2 * rate * np.tan(np.pi * cutoff / rate)
    out = []
    for k in range(order // 2):
        p = w * np.exp(1j * np.pi * (2 * k + order + 1) / (2 * order))
        z = (2 * rate + p) / (2 * rate - p)
        a1, a2 = -2 * z.real, abs(z) ** 2
        g = (1 + a1 + a2) / 4  # unit gain at zero frequency
        out.append((g, 2 * g, g, 1.0, a1, a2))
    return np.array(out)


BLOCK = 128


@lru_cache(maxsize=16)
def section_responses(section: tuple[float, ...], n: int) -> tuple[np.ndarray, np.ndarray]:
    """A section's outputs and states over n steps from an impulse, and from each of its two states:
    (responses: 3 x n, states before each step and after the last: 3 x (n + 1) x 2). Plain numbers, as
    arrays of three would take most of the time of a short series."""
    b0, b1, b2, _, a1, a2 = section
    y, z = np.zeros((3, n)), np.zeros((3, n + 1, 2))
    for k, (x, u, v) in enumerate(((1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 1.0))):
        out, states = [], [(u, v)]
        for _ in range(n):
            o = b0 * x + u
            u, v = b1 * x - a1 * o + v, b2 * x - a2 * o
            x = 0.0
            out.append(o)
            states.append((u, v))
        y[k], z[k] = out, states
    return y, z


def run_sections(sections: np.ndarray, x: np.ndarray, steady: np.ndarray | None = None) -> np.ndarray:
    """Sections one after the other over the first axis; `steady` scales the states of a constant
    input to start from. A block of samples is one product with the section's impulse responses, and
    the two states carry over to the next block."""
    y = x.astype(float)
    shape = y.shape
    y = y.reshape(len(y), -1)
    level = np.asarray(steady, float).reshape(-1) if steady is not None else None
    for section in sections:
        b0, b1, b2, _, a1, a2 = section
        gain = (b0 + b1 + b2) / (1 + a1 + a2)
        state = np.zeros((2, y.shape[1]))
        if level is not None:
            state[1] = (b2 - a2 * gain) * level
            state[0] = (b1 - a1 * gain) * level + state[1]
        n = min(BLOCK, len(y))
        out, z = section_responses(tuple(section.tolist()), n)
        lags = np.arange(n)[:, None] - np.arange(n)
        toeplitz = np.where(lags >= 0, out[0][np.maximum(lags, 0)], 0.0)
        done = np.empty_like(y)
        for i in range(0, len(y), n):
            part = y[i : i + n]
            m = len(part)
            done[i : i + m] = toeplitz[:m, :m] @ part + out[1:, :m].T @ state
            state = z[0, m:0:-1].T @ part + z[1:, m].T @ state
        y = done
        level = gain * level if level is not None else None
    return y.reshape(shape)


def zero_phase(sections: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Forwards and backwards over the series, extended by odd reflection at both ends."""
    n = min(3 * (2 * len(sections) + 1), len(x) - 1)
    ext = np.concatenate([2 * x[0] - x[n:0:-1], x, 2 * x[-1] - x[-2 : -n - 2 : -1]]) if n else x
    y = run_sections(sections, ext, ext[0])
    y = run_sections(sections, y[::-1], y[-1])[::-1]
    return y[n : n + len(x)] if n else y


def regular_grid(t: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(median interval, times from the first one on, the grid at that interval)."""
    if len(t) < 4:
        raise ValueError("a filter needs four samples")
    dt = np.diff(t)
    if (dt <= 0).any():
        raise ValueError("times must increase")
    step = float(np.median(dt))
    return step, t - t[0], np.arange(0, t[-1] - t[0] + dt.mean() / 2, step)


def at_times(at: np.ndarray, t: np.ndarray, v: np.ndarray) -> np.ndarray:
    return np.stack([np.interp(at, t, c) for c in v.T], axis=1)


def low_pass(t: np.ndarray, v: np.ndarray, cutoff: float, order: int) -> np.ndarray:
    """Regular grid at the median interval, zero-phase filter, back to the sample times."""
    step, rel, grid = regular_grid(t)
    out = zero_phase(butterworth(order, cutoff, 1 / step), at_times(grid, rel, v))
    return at_times(rel, grid, out)


def filtered(df: DataFrame, by: Sequence[str], t: str, value: str, per_second: float, cutoff: float = 10.0, order: int = 4, into: str | None = None) -> DataFrame:
    """Rows (by, t, value) with the vector column filtered; series that can't be keep their values and
    say why in `filter_error`. With `into`, that column has the filtered values beside the given ones."""
    kept = [*by, t, *([value] if into else [])]
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept), f"`{into or value}` array<double>", "filter_error string"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(t, kind="stable")
        v = np.stack(pdf[value].to_numpy()).astype(float)
        error = None
        try:
            v = low_pass(pdf[t].to_numpy(float) / per_second, v, cutoff, order)
        except ValueError as e:
            error = str(e)
        return pdf[kept].assign(**{into or value: list(v), "filter_error": error})

    return df.select(*by, t, value).groupBy(*by).applyInPandas(run, schema)


def welch(x: np.ndarray, rate: float, size: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Power spectral density: Hann windows of half overlap, each without its linear trend, averaged."""
    size = min(size, len(x))
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(size) / size)
    step = max(1, size - size // 2)
    k = np.arange(size) - (size - 1) / 2
    parts = [x[i : i + size] for i in range(0, len(x) - size + 1, step)]
    level = [p - p.mean(axis=0) - np.outer(k, k @ p / (k @ k)) for p in parts]
    power = np.mean([np.abs(np.fft.rfft(p * window[:, None], axis=0)) ** 2 for p in level], axis=0) / (rate * (window**2).sum())
    power[1 : -1 if size % 2 == 0 else None] *= 2
    return np.fft.rfftfreq(size, 1 / rate), power


def band(f: np.ndarray, p: np.ndarray, lo: float, hi: float) -> float:
    m = (f >= lo) & (f <= hi)
    return float(np.trapezoid(p[m], f[m], axis=0).sum()) if m.sum() > 1 else 0.0


def retention(t: np.ndarray, before: np.ndarray, after: np.ndarray, low=(0.5, 10.0), high: float = 15.0) -> tuple[float | None, float | None]:
    """Share of the velocity's band power that filtering left, below and above, on the regular grid."""
    step, rel, grid = regular_grid(t)
    a, b = (np.gradient(at_times(grid, rel, v), step, axis=0) for v in (before, after))
    f, pa = welch(a, 1 / step)
    _, pb = welch(b, 1 / step)
    out = []
    for lo, hi in (low, (high, np.inf)):
        whole = band(f, pa, lo, hi)
        out.append(band(f, pb, lo, hi) / whole if whole > 0 else None)
    return out[0], out[1]


def filter_report(df: DataFrame, by: Sequence[str], t: str, before: str, after: str, per_second: float, cutoff: float = 10.0, high: float | None = None) -> DataFrame:
    """(by, low_retention, high_retention, filter_error) per series of `filtered`. The bands follow the
    cutoff: from a twentieth of it to it, and from `high` on, one and a half times the cutoff if not given.
    Null: fewer than two of the spectrum's frequencies in the band, no power there, or no spectrum for the
    reason in filter_error."""
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by), "low_retention double, high_retention double, filter_error string"])
    bands = {"low": (cutoff / 20, cutoff), "high": 1.5 * cutoff if high is None else high}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(t, kind="stable")
        left, error = (None, None), pdf["filter_error"].iloc[0]
        try:
            left = retention(pdf[t].to_numpy(float) / per_second, *(np.stack(pdf[c].to_numpy()).astype(float) for c in (before, after)), **bands)
        except ValueError as e:
            error = error or str(e)
        return pd.DataFrame([{**{c: pdf[c].iloc[0] for c in by}, "low_retention": left[0], "high_retention": left[1], "filter_error": error}])

    return df.select(*by, t, before, after, "filter_error").groupBy(*by).applyInPandas(run, schema)

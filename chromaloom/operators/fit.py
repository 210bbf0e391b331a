"""Negative binomial fits of many places at once: each row has its samples' counts, size factors and sides."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

#: Dispersions tried, and how many of them around the best are tried again more finely.
GRID = np.geomspace(1e-8, 50.0, 61)
LEAST = 1e-8


def _doubles(*names: str) -> StructType:
    return StructType([StructField(n, DoubleType()) for n in names])


def log_gamma(x: np.ndarray) -> np.ndarray:
    """By Stirling's series eight places up."""
    y = x + 8
    series = (y - 0.5) * np.log(y) - y + 0.918938533204672742 + (1 / 12 - (1 / 360 - 1 / (1260 * y * y)) / (y * y)) / y
    return series - np.log(x * (x + 1) * (x + 2) * (x + 3)) - np.log((x + 4) * (x + 5) * (x + 6) * (x + 7))


def trigamma(x: float) -> float:
    out = 0.0
    while x < 8:
        out, x = out + 1 / (x * x), x + 1
    return out + 1 / x + 1 / (2 * x * x) + 1 / (6 * x**3) - 1 / (30 * x**5)


def _stack(*columns: pd.Series) -> list[np.ndarray]:
    return [np.array(c.tolist(), float).reshape(len(c), -1) for c in columns]


def group_means(n: np.ndarray, factor: np.ndarray, side: np.ndarray, dispersion: np.ndarray, rounds: int = 12) -> np.ndarray:
    """(rows, 2): the likeliest mean of each side over its size factors, by Newton's steps."""
    out = np.empty((len(n), 2))
    for k in (0, 1):
        own = side == k
        size = np.where(own, factor, 0.0)
        q = (n * own).sum(1) / size.sum(1)
        for _ in range(rounds):
            mu = size * q[:, None]
            weight = 1 / (1 + dispersion[:, None] * mu)
            step = ((n - mu) * own * weight).sum(1) / np.maximum((size * weight).sum(1), 1e-300)
            q = np.maximum(q + step, 0.0)
        out[:, k] = q
    return out


def _profile(n: np.ndarray, mu: np.ndarray, side: np.ndarray, dispersion: np.ndarray) -> np.ndarray:
    """Log likelihood of a dispersion for each row, less what the fitted means use up (Cox and Reid)."""
    r = 1 / dispersion[:, None]
    value = (log_gamma(n + r) - log_gamma(r) - (n + r) * np.log1p(mu / r) + n * np.log(np.maximum(mu, 1e-300) / r) * (n > 0)).sum(1)
    weight = mu / (1 + dispersion[:, None] * mu)
    used = sum(np.log(np.maximum((weight * (side == k)).sum(1), 1e-300)) for k in (0, 1))
    return value - 0.5 * used


def _best(n: np.ndarray, mu: np.ndarray, side: np.ndarray, centre: np.ndarray | None = None, spread: np.ndarray | None = None) -> np.ndarray:
    """The likeliest dispersion of each row, with a prior on its logarithm if one is given."""

    def value(log_d: np.ndarray) -> np.ndarray:
        v = _profile(n, mu, side, np.exp(log_d))
        return v if centre is None else v - (log_d - centre) ** 2 / (2 * spread)

    grid = np.log(GRID)
    tried = np.array([value(np.full(len(n), g)) for g in grid])
    at = grid[tried.argmax(0)]
    step = grid[1] - grid[0]
    for _ in range(3):  # a finer grid around the best
        offsets = np.linspace(-step, step, 9)
        tried = np.array([value(at + o) for o in offsets])
        at, step = at + offsets[tried.argmax(0)], step / 4
    return np.clip(np.exp(at), LEAST, GRID[-1])


def _fitted_means(n: np.ndarray, factor: np.ndarray, side: np.ndarray, dispersion: np.ndarray) -> np.ndarray:
    q = group_means(n, factor, side, dispersion)
    return factor * np.where(side == 1, q[:, 1:], q[:, :1])


@F.pandas_udf(_doubles("base_mean", "own"))
def own_dispersion(n: pd.Series, factor: pd.Series, side: pd.Series) -> pd.DataFrame:
    """The mean over size factors, and the dispersion by a place's own counts."""
    if not len(n):
        return pd.DataFrame({"base_mean": [], "own": []}, dtype=float)
    x, s, k = _stack(n, factor, side)
    mu = _fitted_means(x, s, k, np.full(len(x), 0.1))
    own = _best(x, mu, k) if x.shape[1] > 2 else np.full(len(x), LEAST)  # two samples can't tell
    return pd.DataFrame({"base_mean": (x / s).mean(1), "own": own})


def trend(places: pd.DataFrame) -> pd.DataFrame:
    """Dispersion = asymptote + slope / mean over a viewpoint's places, and how far logarithms lie from it."""
    places = places.sort_values(["base_mean", "own"])
    mean, own = places["base_mean"].to_numpy(), places["own"].to_numpy()
    told = own > 100 * LEAST
    asymptote, slope, spread = float(np.median(own)), 0.0, 1.0
    if told.sum() >= 3 and 2 * told.sum() >= len(own):  # else most places have none that counts could tell
        x, y = 1 / mean[told], own[told]
        for _ in range(10):  # variances as the squares of what is fitted
            w = 1 / np.maximum(asymptote + slope * x, LEAST) ** 2
            a, b, c, d, e = w.sum(), (w * x).sum(), (w * x * x).sum(), (w * y).sum(), (w * x * y).sum()
            det = a * c - b * b
            asymptote, slope = ((c * d - b * e) / det, (a * e - b * d) / det) if det > 1e-12 * a * c else (d / a, 0.0)
            if asymptote < LEAST:
                asymptote, slope = LEAST, max(e / c, 0.0)
            if slope < 0:
                asymptote, slope = d / a, 0.0
        away = np.log(y) - np.log(np.maximum(asymptote + slope * x, LEAST))
        spread = float((1.4826 * np.median(np.abs(away - np.median(away)))) ** 2)
    return pd.DataFrame({"viewpoint": [places["viewpoint"].iloc[0]], "asymptote": [max(asymptote, LEAST)], "slope": [slope], "spread": [spread]})


@F.pandas_udf(_doubles("mean_a", "mean_b", "change", "error", "dispersion"))
def tested(n: pd.Series, factor: pd.Series, side: pd.Series, own: pd.Series, mean: pd.Series, asymptote: pd.Series, slope: pd.Series, spread: pd.Series) -> pd.DataFrame:
    """Means of both sides, the log ratio and its standard error with the dispersion drawn to the trend."""
    if not len(n):
        return pd.DataFrame({c: [] for c in ("mean_a", "mean_b", "change", "error", "dispersion")}, dtype=float)
    x, s, k = _stack(n, factor, side)
    own, usual = own.to_numpy(), np.maximum(asymptote.to_numpy() + slope.to_numpy() / mean.to_numpy(), LEAST)
    if x.shape[1] > 2:
        width = np.maximum(spread.to_numpy() - trigamma((x.shape[1] - 2) / 2), 0.25)
        drawn = _best(x, _fitted_means(x, s, k, own), k, np.log(usual), width)
        dispersion = np.where(np.log(own) > np.log(usual) + 2 * np.sqrt(np.maximum(spread.to_numpy(), 0.25)), own, drawn)
    else:
        dispersion = usual
    q = group_means(x, s, k, dispersion)
    sizes = [(k == j).sum(1) for j in (0, 1)]
    floor = np.stack([0.5 / c for c in sizes], 1)
    held = np.maximum(q, floor)
    mu = s * np.where(k == 1, held[:, 1:], held[:, :1])
    weight = mu / (1 + dispersion[:, None] * mu)
    variance = sum(1 / (weight * (k == j)).sum(1) for j in (0, 1))
    return pd.DataFrame({"mean_a": q[:, 0], "mean_b": q[:, 1], "change": np.log(held[:, 1] / held[:, 0]), "error": np.sqrt(variance), "dispersion": dispersion})

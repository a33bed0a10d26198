"""Regressions of a series on its lags, all of them from the Gram matrix of one distributed pass.

``g`` is X'X of ``[1, y, lag 1..p]`` over ``n`` rows (``series.gram`` or ``series.wide_gram``), so what
the driver works on has the size of the order, whatever the series' length.
"""

from __future__ import annotations

from math import exp, lgamma, log

import numpy as np
from pyspark.sql import DataFrame

from barforge.operators import series

METHODS = ("ols", "ridge", "lasso", "elastic_net", "auto")


def centred(g: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Covariances of the lags, their covariances with y, their means and y's."""
    mean, y = g[0, 2:] / n, float(g[0, 1] / n)
    return g[2:, 2:] / n - np.outer(mean, mean), g[2:, 1] / n - mean * y, mean, y


def penalised(cov: np.ndarray, with_y: np.ndarray, alpha: float, l1_ratio: float, rounds: int = 10_000, tol: float = 1e-10) -> np.ndarray:
    """Coefficients of least ``|y - Xw|^2 / 2n + alpha * (l1_ratio |w|_1 + (1 - l1_ratio) |w|^2 / 2)``, by coordinate descent."""
    w = np.zeros(len(with_y))
    for _ in range(rounds):
        most = 0.0
        for j in range(len(w)):
            if cov[j, j] <= 0:
                continue
            free = with_y[j] - cov[j] @ w + cov[j, j] * w[j]
            now = np.sign(free) * max(abs(free) - alpha * l1_ratio, 0.0) / (cov[j, j] + alpha * (1 - l1_ratio))
            most, w[j] = max(most, abs(now - w[j])), now
        if most <= tol:
            break
    return w


def fit(g: np.ndarray, n: int, p: int, method: str = "auto", alpha: float = 1.0) -> dict:
    """``method`` used, ``params`` (intercept first), ``r2`` and ``rmse``. The intercept is never penalised.

    ``ridge`` adds ``alpha`` to the lags' sums of squares; ``lasso`` and ``elastic_net`` (half of each
    penalty) weigh ``alpha`` against the mean square. ``auto`` is ordinary least squares, or ridge
    where the lags do not determine it.
    """
    if method not in METHODS:
        raise ValueError(f"no such method: {method}")
    g = g[: p + 2, : p + 2]
    cov, with_y, mean, y = centred(g, n)
    if method == "auto":
        method = "ols" if np.linalg.matrix_rank(cov) == p else "ridge"
    if method == "ols":
        w = np.linalg.lstsq(cov, with_y, rcond=None)[0]
    elif method == "ridge":
        w = np.linalg.solve(cov + alpha / n * np.eye(p), with_y)
    else:
        w = penalised(cov, with_y, alpha, 1.0 if method == "lasso" else 0.5)
    error = g[1, 1] / n - y * y - 2 * w @ with_y + w @ cov @ w
    return {"method": method, "params": np.r_[y - w @ mean, w], "r2": 1 - error / (g[1, 1] / n - y * y), "rmse": float(np.sqrt(max(error, 0.0)))}


def components(g: np.ndarray, n: int, share: float = 0.95) -> tuple[np.ndarray, np.ndarray]:
    """Principal axes of the lags (rows) that hold ``share`` of their variance, and the share of each."""
    values, vectors = np.linalg.eigh(centred(g, n)[0])
    values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1].T
    ratio = values / values.sum()
    needed = int(np.argmax(np.cumsum(ratio) >= min(share, np.cumsum(ratio)[-1]))) + 1
    return vectors[:needed], ratio[:needed]


def t_probability(t: float, free: int) -> float:
    """Two-sided probability of Student's t, by the continued fraction of the incomplete beta function."""
    a, b, x = free / 2, 0.5, free / (free + t * t)
    if x >= 1:
        return 1.0

    def fraction(a: float, b: float, x: float) -> float:
        tiny = 1e-300
        c, d = 1.0, 1 - (a + b) * x / (a + 1)
        d = 1 / (d if abs(d) > tiny else tiny)
        h = d
        for m in range(1, 500):
            for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d, c = 1 + step * d, 1 + step / c
                d, c = 1 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
                h *= d * c
            if abs(d * c - 1) < 1e-14:
                break
        return h

    front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log(1 - x)) if x > 0 else 0.0
    return front * fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * fraction(b, a, 1 - x) / b


def stepwise(g: np.ndarray, n: int, level: float = 0.05) -> list[int]:
    """Lags (from 1) in the order of a forward search: each time the one of least probability under ``level``."""
    left, chosen = list(range(2, len(g))), []
    while left:
        trials = []
        for j in left:
            x = [0, *chosen, j]
            a = g[np.ix_(x, x)]
            if np.linalg.matrix_rank(a) < len(x) or n <= len(x):
                continue
            inverse = np.linalg.inv(a)
            w = inverse @ g[x, 1]
            error = max(float(g[1, 1] - w @ g[x, 1]), 0.0) / (n - len(x))
            spread = float(np.sqrt(error * inverse[-1, -1]))
            trials.append((t_probability(float(w[-1]) / spread, n - len(x)) if spread else 0.0, -abs(float(w[-1])) / spread if spread else -np.inf, j))
        if not trials or min(trials)[0] >= level:
            break
        chosen.append(min(trials)[2])
        left.remove(chosen[-1])
    return [j - 1 for j in chosen]


def treated(rows: DataFrame, p: int, value: str = "value") -> dict:
    """The fit that the inflation of the lags recommends; with ``pca``, on the lags' leading axes."""
    g, n = series.wide_gram(rows, p, value)
    cov, with_y, mean, y = centred(g, n)
    scale = np.sqrt(np.diag(cov))
    method = series.recommend(np.diag(np.linalg.pinv(cov / np.outer(scale, scale))).tolist())
    if method != "pca":
        return fit(g, n, p, method)
    axes, _ = components(g, n)
    w = axes.T @ np.linalg.solve(axes @ cov @ axes.T, axes @ with_y)
    error = g[1, 1] / n - y * y - 2 * w @ with_y + w @ cov @ w
    return {"method": "pca", "params": np.r_[y - w @ mean, w], "r2": 1 - error / (g[1, 1] / n - y * y), "rmse": float(np.sqrt(max(error, 0.0)))}

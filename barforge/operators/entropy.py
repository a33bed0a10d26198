"""Rolling entropy features on blocks of a series with the rows that their first window needs."""

from __future__ import annotations

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame

from barforge.operators.series import halo_blocks

#: The windows and numbers of bins that existing feature tables have.
WINDOWS = tuple(range(50, 451, 50))
SHANNON_BINS = tuple(range(25, 226, 25))
BINS = (25, 50, 75, 100, 150, 200)


def _rolling(values: np.ndarray, n: int, fn) -> np.ndarray:
    """``fn`` of a matrix with a window a row, some thousands at a time."""
    out = np.full(len(values), np.nan)
    if len(values) >= n:
        view = sliding_window_view(values, n)
        out[n - 1 :] = np.concatenate([fn(view[a : a + 2048]) for a in range(0, len(view), 2048)])
    return out


def shannon_rows(view: np.ndarray, bins: int) -> np.ndarray:
    """Bits, over ``bins`` equal widths between each row's extremes; a constant row has 0."""
    low, high = view.min(1, keepdims=True), view.max(1, keepdims=True)
    at = np.minimum(((view - low) * bins / np.where(high > low, high - low, 1.0)).astype(np.int64), bins - 1)
    counts = np.bincount((np.arange(len(view))[:, None] * bins + at).ravel(), minlength=len(view) * bins).reshape(len(view), bins)
    p = counts / view.shape[1]
    return -np.where(p > 0, p * np.log2(np.where(p > 0, p, 1.0)), 0.0).sum(1)


def match_lengths(view: np.ndarray) -> np.ndarray:
    """For each place of each row, the longest run from it that also occurs earlier without reaching past it."""
    rows, n = view.shape
    view = np.ascontiguousarray(view, np.int16)
    common = np.zeros((rows, n + 1), np.int16)  # run of equal symbols from (i + 1, j) on
    apart = np.arange(n, 0, -1, dtype=np.int16)  # n - j
    out = np.zeros((rows, n), np.int16)
    for i in range(n - 1, -1, -1):
        now = np.zeros((rows, i + 1), np.int16)
        if i:
            np.multiply(common[:, 1 : i + 1] + np.int16(1), view[:, i : i + 1] == view[:, :i], out=now[:, :i])
            out[:, i] = np.minimum(now[:, :i], apart[n - i :]).max(1)
        common = now
    return out


def lempel_ziv_rows(view: np.ndarray) -> np.ndarray:
    """Number of phrases over n / log2 n; each is the longest match with what is before, and a symbol."""
    rows, n = view.shape
    if n <= 1:
        return np.full(rows, np.nan)
    longest, at, phrases, row = match_lengths(view).astype(np.int64), np.zeros(rows, np.int64), np.ones(rows), np.arange(rows)
    while True:
        live = at < n
        if not live.any():
            return phrases / (n / np.log2(n))
        at[live] += longest[row[live], at[live]] + 1
        phrases += live & (at < n)


def kontoyiannis_rows(view: np.ndarray) -> np.ndarray:
    """log2 n over the mean of match lengths plus one."""
    rows, n = view.shape
    return np.full(rows, np.nan) if n < 4 else np.log2(n) / (match_lengths(view)[:, 1:].astype(np.float64) + 1).mean(1)


def lempel_ziv(s: np.ndarray) -> float:
    return float(lempel_ziv_rows(np.asarray(s)[None, :])[0])


def kontoyiannis(s: np.ndarray) -> float:
    return float(kontoyiannis_rows(np.asarray(s)[None, :])[0])


def cut_equal(row: np.ndarray, bins: int) -> np.ndarray:
    """Right-closed bins of equal width; two bins are split at the median instead."""
    if bins == 2:
        return (row > np.nanmedian(row)).astype(np.int32)
    low, high = row.min(), row.max()
    if not np.isfinite(low) or low == high:
        return np.zeros(len(row), np.int32) if not np.isfinite(low) else np.full(len(row), (bins - 1) // 2, np.int32)
    edges = np.linspace(low, high, bins + 1)
    edges[0] -= (high - low) * 0.001
    return np.clip(np.searchsorted(edges, row, side="left") - 1, 0, bins - 1).astype(np.int32)


def cut_quantile(row: np.ndarray, bins: int) -> np.ndarray:
    """Left-closed bins between percentiles."""
    return np.digitize(row, np.nanpercentile(row, np.linspace(0, 100, bins + 1)[1:-1])).astype(np.int32)


def shannon(rows: DataFrame, windows: tuple[int, ...] = WINDOWS, bins: tuple[int, ...] = SHANNON_BINS, value: str = "value") -> DataFrame:
    made = [(w, b) for w in windows for b in bins]
    fn = lambda v: {f"shannon_w{w}_b{b}": _rolling(v, w, lambda m: shannon_rows(m, b)) for w, b in made}
    return halo_blocks(rows, max(windows) - 1, fn, ", ".join(f"shannon_w{w}_b{b} double" for w, b in made), value, block=16_384)


def _cut_rows(kernel, cut, b):
    """``kernel`` of some hundred windows at a time, each cut by itself."""
    return lambda m: np.concatenate([kernel(np.stack([cut(r, b) for r in m[a : a + 256]])) for a in range(0, len(m), 256)])


def lz(rows: DataFrame, windows: tuple[int, ...] = WINDOWS, bins: tuple[int, ...] = BINS, value: str = "value") -> DataFrame:
    made = [(w, b) for w in windows for b in bins if w >= 2 * b]
    fn = lambda v: {f"lz_w{w}_b{b}": _rolling(v, w, _cut_rows(lempel_ziv_rows, cut_equal, b)) for w, b in made}
    return halo_blocks(rows, max(windows) - 1, fn, ", ".join(f"lz_w{w}_b{b} double" for w, b in made), value, block=2_048)


def kont(rows: DataFrame, windows: tuple[int, ...] = WINDOWS, bins: tuple[int, ...] = BINS, value: str = "value") -> DataFrame:
    made = [(w, b) for w in windows for b in bins if w >= 4 * b]
    fn = lambda v: {f"kont_w{w}_b{b}": _rolling(v, w, _cut_rows(kontoyiannis_rows, cut_quantile, b)) for w, b in made}
    return halo_blocks(rows, max(windows) - 1, fn, ", ".join(f"kont_w{w}_b{b} double" for w, b in made), value, block=2_048)

"""Information-driven bars.

Kernels find where bars end; sums and extremes of the rows between are taken with ``reduceat``
and merged with those of the bar that was open when the batch began. No kernel loops over ticks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.operators.fold import ordered_fold

BAR = "symbol string, bar_id long, start_seq long, end_seq long, start_time timestamp_ntz, end_time timestamp_ntz, open double, high double, low double, close double, theta double, buy double, usd double, qty double, ticks long, ticks_buy long"
STANDARD = BAR
IMBALANCE = BAR + ", ewma_t double, ewma_imbalance double"
LEGACY = BAR + ", ewma_volume double, ewma_dif double, threshold double"
_SUMS = ("theta", "buy", "usd", "qty", "ticks", "ticks_buy")
#: Ticks that a search for the end of a bar looks at in one go.
LOOK = 8192


@dataclass
class _Bars:
    """Open bar and numbering that all kernels share."""

    symbol: str
    bar_id: int = 0
    open: dict | None = None
    out: list[dict] = field(default_factory=list)

    def push(self, rows: pd.DataFrame) -> pd.DataFrame | None:
        net, side = rows["net"].to_numpy(np.float64), rows["side"].to_numpy()
        ends, extra = self.ends(net, side, rows["time"].to_numpy())
        starts = np.r_[0, np.asarray(ends, np.int64) + 1]
        starts = starts[starts < len(net)]
        price = rows["price"].to_numpy(np.float64)
        bought = side > 0
        columns = {"theta": net, "buy": np.where(bought, net, 0.0), "usd": np.abs(net), "qty": rows["qty"].to_numpy(np.float64), "ticks": np.ones(len(net)), "ticks_buy": bought.astype(np.float64)}
        sums = {k: np.add.reduceat(v, starts) for k, v in columns.items()}
        high, low = np.maximum.reduceat(price, starts), np.minimum.reduceat(price, starts)
        last = np.r_[starts[1:], len(net)] - 1
        seq, time = rows["seq"].to_numpy(), rows["time"].to_numpy()
        self.out = []
        for i, (a, b) in enumerate(zip(starts.tolist(), last.tolist(), strict=True)):
            part = {k: float(v[i]) for k, v in sums.items()} | {"open": price[a], "high": high[i], "low": low[i], "close": price[b], "start_seq": seq[a], "end_seq": seq[b], "start_time": time[a], "end_time": time[b]}
            if self.open is not None:
                part = _merged(self.open, part)
            if i < len(ends):
                self.out.append(part | {"symbol": self.symbol, "bar_id": self.bar_id} | (extra[i] if extra else {}))
                self.bar_id, self.open = self.bar_id + 1, None
            else:
                self.open = part
        return pd.DataFrame(self.out)

    def close(self) -> pd.DataFrame | None:
        return None

    def ends(self, net: np.ndarray, side: np.ndarray, time: np.ndarray) -> tuple[list[int], list[dict]]:
        raise NotImplementedError


def _merged(a: dict, b: dict) -> dict:
    return b | {k: a[k] + b[k] for k in _SUMS} | {"open": a["open"], "high": max(a["high"], b["high"]), "low": min(a["low"], b["low"]), "start_seq": a["start_seq"], "start_time": a["start_time"]}


@dataclass
class StandardKernel(_Bars):
    """A bar ends with the tick that brings its notional to the threshold; overshoot is discarded."""

    threshold: float = 0.0

    def ends(self, net, side, time):
        total = np.cumsum(np.abs(net))
        held = self.open["usd"] if self.open else 0.0
        found, base = [], -held
        while True:
            at = int(np.searchsorted(total, base + self.threshold))
            if at >= len(total):
                return found, []
            found.append(at)
            base = total[at]


@dataclass
class ImbalanceKernel(_Bars):
    """Ends when |signed notional| reaches expected ticks x expected imbalance, both exponential averages.

    The first bar, and one after a bar of over ``reset_hours``, is warm: it ends after ``init_ticks``
    ticks and sets the averages.
    """

    init_ticks: int = 100
    alpha_ticks: float = 0.1
    alpha_imbalance: float = 0.1
    reset_hours: float = float("inf")
    ewma_t: float = 0.0
    ewma_imbalance: float = 0.0
    warm: bool = True

    def ends(self, net, side, time):
        theta, ticks = (self.open["theta"], int(self.open["ticks"])) if self.open else (0.0, 0)
        start_time = self.open["start_time"] if self.open else None
        found, extra, at = [], [], 0
        total = np.cumsum(net)
        while at < len(net):
            start_time = time[at] if start_time is None else start_time
            base = (total[at - 1] if at else 0.0) - theta
            if self.warm:
                end = at + max(self.init_ticks - ticks, 1) - 1
                end = end if end < len(net) else None
            else:
                end = _first_reach(total, at, base, self.ewma_t * self.ewma_imbalance)
            if end is None:
                break
            n, reached = ticks + end - at + 1, abs(total[end] - base)
            if self.warm:
                self.ewma_t, self.ewma_imbalance, self.warm = float(n), reached / n, False
            else:
                self.ewma_t += self.alpha_ticks * (n - self.ewma_t)
                self.ewma_imbalance += self.alpha_imbalance * (reached / n - self.ewma_imbalance)
            found.append(end)
            extra.append({"ewma_t": self.ewma_t, "ewma_imbalance": self.ewma_imbalance})
            self.warm = (time[end] - start_time) / np.timedelta64(1, "ms") > 3_600_000.0 * self.reset_hours
            at, theta, ticks, start_time = end + 1, 0.0, 0, None
        return found, extra


@dataclass
class LegacyKernel(_Bars):
    """The older imbalance bar: threshold = expected notional x |expected 2 buy share - 1|.

    A ``dif`` of exactly 1 marks the averages as unset. The open bar is returned when the tape ends.
    """

    init_volume: float = 0.0
    init_dif: float = 1.0
    alpha_volume: float = 0.1
    alpha_imbalance: float = 0.1

    def __post_init__(self):
        self.volume, self.dif = self.init_volume, self.init_dif

    def ends(self, net, side, time):
        theta, usd, buy = (self.open["theta"], self.open["usd"], self.open["buy"]) if self.open else (0.0, 0.0, 0.0)
        found, extra, at = [], [], 0
        total, gross, bought = np.cumsum(net), np.cumsum(np.abs(net)), np.cumsum(np.where(side > 0, net, 0.0))
        before = lambda c: c[at - 1] if at else 0.0
        while at < len(net):
            end = _first_reach(total, at, before(total) - theta, self.volume * abs(self.dif))
            if end is None:
                break
            bar_usd, bar_buy = gross[end] - before(gross) + usd, bought[end] - before(bought) + buy
            share = abs(2 * bar_buy / bar_usd - 1)
            if self.dif == 1.0:
                self.volume, self.dif = bar_usd, share
            else:
                self.volume += self.alpha_volume * (bar_usd - self.volume)
                self.dif += self.alpha_imbalance * (share - self.dif)
            found.append(end)
            extra.append({"ewma_volume": self.volume, "ewma_dif": self.dif, "threshold": self.volume * abs(self.dif)})
            at, theta, usd, buy = end + 1, 0.0, 0.0, 0.0
        return found, extra

    def close(self):
        if self.open is None:
            return None
        return pd.DataFrame([self.open | {"symbol": self.symbol, "bar_id": self.bar_id, "ewma_volume": self.volume, "ewma_dif": self.dif, "threshold": self.volume * abs(self.dif)}])


def _first_reach(total: np.ndarray, at: int, base: float, threshold: float) -> int | None:
    while at < len(total):
        hit = np.flatnonzero(np.abs(total[at : at + LOOK] - base) >= threshold)
        if len(hit):
            return at + int(hit[0])
        at += LOOK
    return None


_NEEDED = ["symbol", "seq", "time", "price", "qty", "side", "net"]


def standard_bars(trades: DataFrame, threshold: float) -> DataFrame:
    """Dollar bars of a tape with ``side`` and ``net``; a trailing bar that is not full is left out."""
    return ordered_fold(trades.select(*_NEEDED), ["symbol"], ["seq"], lambda k: StandardKernel(k[0], threshold=threshold), STANDARD)


def imbalance_bars(trades: DataFrame, init_ticks: int, alpha_ticks: float, alpha_imbalance: float, reset_hours: float = float("inf")) -> DataFrame:
    make = lambda k: ImbalanceKernel(k[0], init_ticks=init_ticks, alpha_ticks=alpha_ticks, alpha_imbalance=alpha_imbalance, reset_hours=reset_hours)
    return ordered_fold(trades.select(*_NEEDED), ["symbol"], ["seq"], make, IMBALANCE)


def legacy_imbalance_bars(trades: DataFrame, init_volume: float, init_dif: float, alpha_volume: float, alpha_imbalance: float) -> DataFrame:
    make = lambda k: LegacyKernel(k[0], init_volume=init_volume, init_dif=init_dif, alpha_volume=alpha_volume, alpha_imbalance=alpha_imbalance)
    return ordered_fold(trades.select(*_NEEDED), ["symbol"], ["seq"], make, LEGACY)


def bar_grid(trades: DataFrame, thresholds: list[float]) -> DataFrame:
    """Standard bars for several thresholds at once; symbols and thresholds are folded side by side."""
    grid = F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("params")
    make = lambda k: StandardKernel(k[0], threshold=float(k[1]))

    class Tagged:
        def __init__(self, key):
            self.own, self.params = make(key), key[1]

        def push(self, rows):
            out = self.own.push(rows)
            return out.assign(params=self.params) if len(out) else None

        def close(self):
            return None

    return ordered_fold(trades.select(*_NEEDED, grid), ["symbol", "params"], ["seq"], Tagged, "params double, " + BAR)


def collapse(bars: DataFrame) -> DataFrame:
    """One row per symbol and end time: first open, extremes, last close, sums; the last time is left out."""
    rows = bars.groupBy("symbol", "end_time").agg(
        F.min_by("open", "bar_id").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "bar_id").alias("close"),
        F.sum("qty").alias("total_volume"),
        F.sum("usd").alias("total_volume_usd"),
        F.sum("buy").alias("total_volume_buy_usd"),
    )
    last = rows.groupBy("symbol").agg(F.max("end_time").alias("__last"))
    return rows.join(last, "symbol").where("end_time < __last").drop("__last").withColumn("log_close", F.log("close"))

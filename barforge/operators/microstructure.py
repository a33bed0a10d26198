"""Rolling microstructure features of a bar table ``(symbol, idx, high, low, close, volume, usd, buy)``.

All are window aggregates of built-in functions; a feature of ``n`` rows is null where its frame is not full.
"""

from __future__ import annotations

from math import log, sqrt

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

SPREAD_WINDOWS = tuple(range(10, 200, 10))
WINDOWS = tuple(range(50, 451, 50))
EPS = 1e-10
SPREAD_SCALE = 2 * (sqrt(2) - 1)


def _order() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("idx")


def frame(n: int, last: int = 0) -> WindowSpec:
    return _order().rowsBetween(-(n - 1), last)


def completed(bars: DataFrame) -> DataFrame:
    """Columns that bars lack: high and low are the close, volume is 1, buy and sell volume follow the close.

    A bar whose close did not fall has bought all of its volume and sold 0.3 of it, another the reverse.
    """
    high = {c: F.col("close") for c in ("high", "low") if c not in bars.columns}
    bars = bars.withColumns(high | ({} if "volume" in bars.columns else {"volume": F.lit(1.0)}))
    if {"buy", "usd"} <= set(bars.columns):
        return bars
    fell, most = F.col("close") < F.lag("close", 1).over(_order()), F.col("volume")
    fell = F.coalesce(fell, F.lit(False))
    bars = bars.withColumns({"__buy": F.when(fell, 0.3 * most).otherwise(most), "__sold": F.when(fell, most).otherwise(0.3 * most)})
    return bars.withColumns({"buy": F.col("__buy"), "usd": F.col("__buy") + F.col("__sold")}).drop("__buy", "__sold")


def prepared(bars: DataFrame) -> DataFrame:
    """Helper columns: sell volume, return on the current close, log range, spread of a pair of bars."""
    bars = completed(bars)
    before = {c: F.lag(c).over(_order()) for c in ("high", "low", "close")}
    high, low, close = F.col("high"), F.col("low"), F.col("close")
    top, bottom = F.greatest(high, before["high"]), F.least(low, before["low"])
    beta = F.pow(F.log(top / bottom), 2)
    gamma = F.pow(F.log(high / low), 2) + F.pow(F.log(before["high"] / before["low"]), 2)
    alpha = F.abs((F.sqrt(2 * beta) - F.sqrt(beta)) / SPREAD_SCALE - F.sqrt(gamma / SPREAD_SCALE))
    usable = (high > 0) & (low > 0) & (before["high"] > 0) & (before["low"] > 0)
    return bars.withColumns(
        {
            "__sell": F.col("usd") - F.col("buy"),
            "__ret": F.coalesce((close - before["close"]) / (close + EPS), F.lit(0.0)),
            "__range": F.log(high / (low + EPS) + EPS),
            "__pair": F.when(usable, 2 * (F.exp(alpha) - 1) / (1 + F.exp(alpha))),
        }
    ).withColumn("__before", F.lag("__ret").over(_order()))


def _full(n: int, value: Column, rows: int = 0) -> Column:
    return F.when(F.col("idx") >= n - 1 + rows, value)


def corwin_schultz(n: int) -> Column:
    """Mean pair spread of the ``n - 1`` bars before this one; 0 if none is usable."""
    return _full(n, F.coalesce(F.avg("__pair").over(frame(n, -1)), F.lit(0.0)), 1)


def vpin(n: int) -> Column:
    total = F.sum("volume").over(frame(n))
    return _full(n, F.when(total > 0, F.sum(F.abs(F.col("buy") - F.col("__sell"))).over(frame(n)) / total).otherwise(0.0))


def oir(n: int) -> Column:
    buy, sell = F.sum("buy").over(frame(n)), F.sum("__sell").over(frame(n))
    return _full(n, F.when(buy + sell > 0, (buy - sell) / (buy + sell)).otherwise(0.0))


def volatility(n: int) -> Column:
    return _full(n, F.stddev_samp("__ret").over(frame(n)))


def becker_parkinson(n: int) -> Column:
    return _full(n, F.stddev_samp("__range").over(frame(n)) / sqrt(4 * log(2)))


def amihud(n: int) -> Column:
    return _full(n, F.avg(F.abs("__ret") / (F.col("volume") + EPS)).over(frame(n)))


kyle_lambda = amihud  # by the definition in use the two are one


def roll_spread(n: int) -> Column:
    """From the covariance of successive returns over the ``n`` bars before this one; 0 unless negative."""
    cov = F.covar_samp("__ret", "__before").over(frame(n, -1))
    return _full(n, F.when(cov < 0, 2 * F.sqrt(-cov)).otherwise(0.0), 1)


FAMILIES = {
    "corwin_schultz": corwin_schultz,
    "vpin_fixed": vpin,
    "oir": oir,
    "volatility": volatility,
    "becker_parkinson": becker_parkinson,
    "amihud": amihud,
    "kyle_lambda": kyle_lambda,
    "roll_spread": roll_spread,
}


def features(bars: DataFrame, spread_windows: tuple[int, ...] = SPREAD_WINDOWS, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """All families, 82 columns by default; one sort serves every frame."""
    made = {f"{name}_{n}": fn(n) for name, fn in FAMILIES.items() for n in (spread_windows if name == "corwin_schultz" else windows)}
    ready = prepared(bars)
    return ready.withColumns(made).select(*[f"`{c}`" for c in bars.columns], *made)


# --- the older definitions: frames end at the current row, returns are relative to the previous close ---


def change() -> Column:
    before = F.lag("close").over(_order())
    return F.col("close") / before - 1


def roll_spread_v2(n: int, ret: str = "__change", before: str = "__change_before") -> Column:
    """From successive changes of the last ``n`` rows; null covariances count as 0."""
    cov = F.covar_samp(ret, before).over(frame(n))
    return _full(n, F.when(cov < 0, 2 * F.sqrt(-cov)).otherwise(0.0), 1)


def amihud_v2(n: int, ret: str = "__change") -> Column:
    return _full(n, F.avg(F.abs(ret) / F.col("volume")).over(frame(n)), 1)


def volatility_v2(n: int, ret: str = "__change") -> Column:
    return _full(n, F.stddev_samp(ret).over(frame(n)), 1)


def rolling_population(n: int, column: str) -> tuple[Column, Column]:
    """Rolling mean and population deviation."""
    return _full(n, F.avg(column).over(frame(n))), _full(n, F.stddev_pop(column).over(frame(n)))


def with_change(bars: DataFrame) -> DataFrame:
    return bars.withColumn("__change", change()).withColumn("__change_before", F.lag("__change").over(_order()))

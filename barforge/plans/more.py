"""Queries over the remaining transforms and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.operators import labels, profile, series, validation
from barforge.operators import microstructure as M
from barforge.plans import evaluation, features
from barforge.plans.evaluation import NUMBERS
from barforge.plans.tapes import HOURS, TAPE, hour_bars, sided
from barforge.sources.tape import table

N = 24


def price_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profile.standard_scores(hour_bars(spark, sf_dir).select("symbol", "idx", "close"), "close")
    return rows.select("symbol", "idx", F.round(F.log("close"), 6).alias("log_close"), F.round(F.pmod("close", F.lit(1.0)), 6).alias("fraction"), F.round("z", 6).alias("z"))


def micro_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean, std = M.rolling_population(N, "close")
    rows = M.with_change(hour_bars(spark, sf_dir))
    return rows.select("symbol", "idx", *[F.round(c, 6).alias(n) for n, c in (("roll", M.roll_spread_v2(N)), ("amihud", M.amihud_v2(N)), ("volatility", M.volatility_v2(N)), ("mean", mean), ("std", std))])


def ar_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features._close(spark, sf_dir)
    return series.ar_predict(rows, series.fit_ar(rows, 1)["params"]).select("symbol", "idx", F.round("predicted", 4).alias("predicted"))


def ar_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chosen order of up to the largest for the number of bars, inflation of its lags and the advice that follows."""
    rows = features._close(spark, sf_dir)
    n, longest = rows.agg(F.count("*"), F.max("idx") + 1).first()
    order = series.select_ar_order(rows, max(1, min(series.largest_order(n), longest // 2 - 1)))
    inflation = series.vif(rows, order)
    return spark.createDataFrame([(order, float(max(inflation)), series.recommend(inflation))], "p long, largest_vif double, advice string")


def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = profile.class_distribution(features._labelled(spark, sf_dir), "meta_label")
    return d.select("label", "n", F.round("share", 6).alias("share"))


def event_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features._events(spark, sf_dir).groupBy("side").agg(F.count("*").alias("n"), F.round(F.avg("trgt"), 6).alias("avg_target"), F.countDistinct("symbol").alias("symbols"))


def weight_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = hour_bars(spark, sf_dir).select("symbol", "time")
    w = labels.sample_weights(labels.vertical_barriers(bars, bars, features.MINUTES), features.DECAY)
    return w.agg(*[F.round(f("weight"), 6).alias(n) for n, f in (("least", F.min), ("most", F.max), ("mean", F.avg), ("std", F.stddev_pop))])


def half_life(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hour_bars(spark, sf_dir).select("symbol", "time", F.round(labels.half_life_decay(7.0), 6).alias("weight"))


def correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.correlations(table(spark, sf_dir, "lineitem"), NUMBERS).select("a", "b", F.round("corr", 6).alias("corr"))


def pbo_stochastic(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = validation.path_metrics(evaluation._cube(spark, sf_dir), evaluation.GROUPS, evaluation.TESTED)
    return validation.overfitting(paths, method="stochastic").select("n_paths", F.round("pbo", 4).alias("pbo"))


def sell_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buy notional less all notional by day: the (negative) sell volume of existing reports."""
    rows = sided(spark, sf_dir).groupBy("symbol", F.to_date("time").alias("day")).agg(F.sum(F.when(F.col("side") > 0, F.col("net")).otherwise(0.0)).alias("buy"), F.sum("quoteQty").alias("usd"))
    return rows.select("symbol", "day", (F.col("buy") - F.col("usd")).alias("sell"))


QUERIES = {f.__name__: f for f in (price_transforms, micro_v2, ar_predict, ar_order, class_distribution, event_summary, weight_stats, half_life, correlations, pbo_stochastic, sell_volume)}
_W = f"(PARTITION BY symbol ORDER BY idx ROWS BETWEEN {N - 1} PRECEDING AND CURRENT ROW)"
_FIT = "l AS (SELECT symbol, idx, close AS y, lag(close) OVER (PARTITION BY symbol ORDER BY idx) AS x FROM bars), m AS (SELECT regr_intercept(y, x) AS a, regr_slope(y, x) AS b FROM l)"
ORACLES = {
    "price_transforms": f"WITH {HOURS} SELECT symbol, idx, round(ln(close), 6) AS log_close, round(close - floor(close), 6) AS fraction, round((close - avg(close) OVER p) / stddev_samp(close) OVER p, 6) + 0.0::DOUBLE AS z FROM bars WINDOW p AS (PARTITION BY symbol)",
    "micro_v2": f"""WITH {HOURS}, c AS (SELECT *, close / lag(close) OVER (PARTITION BY symbol ORDER BY idx) - 1 AS r FROM bars), d AS (SELECT *, lag(r) OVER (PARTITION BY symbol ORDER BY idx) AS r0 FROM c)
SELECT symbol, idx, round(CASE WHEN idx >= {N} THEN CASE WHEN covar_samp(r, r0) OVER {_W} < 0 THEN 2 * sqrt(-covar_samp(r, r0) OVER {_W}) ELSE 0 END END, 6) AS roll,
       round(CASE WHEN idx >= {N} THEN avg(abs(r) / volume) OVER {_W} END, 6) AS amihud, round(CASE WHEN idx >= {N} THEN stddev_samp(r) OVER {_W} END, 6) AS volatility,
       round(CASE WHEN idx >= {N - 1} THEN avg(close) OVER {_W} END, 6) AS mean, round(CASE WHEN idx >= {N - 1} THEN stddev_pop(close) OVER {_W} END, 6) AS std FROM d""",
    "ar_predict": f"WITH {HOURS}, {_FIT} SELECT symbol, idx, round(a + b * CASE WHEN idx < 1 THEN y ELSE x END, 4) AS predicted FROM l, m",
    "class_distribution": f"WITH RECURSIVE {features._LABELLED} SELECT meta_label AS label, count(*) AS n, round(count(*) / (SELECT count(*) FROM lab)::DOUBLE, 6) AS share FROM lab GROUP BY meta_label",
    "event_summary": f"WITH RECURSIVE {features._EVENTS} SELECT side, count(*) AS n, round(avg(trgt), 6) AS avg_target, count(DISTINCT symbol) AS symbols FROM ev GROUP BY side",
    "weight_stats": f"WITH {features._UNIQUE}, w AS (SELECT uniqueness * pow({features.DECAY}::DOUBLE, floor(epoch(max(time) OVER (PARTITION BY symbol) - time) / 86400)) AS w FROM uq) SELECT round(min(w), 6) AS least, round(max(w), 6) AS most, round(avg(w), 6) AS mean, round(stddev_pop(w), 6) AS std FROM w",
    "half_life": f"WITH {HOURS} SELECT symbol, time, round(exp(-ln(2) / 7 * epoch(max(time) OVER (PARTITION BY symbol) - time) / 86400), 6) AS weight FROM bars",
    "correlations": " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}::DOUBLE, {b}::DOUBLE), 6) AS corr FROM lineitem" for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1 :]),
    "pbo_stochastic": evaluation._PATHS + " SELECT count(*) AS n_paths, round((count(*) FILTER (sharpe >= (SELECT max(sharpe) FROM m) * 0.5)) / count(*)::DOUBLE, 4) AS pbo FROM m",
    "sell_volume": f"WITH {TAPE} SELECT symbol, time::DATE AS day, sum(CASE WHEN side > 0 THEN net ELSE 0 END) - sum(quoteQty) AS sell FROM sided GROUP BY symbol, time::DATE",
}

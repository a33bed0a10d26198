"""Queries over validation splits, paths, profiles and models."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barforge.operators import forest, profile, validation
from barforge.operators import microstructure as M
from barforge.plans import features, tapes
from barforge.plans.tapes import HOURS, THRESHOLD, hour_bars, sided
from barforge.sources import shared
from barforge.sources.tape import table
from barforge.streaming import bars as live

FOLDS, GROUPS, TESTED, EMBARGO, HOURS_AHEAD = 5, 6, 2, 0.01, 6
NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars of all symbols in order of time, with labels of some hours."""
    order = Window.orderBy("time", "symbol")
    rows = hour_bars(spark, sf_dir).select((F.row_number().over(order) - 1).cast("long").alias("idx"), F.col("time").alias("t0"))
    last = rows.agg(F.max("t0")).first()[0]
    t1 = F.col("t0") + F.expr(f"INTERVAL {HOURS_AHEAD} HOURS")
    return rows.withColumn("t1", F.when(t1 <= F.lit(last).cast("timestamp_ntz"), t1))


def purged_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.splits(_intervals(spark, sf_dir), FOLDS, 1, EMBARGO)


def cpcv_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.splits(_intervals(spark, sf_dir), GROUPS, TESTED, EMBARGO)


def phi_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.phi_matrix(spark, GROUPS, TESTED)


def _cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions for every order and each combination that tests its group, made of its columns."""
    orders = table(spark, sf_dir, "orders")
    rows = shared.numbered(orders.select("o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice"), "o_orderdate", "o_orderkey").select("idx", (F.col("o_orderstatus") == "F").cast("int").alias("y"), F.round(F.col("o_totalprice").cast("double") * 100).cast("long").alias("cents"))
    grouped, _ = validation.grouped(rows, GROUPS)
    phi = validation.phi_matrix(spark, GROUPS, TESTED).where("is_test = 1").select("comb_idx", "group_idx")
    return grouped.join(F.broadcast(phi), "group_idx").select("idx", "group_idx", "comb_idx", "y", (F.pmod(F.col("cents") + 37 * F.col("comb_idx"), F.lit(101)) / 100.0).alias("pred"))


def path_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = validation.path_metrics(_cube(spark, sf_dir), GROUPS, TESTED)
    return m.select("path_idx", "n", *[F.round(c, 4).alias(c) for c in ("hit_rate", "total_return", "sharpe")])


def pbo(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = validation.overfitting(validation.path_metrics(_cube(spark, sf_dir), GROUPS, TESTED))
    return o.select("n_paths", *[F.round(c, 4).alias(c) for c in ("max_sharpe", "median_sharpe", "sharpe_std", "pbo", "deflated_sharpe")])


def describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = profile.describe(table(spark, sf_dir, "lineitem"), NUMBERS)
    return d.select("feature", "n", *[F.round(c, 4).alias(c) for c in d.columns[2:]])


def outliers_iqr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.outliers_iqr(table(spark, sf_dir, "lineitem"), NUMBERS)


def target_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    return profile.target_correlation(rows, NUMBERS, "y").select("feature", F.round("corr", 6).alias("corr"))


def top_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_variance(table(spark, sf_dir, "lineitem"), NUMBERS, 3).select("feature", F.round("variance", 4).alias("variance"))


def category_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = M.features(hour_bars(spark, sf_dir), (10,), (24,))
    names = [c for c in bars.columns if c.endswith(("_10", "_24"))] + ["close"]
    s = profile.category_summary(profile.describe(bars, names))
    return s.select("category", "n_features", *[F.round(c, 4).alias(c) for c in ("avg_mean", "avg_std", "avg_variance", "avg_missing")])


def class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select((F.col("o_orderstatus") == "F").cast("int").alias("y"), (F.col("o_orderdate") < "1995-06-17").cast("int").alias("p"))
    m = profile.classification(rows, "y", "p")
    return m.select("tp", "fp", "fn", "tn", *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").cast("double").alias("y"), (F.col("l_quantity").cast("double") * 1500).alias("p"))
    m = profile.regression(rows, "y", "p")
    return m.select(*[F.round(c, 4).alias(c) for c in ("mae", "rmse", "r2")])


def forest_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purged folds of a forest on hourly features: rows and accuracy, by fold."""
    bars = M.features(hour_bars(spark, sf_dir), (10,), (24,))
    names = [c for c in bars.columns if c.endswith(("_10", "_24"))]
    at = (F.row_number().over(Window.orderBy("time", "symbol")) - 1).cast("long")
    ready = bars.withColumns({"idx": at, "up": (F.col("close") >= F.col("open")).cast("double")}).na.drop(subset=names)
    rows = forest.assembled(ready.select("idx", "up", *names), names).select("idx", "up", "features")
    parts = validation.splits(_intervals(spark, sf_dir), 3, 1, EMBARGO)
    made = forest.cross_predict(rows, parts, "up", numTrees=10, maxDepth=3)
    return made.groupBy("comb_idx").agg(F.count("*").alias("n"), F.round(F.avg(((F.col("pred") >= 0.5).cast("int") == F.col("y")).cast("double")), 6).alias("accuracy"))


def stream_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The standard bars once more, from a stream over the tape."""
    base = shared.path(spark, "ticks")
    ticks = sided(spark, sf_dir).select("symbol", "seq", F.col("time").cast("timestamp").alias("time"), "price", "qty", F.col("side").cast("int").alias("side"), "net")
    ticks.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(ticks.schema).parquet(f"{base}/in")
    query = live.dollar_bars(stream, THRESHOLD).writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    for name in ("in", "state"):
        shared.delete(spark, f"{base}/{name}")
    return spark.read.parquet(f"{base}/out").select("symbol", "bar_id", "start_seq", "end_seq", "open", "close", "usd", "ticks")


QUERIES = {f.__name__: f for f in (purged_kfold, cpcv_splits, phi_matrix, path_metrics, pbo, describe, outliers_iqr, target_corr, top_variance, category_summary, class_metrics, regression_metrics, forest_cv, stream_bars)}

_PHI = lambda g, k: " UNION ALL ".join(
    f"SELECT {c} AS comb_idx, {j} AS group_idx, {int(j in chosen)} AS is_test" for c, chosen in enumerate(combinations(range(g), k)) for j in range(g)
)


def _splits(groups: int, tested: int) -> str:
    return f"""WITH {HOURS}, iv0 AS (SELECT row_number() OVER (ORDER BY time, symbol) - 1 AS idx, time AS t0 FROM bars), iv AS (
  SELECT idx, t0, CASE WHEN t0 + INTERVAL {HOURS_AHEAD} HOUR <= max(t0) OVER () THEN t0 + INTERVAL {HOURS_AHEAD} HOUR END AS t1, count(*) OVER () AS n FROM iv0
), g AS (SELECT *, least(idx // greatest(n // {groups}, 1), {groups - 1}) AS g FROM iv), phi AS ({_PHI(groups, tested)}),
x AS (SELECT comb_idx, idx, t0, t1, is_test, n, g FROM g JOIN phi ON group_idx = g),
ends AS (SELECT comb_idx, max(idx) + 1 AS e, any_value(n) AS n FROM x WHERE is_test = 1 GROUP BY comb_idx, g)
SELECT comb_idx, idx, 'test' AS part FROM x WHERE is_test = 1
UNION ALL
SELECT comb_idx, idx, 'train' FROM x WHERE is_test = 0
  AND NOT EXISTS (SELECT 1 FROM x t WHERE t.comb_idx = x.comb_idx AND t.is_test = 1 AND x.t0 <= t.t1 AND x.t1 >= t.t0)
  AND NOT EXISTS (SELECT 1 FROM ends WHERE ends.comb_idx = x.comb_idx AND x.idx >= e AND x.idx < e + floor(ends.n * {EMBARGO}::DOUBLE))"""


_PATHS = f"""WITH o AS (SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS idx, (o_orderstatus = 'F')::INT AS y, round(o_totalprice::DOUBLE * 100)::BIGINT AS cents, count(*) OVER () AS n FROM orders),
g AS (SELECT *, least(idx // greatest(n // {GROUPS}, 1), {GROUPS - 1}) AS g FROM o), phi AS ({_PHI(GROUPS, TESTED)}),
r AS (SELECT comb_idx, group_idx, row_number() OVER (PARTITION BY group_idx ORDER BY comb_idx) - 1 AS path_idx FROM phi WHERE is_test = 1),
c AS (SELECT path_idx, y, ((cents + 37 * comb_idx) % 101) / 100.0::DOUBLE AS pred FROM g JOIN r ON group_idx = g),
h AS (SELECT path_idx, ((pred >= 0.5)::INT = y)::INT AS hit, CASE WHEN (pred >= 0.5)::INT = y THEN abs(pred - 0.5) * 2 ELSE -abs(pred - 0.5) * 2 END AS r FROM c),
m AS (SELECT path_idx::INT AS path_idx, count(*) AS n, avg(hit) AS hit_rate, sum(r) AS total_return, avg(r) / stddev_pop(r) * sqrt(252) AS sharpe FROM h GROUP BY path_idx)"""
_LONG = "WITH c AS (" + " UNION ALL ".join(f"SELECT '{n}' AS feature, {n}::DOUBLE AS value, (l_returnflag = 'R')::INT AS y FROM lineitem" for n in NUMBERS) + ")"
ORACLES = {
    "purged_kfold": _splits(FOLDS, 1),
    "cpcv_splits": _splits(GROUPS, TESTED),
    "phi_matrix": _PHI(GROUPS, TESTED),
    "path_metrics": _PATHS + " SELECT path_idx, n, round(hit_rate, 4) AS hit_rate, round(total_return, 4) AS total_return, round(sharpe, 4) AS sharpe FROM m",
    "pbo": _PATHS + """, s AS (SELECT count(*) AS n_paths, max(sharpe) AS mx, median(sharpe) AS md, stddev_pop(sharpe) AS sd FROM m)
SELECT n_paths, round(mx, 4) AS max_sharpe, round(md, 4) AS median_sharpe, round(sd, 4) AS sharpe_std, round((SELECT count(*) FROM m WHERE sharpe < md) / n_paths::DOUBLE, 4) AS pbo,
       round(CASE WHEN sd <= 0 THEN mx ELSE greatest(0, mx - sd * sqrt(2 * ln(n_paths))) END, 4) AS deflated_sharpe FROM s""",
    "describe": _LONG + " SELECT feature, count(value) AS n, " + ", ".join(f"round({x}, 4) AS {a}" for x, a in (("avg(value)", "mean"), ("stddev_samp(value)", "std"), ("min(value)", "min"), ("quantile_cont(value, 0.25)", "q25"), ("quantile_cont(value, 0.5)", "q50"), ("quantile_cont(value, 0.75)", "q75"), ("max(value)", "max"), ("100.0::DOUBLE * count(*) FILTER (value IS NULL) / count(*)", "missing_pct"), ("100.0::DOUBLE * count(*) FILTER (value = 0) / count(*)", "zeros_pct"), ("skewness(value)", "skew"), ("kurtosis(value)", "kurtosis"))) + " FROM c GROUP BY feature",
    "outliers_iqr": _LONG + ", q AS (SELECT feature, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM c GROUP BY feature) SELECT feature, count(*) FILTER (value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)) AS outliers FROM c JOIN q USING (feature) GROUP BY feature",
    "target_corr": _LONG + " SELECT feature, round(corr(value, y), 6) AS corr FROM c GROUP BY feature",
    "top_variance": _LONG + " SELECT feature, round(var_samp(value), 4) AS variance FROM c GROUP BY feature ORDER BY var_samp(value) DESC LIMIT 3",
    "class_metrics": "WITH c AS (SELECT (o_orderstatus = 'F')::INT AS y, (o_orderdate < DATE '1995-06-17')::INT AS p FROM orders), m AS (SELECT count(*) FILTER (y = 1 AND p = 1) AS tp, count(*) FILTER (y = 0 AND p = 1) AS fp, count(*) FILTER (y = 1 AND p = 0) AS fn, count(*) FILTER (y = 0 AND p = 0) AS tn FROM c) SELECT tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn)::DOUBLE, 6) AS accuracy, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0 END, 6) AS precision, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0 END, 6) AS recall, round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn)::DOUBLE ELSE 0 END, 6) AS f1 FROM m",
    "regression_metrics": "WITH c AS (SELECT l_extendedprice::DOUBLE AS y, l_quantity::DOUBLE * 1500 AS p FROM lineitem) SELECT round(avg(abs(y - p)), 4) AS mae, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse, round(1 - avg((y - p) * (y - p)) / var_pop(y), 4) AS r2 FROM c",
}
_SUMMARY = [(f"{k}_{n}", features._sql(k, n)) for k in M.FAMILIES for n in ((10,) if k == "corwin_schultz" else (24,))] + [("close", "close")]
ORACLES["category_summary"] = f"""WITH {features._READY}, f AS (SELECT {', '.join(f'{sql} AS {c}' for c, sql in _SUMMARY)} FROM z),
l AS ({' UNION ALL '.join(f"SELECT '{'other' if c == 'close' else 'microstructure'}' AS category, '{c}' AS feature, {c} AS v FROM f" for c, _ in _SUMMARY)}),
s AS (SELECT category, feature, avg(v) AS mean, stddev_samp(v) AS std, 100.0::DOUBLE * count(*) FILTER (v IS NULL) / count(*) AS missing FROM l GROUP BY category, feature)
SELECT category, count(*) AS n_features, round(avg(mean), 4) AS avg_mean, round(avg(std), 4) AS avg_std, round(avg(std * std), 4) AS avg_variance, round(avg(missing), 4) AS avg_missing FROM s GROUP BY category"""
ORACLES["stream_bars"] = f"SELECT symbol, bar_id, start_seq, end_seq, open, close, usd, ticks FROM ({tapes.ORACLES['dollar_bars']})"

"""The chain from bars to a weighted training matrix, whole feature grids, and models over the matrix.

differences -> autoregression residuals -> volatility -> CUSUM events -> barriers -> weights, joined
with features by symbol and time, so that rows that any step leaves out cannot shift the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barforge.operators import entropy, forest, labels, profile, regress, series, validation
from barforge.operators import microstructure as M
from barforge.plans import features
from barforge.plans.features import D, D_THRESHOLD, DECAY, MINUTES, PT, SL, SPAN, SPREAD_N, N
from barforge.plans.tapes import HOURS, hour_bars
from barforge.sources import shared

ORDER, TAU1, TAU2 = 1, 10.0, 40.0
NAMES = [f"{k}_{SPREAD_N if k == 'corwin_schultz' else N}" for k in M.FAMILIES]
GROUPS, TESTED, EMBARGO = 4, 2, 0.01
FOREST = {"numTrees": 5, "maxDepth": 3}
GRID = {"numTrees": (3, 5), "maxDepth": (2, 3)}
TYPES = ("corwin_schultz", "vpin_fixed", "oir", "volatility", "becker_parkinson", "amihud")
TYPE_WINDOWS = (12, 24)


def chain_events(bars: DataFrame) -> DataFrame:
    """``symbol, idx, time, trgt, side``: events of the residuals of differenced closes against their volatility."""
    diff = series.fracdiff(bars.select("symbol", "idx", F.col("close").alias("value")), D, D_THRESHOLD)
    residuals = series.ar_residuals(diff, series.fit_ar(diff, ORDER)["params"])
    vol = series.ewm_std(diff, SPAN).where("vol is not null")
    found = series.cusum_with_retry(residuals.join(vol, ["symbol", "idx"]), TAU1, TAU2)
    return found.join(bars.select("symbol", "idx", "time"), ["symbol", "idx"])


def matrix(bars: DataFrame) -> DataFrame:
    """``symbol, time, t1``, features, ``meta_label`` and ``weight`` of every event that has all features."""
    events = labels.vertical_barriers(shared.table(chain_events(bars), "chain-events").select("symbol", "time", "trgt", "side"), bars, MINUTES)
    labelled = labels.triple_barrier(events, bars.select("symbol", "time", "close"), PT, SL, MINUTES).select("symbol", "time", "meta_label")
    weighted = labels.sample_weights(events.select("symbol", "time", "t1"), DECAY).select("symbol", "time", "t1", "weight")
    made = M.features(bars, (SPREAD_N,), (N,)).select("symbol", "time", *NAMES).na.drop(subset=NAMES)
    return labelled.join(weighted, ["symbol", "time"]).join(made, ["symbol", "time"])


def _bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared.table(hour_bars(spark, sf_dir), "hour-bars")


def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = matrix(_bars(spark, sf_dir))
    return rows.select("symbol", "time", "meta_label", F.round("weight", 6).alias("weight"), *[F.round(c, 6).alias(c) for c in NAMES])


def micro_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 82 microstructure columns."""
    bars = hour_bars(spark, sf_dir)
    made = M.features(bars)
    return made.select("symbol", "idx", *[F.round(c, 6).alias(c) for c in made.columns if c not in bars.columns])


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hour_bars(spark, sf_dir).select("symbol", "idx", F.col("close").alias("value"))


def _long(wide: DataFrame) -> DataFrame:
    names = wide.columns[2:]
    pairs = ", ".join(f"'{c}', `{c}`" for c in names)
    return wide.select("symbol", "idx", F.expr(f"stack({len(names)}, {pairs}) as (feature, value)")).where("value is not null").withColumn("value", F.round("value", 6))


def shannon_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 81 Shannon columns, a row for each value."""
    return _long(entropy.shannon(_values(spark, sf_dir)))


def lz_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 36 Lempel-Ziv columns, a row for each value."""
    return _long(entropy.lz(_values(spark, sf_dir)))


def kont_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 20 Kontoyiannis columns, a row for each value."""
    return _long(entropy.kont(_values(spark, sf_dir)))


def grid_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of each family of features, and of all in a rollup."""
    rows = _values(spark, sf_dir)
    bars = hour_bars(spark, sf_dir)
    names = [("microstructure", c) for c in M.features(bars).columns if c not in bars.columns]
    names += [(c.split("_")[0], c) for made in (entropy.shannon(rows), entropy.lz(rows), entropy.kont(rows)) for c in made.columns[2:]]
    return spark.createDataFrame(names, "family string, feature string").rollup("family").agg(F.countDistinct("feature").alias("columns"))


def feature_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each type of feature: variants, means of their statistics, extremes, correlation with the bar's direction."""
    rows = M.features(hour_bars(spark, sf_dir), TYPE_WINDOWS, TYPE_WINDOWS)
    names = [f"{k}_{n}" for k in TYPES for n in TYPE_WINDOWS]
    made = profile.feature_types(rows.withColumn("y", (F.col("close") >= F.col("open")).cast("int")).na.drop(subset=names), names, "y")
    return made.select("type", "n_variants", *[F.round(c, 4).alias(c) for c in made.columns[2:]])


def ar_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each fit of the closes on their three last: intercept, slopes, share explained."""
    g, n = series.wide_gram(_values(spark, sf_dir), 3)
    fits = [(asked, regress.fit(g, n, 3, asked)) for asked in regress.METHODS]
    rows = [(asked, f["method"], *[float(x) for x in f["params"]], float(f["r2"]), f["rmse"]) for asked, f in fits]
    return spark.createDataFrame(rows, "asked string, method string, intercept double, lag_1 double, lag_2 double, lag_3 double, r2 double, rmse double")


def _differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.fracdiff(_values(spark, sf_dir), D, D_THRESHOLD)


def ar_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of variance of the leading axes of the differences' twelve lags, up to 95 %."""
    _, ratio = regress.components(*series.wide_gram(_differences(spark, sf_dir), 12))
    return spark.createDataFrame([(k + 1, float(r)) for k, r in enumerate(ratio)], "component int, ratio double")


def ar_stepwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lags of the differences, of twelve, in the order that a forward search takes them."""
    chosen = regress.stepwise(*series.wide_gram(_differences(spark, sf_dir), 12))
    return spark.createDataFrame([(k + 1, lag) for k, lag in enumerate(chosen)], "step int, lag int")


def d_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The least order of differencing that makes all series stationary."""
    return spark.createDataFrame([(series.search_d(shared.table(_values(spark, sf_dir), "closes"), threshold=D_THRESHOLD),)], "d double")


def _assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix in order of time: ``idx, t0, t1, y, weight, features``."""
    rows = shared.numbered(matrix(_bars(spark, sf_dir)), "time", "symbol")
    ready = rows.select("idx", F.col("time").alias("t0"), "t1", F.col("meta_label").cast("double").alias("y"), "weight", *NAMES)
    return shared.table(forest.assembled(ready, NAMES).drop(*NAMES), "matrix")


def forest_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best trials of a forest by log loss over purged folds, weighted."""
    rows = _assembled(spark, sf_dir)
    parts = shared.table(validation.splits(rows.select("idx", "t0", "t1"), 3, 1, EMBARGO), "splits")
    best = forest.trials(rows, parts, "y", GRID, "weight")[:3]
    return spark.createDataFrame([(k + 1, p["numTrees"], p["maxDepth"], loss) for k, (loss, p) in enumerate(best)], "rank int, trees int, depth int, log_loss double")


def forest_grid_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean F1 of a forest over stratified folds, for each set of parameters."""
    rows = _assembled(spark, sf_dir)
    made = forest.stratified_search(rows, "y", 2, {"numTrees": (3,), "maxDepth": (2, 3)})
    return spark.createDataFrame([(p["numTrees"], p["maxDepth"], f1) for f1, p in made], "trees int, depth int, f1 double")


def forest_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas under the curve over purged folds with all features and with the selected ones, and which model is taken."""
    rows = _assembled(spark, sf_dir)
    parts = shared.table(validation.splits(rows.select("idx", "t0", "t1"), 3, 1, EMBARGO), "splits")
    s = forest.selected(rows, parts, "y", NAMES, top=4, weight="weight", **FOREST)
    return spark.createDataFrame([(len(NAMES), len(s["features"]), s["auc_all"], s["auc_selected"], s["use_selected"])], "n_features int, n_selected int, auc_all double, auc_selected double, use_selected boolean")


def importance_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance of the matrix' features, summed by family: ``category, features, importance``."""
    ranked = forest.importance(forest.fit(_assembled(spark, sf_dir), "y", "weight", **FOREST), NAMES, least=-1.0)
    rows = spark.createDataFrame(ranked, "feature string, importance double")
    family = F.when(F.col("feature").rlike("^(volatility|becker)"), "volatility").otherwise(profile.category(F.col("feature")))
    return rows.groupBy(family.alias("category")).agg(F.count("*").alias("features"), F.sum("importance").alias("importance"))


def cpcv_pbo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forests of every combination, their predictions joined to paths, and the measures of overfitting."""
    return validation_pbo(_assembled(spark, sf_dir))


def validation_pbo(rows: DataFrame) -> DataFrame:
    parts = shared.table(validation.splits(rows.select("idx", "t0", "t1"), GROUPS, TESTED, EMBARGO), "splits")
    predicted = shared.table(forest.cross_predict(rows, parts, "y", "weight", **FOREST), "predictions")
    grouped, _ = validation.grouped(rows.select("idx"), GROUPS)
    paths = validation.path_metrics(predicted.join(grouped, "idx"), GROUPS, TESTED)
    measures = validation.overfitting(paths)
    losses = predicted.groupBy("comb_idx").agg(forest.loss_column().alias("l")).agg(F.count("*").alias("n_combinations"), F.avg("l").alias("mean_log_loss"))  # one row
    return measures.crossJoin(F.broadcast(losses))


QUERIES = {f.__name__: f for f in (training_set, micro_grid, shannon_grid, lz_grid, kont_grid, grid_counts, feature_types, ar_models, ar_components, ar_stepwise, d_search, forest_search, forest_grid_f1, forest_selection, importance_by_category, cpcv_pbo)}

_Q = f"{1 - 2 / (SPAN + 1)}::DOUBLE"
_CHAIN = f"""{HOURS}, {features._FRAC}, fd AS MATERIALIZED (
  SELECT a.symbol, a.idx, any_value(a.time) AS time, sum(w * b.close) AS v FROM bars a JOIN bars b ON b.symbol = a.symbol AND b.idx <= a.idx JOIN w ON k = a.idx - b.idx WHERE a.idx >= (SELECT max(k) FROM w) GROUP BY a.symbol, a.idx
), ln AS MATERIALIZED (
  SELECT *, lag(v) OVER o AS x, row_number() OVER o - 1 AS rn, v / lag(v) OVER o - 1 AS ch FROM fd WINDOW o AS (PARTITION BY symbol ORDER BY idx)
), m AS (SELECT regr_intercept(v, x) AS a, regr_slope(v, x) AS b FROM ln), s0 AS MATERIALIZED (
  SELECT a.symbol, a.rn, sum(pow({_Q}, a.rn - b.rn)) AS n0, sum(pow({_Q}, 2 * (a.rn - b.rn))) AS n2, sum(pow({_Q}, a.rn - b.rn) * b.ch) AS n1
  FROM ln a JOIN ln b ON b.symbol = a.symbol AND b.rn <= a.rn AND b.ch IS NOT NULL GROUP BY a.symbol, a.rn
), s1 AS MATERIALIZED (
  SELECT a.symbol, a.rn, any_value(a.n0) AS n0, any_value(a.n2) AS n2, sum(pow({_Q}, a.rn - b.rn) * pow(b.ch - a.n1 / a.n0, 2)) AS d
  FROM s0 a JOIN ln b ON b.symbol = a.symbol AND b.rn <= a.rn AND b.ch IS NOT NULL GROUP BY a.symbol, a.rn
), rd AS MATERIALIZED (
  SELECT ln.symbol, ln.idx, ln.time, ln.v - m.a - m.b * ln.x AS r, sqrt(d / n0 * n0 * n0 / (n0 * n0 - n2)) AS vol, row_number() OVER (PARTITION BY ln.symbol ORDER BY ln.idx) AS n
  FROM ln JOIN s1 ON s1.symbol = ln.symbol AND s1.rn = ln.rn, m WHERE ln.rn > 1
), cs AS (
  SELECT symbol, n, time, vol, greatest(0, r) AS u, least(0, r) AS l FROM rd WHERE n = 1
  UNION ALL
  SELECT rd.symbol, rd.n, rd.time, rd.vol, greatest(0, CASE WHEN c.u > {TAU1} * c.vol THEN 0 ELSE c.u END + rd.r), least(0, CASE WHEN c.u <= {TAU1} * c.vol AND c.l < -{TAU1} * c.vol THEN 0 ELSE c.l END + rd.r)
  FROM cs c JOIN rd ON rd.symbol = c.symbol AND rd.n = c.n + 1
), ev AS (SELECT symbol, time, CASE WHEN u > {TAU1} * vol THEN 1 ELSE -1 END AS side, vol / {TAU1} * {TAU2} AS trgt FROM cs WHERE u > {TAU1} * vol OR l < -{TAU1} * vol)
{features._LABELLED[len(features._EVENTS):]}, uq AS (
  SELECT a.symbol, a.time, CASE WHEN a.t1 IS NULL THEN 1 ELSE 1.0::DOUBLE / count(b.time) END AS uniqueness
  FROM lab a LEFT JOIN lab b ON b.symbol = a.symbol AND b.t1 IS NOT NULL AND b.time <= a.t1 AND b.t1 >= a.time GROUP BY a.symbol, a.time, a.t1
), wt AS (SELECT symbol, time, uniqueness * pow({DECAY}::DOUBLE, floor(epoch(max(time) OVER (PARTITION BY symbol) - time) / 86400)) AS weight FROM uq)"""
_PREPARED = features._READY[len(HOURS) + 2 :]
_SHANNON = lambda w: f"""SELECT a.symbol, a.idx, {w} AS w, b.close AS v, min(b.close) OVER (PARTITION BY a.symbol, a.idx) AS lo, max(b.close) OVER (PARTITION BY a.symbol, a.idx) AS hi
  FROM bars a JOIN bars b ON b.symbol = a.symbol AND b.idx BETWEEN a.idx - {w - 1} AND a.idx WHERE a.idx >= {w - 1}"""  # noqa: E731
_BINS = ", ".join(map(str, entropy.SHANNON_BINS))
_TYPED = [(k, f"{k}_{n}", features._sql(k, n)) for k in TYPES for n in TYPE_WINDOWS]
_GRID_COLUMNS = [(f"{k}_{n}", features._sql(k, n)) for k in M.FAMILIES for n in (M.SPREAD_WINDOWS if k == "corwin_schultz" else M.WINDOWS)]
_KINDS = {"microstructure": 82, "shannon": 81, "lz": 36, "kont": 20}

ORACLES = {
    "training_set": f"""WITH RECURSIVE {_CHAIN}, {_PREPARED}, f AS (SELECT symbol, time, {', '.join(f'{features._FEATURE_SQL[k]} AS {c}' for k, c in zip(M.FAMILIES, NAMES, strict=True))} FROM z)
SELECT lab.symbol, lab.time, meta_label, round(weight, 6) AS weight, {', '.join(f'round({c}, 6) AS {c}' for c in NAMES)}
FROM lab JOIN wt ON wt.symbol = lab.symbol AND wt.time = lab.time JOIN f ON f.symbol = lab.symbol AND f.time = lab.time WHERE {' AND '.join(f'{c} IS NOT NULL' for c in NAMES)}""",
    "micro_grid": f"WITH {features._READY} SELECT symbol, idx, {', '.join(f'round({sql}, 6) AS {c}' for c, sql in _GRID_COLUMNS)} FROM z",
    "shannon_grid": f"""WITH {HOURS}, x AS ({' UNION ALL '.join(_SHANNON(w) for w in entropy.WINDOWS)}),
c AS (SELECT symbol, idx, w, b, least(floor((v - lo) * b / (hi - lo)), b - 1) AS bin, count(*) AS n FROM x, (SELECT unnest([{_BINS}]) AS b) GROUP BY ALL)
SELECT symbol, idx, 'shannon_w' || w || '_b' || b AS feature, round(-sum(n / w::DOUBLE * log2(n / w::DOUBLE)), 6) AS value FROM c GROUP BY symbol, idx, w, b""",
    "grid_counts": "SELECT * FROM (VALUES " + ", ".join(f"('{k}', {n}::BIGINT)" for k, n in [*_KINDS.items()]) + f", (NULL, {sum(_KINDS.values())}::BIGINT)) AS t(family, columns)",
    "feature_types": f"""WITH {features._READY}, f AS (SELECT (close >= open)::INT AS y, {', '.join(f'{sql} AS {c}' for _, c, sql in _TYPED)} FROM z),
k AS (SELECT * FROM f WHERE {' AND '.join(f'{c} IS NOT NULL' for _, c, _ in _TYPED)}),
l AS ({' UNION ALL '.join(f"SELECT '{t}' AS type, '{c}' AS feature, {c} AS v, y FROM k" for t, c, _ in _TYPED)}),
s AS (SELECT type, feature, avg(v) AS mean, stddev_samp(v) AS std, min(v) AS least, max(v) AS most, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.75) AS q75, corr(v, y) AS r FROM l GROUP BY type, feature)
SELECT type, count(*) AS n_variants, round(avg(mean), 4) AS mean, round(avg(std), 4) AS std, round(min(least), 4) AS min, round(max(most), 4) AS max, round(avg(q25), 4) AS q25, round(avg(q50), 4) AS q50, round(avg(q75), 4) AS q75,
       round(avg(r), 4) AS corr_mean, round(max(abs(r)), 4) AS corr_most FROM s GROUP BY type""",
}

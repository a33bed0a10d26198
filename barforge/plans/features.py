"""Queries over series, labels, weights and rolling features of hourly bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barforge.operators import entropy, labels, series
from barforge.operators import microstructure as M
from barforge.plans.tapes import HOURS, hour_bars
from barforge.sources import tape

D, D_THRESHOLD, SPAN, TAU, MINUTES = 0.5, 0.01, 20, 1.0, 360
PT, SL, TARGET = 1.0, 1.0, 20.0
N, SPREAD_N = 24, 10
LAGS = 3
DECAY = 0.98


def _close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hour_bars(spark, sf_dir).select("symbol", "idx", "time", "close", F.col("close").alias("value"))


def frac_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.fracdiff(_close(spark, sf_dir), D, D_THRESHOLD).select("symbol", "idx", F.round("value", 6).alias("value"))


def frac_diff_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All weights down to the operator's own threshold (928 rows at d = 0.5), on the trades of the second tape."""
    w = Window.partitionBy("symbol").orderBy("seq")
    rows = tape.trades_from_lineitem(spark, sf_dir).select("symbol", (F.row_number().over(w) - 1).cast("long").alias("idx"), F.col("price").alias("value"))
    return series.fracdiff(rows, D).select("symbol", "idx", F.round("value", 4).alias("value"))


def ewm_vol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.ewm_std(_close(spark, sf_dir), SPAN).select("symbol", "idx", F.round("vol", 6).alias("vol"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CUSUM events on changes of the log close against a fixed scale."""
    w = Window.partitionBy("symbol").orderBy("idx")
    rows = hour_bars(spark, sf_dir).select("symbol", "idx", "time", (F.log("close") - F.log(F.lag("close").over(w))).alias("residual"), F.lit(1.0).alias("vol"))
    found = series.cusum_with_retry(rows, TAU, TARGET)
    return found.join(rows.select("symbol", "idx", "time"), ["symbol", "idx"])


def cusum_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("symbol", "idx", "time", F.round("trgt", 6).alias("trgt"), "side")


def ar_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.lags(_close(spark, sf_dir), ["close"], LAGS).select("symbol", "idx", *[f"close_lag_{k}" for k in range(1, LAGS + 1)])


def ar_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-order fit over all symbols, and its largest order by sample size."""
    rows = _close(spark, sf_dir)
    fit = series.fit_ar(rows, 1)
    n = fit["n"]
    return spark.createDataFrame([(n, round(float(fit["params"][0]), 4), round(float(fit["params"][1]), 6), round(fit["r2"], 6), series.largest_order(n))], "n long, intercept double, slope double, r2 double, p_max int")


def ar_residual_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barforge.operators.profile import residual_stats

    rows = _close(spark, sf_dir)
    made = residual_stats(series.ar_residuals(rows, series.fit_ar(rows, 1)["params"]), "residual")
    return made.select(*[F.round(c, 4).alias(c) for c in ("std", "skew", "kurtosis")])


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = hour_bars(spark, sf_dir)
    events = labels.vertical_barriers(_events(spark, sf_dir).select("symbol", "time", "trgt", "side"), bars, MINUTES)
    return labels.triple_barrier(events, bars.select("symbol", "time", "close"), PT, SL, MINUTES)


def triple_barrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir).select("symbol", "time", "side", "t1", "t_pt", "t_sl", F.round("ret", 6).alias("ret"), "label", "meta_label")


def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir).groupBy("symbol", "label").agg(F.count("*").alias("n"), F.round(F.avg("ret"), 6).alias("ret"))


def uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = hour_bars(spark, sf_dir).select("symbol", "time")
    return labels.uniqueness(labels.vertical_barriers(bars, bars, MINUTES)).select("symbol", "time", F.round("uniqueness", 6).alias("uniqueness"))


def sample_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = hour_bars(spark, sf_dir).select("symbol", "time")
    return labels.sample_weights(labels.vertical_barriers(bars, bars, MINUTES), DECAY).select("symbol", "time", F.round("weight", 6).alias("weight"))


def _feature(name: str, n: int):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return M.prepared(hour_bars(spark, sf_dir)).select("symbol", "idx", F.round(M.FAMILIES[name](n), 6).alias(name))

    query.__name__ = name
    return query


def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled events with a feature of each family and its lags over bars."""
    bars = M.features(hour_bars(spark, sf_dir), (SPREAD_N,), (N,))
    lagged = series.lags(bars, [f"oir_{N}", f"volatility_{N}"], 2)
    names = [c for c in lagged.columns if c.startswith(("corwin", "vpin", "oir", "volatility", "becker"))]
    rows = _labelled(spark, sf_dir).select("symbol", "time", "meta_label").join(lagged.select("symbol", "time", *names), ["symbol", "time"], "left").na.drop(subset=names)
    return rows.select("symbol", "time", "meta_label", *[F.round(c, 6).alias(c) for c in names])


def shannon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entropy.shannon(_close(spark, sf_dir), (50,), (25,)).select("symbol", "idx", F.round("shannon_w50_b25", 6).alias("shannon"))


def lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entropy.lz(_close(spark, sf_dir), (50, 100), (25,)).select("symbol", "idx", "lz_w50_b25", "lz_w100_b25")


def kont(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entropy.kont(_close(spark, sf_dir), (100,), (25,))


def adf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.adf_of(_close(spark, sf_dir))


QUERIES = {f.__name__: f for f in (frac_diff, frac_diff_wide, ewm_vol, cusum_events, ar_lags, ar_fit, ar_residual_stats, triple_barrier, label_counts, uniqueness, sample_weights, feature_matrix, shannon, lz, kont, adf)}
QUERIES |= {name: _feature(name, SPREAD_N if name == "corwin_schultz" else N) for name in M.FAMILIES}

_EVENTS = f"""{HOURS}, r AS (
  SELECT symbol, idx, time, close, coalesce(ln(close) - ln(lag(close) OVER (PARTITION BY symbol ORDER BY idx)), 0) AS r FROM bars
), cs AS (
  SELECT symbol, idx, time, greatest(0, r) AS u, least(0, r) AS l, 0 AS up0 FROM r WHERE idx = 0
  UNION ALL
  SELECT r.symbol, r.idx, r.time, greatest(0, CASE WHEN c.u > {TAU} THEN 0 ELSE c.u END + r.r), least(0, CASE WHEN c.u <= {TAU} AND c.l < -{TAU} THEN 0 ELSE c.l END + r.r), 0
  FROM cs c JOIN r ON r.symbol = c.symbol AND r.idx = c.idx + 1
), ev AS (
  SELECT symbol, idx, time, CASE WHEN u > {TAU} THEN 1 ELSE -1 END AS side, {TARGET / TAU}::DOUBLE AS trgt FROM cs WHERE u > {TAU} OR l < -{TAU}
)"""
_T1 = f"CASE WHEN time + INTERVAL {MINUTES} MINUTE <= max(time) OVER (PARTITION BY symbol) THEN time + INTERVAL {MINUTES} MINUTE END AS t1"
_LABELLED = f"""{_EVENTS}, vb AS (
  SELECT e.*, CASE WHEN e.time + INTERVAL {MINUTES} MINUTE <= m.l THEN e.time + INTERVAL {MINUTES} MINUTE END AS t1 FROM ev e JOIN (SELECT symbol, max(time) AS l FROM bars GROUP BY symbol) m USING (symbol)
), path AS (
  SELECT v.symbol, v.time, v.side, v.trgt, b.time AS t, b.close AS c, x.close AS x, (b.close / x.close - 1) * v.side AS ret,
         CASE WHEN v.side = 1 AND b.close >= x.close + v.trgt * {PT} OR v.side = -1 AND b.close <= x.close - v.trgt * {PT} THEN 1
              WHEN v.side = 1 AND b.close <= x.close - v.trgt * {SL} OR v.side = -1 AND b.close >= x.close + v.trgt * {SL} THEN -1 END AS kind
  FROM vb v JOIN bars x ON x.symbol = v.symbol AND x.time = v.time JOIN bars b ON b.symbol = v.symbol AND b.time BETWEEN v.time AND v.t1
), hit AS (
  SELECT symbol, time, arg_min(kind, t) FILTER (kind IS NOT NULL) AS kind, min(t) FILTER (kind IS NOT NULL) AS t, arg_min(ret, t) FILTER (kind IS NOT NULL) AS ret, arg_max(ret, t) AS last FROM path GROUP BY symbol, time
), lab AS (
  SELECT v.symbol, v.time, v.side, v.t1, CASE WHEN h.kind = 1 THEN h.t END AS t_pt, CASE WHEN h.kind = -1 THEN h.t END AS t_sl,
         coalesce(CASE WHEN h.kind IS NOT NULL THEN h.ret ELSE h.last END, 0)::DOUBLE AS ret, coalesce(h.kind, 0) AS label, (coalesce(h.kind, 0) = 1)::INT AS meta_label
  FROM vb v LEFT JOIN hit h ON h.symbol = v.symbol AND h.time = v.time
)"""
_UNIQUE = f"""{HOURS}, iv AS (SELECT symbol, time, {_T1} FROM bars), uq AS (
  SELECT a.symbol, a.time, a.t1, CASE WHEN a.t1 IS NULL THEN 1 ELSE 1.0::DOUBLE / count(b.time) END AS uniqueness
  FROM iv a LEFT JOIN iv b ON b.symbol = a.symbol AND b.t1 IS NOT NULL AND b.time <= a.t1 AND b.t1 >= a.time GROUP BY a.symbol, a.time, a.t1
)"""
_READY = f"""{HOURS}, p AS (
  SELECT *, usd - buy AS sell, coalesce((close - lag(close) OVER w) / (close + 1e-10), 0) AS ret, ln(high / (low + 1e-10) + 1e-10) AS rng,
         pow(ln(greatest(high, lag(high) OVER w) / least(low, lag(low) OVER w)), 2) AS beta,
         pow(ln(high / low), 2) + pow(ln(lag(high) OVER w / lag(low) OVER w), 2) AS gamma
  FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY idx)
), q AS (
  SELECT *, lag(ret) OVER (PARTITION BY symbol ORDER BY idx) AS ret0, abs((sqrt(2 * beta) - sqrt(beta)) / (2 * (sqrt(2) - 1)) - sqrt(gamma / (2 * (sqrt(2) - 1)))) AS alpha FROM p
), z AS (SELECT *, 2 * (exp(alpha) - 1) / (1 + exp(alpha)) AS pair FROM q)"""


def _sql(name: str, n: int) -> str:
    """A feature of ``n`` rows over the prepared table ``z``."""
    now = f"(PARTITION BY symbol ORDER BY idx ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    before = f"(PARTITION BY symbol ORDER BY idx ROWS BETWEEN {n - 1} PRECEDING AND 1 PRECEDING)"
    impact = f"CASE WHEN idx >= {n - 1} THEN avg(abs(ret) / (volume + 1e-10)) OVER {now} END"
    return {
        "corwin_schultz": f"CASE WHEN idx >= {n} THEN coalesce(avg(pair) OVER {before}, 0) END",
        "vpin_fixed": f"CASE WHEN idx >= {n - 1} THEN CASE WHEN sum(volume) OVER {now} > 0 THEN sum(abs(buy - sell)) OVER {now} / sum(volume) OVER {now} ELSE 0 END END",
        "oir": f"CASE WHEN idx >= {n - 1} THEN CASE WHEN sum(usd) OVER {now} > 0 THEN (sum(buy) OVER {now} - sum(sell) OVER {now}) / (sum(buy) OVER {now} + sum(sell) OVER {now}) ELSE 0 END END",
        "volatility": f"CASE WHEN idx >= {n - 1} THEN stddev_samp(ret) OVER {now} END",
        "becker_parkinson": f"CASE WHEN idx >= {n - 1} THEN stddev_samp(rng) OVER {now} / sqrt(4 * ln(2)) END",
        "amihud": impact,
        "kyle_lambda": impact,
        "roll_spread": f"CASE WHEN idx >= {n} THEN CASE WHEN covar_samp(ret, ret0) OVER {before} < 0 THEN 2 * sqrt(-covar_samp(ret, ret0) OVER {before}) ELSE 0 END END",
    }[name]


_FEATURE_SQL = {k: _sql(k, SPREAD_N if k == "corwin_schultz" else N) for k in M.FAMILIES}
_FRAC = f"""w AS (
  SELECT 0 AS k, 1::DOUBLE AS w UNION ALL SELECT k + 1, -w * ({D} - k) / (k + 1) FROM w WHERE abs(w) >= {D_THRESHOLD} OR k = 0
)"""

ORACLES = {
    "frac_diff": f"WITH RECURSIVE {HOURS}, {_FRAC} SELECT a.symbol, a.idx, round(sum(w * b.close), 6) AS value FROM bars a JOIN bars b ON b.symbol = a.symbol AND b.idx <= a.idx JOIN w ON k = a.idx - b.idx WHERE a.idx >= (SELECT max(k) FROM w) GROUP BY a.symbol, a.idx",
    "ewm_vol": f"""WITH {HOURS}, c AS (SELECT symbol, idx, close / lag(close) OVER (PARTITION BY symbol ORDER BY idx) - 1 AS x FROM bars), s AS (
  SELECT a.symbol, a.idx, sum(pow(1 - {2 / (SPAN + 1)}::DOUBLE, a.idx - b.idx)) AS s0, sum(pow(1 - {2 / (SPAN + 1)}::DOUBLE, 2 * (a.idx - b.idx))) AS q,
         sum(pow(1 - {2 / (SPAN + 1)}::DOUBLE, a.idx - b.idx) * b.x) AS s1
  FROM c a JOIN c b ON b.symbol = a.symbol AND b.idx <= a.idx AND b.x IS NOT NULL GROUP BY a.symbol, a.idx
), v AS (
  SELECT a.symbol, a.idx, any_value(a.s0) AS s0, any_value(a.q) AS q, sum(pow(1 - {2 / (SPAN + 1)}::DOUBLE, a.idx - b.idx) * pow(b.x - a.s1 / a.s0, 2)) AS s2
  FROM s a JOIN c b ON b.symbol = a.symbol AND b.idx <= a.idx AND b.x IS NOT NULL GROUP BY a.symbol, a.idx
)
SELECT c.symbol, c.idx, round(CASE WHEN c.idx > 1 THEN sqrt(s2 / s0 * s0 * s0 / (s0 * s0 - q)) END, 6) AS vol FROM c LEFT JOIN v USING (symbol, idx)""",
    "cusum_events": f"WITH RECURSIVE {_EVENTS} SELECT symbol, idx, time, round(trgt, 6) AS trgt, side FROM ev",
    "ar_lags": f"WITH {HOURS} SELECT symbol, idx, " + ", ".join(f"lag(close, {k}) OVER (PARTITION BY symbol ORDER BY idx) AS close_lag_{k}" for k in range(1, LAGS + 1)) + " FROM bars",
    "ar_fit": f"WITH {HOURS}, l AS (SELECT close AS y, lag(close) OVER (PARTITION BY symbol ORDER BY idx) AS x FROM bars) SELECT regr_count(y, x)::BIGINT AS n, round(regr_intercept(y, x), 4) AS intercept, round(regr_slope(y, x), 6) AS slope, round(regr_r2(y, x), 6) AS r2, (CASE WHEN round(sqrt(regr_count(y, x))) > 200 THEN 50 WHEN round(sqrt(regr_count(y, x))) > 100 THEN 75 ELSE round(sqrt(regr_count(y, x))) END)::INT AS p_max FROM l",
    "ar_residual_stats": f"WITH {HOURS}, l AS (SELECT close AS y, lag(close) OVER (PARTITION BY symbol ORDER BY idx) AS x FROM bars), m AS (SELECT regr_intercept(y, x) AS a, regr_slope(y, x) AS b FROM l), e AS (SELECT y - a - b * x AS r FROM l, m WHERE x IS NOT NULL) SELECT round(stddev_pop(r), 4) AS std, round(skewness(r), 4) AS skew, round(kurtosis(r), 4) AS kurtosis FROM e",
    "triple_barrier": f"WITH RECURSIVE {_LABELLED} SELECT symbol, time, side, t1, t_pt, t_sl, round(ret, 6) + 0.0::DOUBLE AS ret, label, meta_label FROM lab",
    "label_counts": f"WITH RECURSIVE {_LABELLED} SELECT symbol, label, count(*) AS n, round(avg(ret), 6) + 0.0::DOUBLE AS ret FROM lab GROUP BY symbol, label",
    "uniqueness": f"WITH {_UNIQUE} SELECT symbol, time, round(uniqueness, 6) AS uniqueness FROM uq",
    "sample_weights": f"WITH {_UNIQUE} SELECT symbol, time, round(uniqueness * pow({DECAY}::DOUBLE, floor(epoch(max(time) OVER (PARTITION BY symbol) - time) / 86400)), 6) AS weight FROM uq",
    "shannon": f"""WITH {HOURS}, w AS (
  SELECT a.symbol, a.idx, b.close AS v, min(b.close) OVER (PARTITION BY a.symbol, a.idx) AS lo, max(b.close) OVER (PARTITION BY a.symbol, a.idx) AS hi
  FROM bars a JOIN bars b ON b.symbol = a.symbol AND b.idx BETWEEN a.idx - 49 AND a.idx WHERE a.idx >= 49
), c AS (SELECT symbol, idx, least(floor((v - lo) * 25 / (hi - lo)), 24) AS bin, count(*) AS n FROM w GROUP BY ALL),
e AS (SELECT symbol, idx, -sum(n / 50.0::DOUBLE * log2(n / 50.0::DOUBLE)) AS h FROM c GROUP BY symbol, idx)
SELECT bars.symbol, bars.idx, round(h, 6) AS shannon FROM bars LEFT JOIN e ON e.symbol = bars.symbol AND e.idx = bars.idx""",
    "feature_matrix": f"""WITH RECURSIVE {_LABELLED}, {_READY[len(HOURS) + 2:]}, f AS (
  SELECT symbol, time, idx, {', '.join(f'{sql} AS {k}_{SPREAD_N if k == "corwin_schultz" else N}' for k, sql in _FEATURE_SQL.items() if k.startswith(('corwin', 'vpin', 'oir', 'volatility', 'becker')))} FROM z
), g AS (
  SELECT *, {', '.join(f'lag({c}, {k}) OVER (PARTITION BY symbol ORDER BY idx) AS {c}_lag_{k}' for c in (f'oir_{N}', f'volatility_{N}') for k in (1, 2))} FROM f
)
SELECT lab.symbol, lab.time, meta_label, {', '.join(f'round({c}, 6) AS {c}' for c in [f'corwin_schultz_{SPREAD_N}', *(f'{k}_{N}' for k in ('vpin_fixed', 'oir', 'volatility', 'becker_parkinson')), *(f'{c}_{N}_lag_{k}' for c in ('oir', 'volatility') for k in (1, 2))])}
FROM lab JOIN g ON g.symbol = lab.symbol AND g.time = lab.time
WHERE corwin_schultz_{SPREAD_N} IS NOT NULL AND oir_{N}_lag_2 IS NOT NULL AND volatility_{N}_lag_2 IS NOT NULL""",
}
ORACLES |= {k: f"WITH {_READY} SELECT symbol, idx, round({sql}, 6) AS {k} FROM z" for k, sql in _FEATURE_SQL.items()}
ORACLES["frac_diff_wide"] = f"""WITH RECURSIVE {_FRAC.replace(f'>= {D_THRESHOLD}', '>= 0.00001')}, t AS (
  SELECT l_returnflag AS symbol, row_number() OVER p - 1 AS idx, list(l_extendedprice::DOUBLE / l_quantity::DOUBLE) OVER (p ROWS BETWEEN 927 PRECEDING AND CURRENT ROW) AS past
  FROM lineitem WINDOW p AS (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey)
), v AS (SELECT list(w ORDER BY k DESC) AS ws FROM w)
SELECT symbol, idx, round(list_dot_product(past, ws), 4) AS value FROM t, v WHERE len(past) = len(ws)"""

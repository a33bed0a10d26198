"""Profiles of wide numeric tables; every statistic of every column in one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def long(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``feature, value``: a row for each cell of ``columns``."""
    pairs = ", ".join(f"'{c}', cast(`{c}` as double)" for c in columns)
    return rows.select(F.expr(f"stack({len(columns)}, {pairs}) as (feature, value)"))


def sample_skew(x: Column) -> Column:
    """Bias-corrected skewness."""
    n = F.count(x)
    return F.when(n > 2, F.skewness(x) * F.sqrt(n * (n - 1.0)) / (n - 2))


def sample_kurtosis(x: Column) -> Column:
    """Bias-corrected excess kurtosis."""
    n = F.count(x)
    return F.when(n > 3, (n - 1) / ((n - 2.0) * (n - 3)) * ((n + 1) * F.kurtosis(x) + 6))


def describe(rows: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """A row per column: count, mean, std, quartiles, extremes, shares missing and zero, skew, kurtosis.

    Exact quartiles hold a column's distinct values in one task; pass ``exact=False`` for sketches
    (error 1e-4 of the rank) where columns have more of them than that.
    """
    x, at = F.col("value"), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    quartiles = F.percentile(x, at) if exact else F.percentile_approx(x, at, 10_000)
    return (
        long(rows, columns)
        .groupBy("feature")
        .agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"), quartiles.alias("q"), (100.0 * F.sum(F.isnull(x).cast("int")) / F.count("*")).alias("missing_pct"), (100.0 * F.sum((x == 0).cast("int")) / F.count("*")).alias("zeros_pct"), sample_skew(x).alias("skew"), sample_kurtosis(x).alias("kurtosis"))
        .select("feature", "n", "mean", "std", "min", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"), "max", "missing_pct", "zeros_pct", "skew", "kurtosis")
    )


def outliers_iqr(rows: DataFrame, columns: list[str], reach: float = 1.5) -> DataFrame:
    """``feature, outliers``: values beyond ``reach`` interquartile ranges from the quartiles."""
    cells = long(rows, columns)
    q = cells.groupBy("feature").agg(F.percentile("value", F.array(F.lit(0.25), F.lit(0.75))).alias("q"))  # a row per column
    low, high = F.col("q")[0] - reach * (F.col("q")[1] - F.col("q")[0]), F.col("q")[1] + reach * (F.col("q")[1] - F.col("q")[0])
    return cells.join(F.broadcast(q), "feature").groupBy("feature").agg(F.sum(((F.col("value") < low) | (F.col("value") > high)).cast("long")).alias("outliers"))


def target_correlation(rows: DataFrame, columns: list[str], target: str) -> DataFrame:
    pairs = ", ".join(f"'{c}', cast(`{c}` as double)" for c in columns)
    cells = rows.select(F.expr(f"stack({len(columns)}, {pairs}) as (feature, value)"), F.col(target).cast("double").alias("y"))
    return cells.groupBy("feature").agg(F.corr("value", "y").alias("corr"))


def low_variance(rows: DataFrame, columns: list[str], least: float = 1e-10) -> list[str]:
    """Columns to drop: variance under ``least`` or unknown."""
    r = rows.agg(*[F.var_samp(c).alias(c) for c in columns]).first()
    return [c for c in columns if r[c] is None or r[c] < least]


def top_variance(rows: DataFrame, columns: list[str], n: int) -> DataFrame:
    return long(rows, columns).groupBy("feature").agg(F.var_samp("value").alias("variance")).orderBy(F.desc("variance"), "feature").limit(n)


def category(name: Column) -> Column:
    """Family of a generated feature name."""
    low = F.lower(name)
    return F.when(low.rlike("shannon|lz_|kont_"), "entropy").when(low.rlike("corwin|vpin|oir|volatility|becker|amihud|kyle|roll"), "microstructure").otherwise("other")


def category_summary(described: DataFrame) -> DataFrame:
    return described.groupBy(category(F.col("feature")).alias("category")).agg(F.count("*").alias("n_features"), F.avg("mean").alias("avg_mean"), F.avg("std").alias("avg_std"), F.avg(F.col("std") * F.col("std")).alias("avg_variance"), F.avg("missing_pct").alias("avg_missing"))


def feature_types(rows: DataFrame, columns: list[str], target: str) -> DataFrame:
    """A row for each type of feature (a name less its last part): variants, means of their statistics, extremes, correlations."""
    kind = F.regexp_replace("feature", "_[^_]*$", "")
    both = describe(rows, columns).join(target_correlation(rows, columns, target), "feature")  # a row for each column
    means = [F.avg(c).alias(c) for c in ("mean", "std")] + [F.min("min").alias("min"), F.max("max").alias("max")] + [F.avg(c).alias(c) for c in ("q25", "q50", "q75")]
    return both.groupBy(kind.alias("type")).agg(F.count("*").alias("n_variants"), *means, F.avg("corr").alias("corr_mean"), F.max(F.abs("corr")).alias("corr_most"))


def classification(rows: DataFrame, label: str, predicted: str) -> DataFrame:
    """One row: confusion counts, accuracy, precision, recall and F1 of 0/1 columns."""
    n = lambda y, p: F.sum(((F.col(label) == y) & (F.col(predicted) == p)).cast("long"))
    c = rows.agg(n(1, 1).alias("tp"), n(0, 1).alias("fp"), n(1, 0).alias("fn"), n(0, 0).alias("tn"))
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.withColumns({"accuracy": share(tp + tn, tp + fp + fn + tn), "precision": share(tp, tp + fp), "recall": share(tp, tp + fn), "f1": share(2 * tp, 2 * tp + fp + fn)})


def regression(rows: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: MAE, RMSE, R2."""
    y, p = F.col(actual), F.col(predicted)
    sse = F.sum((y - p) * (y - p))
    return rows.agg(F.avg(F.abs(y - p)).alias("mae"), F.sqrt(sse / F.count("*")).alias("rmse"), (1 - sse / (F.var_pop(y) * F.count("*"))).alias("r2"))


def residual_stats(rows: DataFrame, residual: str) -> DataFrame:
    r = F.col(residual)
    return rows.agg(F.avg(r).alias("mean"), F.stddev_pop(r).alias("std"), sample_skew(r).alias("skew"), sample_kurtosis(r).alias("kurtosis"))


def class_distribution(rows: DataFrame, label: str) -> DataFrame:
    """``label, n, share``."""
    counts = rows.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("__total"))  # one row
    return counts.crossJoin(F.broadcast(total)).select("label", "n", (F.col("n") / F.col("__total")).alias("share"))


def correlations(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``a, b, corr`` of every pair of columns, all of them from one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    wide = rows.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return wide.select(F.expr(f"stack({len(pairs)}, " + ", ".join(f"'{a}', '{b}', c{i}" for i, (a, b) in enumerate(pairs)) + ") as (a, b, corr)"))


def standard_scores(rows: DataFrame, column: str, key: str = "symbol") -> DataFrame:
    """Adds ``z``: distance from the key's mean in sample deviations. Means are joined back, so no key is gathered."""
    stats = rows.groupBy(key).agg(F.avg(column).alias("__m"), F.stddev_samp(column).alias("__s"))
    return rows.join(stats, key).withColumn("z", (F.col(column) - F.col("__m")) / F.col("__s")).drop("__m", "__s")

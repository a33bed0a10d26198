"""Purged and combinatorial purged cross-validation, backtest paths and overfitting measures.

Input rows are ``(idx, t0, t1)``, ``idx`` counting from 0 in time order. Whether a row's label overlaps a
group of test rows follows from a running maximum of the group's label ends, so purging sorts
rows once for each group instead of comparing pairs.
"""

from __future__ import annotations

from itertools import combinations
from math import comb, log, sqrt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def number_of_paths(groups: int, tested: int) -> int:
    return comb(groups - 1, tested - 1)


def phi_matrix(spark: SparkSession, groups: int, tested: int) -> DataFrame:
    """``comb_idx, group_idx, is_test`` for every choice of test groups, in lexical order."""
    rows = [(c, g, int(g in chosen)) for c, chosen in enumerate(combinations(range(groups), tested)) for g in range(groups)]
    return spark.createDataFrame(rows, "comb_idx int, group_idx int, is_test int")


def grouped(rows: DataFrame, groups: int) -> tuple[DataFrame, int]:
    """Adds ``group_idx``: runs of equal size in order, the last takes what is left."""
    n = rows.count()
    size = max(n // groups, 1)
    return rows.withColumn("group_idx", F.least(F.floor(F.col("idx") / size), F.lit(groups - 1)).cast("int")), n


def combinations_of(rows: DataFrame, groups: int, tested: int) -> DataFrame:
    """``idx, group_idx, tested_in``: each row's group, and the combinations that test it."""
    at, _ = grouped(rows, groups)
    of_group = phi_matrix(rows.sparkSession, groups, tested).where("is_test = 1").groupBy("group_idx").agg(F.sort_array(F.collect_list("comb_idx")).alias("tested_in"))
    return at.join(F.broadcast(of_group), "group_idx").select("idx", "group_idx", "tested_in")


def overlaps(rows: DataFrame, groups: int) -> DataFrame:
    """``idx, group_idx``: rows of other groups whose label overlaps a label of the group; null ``t1`` never does."""
    known = rows.where("t1 is not null")
    tests = known.select("group_idx", F.col("t0").alias("at"), F.lit(0).alias("ask"), F.col("t1").alias("end"), F.lit(None).cast("long").alias("idx"), F.col("t0").alias("t0"))
    to = F.explode(F.array_except(F.sequence(F.lit(0), F.lit(groups - 1)), F.array("own")))
    asks = known.withColumnRenamed("group_idx", "own").select(to.alias("group_idx"), F.col("t1").alias("at"), F.lit(1).alias("ask"), F.lit(None).cast(rows.schema["t1"].dataType).alias("end"), F.col("idx").cast("long").alias("idx"), "t0")
    reach = F.max("end").over(Window.partitionBy("group_idx").orderBy("at", "ask").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return tests.unionByName(asks).withColumn("__reach", reach).where("ask = 1 and __reach >= t0").select("idx", "group_idx")


def splits(rows: DataFrame, groups: int, tested: int = 1, embargo: float = 0.0) -> DataFrame:
    """``comb_idx, idx, part`` (train or test); purged and embargoed rows are left out of a combination.

    With one tested group these are the folds of purged K-fold, with more those of the combinatorial
    form. The embargo removes ``int(n * embargo)`` rows after each test group.
    """
    spark = rows.sparkSession
    at, n = grouped(rows, groups)
    step, size = int(n * embargo), max(n // groups, 1)
    phi = F.broadcast(phi_matrix(spark, groups, tested))
    chosen = F.broadcast(phi_matrix(spark, groups, tested).where("is_test = 1").select("comb_idx", F.col("group_idx").alias("g")))
    placed = at.join(phi, "group_idx").select("comb_idx", "idx", "is_test")
    test = placed.where("is_test = 1").select("comb_idx", "idx", F.lit("test").alias("part"))
    end = F.when(F.col("g") == groups - 1, n).otherwise((F.col("g") + 1) * size)
    barred = overlaps(at, groups).join(chosen, F.col("group_idx") == F.col("g")).select("comb_idx", "idx")
    if step:
        after = chosen.select("comb_idx", F.explode(F.sequence(end, end + step - 1)).alias("idx"))
        barred = barred.unionByName(after.select("comb_idx", F.col("idx").cast("long").alias("idx")))
    train = placed.where("is_test = 0").join(barred.distinct(), ["comb_idx", "idx"], "left_anti").select("comb_idx", "idx", F.lit("train").alias("part"))
    return test.unionByName(train)


def path_metrics(predictions: DataFrame, groups: int, tested: int) -> DataFrame:
    """``path_idx, n, hit_rate, total_return, sharpe`` from ``(idx, group_idx, comb_idx, pred, y)``.

    The ``k``-th combination that tests a group gives its rows to path ``k``. Returns are the
    confidence of the prediction, signed by whether it is right; Sharpe ratios are annualised over 252.
    """
    spark = predictions.sparkSession
    order = F.row_number().over(Window.partitionBy("group_idx").orderBy("comb_idx")) - 1
    ranked = phi_matrix(spark, groups, tested).where("is_test = 1").select("comb_idx", "group_idx", order.alias("path_idx"))
    right = (F.col("pred") >= 0.5).cast("int") == F.col("y")
    gain = F.abs(F.col("pred") - 0.5) * 2
    rows = predictions.join(F.broadcast(ranked), ["comb_idx", "group_idx"]).withColumns({"__hit": right.cast("double"), "__r": F.when(right, gain).otherwise(-gain)})
    spread = F.stddev_pop("__r")
    return rows.groupBy("path_idx").agg(F.count("*").alias("n"), F.avg("__hit").alias("hit_rate"), F.sum("__r").alias("total_return"), F.when(spread > 0, F.avg("__r") / spread * sqrt(252)).otherwise(0.0).alias("sharpe"))


def overfitting(paths: DataFrame, sharpe: str = "sharpe", method: str = "rank") -> DataFrame:
    """One row: share of paths under the median (or, ``stochastic``, over half the best), deflated best Sharpe."""
    s = F.col(sharpe)
    whole = paths.agg(F.count(s).alias("n_paths"), F.max(s).alias("max_sharpe"), F.median(s).alias("median_sharpe"), F.stddev_pop(s).alias("sharpe_std"), F.collect_list(s).alias("__all"))
    share = F.size(F.filter("__all", (lambda x: x < F.col("median_sharpe")) if method == "rank" else (lambda x: x >= F.col("max_sharpe") * 0.5))) / F.col("n_paths")
    deflated = F.when((F.col("n_paths") <= 1) | (F.col("sharpe_std") <= 0), F.col("max_sharpe")).otherwise(F.greatest(F.lit(0.0), F.col("max_sharpe") - F.col("sharpe_std") * F.sqrt(2 * F.log("n_paths"))))
    return whole.select("n_paths", "max_sharpe", "median_sharpe", "sharpe_std", share.alias("pbo"), deflated.alias("deflated_sharpe"))


def deflated_sharpe(best: float, trials: int, spread: float) -> float:
    return best if trials <= 1 or spread <= 0 else max(0.0, best - spread * sqrt(2 * log(trials)))


def embargo_seconds(rows: DataFrame, share: float) -> int:
    """Time between the first row and the one ``int(n * share)`` rows on, in seconds."""
    step = int(rows.count() * share)
    if not step:
        return 0
    at = rows.where(F.col("idx").isin(0, step)).agg(F.unix_seconds(F.max("t0").cast("timestamp")) - F.unix_seconds(F.min("t0").cast("timestamp")))
    return int(at.first()[0])

"""Random forests over a feature matrix: search, purged evaluation, importance and selection."""

from __future__ import annotations

import itertools

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRID = {"numTrees": (20,), "maxDepth": (3, 5)}


def assembled(rows: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip").transform(rows)


def fit(rows: DataFrame, label: str, weight: str | None = None, **params) -> RandomForestClassificationModel:
    model = RandomForestClassifier(featuresCol="features", labelCol=label, seed=42, **params)
    return (model.setWeightCol(weight) if weight else model).fit(rows)


def log_loss(predicted: DataFrame, label: str) -> float:
    return MulticlassClassificationEvaluator(metricName="logLoss", labelCol=label, probabilityCol="probability").evaluate(predicted)


def auc(predicted: DataFrame, label: str) -> float:
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction").evaluate(predicted)


def cross_predict(rows: DataFrame, parts: DataFrame, label: str, weight: str | None = None, **params) -> DataFrame:
    """Predictions ``comb_idx, idx, pred, y`` of each combination's test rows, by a forest of its train rows."""
    out = None
    for c in sorted(r.comb_idx for r in parts.select("comb_idx").distinct().collect()):  # one per combination
        own = parts.where(F.col("comb_idx") == c)
        train = rows.join(own.where("part = 'train'").select("idx"), "idx", "left_semi")
        test = rows.join(own.where("part = 'test'").select("idx"), "idx", "left_semi")
        made = fit(train, label, weight, **params).transform(test).select(F.lit(c).alias("comb_idx"), "idx", F.coalesce(F.get(vector_to_array("probability"), F.lit(1)), F.lit(0.0)).alias("pred"), F.col(label).cast("int").alias("y"))
        out = made if out is None else out.unionByName(made)
    return out


def loss_column() -> Column:
    """Mean log loss of ``pred`` against ``y``."""
    p = F.greatest(F.least("pred", F.lit(1 - 1e-15)), F.lit(1e-15))
    return F.avg(-F.when(F.col("y") == 1, F.log(p)).otherwise(F.log(1 - p)))


def _grid(grid: dict) -> list[dict]:
    return [dict(zip(grid, values, strict=True)) for values in itertools.product(*grid.values())]


def trials(rows: DataFrame, parts: DataFrame, label: str, grid: dict = GRID, weight: str | None = None) -> list[tuple[float, dict]]:
    """Log loss over the combinations' test rows and parameters of every trial, the best first."""
    made = [(cross_predict(rows, parts, label, weight, **params).agg(loss_column()).first()[0], params) for params in _grid(grid)]
    return sorted(made, key=lambda t: t[0])


def search(rows: DataFrame, parts: DataFrame, label: str, grid: dict = GRID, weight: str | None = None) -> tuple[dict, float]:
    """The parameters of least log loss, and that loss."""
    loss, params = trials(rows, parts, label, grid, weight)[0]
    return params, loss


def stratified(rows: DataFrame, label: str, folds: int) -> DataFrame:
    """``comb_idx, idx, part`` of folds that deal each label's rows out evenly, in an order of hashes."""
    dealt = (F.row_number().over(Window.partitionBy(label).orderBy(F.xxhash64("idx"), "idx")) % folds).cast("int")
    at = rows.select("idx", dealt.alias("fold"))
    every = F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))
    return at.withColumn("comb_idx", every).select("comb_idx", "idx", F.when(F.col("fold") == F.col("comb_idx"), "test").otherwise("train").alias("part"))


def stratified_search(rows: DataFrame, label: str, folds: int, grid: dict = GRID, weight: str | None = None) -> list[tuple[float, dict]]:
    """Mean F1 over stratified folds and parameters of every trial, the best first."""
    parts, out = stratified(rows, label, folds), []
    for params in _grid(grid):
        made = cross_predict(rows, parts, label, weight, **params).withColumn("p", (F.col("pred") >= 0.5).cast("int"))
        n = lambda y, p: F.sum(((F.col("y") == y) & (F.col("p") == p)).cast("long"))
        each = made.groupBy("comb_idx").agg(F.coalesce(2 * n(1, 1) / F.nullif(2 * n(1, 1) + n(0, 1) + n(1, 0), F.lit(0)), F.lit(0.0)).alias("f1"))
        out.append((each.agg(F.avg("f1")).first()[0], params))
    return sorted(out, key=lambda t: -t[0])


def importance(model: RandomForestClassificationModel, features: list[str], least: float = 0.0, top: int | None = None) -> list[tuple[str, float]]:
    """Features over ``least`` by falling importance, the first ``top`` of them."""
    ranked = sorted(zip(features, model.featureImportances.toArray().tolist(), strict=True), key=lambda x: -x[1])
    return [x for x in ranked if x[1] > least][:top]


def area(predicted: DataFrame) -> float:
    """Area under the curve of ``pred`` against ``y``."""
    return BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="pred").evaluate(predicted.withColumn("y", F.col("y").cast("double")))


def selected(rows: DataFrame, parts: DataFrame, label: str, features: list[str], top: int, weight: str | None = None, least: float = 0.0, **params) -> dict:
    """A forest with all features against one with the ``top`` most important: areas over the test rows, and whether to take the latter."""
    best = [f for f, _ in importance(fit(rows, label, weight, **params), features, least, top)]
    chosen = VectorSlicer(inputCol="__all", outputCol="features", indices=[features.index(f) for f in best]).transform(rows.withColumnRenamed("features", "__all"))
    whole, less = area(cross_predict(rows, parts, label, weight, **params)), area(cross_predict(chosen, parts, label, weight, **params))
    return {"features": best, "auc_all": whole, "auc_selected": less, "use_selected": less > whole}

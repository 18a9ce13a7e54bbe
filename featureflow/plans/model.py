"""Model selection, metrics and batch scoring.

Training uses ``pyspark.ml`` as is (tree-aggregated, distributed), but for the
trees and forests of a selection of many rows (``operators/trees``); what this
module adds is the orchestration: one metric aggregate instead of three
evaluator passes, a persisted training set during cross-validation, the
winning grid entry carried into the retrained model, and scoring every saved
model in a folder.
"""

from __future__ import annotations

import json
import math
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import (DecisionTreeRegressionModel, DecisionTreeRegressor, LinearRegression,
                                   RandomForestRegressionModel, RandomForestRegressor)
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from featureflow.operators import ridge, trees
from featureflow.operators.clean import output_projection
from featureflow.operators.sampling import PART_BYTES, ensure_parallelism, input_bytes
from featureflow.plans.features import list_dirs
from featureflow.session import shared_path

# --- fixed values: model families and their grids ---------------------------
FAMILIES = ("Linear_Regression", "Decision_Tree", "Random_Forest")
GRIDS = {
    "Linear_Regression": ("regParam", [0.1, 0.3, 0.5]),
    "Decision_Tree": ("maxDepth", [5, 10, 20]),
    "Random_Forest": ("numTrees", [10, 50, 100]),
}
MOST_ROWS = 500_000             # of a model selection whose trees pyspark.ml fits; those of more rows grow by operators/trees


def regression_metrics(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row ``(rmse, mae, r2)`` from ONE aggregate (same values as
    RegressionEvaluator's three metrics)."""
    y = F.col(label).cast(DoubleType())
    e = y - F.col(prediction).cast(DoubleType())
    agg = pred.agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
                   F.sum(e * e).alias("_sse"), (F.var_pop(y) * F.count(y)).alias("_sst"))
    return agg.select("rmse", "mae", (F.lit(1.0) - F.col("_sse") / F.col("_sst")).alias("r2"))


def make_estimator(family: str, features_col: str, label: str, seed: int = 42):
    if family == "Linear_Regression":
        return LinearRegression(featuresCol=features_col, labelCol=label)
    if family == "Decision_Tree":
        return DecisionTreeRegressor(featuresCol=features_col, labelCol=label, seed=seed)
    if family == "Random_Forest":
        return RandomForestRegressor(featuresCol=features_col, labelCol=label, seed=seed)
    raise ValueError(f"unknown model family {family!r}")


def make_scaler(features_col: str, scaled_col: str) -> StandardScaler:
    """Zero mean, unit sample deviation."""
    return StandardScaler(inputCol=features_col, outputCol=scaled_col, withMean=True, withStd=True)


class ScaledPipeline(Pipeline):
    """Scaler, then regressor; a grid over the regressor's params fits the scaler once a fold."""

    def fitMultiple(self, dataset, paramMaps):
        scaler, estimator = self.getStages()
        scaling = scaler.fit(dataset)
        fits = estimator.fitMultiple(scaling.transform(dataset), paramMaps)
        return map(lambda fit: (fit[0], PipelineModel([scaling, fit[1]])), fits)


def scaled_pipeline(estimator, features_col: str = "features", scaled_col: str = "scaledFeatures") -> Pipeline:
    return ScaledPipeline(stages=[make_scaler(features_col, scaled_col), estimator])


def training_set(df: DataFrame, label: str, features_col: str = "features",
                 *extra: str | None) -> DataFrame:
    """The columns a fit reads, spread over the cores and persisted.

    Model fits make many passes; without this each pass recomputes the
    whole feature plan.  MEMORY_AND_DISK spills instead of failing, and a
    lost executor's blocks are recomputed from the lineage.
    """
    data = df.select(features_col, label, *[c for c in extra if c])
    return ensure_parallelism(data).persist(StorageLevel.MEMORY_AND_DISK)


def cross_validate(train: DataFrame, family: str, label: str, grid_values=None, folds: int = 5,
                   seed: int = 42, parallelism: int | None = None, features_col: str = "features",
                   fold_col: str | None = None, persist: bool = True, grown: GrownRows | None = None):
    """Grid search with k-fold CV on RMSE.  Returns (cv_model, best_param, best_value).

    ``fold_col`` names an INT column of fold numbers 0 .. folds-1 (a hash of the
    key makes the folds independent of the layout); without it rows are dealt
    at random by ``seed``.  Grid points are fitted concurrently (``parallelism``, default one per grid
    value); they share the persisted training set and, in a fold, one fitted
    scaler.  Linear regressions of up to ``ridge.MOST_FEATURES`` features are
    solved for all folds and grid values from one pass over the rows.  ``persist=False``: ``train`` is cheap to read (part of a persisted set).
    ``grown``: the same rows and folds, for forests by ``operators/trees``, all folds and grid values together.
    """
    est = make_estimator(family, "scaledFeatures", label, seed)
    pname, default_values = GRIDS[family]
    values = list(grid_values if grid_values is not None else default_values)
    if family == "Linear_Regression" and (k := features_of(train, features_col)) and k <= ridge.MOST_FEATURES:
        return _cross_validate_ridge(train, label, values, folds, seed, features_col, fold_col, persist, k)
    if grown and family == "Random_Forest":
        return _cross_validate_grown(grown, family, pname, values)
    grid = ParamGridBuilder().addGrid(est.getParam(pname), values).build()
    evaluator = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
    cv = CrossValidator(estimator=scaled_pipeline(est, features_col), estimatorParamMaps=grid,
                        evaluator=evaluator, numFolds=folds, seed=seed,
                        parallelism=parallelism or len(values), foldCol=fold_col or "")
    # every fold re-reads its input: keep only the two needed columns, persisted
    owned = persist and not train.storageLevel.useMemory and not train.storageLevel.useDisk
    data = training_set(train, label, features_col, fold_col) if owned else train
    try:
        model = cv.fit(data)
    finally:
        if owned:
            data.unpersist()
    best_idx = min(range(len(values)), key=lambda i: model.avgMetrics[i])
    return model, pname, values[best_idx]


def _cross_validate_grown(grown: GrownRows, family: str, pname: str, values: list):
    """``cross_validate`` of trees by ``operators/trees``."""
    metrics = grown.cross_validate(family, values)
    best = min(range(len(values)), key=lambda i: metrics[i])
    model = retrain_best(grown.rows, family, grown.label, pname, values[best], grown.seed, grown.features_col, grown=grown)
    return CrossValidatorModel(model, metrics), pname, values[best]


def features_of(df: DataFrame, features_col: str) -> int:
    """The length of the feature vectors, from the schema or one row; 0 without rows."""
    about = df.schema[features_col].metadata.get("ml_attr", {})
    if "num_attrs" in about:
        return about["num_attrs"]
    row = df.select(features_col).first()
    return len(row[0]) if row and row[0] is not None else 0


def _cross_validate_ridge(train: DataFrame, label: str, values: list, folds: int, seed: int, features_col: str,
                          fold_col: str | None, persist: bool, features: int):
    """``cross_validate`` of linear regressions: one pass for all folds and grid values, one fit of the best."""
    owned = persist and not train.storageLevel.useMemory and not train.storageLevel.useDisk
    data = training_set(train, label, features_col, fold_col) if owned else train
    # dealt as CrossValidator deals
    fold = F.col(fold_col) if fold_col else F.floor(F.rand(seed) * folds)
    try:
        metrics = ridge.cross_validated_rmse(data, features_col, label, fold, folds, values, features)
        best = min(range(len(values)), key=lambda i: metrics[i])
        model = scaled_pipeline(make_estimator("Linear_Regression", "scaledFeatures", label, seed).setRegParam(values[best]),
                                features_col).fit(data)
    finally:
        if owned:
            data.unpersist()
    return CrossValidatorModel(model, metrics), "regParam", values[best]


# ---------------------------------------------------------------- one tree for a grid of depths
def truncated_tree(model: DecisionTreeRegressionModel, depth: int) -> DecisionTreeRegressionModel:
    """The tree cut at ``depth``: nodes there become leaves that predict their own mean.

    Trees grow level by level and a node's split depends on its rows alone, so
    this is the tree a fit with ``maxDepth=depth`` gives.  Works on the saved
    node table: of the tree, which the driver holds anyway, only the links pass
    through it again.
    """
    spark = SparkSession.active()
    whole, cut = shared_path(spark, "tree"), shared_path(spark, "tree")
    model.write().overwrite().save(whole)
    nodes = spark.read.parquet(f"{whole}/data")
    links = {r["id"]: (r["leftChild"], r["rightChild"]) for r in nodes.select("id", "leftChild", "rightChild").collect()}
    kept, stack = [], [(0, 0)]
    while stack:                                            # preorder, as the ids of a saved tree are
        node, level = stack.pop()
        left, right = links[node] if level < depth else (-1, -1)
        kept.append((node, left, right))
        stack += [(child, level + 1) for child in (right, left) if child >= 0]
    number = {old: new for new, (old, _, _) in enumerate(kept)} | {-1: -1}
    moved = spark.createDataFrame([(old, number[old], number[left], number[right]) for old, left, right in kept],
                                  "id int, _id int, _left int, _right int")
    split = F.struct(F.lit(-1).alias("featureIndex"), F.array().cast("array<double>").alias("leftCategoriesOrThreshold"),
                     F.lit(-1).alias("numCategories"))
    leaf = F.col("_left") < 0
    (nodes.join(F.broadcast(moved), "id")                   # at most 2 ** (depth + 1) rows of the model itself
     .select(F.col("_id").alias("id"), "prediction", "impurity", "impurityStats", "rawCount",
             F.when(leaf, F.lit(-1.0)).otherwise(F.col("gain")).alias("gain"), F.col("_left").alias("leftChild"),
             F.col("_right").alias("rightChild"), F.when(leaf, split).otherwise(F.col("split")).alias("split"))
     .write.parquet(f"{cut}/data"))
    about = json.loads(spark.read.text(f"{whole}/metadata").first()["value"])
    about["paramMap"]["maxDepth"] = depth
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{cut}/metadata")
    return DecisionTreeRegressionModel.load(cut)


def _part_count(df: DataFrame, at_once: int) -> int:
    """Parts of one of ``at_once`` fits that share the cores; more for larger inputs, as ``ensure_parallelism`` has."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-cores // at_once), -(-input_bytes(df) // PART_BYTES))


def cross_validate_depths(train: DataFrame, label: str, depths=None, folds: int = 5, seed: int = 42,
                          features_col: str = "features", fold_col: str | None = None, persist: bool = True,
                          grown: GrownRows | None = None):
    """``cross_validate`` of a decision tree over a grid of depths with one fit a fold.

    The deepest tree of a fold holds all shallower ones (``truncated_tree``); the
    fold's rows are scored by all depths in one pass.  The folds are fitted side by side.  The best tree over all
    rows is fitted once, at the best depth.  Returns what ``cross_validate`` does.
    ``grown``: the same rows and folds, for trees by ``operators/trees``, those of all folds together.
    """
    depths = list(depths if depths is not None else GRIDS["Decision_Tree"][1])
    if grown:
        return _cross_validate_grown(grown, "Decision_Tree", "maxDepth", depths)
    owned = persist and not train.storageLevel.useMemory and not train.storageLevel.useDisk
    data = training_set(train, label, features_col, fold_col) if owned else train
    fold = F.col(fold_col) if fold_col else F.floor(F.rand(seed) * folds).cast("int")
    dealt = data.withColumn("_fold", fold)
    if not fold_col:
        dealt = dealt.persist(StorageLevel.MEMORY_AND_DISK)     # the dealing is drawn once
    # a level's sums are nodes x parts: folds side by side on few parts each instead of one by one on many
    side_by_side = _part_count(data, folds)

    def fold_errors(k):
        tree = make_estimator("Decision_Tree", "scaledFeatures", label, seed).setMaxDepth(max(depths))
        rest = dealt.filter(F.col("_fold") != k)
        scaling, deepest = scaled_pipeline(tree, features_col).fit(rest.coalesce(side_by_side)).stages
        held = scaling.transform(dealt.filter(F.col("_fold") == k))
        for i, depth in enumerate(depths):
            model = deepest if depth == max(depths) else truncated_tree(deepest, depth)
            held = model.setPredictionCol(f"_depth{i}").transform(held)
        y = F.col(label).cast(DoubleType())
        return held.agg(*[F.sqrt(F.avg((y - F.col(f"_depth{i}")) ** 2)).alias(f"e{i}")
                          for i in range(len(depths))]).first()

    try:
        with ThreadPool(folds) as pool:
            errors = pool.map(inheritable_thread_target(data.sparkSession)(fold_errors), range(folds))
        metrics = [sum(e[i] for e in errors) / folds for i in range(len(depths))]
        best = min(range(len(depths)), key=lambda i: metrics[i])
        model = retrain_best(data, "Decision_Tree", label, "maxDepth", depths[best], seed, features_col)
    finally:
        if not fold_col:
            dealt.unpersist()
        if owned:
            data.unpersist()
    return CrossValidatorModel(model, metrics), "maxDepth", depths[best]


# ---------------------------------------------------------------- trees of many rows
def _binner(rows: DataFrame, label: str, seed: int, features_col: str):
    """(fitted scaler, its ``trees.Binner``) of a training set: the split candidates that ``pyspark.ml`` would try."""
    scaling = make_scaler(features_col, "scaledFeatures").fit(rows)
    tree = make_estimator("Decision_Tree", "scaledFeatures", label, seed)
    tree._transfer_params_to_java()
    jvm, java = rows.sparkSession.sparkContext._jvm, tree._java_obj
    module = lambda package, name: getattr(getattr(package, f"{name}$"), "MODULE$")
    instances = module(jvm.org.apache.spark.ml.util, "DatasetUtils").extractInstances(
        java, scaling.transform(rows)._jdf, module(jvm.scala, "None"))
    impl = jvm.org.apache.spark.ml.tree.impl
    about = module(impl, "DecisionTreeMetadata").buildMetadata(
        instances, java.getOldStrategy(module(jvm.scala.collection.immutable, "Map").empty()), 1, "all")
    found = [np.array([split.threshold() for split in splits])
             for splits in module(impl, "RandomForest").findSplits(instances, about, seed)]
    std = scaling.std.toArray()
    scale = np.divide(1.0, std, out=np.zeros_like(std), where=std != 0)
    return scaling, trees.Binner(scaling.mean.toArray(), scale, found)


class GrownRows:
    """The rows of one model selection as ``operators/trees`` reads them: binned once, for all folds and families."""

    def __init__(self, rows: DataFrame, label: str, seed: int, features_col: str, folds: int = 0, fold=None):
        self.label, self.seed, self.features_col, self.folds = label, seed, features_col, folds
        self.rows = rows.withColumn("_fold", fold.cast("int") if folds else F.lit(0))
        self._held = None

    def held(self) -> DataFrame:
        if self._held is None:
            about = self.rows.agg(F.avg(F.col(self.label).cast("double")), F.min("_fold"), F.max("_fold")).first()
            if about[0] is None:
                raise ValueError("no rows to learn from")
            if self.folds and (about[1] is None or about[1] < 0 or about[2] >= self.folds):
                raise ValueError(f"fold numbers must lie between 0 and {self.folds - 1}, not {about[1]} and {about[2]}")
            sets = [self.rows.filter(F.col("_fold") != k) for k in range(self.folds)] + [self.rows]
            with ThreadPool(len(sets)) as pool:
                found = pool.map(inheritable_thread_target(self.rows.sparkSession)(
                    lambda part: _binner(part, self.label, self.seed, self.features_col)), sets)
            self.scaling, self.binners, self.shift = found[-1][0], [b for _, b in found], about[0]
            self.width = len(self.binners[0].candidates)
            self.bins = 1 + max(len(c) for b in self.binners for c in b.candidates)
            self._held = trees.persisted(trees.blocks(self.rows, self.features_col, self.label, F.col("_fold"), self.binners,
                                                      self.shift))
        return self._held

    def release(self) -> None:
        if self._held is not None:
            self._held.unpersist()

    def _trees(self, est, family: str, first: int, binner: int, fold: int) -> list[trees.Tree]:
        depth, many = est.getOrDefault("maxDepth"), est.getNumTrees() if family == "Random_Forest" else 1
        share = math.ceil(self.width / 3.0) if many > 1 else self.width
        return [trees.Tree(first + i, binner, fold, depth, share, family == "Random_Forest", self.seed) for i in range(many)]

    def cross_validate(self, family: str, values: list) -> list[float]:
        """Mean over the folds of each grid value's RMSE; the trees of all folds and values grow together."""
        held, sets, folds = self.held(), len(self.binners), range(self.folds)
        est = make_estimator(family, "scaledFeatures", self.label, self.seed)
        if family == "Decision_Tree":
            grown = [t for k in folds for t in self._trees(est.setMaxDepth(max(values)), family, k, k, k)]
            trees.grow_deep(held, grown, sets, self.width, self.bins)
            errors = trees.depth_errors(held, grown, values, sets)
            by_fold = [errors[k] for k in folds]
        else:
            forests, first = {}, 0
            for k in folds:
                for i, many in enumerate(values):
                    forests[k * len(values) + i] = self._trees(est.setNumTrees(many), family, first, k, k)
                    first += many
            trees.grow_levels(held, [t for f in forests.values() for t in f], sets, self.width, self.bins)
            errors = trees.forest_errors(held, forests, sets)
            by_fold = [[errors[k * len(values) + i] for i in range(len(values))] for k in folds]
        return [float(np.mean(e)) for e in zip(*by_fold, strict=True)]

    def fit(self, family: str, est) -> PipelineModel:
        """The tree or forest of all rows as a pipeline of ``pyspark.ml``."""
        held, sets = self.held(), len(self.binners)
        grown = self._trees(est, family, 0, sets - 1, -1)
        if family == "Decision_Tree":
            sums = trees.grow_deep(held, grown, sets, self.width, self.bins)
        else:
            trees.grow_levels(held, grown, sets, self.width, self.bins)
            sums = trees.node_sums(held, grown, sets)
        tables = [trees.node_table(t, sums[t.number], self.binners[-1], self.shift) for t in grown]
        return PipelineModel([self.scaling, _saved_and_loaded(self.rows.sparkSession, est, self.label, self.width, tables)])


def _saved_and_loaded(spark: SparkSession, est, label: str, width: int, tables: list):
    """A model of ``est`` with these nodes: everything but them is taken from a fit to two rows."""
    whole, made = shared_path(spark, "tree"), shared_path(spark, "tree")
    two = spark.createDataFrame([(Vectors.dense([float(i)] * width), float(i)) for i in range(2)], ["scaledFeatures", label])
    est.fit(two).write().overwrite().save(whole)
    spark.read.text(f"{whole}/metadata").coalesce(1).write.text(f"{made}/metadata")
    if isinstance(est, DecisionTreeRegressor):
        spark.createDataFrame(tables[0]).write.parquet(f"{made}/data")
        return DecisionTreeRegressionModel.load(made)
    spark.read.parquet(f"{whole}/treesMetadata").write.parquet(f"{made}/treesMetadata")
    nodes = pa.concat_tables([
        pa.table({"treeID": pa.array([i] * len(t), pa.int32()), "nodeData": t.to_struct_array().combine_chunks()})
        for i, t in enumerate(tables)])
    spark.createDataFrame(nodes).write.parquet(f"{made}/data")
    return RandomForestRegressionModel.load(made)


def retrain_best(train: DataFrame, family: str, label: str, param: str, value,
                 seed: int = 42, features_col: str = "features", grown: GrownRows | None = None) -> PipelineModel:
    """Refit the family on all training rows with the winning grid entry (``grown``: these rows, for trees by ``operators/trees``)."""
    est = make_estimator(family, "scaledFeatures", label, seed)
    est = est.copy({est.getParam(param): value})
    if grown and family != "Linear_Regression":
        return grown.fit(family, est)
    owned = not train.storageLevel.useMemory and not train.storageLevel.useDisk
    if not owned:
        data = train
    elif family == "Linear_Regression":
        # three light passes: dealing the rows over more parts costs more than it saves
        data = train.select(features_col, label).persist(StorageLevel.MEMORY_AND_DISK)
    else:
        data = training_set(train, label, features_col)
    try:
        return scaled_pipeline(est, features_col).fit(data)
    finally:
        if owned:
            data.unpersist()


def train_select(train_df: DataFrame, label: str, families=FAMILIES, grids: dict | None = None,
                 folds: int = 5, seed: int = 42, parallelism: int | None = None, holdout: float = 0.2,
                 save_dir: str | None = None, features_col: str = "features", holdout_col: str | None = None,
                 fold_col: str | None = None):
    """For each family: CV on 80 %, metrics on the 20 % hold-out, retrain with the
    best grid entry on all rows (saved as ``retrained_<family>``).

    ``holdout_col`` (a BOOLEAN column, TRUE for hold-out rows) and ``fold_col``
    make both splits independent of the layout; without them rows are dealt at
    random by ``seed``.  Returns ``(metrics DataFrame, {family: PipelineModel})``.  The training rows
    are persisted while the fits run and released afterwards.  Trees of over ``MOST_ROWS`` rows grow by ``operators/trees``.
    """
    spark = train_df.sparkSession
    data = training_set(train_df, label, features_col, fold_col, holdout_col)
    if holdout_col:
        fit_part, test_part = data.filter(~F.col(holdout_col)), data.filter(F.col(holdout_col))
    else:
        fit_part, test_part = data.randomSplit([1.0 - holdout, holdout], seed=seed)
    rows, models, grown = [], {}, (None, None)
    try:
        if data.count() > MOST_ROWS:
            if not holdout_col:
                fit_part = fit_part.persist(StorageLevel.MEMORY_AND_DISK)     # a random split sorts its rows in every pass
            fold = F.col(fold_col) if fold_col else F.floor(F.rand(seed) * folds)
            grown = GrownRows(fit_part, label, seed, features_col, folds, fold), GrownRows(data, label, seed, features_col)
        for fam in families:
            values = (grids or {}).get(fam)
            if fam == "Decision_Tree":
                cv_model, pname, best = cross_validate_depths(fit_part, label, values, folds, seed, features_col, fold_col,
                                                              persist=False, grown=grown[0])
            else:
                cv_model, pname, best = cross_validate(fit_part, fam, label, values, folds, seed, parallelism,
                                                       features_col, fold_col, persist=False, grown=grown[0])
            m = regression_metrics(cv_model.transform(test_part), label).first()
            rows.append((fam, float(m["rmse"]), float(m["mae"]), float(m["r2"]), pname, float(best)))
            final = retrain_best(data, fam, label, pname, best, seed, features_col, grown=grown[1])
            if save_dir:
                final.write().overwrite().save(f"{save_dir}/retrained_{fam}")
            models[fam] = final
    finally:
        for part in grown:
            if part:
                part.release()
        fit_part.unpersist()
        data.unpersist()
    metrics = spark.createDataFrame(
        rows, "model string, rmse double, mae double, r2 double, best_param string, best_value double")
    return metrics, models


def score(df: DataFrame, model: PipelineModel | str, label: str | None, output_path: str | None = None,
          output_columns=None, exclude=("features", "scaledFeatures")):
    """Predict with a saved (or given) pipeline; optionally write the projected
    predictions as CSV.  Returns (predictions, metrics or None)."""
    if isinstance(model, str):
        model = PipelineModel.load(model)
    pred = model.transform(df)
    metrics = regression_metrics(pred, label) if label and label in pred.columns else None
    if output_path:
        if output_columns is None:
            shown = output_projection(pred, exclude=exclude, no_underscore=True)
        else:
            shown = output_projection(pred, dict.fromkeys([*output_columns, "prediction"]))
        shown.write.mode("overwrite").option("header", True).csv(output_path)
    return pred, metrics


def score_all_models(spark: SparkSession, models_dir: str, df: DataFrame, label: str,
                     output_dir: str | None = None) -> DataFrame:
    """Score every saved model under ``models_dir``: ``(model, rmse, mae, r2)``.

    Model transforms are row-wise, so all models are chained over the same
    rows (each prediction renamed) and the metrics of every model come from
    ONE aggregate: one scan of ``df`` however many models there are.
    Prediction CSVs, when asked for, are one write per model.
    """
    names = [n for n in list_dirs(spark, models_dir) if _is_pipeline_model(spark, f"{models_dir}/{n}")]
    if not names:
        return spark.createDataFrame([], "model string, rmse double, mae double, r2 double")
    base_cols = list(df.columns)
    scored = df
    for i, name in enumerate(names):
        scored = PipelineModel.load(f"{models_dir}/{name}").transform(scored)
        scored = scored.withColumnRenamed("prediction", f"_pred{i}")
        # drop the stage outputs (scaledFeatures ...) so the next model adds its own
        scored = scored.select(*base_cols, *[f"_pred{j}" for j in range(i + 1)])
    y = F.col(label).cast(DoubleType())
    aggs = [(F.var_pop(y) * F.count(y)).alias("_sst")]
    for i in range(len(names)):
        e = y - F.col(f"_pred{i}").cast(DoubleType())
        aggs += [F.sqrt(F.avg(e * e)).alias(f"rmse{i}"), F.avg(F.abs(e)).alias(f"mae{i}"),
                 F.sum(e * e).alias(f"sse{i}")]
    row = scored.agg(*aggs)
    metrics = row.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("model"), F.col(f"rmse{i}").alias("rmse"), F.col(f"mae{i}").alias("mae"),
                 (F.lit(1.0) - F.col(f"sse{i}") / F.col("_sst")).alias("r2"))
        for i, name in enumerate(names)])))
    if output_dir:
        out_cols = output_projection(df, exclude=("features", "scaledFeatures"), no_underscore=True).columns
        for i, name in enumerate(names):
            (scored.select(*out_cols, F.col(f"_pred{i}").alias("prediction"))
             .write.mode("overwrite").option("header", True).csv(f"{output_dir}/{name}_pred.csv"))
    return metrics


def _is_pipeline_model(spark: SparkSession, path: str) -> bool:
    from featureflow.plans.features import path_exists
    return path_exists(spark, f"{path}/metadata") and path_exists(spark, f"{path}/stages")

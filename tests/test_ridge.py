"""One-pass ridge cross-validation, and training sets whose parts do not grow with the table."""
import random

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from featureflow.operators import ridge, sampling
from featureflow.plans import model as mdl


def _rows(spark, n=600):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        a, b = rng.gauss(1e6, 3), rng.random()
        # a large offset, a constant column, two equal columns
        rows.append((Vectors.dense([a, b, 7.0, b, rng.gauss(0, 1)]), 5e4 + 3 * (a - 1e6) - 8 * b + rng.gauss(0, 2), i % 4))
    return spark.createDataFrame(rows, ["features", "y", "fold"]).withColumn("fold", F.col("fold").cast("int"))


@pytest.mark.parametrize("fold_col", ["fold", None])
def test_one_pass_equals_the_plain_grid_search(spark, fold_col):
    data, values = _rows(spark).repartition(3).cache(), [0.1, 3.0, 40.0]
    est = mdl.make_estimator("Linear_Regression", "scaledFeatures", "y")
    plain = CrossValidator(estimator=mdl.scaled_pipeline(est), numFolds=4, seed=42, foldCol=fold_col or "",
                           estimatorParamMaps=ParamGridBuilder().addGrid(est.regParam, values).build(),
                           evaluator=RegressionEvaluator(labelCol="y", metricName="rmse")).fit(data)
    found, name, best = mdl.cross_validate(data, "Linear_Regression", "y", values, folds=4, fold_col=fold_col)
    assert found.avgMetrics == pytest.approx(plain.avgMetrics, rel=1e-7) and name == "regParam"
    assert best == values[min(range(3), key=lambda i: plain.avgMetrics[i])]
    mine, theirs = found.bestModel.stages[-1], plain.bestModel.stages[-1]
    assert list(mine.coefficients) == pytest.approx(list(theirs.coefficients), rel=1e-6)
    assert mine.getRegParam() == best


def test_one_pass_reads_the_rows_once(spark, monkeypatch):
    """The search itself is one job over the rows; only the best entry is fitted."""
    fits, fit = [], mdl.ScaledPipeline.fit
    monkeypatch.setattr(mdl.ScaledPipeline, "fit", lambda self, *a, **k: fits.append(1) or fit(self, *a, **k))
    monkeypatch.setattr(mdl.ScaledPipeline, "fitMultiple", lambda *a, **k: pytest.fail("one fit a grid value"))
    mdl.cross_validate(_rows(spark), "Linear_Regression", "y", folds=4, fold_col="fold")
    assert len(fits) == 1


def test_rows_that_cannot_be_learned_from_are_refused(spark):
    data = _rows(spark, 40)
    for bad in (data.withColumn("fold", F.lit(9)), data.withColumn("y", F.when(F.col("fold") > 0, F.col("y"))),
                data.withColumn("fold", F.lit(0)), data.withColumn("y", F.lit(float("nan")))):
        with pytest.raises(Exception):
            ridge.cross_validated_rmse(bad, "features", "y", F.col("fold"), 4, [0.1], 5)


def test_parts_of_a_training_set_do_not_grow_with_the_files(spark, tmp_path):
    at = str(tmp_path / "t")
    spark.range(20_000).withColumn("x", F.sha2(F.col("id").cast("string"), 256)).coalesce(1).write.parquet(at)
    df = spark.read.parquet(at)
    size = sampling.input_bytes(df)
    assert size == sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet")) > 1_000_000
    assert sampling.ensure_parallelism(df, 2).rdd.getNumPartitions() == 2
    assert sampling.ensure_parallelism(df, 2, part_bytes=100_000).rdd.getNumPartitions() == -(-size // 100_000)
    assert sampling.input_bytes(spark.range(3)) == 0

"""Learning and applying features: no interpreted lambdas, map searches or dealing of rows where none is needed."""

import math
import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from featureflow import registry
from featureflow.functions import columns
from featureflow.operators import quantiles
from featureflow.plans import model as mdl


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("kind", ["double", "long", "decimal(12,2)"])
def test_binning_passes_are_compiled_and_exact(spark, monkeypatch, kind):
    rng = random.Random(5)
    rows = [(rng.choice([None, rng.uniform(-1e6, 1e6), 0.0, -0.0, 7.0]), float(rng.randrange(9)), rng.expovariate(1e-3))
            for _ in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double").select(*[F.col(x).cast(kind).alias(x) for x in "abc"])
    held = df.collect()
    plans = []
    collect = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: plans.append(plan(self)) or collect(self))
    probs = (0.0, 0.1, 0.5, 0.77, 1.0)
    got = quantiles.exact_quantiles(df, ["a", "b", "c"], probs, bins=16)
    for i, c in enumerate("abc"):
        values = sorted(r[i] for r in held if r[i] is not None)
        for p in probs:
            assert got[(c, p)] == values[max(1, math.ceil(p * len(values) - 1e-9)) - 1], (c, p)
    assert len(plans) > 2
    assert not [p for p in plans if "lambda" in p or "Generate" in p]


def test_quantiles_of_nan_and_infinities(spark):
    df = spark.createDataFrame([(math.nan,), (math.inf,), (-math.inf,), (2.0,), (3.0,), (None,)], "x double")
    got = quantiles.exact_quantiles(df, ["x"], (0.0, 0.5, 0.75, 1.0))
    assert [got[("x", p)] for p in (0.0, 0.5, 0.75, 1.0)] == [-math.inf, 2.0, 3.0, math.inf]


def test_small_lookups_are_compiled(spark):
    df = spark.createDataFrame([("a",), ("b",), ("zz",), (None,)], "k string")
    small = df.select(columns.lookup("k", {"a": 1.0, "b": None}, default=9.0).alias("x"))
    assert [r[0] for r in small.collect()] == [1.0, 9.0, 9.0, 9.0]
    named = df.select(F.concat("k", F.lit("")).alias("k")).select(columns.lookup("k", {"a": 1.0, "b": 2.0}).alias("x"))
    assert "element_at" not in plan(spark.range(3).select(F.rand().cast("string").alias("k")).select(
        columns.lookup("k", {"a": 1.0, "b": 2.0})))
    assert [r[0] for r in named.collect()] == [1.0, 2.0, None, None]
    many = {str(i): float(i) for i in range(columns.MOST_CASES + 1)}
    wide = spark.range(70).select(columns.lookup(F.col("id").cast("string"), many, default=-1.0).alias("x"))
    assert [r[0] for r in wide.collect()] == [float(i) if i < len(many) else -1.0 for i in range(70)]


def test_rounding_does_not_draw_the_encoding_into_its_lambda(spark):
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.range(4).select((F.col("id") / 3).alias("a"), (F.col("id") / 7).alias("b")))
    out = data.select("a", "b", registry._rounded_features(data))
    lambdas = [line for line in plan(out).splitlines() if "lambda" in line]
    assert lambdas and not [line for line in lambdas if "UDF(struct" in line]
    for r in out.collect():
        assert r["features"] == pytest.approx([r["a"], r["b"]], abs=5e-7)
    assert dict(out.dtypes)["features"] == dict(data.select(vector_to_array("features").alias("features")).dtypes)["features"]


def test_a_linear_fit_does_not_deal_its_rows(spark, monkeypatch):
    rows = [(float(i % 7), float(i % 5), 2.0 * (i % 7) - (i % 5) + 1.0) for i in range(200)]
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.createDataFrame(rows, "a double, b double, y double"))
    dealt = []
    deal = mdl.ensure_parallelism
    monkeypatch.setattr(mdl, "ensure_parallelism", lambda df: dealt.append(1) or deal(df))
    model = mdl.retrain_best(data, "Linear_Regression", "y", "regParam", 0.0)
    assert not dealt
    assert mdl.regression_metrics(model.transform(data), "y").first()["rmse"] < 1e-6
    mdl.retrain_best(data, "Decision_Tree", "y", "maxDepth", 2)
    assert dealt

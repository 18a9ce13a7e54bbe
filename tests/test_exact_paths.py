"""Exact quantiles of every type, estimator settings, text keys, bounded labels and broadcasts."""
import math
import random
from decimal import Decimal

import pytest

from featureflow import presets
from featureflow.operators import encode, joins, quantiles, stats
from featureflow.plans import features as feat

PROBS = (0.01, 0.25, 0.5, 0.75, 0.99)


def _ranked(values, p):
    v = sorted(values)
    return v[max(1, math.ceil(p * len(v) - 1e-9)) - 1]


def _passes(monkeypatch):
    seen = []
    count = quantiles._count_bins
    monkeypatch.setattr(quantiles, "_count_bins", lambda *a: seen.append(1) or count(*a))
    return seen


@pytest.mark.parametrize("name, values", [
    ("above 2**53", [9007199254740993, 9007199254740993, 9007199254740995]),
    ("all 64 bits", [-2 ** 63, -2 ** 63 + 1, -1, 0, 1, 2 ** 62, 2 ** 63 - 2, 2 ** 63 - 1]),
    ("random 64 bits", [random.Random(3).randrange(-2 ** 63, 2 ** 63) for _ in range(300)]),
])
def test_integers_are_exact_in_few_passes(spark, monkeypatch, name, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x long")
    passes = _passes(monkeypatch)
    got = stats.exact_quantiles(df, ["x"], PROBS)
    assert got == {("x", p): _ranked(values, p) for p in PROBS}
    assert len(passes) < 9


@pytest.mark.parametrize("values", [
    [float("inf"), 1.0, 2.0, 3.0],
    [float("-inf"), float("-inf"), -0.0, 0.0, float("inf")],
    [-1.7e308, 1.7e308, 5e-324, -5e-324, 0.0, 1.0],
    [2.0 ** e * (1 if e % 3 else -1) for e in range(-1000, 1001, 7)],
    [1.0 + k * 2.0 ** -52 for k in range(40)],
    [random.Random(4).uniform(-1e6, 1e6) for _ in range(300)],
])
def test_doubles_are_exact_in_few_passes(spark, monkeypatch, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    passes = _passes(monkeypatch)
    got = stats.exact_quantiles(df, ["x"], PROBS)
    assert got == {("x", p): _ranked(values, p) for p in PROBS}
    assert len(passes) < 9


def test_decimals_keep_their_digits_and_types_mix(spark):
    rng = random.Random(6)
    wide = [Decimal(f"{rng.choice('-+')}{rng.randrange(10 ** 32)}.{rng.randrange(10 ** 4):04d}") for _ in range(60)]
    rows = [(w, i % 7, float(i)) for i, w in enumerate(wide)]
    df = spark.createDataFrame(rows, "d decimal(36,4), i int, x double")
    got = stats.exact_quantiles(df, ["d", "i", "x"], PROBS)
    for c, values in zip("dix", zip(*rows)):
        assert all(got[(c, p)] == _ranked(values, p) for p in PROBS)
    assert stats.exact_quantiles(df.limit(0), ["d", "i"]) == {("d", 0.5): None, ("i", 0.5): None}


def test_estimator_settings_survive_a_reload_and_can_be_overridden(spark, sf, tmp_path):
    est = feat.FeatureEstimator(presets.TPCH, 0.2, 3, "ignore", 0.5)
    est.write().overwrite().save(str(tmp_path / "est"))
    back = feat.FeatureEstimator.load(str(tmp_path / "est"))
    names = ("frequencyThreshold", "cardinalityThreshold", "highCardinalityStrategy", "relativeError")
    assert [back.getOrDefault(n) for n in names] == [0.2, 3, "ignore", 0.5]
    df = feat.static_features(spark.read.parquet(f"{sf}/lineitem.parquet"), spark.read.parquet(f"{sf}/part.parquet"),
                              presets.TPCH)
    few = back.fit(df).params_dict["frequent"]
    many = back.fit(df, {back.frequencyThreshold: 0.001}).params_dict["frequent"]
    assert sum(map(len, many.values())) > sum(map(len, few.values()))
    with pytest.raises(ValueError, match="frequency_threshold"):
        back.fit(df, {back.frequencyThreshold: 0.0})


def test_a_numeric_column_without_values_is_refused_at_fit(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("* except (l_tax)", "cast(NULL as double) AS l_tax")
    df = feat.static_features(li, spark.read.parquet(f"{sf}/part.parquet"), presets.TPCH)
    with pytest.raises(ValueError, match="l_tax"):
        feat.FeatureEstimator(presets.TPCH).fit(df)


def test_mean_target_of_a_numeric_key(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (7, 6.0), (None, 8.0)], "k long, y double")
    table = encode.mean_target_table(df, "k", "y", "m")
    assert {r.k: r.m for r in table.collect()} == {"1": 3.0, "7": 6.0, None: 8.0, "Other": 5.0}
    new = spark.createDataFrame([(1,), (9,), (None,)], "k long")
    out = encode.mean_encode(new, table, "k", "m", default=5.0)
    assert out.schema["k"].dataType.typeName() == "long"
    assert {r.k: r.m for r in out.collect()} == {1: 3.0, 9: 5.0, None: 5.0}


def test_the_label_may_be_a_feature(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "c string, y double")
    got = {(r.feature, r.value): (r.n, r.label_n, r.label_sum) for r in stats.value_stats(df, ["c", "y"], "y").collect()}
    assert got == {("c", "a"): (2, 2, 4.0), ("c", "b"): (1, 0, None), ("y", "1.0"): (1, 1, 1.0),
                   ("y", "3.0"): (1, 1, 3.0), ("y", None): (1, 0, None)}


def test_labels_and_broadcasts_are_bounded(spark):
    df = spark.range(50).selectExpr("cast(id AS string) AS k", "repeat('x', 1000) AS t", "array(id, id) AS a")
    with pytest.raises(ValueError, match="50 distinct"):
        encode.learn_index_labels(df, ["k"], max_labels=49)
    assert len(encode.learn_index_labels(df, ["k"], max_labels=50)["k"]) == 50
    assert joins.is_small(df) and not joins.is_small(df, max_rows=49) and not joins.is_small(df, max_bytes=50_000)
    assert joins.is_small(spark.range(0))
    with pytest.raises(ValueError, match="right"):
        joins.salted_join(df, df.select("k"), "k", how="right")

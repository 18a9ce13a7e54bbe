"""Trees and forests of many rows: the trees of pyspark.ml, sums and draws against plain loops, the whole selection."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from featureflow.operators import trees
from featureflow.plans import model as mdl


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    n = 3000
    a, b, c, e = rng.normal(size=n), rng.integers(0, 7, n), rng.exponential(size=n), rng.normal(size=n)
    y = np.round(50 * np.sin(3 * a) + 20 * (b == 3) * c + 10 * rng.normal(size=n) + 5 * np.abs(e))
    values = [tuple(map(float, r)) for r in zip(a, b, c, np.ones(n), e, y, strict=True)]
    df = VectorAssembler(inputCols=list("abcde"), outputCol="features").transform(
        spark.createDataFrame(values, "a double, b double, c double, d double, e double, y double").repartition(3))
    df = df.select("features", "y").persist()
    yield df
    df.unpersist()


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(trees, "LOCAL_ROWS", 300)
    monkeypatch.setattr(trees, "BLOCK_ROWS", 400)


@pytest.mark.parametrize("depth", [2, 8])
def test_a_grown_tree_is_that_of_pyspark(spark, rows, small, depth):
    known = mdl.retrain_best(rows, "Decision_Tree", "y", "maxDepth", depth)
    grown = mdl.retrain_best(rows, "Decision_Tree", "y", "maxDepth", depth, grown=mdl.GrownRows(rows, "y", 42, "features"))
    a, b = known.stages[-1], grown.stages[-1]
    assert a.numNodes == b.numNodes and a.depth == b.depth == depth == b.getMaxDepth()
    assert b.featureImportances.toArray() == pytest.approx(a.featureImportances.toArray(), abs=1e-9)
    both = grown.transform(known.transform(rows).select("features", F.col("prediction").alias("known")))
    assert both.filter(F.abs(F.col("known") - F.col("prediction")) > 1e-6).count() == 0


def test_the_depth_grid_has_the_errors_of_pyspark(rows, small):
    depths = [2, 4, 7]
    known, _, best = mdl.cross_validate_depths(rows, "y", depths, folds=3)
    held = mdl.GrownRows(rows, "y", 42, "features", 3, F.floor(F.rand(42) * 3))
    grown, _, found = mdl.cross_validate_depths(rows, "y", depths, folds=3, grown=held)
    held.release()
    assert found == best and grown.avgMetrics == pytest.approx(known.avgMetrics, rel=1e-9)


def test_equal_labels_and_repeated_rows_end_a_tree():
    x = np.array([[0, 0, 1, 1, 1], [3, 3, 2, 2, 2]], np.uint8)
    links, stats = trees.grow_local(x, np.array([1.5, 1.5, 4.1, 4.1, 5.0]), 20)
    assert links[2].tolist() == [1, -1, -1] and links[0][0] == 0            # the first of two equal splits; equal rows stay together
    assert stats[:, 0].tolist() == [5, 2, 3] and stats[:, 1] == pytest.approx([16.2, 3.0, 13.2])
    assert trees.grow_local(x, np.full(5, 0.1), 20)[0][2].tolist() == [-1]
    # without a feature that tells rows apart, whatever the labels
    assert trees.grow_local(np.zeros((2, 4), np.uint8), np.arange(4.0), 20)[0][2].tolist() == [-1]


def test_sums_of_drawn_rows_against_a_loop():
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 9, (5, 700), dtype=np.uint8), rng.normal(size=700)
    tree = trees.Tree(3, 0, -1, 5, 3, True, 42)
    left = tree.split(0, 2, 4, 0.0, 0.0)
    deeper = tree.split(left, 1, 6, 0.0, 0.0)
    tree.open = [left + 1, deeper]                                          # the other child is a leaf
    tree.choose(5)
    shape, w = tree.shape(), trees._drawn(tree.shape(), 1, 700)
    assert (w == trees._drawn(shape, 1, 700)).all() and (w != trees._drawn(shape, 2, 700)).any()
    sums, expected = np.zeros((2, 3, 9, 2)), np.zeros((2, 3, 9, 2))
    trees._add_drawn(shape, x, y, w, sums, 9)
    for i in range(700):
        node = left + 1 if x[2, i] > 4 else deeper if x[1, i] <= 6 else None
        if node is not None:
            for j, f in enumerate(tree.subsets[node]):
                expected[tree.open.index(node), j, x[f, i]] += [w[i], w[i] * y[i]]
    assert np.allclose(sums, expected)
    many = np.concatenate([trees._drawn(shape, k, 50_000) for k in range(8)])
    share = np.bincount(many, minlength=6)[:6] / len(many)
    assert share == pytest.approx([np.exp(-1) / f for f in (1, 1, 2, 6, 24, 120)], abs=3e-3)


def test_a_grown_forest_predicts_as_well_as_that_of_pyspark(rows, small):
    held = mdl.GrownRows(rows, "y", 42, "features")
    known = mdl.retrain_best(rows, "Random_Forest", "y", "numTrees", 30)
    grown = mdl.retrain_best(rows, "Random_Forest", "y", "numTrees", 30, grown=held)
    held.release()
    model = grown.stages[-1]
    assert model.getNumTrees == 30 and {t.depth for t in model.trees} == {5}
    errors = [mdl.regression_metrics(m.transform(rows), "y").first()["rmse"] for m in (known, grown)]
    assert errors[1] == pytest.approx(errors[0], rel=0.15)
    assert len({t.toDebugString for t in model.trees}) == 30


def test_a_selection_of_many_rows_grows_all_its_trees(spark, rows, small, monkeypatch):
    monkeypatch.setattr(mdl, "MOST_ROWS", 100)
    monkeypatch.setattr(mdl, "CrossValidator", None)                        # no forest is fitted once a fold and grid value
    asked = []
    level = trees.grow_levels
    monkeypatch.setattr(trees, "grow_levels", lambda held, ts, *a: asked.append(
        [(t.drawn, t.fold, t.depth) for t in ts]) or level(held, ts, *a))
    metrics, models = mdl.train_select(rows, "y", grids={"Random_Forest": [2, 6], "Decision_Tree": [2, 6]}, folds=3)
    found = {r.model: r for r in metrics.collect()}
    assert set(found) == set(models) == set(mdl.FAMILIES) and all(0 < r.mae <= r.rmse for r in found.values())
    assert found["Decision_Tree"].best_value == 6 and found["Decision_Tree"].r2 > 0.5
    # one tree a fold, the best of the folds' rows, the best of all rows; every forest of every fold, and again two
    assert asked[0] == [(False, k, 6) for k in range(3)] and asked[1] == asked[2] == [(False, -1, 6)]
    assert len(asked[3]) == 3 * (2 + 6) and {x[1] for x in asked[3]} == {0, 1, 2} and all(x[0] and x[2] == 5 for x in asked[3])
    assert len(asked[4]) == len(asked[5]) == found["Random_Forest"].best_value and len(asked) == 6


def test_grown_models_are_saved_and_score_other_rows(spark, rows, small, monkeypatch, tmp_path):
    monkeypatch.setattr(mdl, "MOST_ROWS", 100)
    asked = []
    monkeypatch.setattr(mdl, "GrownRows", lambda *a, made=mdl.GrownRows, **b: asked.append(1) or made(*a, **b))
    _, models = mdl.train_select(rows, "y", families=("Decision_Tree", "Random_Forest"), folds=2, save_dir=str(tmp_path),
                                 grids={"Random_Forest": [4], "Decision_Tree": [5]})
    assert len(asked) == 2                                                  # the folds' rows and all rows, binned once for both families
    for family, model in models.items():
        kept, _ = mdl.score(rows, f"{tmp_path}/retrained_{family}", "y")
        both = model.transform(kept.select("features", F.col("prediction").alias("kept")))
        assert both.count() == 3000 and both.filter(F.abs(F.col("kept") - F.col("prediction")) > 1e-9).count() == 0

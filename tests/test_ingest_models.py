"""Manifest ingest, quarantine, Gramian correlations, truncated trees and the single scan of the feature table."""
import os
import random
import shutil

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from featureflow import presets
from featureflow.operators import gram, stats
from featureflow.plans import features as feat
from featureflow.plans import model as mdl
from featureflow.sources import ingest


# ---------------------------------------------------------------- manifest
def test_only_new_and_changed_files_are_read(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "table")
    os.makedirs(f"{raw}/2007/may")
    os.makedirs(f"{raw}/2008")

    def put(name, *lines):
        with open(f"{raw}/{name}", "w") as f:
            f.write("k,v\n" + "".join(f"{x}\n" for x in lines))

    def rows(**options):
        return sorted(map(tuple, ingest.ingest_files(spark, raw, root, types={"k": "int"}, **options).collect()))

    def batches():
        return {(r["batch"], os.path.basename(r["file"]), r["rows"], r["removed"])
                for r in ingest.read_manifest(spark, root).collect()}

    with pytest.raises(ValueError):
        rows()
    put("2007/may/a b.csv", "1,x", "2,y")
    put("2008/b.csv", "3,z")
    assert rows() == [(1, "x"), (2, "y"), (3, "z")]
    first = {(1, "a%20b.csv", 2, False), (1, "b.csv", 1, False)}
    assert batches() == first and rows() == [(1, "x"), (2, "y"), (3, "z")] and batches() == first
    put("2008/b.csv", "30,zz", "31,q")
    put("2008/c.csv")
    untouched = {p: os.stat(os.path.join(d, p)).st_mtime_ns for d, _, files in os.walk(f"{root}/data")
                 for p in files if p.endswith(".parquet")}
    assert rows() == [(1, "x"), (2, "y"), (30, "zz"), (31, "q")]
    assert batches() - first == {(2, "b.csv", 2, False), (2, "c.csv", 0, False)}       # the two files that were read
    kept = {p: os.stat(os.path.join(d, p)).st_mtime_ns for d, _, files in os.walk(f"{root}/data") for p in files}
    assert sum(kept.get(p) == t for p, t in untouched.items()) >= 1                     # a b.csv was not written again
    put("2007/may/a b.csv")                                                            # changed to no rows
    assert rows() == [(30, "zz"), (31, "q")]
    os.remove(f"{raw}/2008/b.csv")
    assert rows() == [(30, "zz"), (31, "q")]                                           # gone files keep their rows
    assert rows(prune=True) == [] and (4, "b.csv", 0, True) in batches()
    put("2008/b.csv", "5,back")
    assert rows() == [(5, "back")]


def test_a_run_that_died_before_its_manifest_is_repeated(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "table")
    os.makedirs(raw)
    for name in "ab":
        with open(f"{raw}/{name}.csv", "w") as f:
            f.write(f"k\n{name}1\n{name}2\n")
    want = sorted(r["k"] for r in ingest.ingest_files(spark, raw, root, types={}).collect())
    shutil.rmtree(f"{root}/manifest")
    assert sorted(r["k"] for r in ingest.ingest_files(spark, raw, root, types={}).collect()) == want == ["a1", "a2", "b1", "b2"]


def test_ingest_keeps_malformed_records_apart_on_request(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "table")
    os.makedirs(raw)

    def put(name, *lines):
        with open(f"{raw}/{name}", "w") as f:
            f.write("k,v\n" + "".join(f"{x}\n" for x in lines))

    put("a.csv", "1,x", "two,y", "3,z,more")
    plain = ingest.ingest_files(spark, raw, str(tmp_path / "plain"), types={"k": "int"})
    assert sorted(map(tuple, plain.collect()), key=str) == [(1, "x"), (3, "z"), (None, "y")]
    with pytest.raises(ingest.TooManyRejects):
        ingest.ingest_files(spark, raw, root, types={"k": "int"}, quarantine=True, most_rejects=0.5)
    assert ingest.read_manifest(spark, root).count() == 0                              # not ingested: the next run reads it again
    rows = ingest.ingest_files(spark, raw, root, types={"k": "int"}, quarantine=True)
    assert [tuple(r) for r in rows.collect()] == [(1, "x")]
    assert {(r["record"], r["reason"]) for r in ingest.rejected_records(spark, root).collect()} == {
        ("two,y", "k is no int"), ("3,z,more", "too many fields")}
    entry = ingest.read_manifest(spark, root).first()
    assert (entry["rows"], entry["rejects"]) == (1, 2)
    put("a.csv", "1,x", "2,y")                                                         # mended: its rejects go
    assert sorted(map(tuple, ingest.ingest_files(spark, raw, root, quarantine=True).collect())) == [(1, "x"), (2, "y")]
    assert ingest.rejected_records(spark, root).count() == 0


# ---------------------------------------------------------------- quarantine
def test_rejects_are_kept_with_a_reason(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    lines = ['1,2.5,x', '2,n/a,y', '3,1.0', '4,1.0,"a,b"', '5,,', '6,1,2,3', 'z,1.0,q', ',,t']
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    schema = StructType.fromDDL("k int, p double, t string")
    rows, rejects = ingest.quarantine_csv(spark, path, str(tmp_path / "out"), schema, header=False, most_rejects=0.5)
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(
        [(1, 2.5, "x"), (4, 1.0, "a,b"), (5, None, None), (None, None, "t")], key=str)
    got = {r["record"]: r["reason"] for r in rejects.collect()}
    assert got == {'2,n/a,y': "p is no double", '3,1.0': "too few fields", '6,1,2,3': "too many fields", 'z,1.0,q': "k is no int"}
    assert all(r["file"].endswith("in.csv") for r in rejects.collect())
    with pytest.raises(ingest.TooManyRejects):
        ingest.quarantine_csv(spark, path, str(tmp_path / "out2"), schema, header=False, most_rejects=0.1)
    assert spark.read.parquet(str(tmp_path / "out2")).count() == len(lines)             # written before the error
    with pytest.raises(ValueError):
        ingest.quarantine_csv(spark, path, str(tmp_path / "out3"), StructType.fromDDL("_record string"))


# ---------------------------------------------------------------- correlations
def test_gramian_equals_numpy_for_300_columns(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 300)) @ rng.normal(size=(300, 300)) * 3 + 1e7
    x[:, 7] = 0.1
    df = spark.createDataFrame(x.tolist(), [f"c{i}" for i in range(300)]).repartition(6)
    out = stats.corr_matrix(df, df.columns)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "corr(" not in plan and "covar" not in plan and plan.count("MapInArrow") == 3
    got = {(r["feature_a"], r["feature_b"]): r["corr"] for r in out.collect()}
    assert len(got) == 300 * 300
    want = np.corrcoef(np.delete(x, 7, axis=1), rowvar=False)
    names = [f"c{i}" for i in range(300) if i != 7]
    assert max(abs(got[a, b] - want[i, j]) for i, a in enumerate(names) for j, b in enumerate(names)) < 1e-7
    assert all(got["c7", f"c{i}"] is None and got[f"c{i}", "c7"] is None for i in range(300))


@pytest.mark.parametrize("zero_fill", [True, False])
def test_gramian_equals_the_pairwise_aggregate(spark, monkeypatch, zero_fill):
    rng = random.Random(4)
    rows = [tuple(None if rng.random() < 0.3 else rng.gauss(50, 3) + i % 7 for _ in range(9)) + (4.0, None) for i in range(500)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(11))).repartition(5)
    plain = {(r[0], r[1]): r[2] for r in stats.corr_matrix(df, df.columns, zero_fill).collect()}
    blocks = {(r[0], r[1]): r[2] for r in gram.correlations(df, df.columns, zero_fill, block=4, fan_in=2).collect()}
    assert plain.keys() == blocks.keys()
    for pair, r in plain.items():
        assert (r is None) == (blocks[pair] is None), pair
        assert r is None or abs(r - blocks[pair]) < 1e-9
    assert gram.correlations(df.limit(0), df.columns).count() == 0


# ---------------------------------------------------------------- trees
def _vectors(spark, n=1500):
    rng = random.Random(9)
    rows = [(rng.random(), rng.gauss(0, 1), float(rng.randrange(5)), i % 3) for i in range(n)]
    df = spark.createDataFrame([(a, b, c, k, a * 3 + (b > 0) * c + rng.gauss(0, 0.1)) for a, b, c, k in rows],
                               "a double, b double, c double, fold int, y double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


def test_a_truncated_tree_is_the_shallow_tree(spark):
    data = _vectors(spark).cache()
    fit = lambda d: DecisionTreeRegressor(featuresCol="features", labelCol="y", maxDepth=d, seed=3).fit(data)
    deep = fit(9)
    for depth in (0, 1, 4, 9):
        cut, shallow = mdl.truncated_tree(deep, depth), fit(depth)
        assert cut.depth == shallow.depth and cut.getMaxDepth() == depth
        pairs = cut.setPredictionCol("p").transform(shallow.setPredictionCol("q").transform(data)).select("p", "q").collect()
        assert all(abs(r["p"] - r["q"]) < 1e-9 for r in pairs)


def test_depth_grid_with_one_fit_a_fold(spark, monkeypatch):
    data, depths = _vectors(spark, 900), [2, 4, 6]
    plain, _, best = mdl.cross_validate(data, "Decision_Tree", "y", depths, folds=3, fold_col="fold")
    fits = []
    pipeline = mdl.scaled_pipeline
    monkeypatch.setattr(mdl, "scaled_pipeline", lambda *a, **k: fits.append(1) or pipeline(*a, **k))
    grid, name, chosen = mdl.cross_validate_depths(data, "y", depths, folds=3, fold_col="fold")
    assert name == "maxDepth" and chosen == best and len(fits) == 3 + 1                 # one a fold, one over all rows
    assert all(abs(a - b) < 1e-9 for a, b in zip(plain.avgMetrics, grid.avgMetrics, strict=True))
    assert grid.bestModel.stages[-1].getMaxDepth() == chosen
    random_folds, _, _ = mdl.cross_validate_depths(data, "y", [1, 5], folds=3)
    assert random_folds.avgMetrics[1] < random_folds.avgMetrics[0]


def test_folds_of_the_depth_grid_share_the_cores(spark, monkeypatch):
    data, parts = _vectors(spark, 900).repartition(8).cache(), []
    pipeline = mdl.scaled_pipeline

    class Seen:
        def __init__(self, *a):
            self.own = pipeline(*a)

        def fit(self, df):
            parts.append(df.rdd.getNumPartitions())
            return self.own.fit(df)

    monkeypatch.setattr(mdl, "scaled_pipeline", Seen)
    grid, _, _ = mdl.cross_validate_depths(data, "y", [2, 6], folds=4, fold_col=None, persist=False)
    assert sorted(parts[:4]) == [1] * 4 and parts[4] == 8         # four cores: a fold's sums are kept once, not eight times
    assert len(grid.avgMetrics) == 2


# ---------------------------------------------------------------- one scan
def test_the_feature_table_is_built_in_one_scan(spark, sf, tmp_path):
    fact, dim = spark.read.parquet(f"{sf}/lineitem.parquet"), spark.read.parquet(f"{sf}/part.parquet")
    seen = spark.sparkContext.accumulator(0)

    def look(x):
        seen.add(1)
        return x

    counted = fact.withColumn("l_tax", F.udf(look, "double").asNondeterministic()("l_tax"))
    train, test = feat.build_feature_table(counted, dim, presets.TPCH, str(tmp_path), split_key="l_orderkey",
                                           relative_error=None)
    rows = fact.filter("l_returnflag <> 'A'").join(dim, fact["l_partkey"] == dim["p_partkey"]).count()
    assert train.count() + test.count() == rows
    assert rows <= seen.value <= fact.count()                                           # no row was read twice
    again, _ = feat.build_feature_table(fact, dim, presets.TPCH, str(tmp_path))
    assert again.count() == train.count() and "is_train" not in again.columns
    with pytest.raises(ValueError):
        feat.flag_split(fact.withColumn("is_train", F.lit(True)))

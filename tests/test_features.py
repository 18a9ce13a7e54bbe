from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from featureflow import presets
from featureflow.plans import features as feat
from featureflow.plans import model as mdl
from featureflow.session import shared_path
from featureflow.spec import Cyclic, FeatureSpec

SPEC = FeatureSpec(
    label="y", key="k", exclude=("cancelled", 1), useless=("cancelled",),
    quantitative=("dist",), hhmm=("dep",), cyclic=(Cyclic("month", period=12),),
    nominal=("cat", "code"), cast_type="int", label_type="int", keep=("id",))


def _frame(spark):
    rows = []
    for i in range(60):
        cat = None if i % 10 == 0 else ("a" if i % 3 else "b")
        code = "None" if i % 7 == 0 else f"c{i % 12}"
        month = None if i % 11 == 0 else (i % 12) + 1
        rows.append((i, i % 4, str(100 + i) if i % 9 else "NA", f"{(i % 24) * 100 + i % 60}", month, cat, code,
                     str(i * 2) if i % 13 else "NA", 1 if i == 5 else 0))
    return spark.createDataFrame(rows, "id int, k int, dist string, dep string, month int, cat string, code string, "
                                       "y string, cancelled int")


def test_static_features_rows_and_columns(spark):
    df = feat.static_features(_frame(spark), None, SPEC)
    assert df.filter(F.col("id") == 5).count() == 0           # cancelled
    assert df.filter(F.col("y").isNull()).count() == 0        # "NA" label rows dropped
    assert "dep_minutes" in df.columns and "dep" not in df.columns
    assert {"month_cos", "month_sin", "month"} <= set(df.columns)


def test_fit_on_imputed_no_null_keys_and_unit_circle(spark):
    df = feat.static_features(_frame(spark), None, SPEC)
    model = feat.FeatureEstimator(SPEC, frequency_threshold=0.05, cardinality_threshold=4).fit(df)
    st = model.params_dict
    for f, m in st["means"].items():
        assert None not in m and "Other" in m
    for f, labels in st["labels"].items():
        assert None not in labels
    out = model.transform(df)
    assert out.count() == df.count()
    r = out.select(F.max(F.abs(F.col("month_cos") ** 2 + F.col("month_sin") ** 2 - 1))).first()[0]
    assert r < 1e-12
    assert out.filter(F.col("code") == "None").count() == 0   # sentinel imputed


def test_save_load_apply_equals_apply(spark):
    df = feat.static_features(_frame(spark), None, SPEC)
    model = feat.FeatureEstimator(SPEC, frequency_threshold=0.05, cardinality_threshold=4).fit(df)
    path = shared_path(spark, "test_feature_model")
    model.write().overwrite().save(path)
    loaded = feat.FeatureModel.load(path)
    a = model.transform(df).select("id", vector_to_array("features").alias("f")).orderBy("id").collect()
    b = loaded.transform(df).select("id", vector_to_array("features").alias("f")).orderBy("id").collect()
    assert a == b


def test_unseen_category_at_apply(spark):
    df = feat.static_features(_frame(spark), None, SPEC)
    model = feat.FeatureEstimator(SPEC, frequency_threshold=0.05, cardinality_threshold=4).fit(df)
    new = _frame(spark).withColumn("code", F.lit("never-seen"))
    out = model.transform(feat.static_features(new, None, SPEC))
    assert out.count() == feat.static_features(new, None, SPEC).count()


def test_best_param_kept_in_retrained_model(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    part = spark.read.parquet(f"{sf}/part.parquet")
    df = feat.static_features(li, part, presets.TPCH)
    data = feat.FeatureEstimator(presets.TPCH).fit(df).transform(df)
    metrics, models = mdl.train_select(data, "l_extendedprice", families=("Linear_Regression",),
                                       grids={"Linear_Regression": [0.1, 0.3]}, folds=2)
    lr = models["Linear_Regression"].stages[-1]
    assert lr.getOrDefault("regParam") in (0.1, 0.3)
    assert metrics.first()["best_value"] == lr.getOrDefault("regParam")


def test_score_all_models_one_pass_equals_each(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    part = spark.read.parquet(f"{sf}/part.parquet")
    df = feat.static_features(li, part, presets.TPCH)
    data = feat.FeatureEstimator(presets.TPCH).fit(df).transform(df)
    root = shared_path(spark, "test_models")
    for fam, p, v in [("Linear_Regression", "regParam", 0.1), ("Decision_Tree", "maxDepth", 3)]:
        mdl.retrain_best(data, fam, "l_extendedprice", p, v).write().overwrite().save(f"{root}/retrained_{fam}")
    together = {r.model: r for r in mdl.score_all_models(spark, root, data, "l_extendedprice").collect()}
    assert set(together) == {"retrained_Linear_Regression", "retrained_Decision_Tree"}
    for name, r in together.items():
        _, m = mdl.score(data, f"{root}/{name}", "l_extendedprice")
        one = m.first()
        for k in ("rmse", "mae", "r2"):
            assert abs(one[k] - r[k]) < 1e-9 * max(1.0, abs(one[k]))
    # a saved model scores the same after a reload
    loaded, _ = mdl.score(data, f"{root}/retrained_Linear_Regression", "l_extendedprice")
    assert loaded.count() == data.count()


def test_the_feature_table_is_written_without_a_sort(spark, sf, monkeypatch, tmp_path):
    """Each task keeps both splits' files open; the setting is put back afterwards."""
    name, seen, transform = "spark.sql.maxConcurrentOutputFileWriters", [], feat.FeatureModel._transform
    before = spark.conf.get(name, None)
    monkeypatch.setattr(feat.FeatureModel, "_transform",
                        lambda self, df: seen.append(spark.conf.get(name)) or transform(self, df))
    li, part = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("lineitem", "part"))
    train, test = feat.build_feature_table(li, part, presets.TPCH, str(tmp_path / "t"), split_key="l_orderkey")
    assert seen == ["2"] and spark.conf.get(name, None) == before
    assert train.count() + test.count() == li.filter("l_returnflag <> 'A'").count() and test.count() > 0

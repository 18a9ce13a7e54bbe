from pyspark.sql import functions as F

from featureflow import presets
from featureflow.operators import stats
from featureflow.plans import features as feat
from featureflow.plans import model as mdl
from featureflow.plans import profile as prof
from featureflow.session import shared_path
from featureflow.streaming import read_stream, score_stream, start_to_parquet


def test_stream_scoring_equals_batch(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    part = spark.read.parquet(f"{sf}/part.parquet")
    static = feat.static_features(li, part, presets.TPCH)
    fm = feat.FeatureEstimator(presets.TPCH).fit(static)
    model = mdl.retrain_best(fm.transform(static), "Linear_Regression", "l_extendedprice", "regParam", 0.1)
    cols = ["l_orderkey", "l_linenumber"]
    batch = model.transform(fm.transform(static)).select(*cols, "prediction")
    stream = read_stream(spark, sf, li.schema, file_glob="lineitem.parquet")
    out = shared_path(spark, "stream-out")
    q = start_to_parquet(score_stream(stream, part, presets.TPCH, fm, model, cols), out, f"{out}_log")
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    # (orderkey, linenumber) is not unique in the generated data: compare multisets
    key = lambda df: sorted((r[0], r[1], round(r[2], 6)) for r in df.collect())
    assert key(got) == key(batch)


def test_profile_tables(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    part = spark.read.parquet(f"{sf}/part.parquet")
    df = feat.static_features(li, part, presets.TPCH)
    t = prof.profile(df, ["l_quantity", "l_discount"], ["brand", "item_type", "l_returnflag"], "l_extendedprice",
                     top_k=5, mean_top_k=3, mean_top_k_features=["brand"])
    assert t["shape"].first()["n_rows"] == df.count()
    assert t["top_categories"].filter(F.col("feature") == "brand").count() == 5
    assert t["mean_target"].filter(F.col("feature") == "brand").count() == 3
    assert t["mean_target"].filter(F.col("feature") == "item_type").count() == 6
    h = {r.bin: r.n for r in t["histograms"].filter(F.col("feature") == "l_quantity").collect()}
    single = {r.bin: r.n for r in stats.histogram(df, "l_quantity", 30).collect()}
    assert h == single
    prof.write_profile(t, shared_path(spark, "profile-out"), "csv")


def test_a_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3), (2.0, 4.0, 3), (4.0, 8.0, 3)], "a double, b double, c int")
    got = {(r.feature_a, r.feature_b): r["corr"] for r in stats.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert abs(got["a", "b"] - 1) < 1e-12 and got["a", "c"] is None and got["c", "c"] is None
    t = prof.profile(df, ["a", "b", "c"], [])
    assert {(r.feature_a, r.feature_b): r["corr"] for r in t["correlation"].collect()}["b", "c"] is None


def test_profile_frame_keeps_all_rows_and_identifiers(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    part = spark.read.parquet(f"{sf}/part.parquet")
    df = prof.profile_frame(li, part, presets.TPCH)
    assert df.count() == li.count() > feat.static_features(li, part, presets.TPCH).count()
    assert set(presets.TPCH.useless) & set(li.columns) <= set(df.columns)


def test_profile_numeric_tables_equal_single_operators(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").withColumn("l_tax", F.nullif(F.col("l_tax"), F.lit(0.0)))
    cols = ["l_quantity", "l_discount", "l_tax"]
    t = prof.profile(li, cols, [], relative_error=None)
    a = {r.feature: r.pct for r in t["null_pct_numeric"].collect()}
    b = {r.feature: r.pct for r in stats.null_percentages(li, cols).collect()}
    assert a == b
    s1 = sorted(tuple(r) for r in t["summary_numeric"].collect())
    s2 = sorted(tuple(r) for r in stats.summary_stats(li, cols).collect())
    assert len(s1) == len(s2)
    for x, y in zip(s1, s2):
        assert x[0] == y[0] and x[1] == y[1] and x[4:] == y[4:]
        assert abs(x[2] - y[2]) < 1e-9 and abs(x[3] - y[3]) < 1e-9
    c1 = {(r.feature_a, r.feature_b): r.corr for r in t["correlation"].collect()}
    c2 = {(r.feature_a, r.feature_b): r.corr for r in stats.corr_matrix(li, cols).collect()}
    assert c1.keys() == c2.keys() and all(abs(c1[k] - c2[k]) < 1e-9 for k in c1)
    assert t["shape"].first()["n_rows"] == li.count()

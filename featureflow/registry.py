"""Registered queries: one per operator of SURVEY section 2, over the driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables.  Stand-in roles (FIXTURES.md section 2): ``lineitem`` is the fact
table, ``part`` the dimension, ``l_extendedprice`` the label; NULLs and bad
text are injected with ``nullif`` / CASE because the tables have none.
Floating results are rounded so the DuckDB oracle compares exactly.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from featureflow import presets
from featureflow.operators import clean, encode, impute, sampling, stats
from featureflow.operators.joins import join_dimension
from featureflow.plans import features as feat
from featureflow.plans import model as mdl
from featureflow.plans import profile as prof
from featureflow.registry_scale import QUERIES as SCALE_QUERIES
from featureflow.session import shared_path
from featureflow.sources import io

LABEL = "l_extendedprice"
KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _base(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem JOIN part (the fact/dimension pair), pruned to the used columns."""
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate")
    p = _t(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type", "p_size",
                                     "p_retailprice")
    return join_dimension(li, p, "l_partkey")


def _r(c, d: int):
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, d) + F.lit(0.0)


# ---------------------------------------------------------------- sources / sinks
def scan_project_drop(spark, sf):
    stored = StructType([StructField("l_orderkey", LongType()), StructField("l_linenumber", IntegerType()),
                         StructField("l_quantity", _t(spark, sf, "lineitem").schema["l_quantity"].dataType),
                         StructField("l_extendedprice", _t(spark, sf, "lineitem").schema["l_extendedprice"].dataType),
                         StructField("l_discount", _t(spark, sf, "lineitem").schema["l_discount"].dataType)])
    df = io.read_parquet(spark, f"{sf}/lineitem.parquet", stored)
    return clean.drop_columns(df, ["l_discount", "not_a_column"])


def parquet_roundtrip(spark, sf):
    path = shared_path(spark, "parquet_roundtrip")
    io.write_parquet(_t(spark, sf, "orders"), path)
    return io.read_parquet(spark, path)


def csv_roundtrip(spark, sf):
    part = _t(spark, sf, "part")
    path = shared_path(spark, "csv_roundtrip")
    io.write_csv(part, path)
    return io.read_csv(spark, path, schema=part.schema)


def schema_roundtrip(spark, sf):
    part = _t(spark, sf, "part")
    spath = shared_path(spark, "schema_roundtrip")
    io.save_schema(spark, part.schema, spath)
    return io.read_parquet(spark, f"{sf}/part.parquet", io.load_schema(spark, spath))


def ingest_cache(spark, sf):
    part = _t(spark, sf, "part")
    root = shared_path(spark, "ingest_cache")
    io.write_csv(part, f"{root}/raw")
    first = io.ingest_cached(spark, f"{root}/raw", f"{root}/part.parquet", f"{root}/schema", part.schema)
    first.count()
    return io.ingest_cached(spark, f"{root}/raw", f"{root}/part.parquet", f"{root}/schema")


def validate_dataset(spark, sf):
    return io.validate_dataset(_t(spark, sf, "orders"), label="o_totalprice", mode="train")


def repartition_invariant(spark, sf):
    return sampling.repartition(_t(spark, sf, "orders"), 10)


# ---------------------------------------------------------------- projections / predicates
def rename_inner_join(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    p = clean.rename_columns(_t(spark, sf, "part"),
                             {"p_partkey": "l_partkey", "p_brand": "brand", "p_type": "item_type"})
    return join_dimension(li, p.select("l_partkey", "brand", "item_type"), "l_partkey").select(
        "l_orderkey", "l_linenumber", "brand", "item_type")


def filter_not_equal_drop_null(spark, sf):
    o = _t(spark, sf, "orders").withColumn("o_orderstatus", F.nullif(F.col("o_orderstatus"), F.lit("F")))
    return clean.exclude_value(o, "o_orderstatus", "P").select("o_orderkey", "o_totalprice")


def try_cast_dropna(spark, sf):
    o = _t(spark, sf, "orders")
    text = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("NA")).otherwise(F.substring("o_orderpriority", 1, 1))
    o = o.select("o_orderkey", text.alias("prio"))
    o = clean.try_cast_columns(o, ["prio"], "int")
    return clean.drop_null_rows(o, ["prio"])


def output_projection_by_name(spark, sf):
    """Every column without ``_`` in its name, minus one."""
    o = clean.rename_columns(_t(spark, sf, "orders"), {"o_orderkey": "orderkey", "o_custkey": "custkey",
                                                       "o_orderstatus": "orderstatus"})
    return clean.output_projection(o, exclude=["custkey"], no_underscore=True)


def output_projection(spark, sf):
    return clean.output_projection(_t(spark, sf, "orders"), exclude=["o_orderpriority"])


def sentinel_to_null(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("prio"))
    return clean.sentinels_to_null(o, ["prio"], ["4-NOT SPECIFIED"])


def head_rows(spark, sf):
    """T4: the first rows of a table for inspection (ordered, so repeatable)."""
    return _t(spark, sf, "orders").orderBy("o_orderkey").limit(10)


def dataset_shape(spark, sf):
    return stats.dataset_shape(_t(spark, sf, "lineitem"))


# ---------------------------------------------------------------- scalar functions
def hhmm_to_minutes(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", (F.hour("ts") * 100 + F.minute("ts")).alias("ts_hhmm"))
    return clean.hhmm_columns(ev, ["ts_hhmm"]).withColumnRenamed("ts_hhmm_minutes", "ts_minutes")


def cyclic_encode(spark, sf):
    li = _t(spark, sf, "lineitem").select(*KEYS, F.month("l_shipdate").alias("m"),
                                          F.dayofmonth("l_shipdate").alias("d"))
    out = feat.cyclic_columns(li, [presets.Cyclic("m", period=12), presets.Cyclic("d", month_col="m")])
    return out.select(*KEYS, _r("m_cos", 9).alias("month_cos"), _r("m_sin", 9).alias("month_sin"),
                      _r("d_cos", 9).alias("dom_cos"))


# ---------------------------------------------------------------- nulls
def _nullified(spark, sf):
    return _t(spark, sf, "lineitem").withColumns({
        "l_quantity": F.nullif(F.col("l_quantity"), F.lit(18.0)),
        "l_returnflag": F.nullif(F.col("l_returnflag"), F.lit("R"))})


def null_counts(spark, sf):
    return stats.null_counts(_nullified(spark, sf), ["l_quantity", "l_returnflag"])


def null_percentages(spark, sf):
    return stats.null_percentages(_nullified(spark, sf), ["l_quantity", "l_returnflag"])


def impute_median(spark, sf):
    li = _t(spark, sf, "lineitem").select(*KEYS, F.nullif(F.col("l_quantity"), F.lit(18.0)).alias("l_quantity"))
    med = impute.learn_medians(li, ["l_quantity"], relative_error=None)
    return impute.fill_values(li, med)


def impute_mode(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("prio"))
    fills = impute.learn_modes(o, ["prio"], sentinels=["5-LOW"])
    return impute.apply_imputation(o, fills, ["prio"], ["5-LOW"])


def quantiles_wide(spark, sf):
    """Exact medians of integers above 2**53 and of a column with infinities."""
    li = _t(spark, sf, "lineitem").select(
        (F.col("l_orderkey") + F.lit(9007199254740993)).alias("big"),
        F.when(F.col("l_quantity") > 40, F.lit(float("inf"))).otherwise(F.col(LABEL)).alias("price"))
    q = stats.quantiles(li, ["big", "price"], [0.5])
    return q.select(F.col("big_q50").alias("q50_big"), F.col("price_q50").alias("q50_price"))


def quantiles(spark, sf):
    q = stats.quantiles(_t(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"], [0.5])
    return q.select(F.col("l_quantity_q50").alias("q50_quantity"), F.col("l_extendedprice_q50").alias("q50_price"))


# ---------------------------------------------------------------- aggregates
def value_proportions(spark, sf):
    return stats.proportions(_base(spark, sf), "p_type")


def mode_values(spark, sf):
    return stats.modes(_base(spark, sf), ["p_brand", "p_type"])


def top_k_categories(spark, sf):
    return stats.top_k(_base(spark, sf), "p_brand", 15)


def top_k_semi_join_mean(spark, sf):
    m = stats.top_k_mean(_base(spark, sf), "p_brand", LABEL, 20)
    return m.select("p_brand", _r("avg_target", 6).alias("avg_target"))


def top_k_semi_join(spark, sf):
    kept = stats.top_k_rows(_base(spark, sf), "p_brand", 20)
    return kept.select(*KEYS, "p_brand")


def _profile_frame(spark, sf):
    return _t(spark, sf, "lineitem").withColumn("l_tax", F.nullif(F.col("l_tax"), F.lit(0.0)))


def profile_histograms(spark, sf):
    return stats.histograms(_profile_frame(spark, sf), ["l_quantity", "l_discount", "l_tax"], 30,
                            ranges={"l_discount": (0.0, 0.05)})


def profile_proportions(spark, sf):
    p = stats.proportions_long(_t(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])
    return p


def profile_top_categories(spark, sf):
    counts = stats.value_stats(_base(spark, sf), ["p_brand", "p_type"])
    return stats.top_k_per_feature(counts, ["p_brand", "p_type"], 5)


def profile_mean_target(spark, sf):
    from featureflow.plans import profile as prof
    t = prof.profile(_base(spark, sf), [], ["p_brand", "p_type", "l_linestatus"], LABEL,
                     mean_top_k=10, mean_top_k_features=["p_brand"])
    m = t["mean_target"]
    return m.select("feature", "value", "n", _r("avg_target", 6).alias("avg_target"))


def mean_target_by_feature(spark, sf):
    return stats.mean_by(_base(spark, sf), "p_type", LABEL).select("p_type", _r("avg_target", 6).alias("avg_target"))


def global_mean(spark, sf):
    return stats.global_mean(_t(spark, sf, "lineitem"), LABEL).select(_r("global_mean", 6).alias("global_mean"))


def frequent_values(spark, sf):
    f = stats.frequent_values(_base(spark, sf), ["p_brand"], 0.04)
    return f.select(F.col("value").alias("p_brand"), _r("frequency", 9).alias("frequency"))


def distinct_values(spark, sf):
    return stats.distinct_values(_t(spark, sf, "part"), "p_type", "k")


def summary_stats(spark, sf):
    s = stats.summary_stats(_t(spark, sf, "lineitem"), ["l_quantity"])
    return s.select("feature", "n", _r("mean", 6).alias("mean"), _r("stddev", 6).alias("stddev"),
                    "mn", "p25", "p50", "p75", "mx")


def corr_matrix(spark, sf):
    li = _t(spark, sf, "lineitem").withColumn("l_discount", F.nullif(F.col("l_discount"), F.lit(0.0)))
    c = stats.corr_matrix(li, ["l_quantity", "l_extendedprice", "l_discount"], zero_fill=True)
    return c.select("feature_a", "feature_b", _r("corr", 9).alias("corr"))


def histogram_30(spark, sf):
    return stats.histogram(_t(spark, sf, "lineitem"), "l_quantity", 30)


def histogram_clipped(spark, sf):
    return stats.histogram(_t(spark, sf, "lineitem"), LABEL, 30, lo=0.0, hi=50000.0)


def union_all_fallback(spark, sf):
    t = encode.mean_target_table(_t(spark, sf, "part"), "p_type", "p_retailprice", "mean_enc")
    return t.select(F.col("p_type").alias("k"), _r("mean_enc", 6).alias("mean_enc"))


# ---------------------------------------------------------------- encoders
def _bucketed(spark, sf, threshold=0.04):
    base = _base(spark, sf)
    keep = encode.learn_frequent(base, ["p_brand"], threshold)
    return encode.rare_to_other(base, keep).withColumnRenamed("p_brand_aggregated", "brand_agg")


def rare_to_other(spark, sf):
    return _bucketed(spark, sf).groupBy("brand_agg").agg(F.count(F.lit(1)).alias("n"))


def mean_encode_fit(spark, sf):
    t = encode.mean_target_table(_bucketed(spark, sf), "brand_agg", LABEL, "mean_enc")
    return t.select("brand_agg", _r("mean_enc", 6).alias("mean_enc"))


def lookup_table_roundtrip(spark, sf):
    """A learned (key -> mean) table written as CSV with a header and
    read back with its schema, as the encoder files are."""
    t = encode.mean_target_table(_bucketed(spark, sf), "brand_agg", LABEL, "mean_enc")
    path = shared_path(spark, "lookup_table")
    io.write_csv(t, path)
    back = io.read_csv(spark, path, schema=t.schema)
    return back.select("brand_agg", _r("mean_enc", 6).alias("mean_enc"))


def mean_encode_apply(spark, sf):
    data = _bucketed(spark, sf)
    table = encode.mean_target_table(data, "brand_agg", LABEL, "mean_enc")
    out = encode.mean_encode(data, table, "brand_agg", "mean_enc",
                             default=table.filter(F.col("brand_agg") == encode.OTHER)
                             .select("mean_enc").scalar(),
                             bound=encode.bound_for(0.04) + 1)
    return out.select(*KEYS, _r("mean_enc", 6).alias("mean_enc"))


def mean_encode_median_default(spark, sf):
    """Mean label by day and quantity, learned on the training rows; keys that only other rows have get the median."""
    key = F.concat_ws("|", F.datediff("l_shipdate", F.lit("1970-01-01").cast("date")), F.col("l_quantity").cast("int"))
    li = _t(spark, sf, "lineitem").select(*KEYS, LABEL, key.alias("k"))
    train, _ = sampling.hash_split(li, "l_orderkey", 0.8)
    table = stats.mean_by(train, "k", LABEL, "enc")
    out = encode.median_default_encode(li, table, "k", "enc", LABEL, relative_error=None)
    return out.select(*KEYS, _r("enc", 6).alias("enc"))


def encoder_choice(spark, sf):
    frequent = encode.learn_frequent(_t(spark, sf, "part"), ["p_brand", "p_type"], 0.02)
    kinds = encode.encoder_choice(frequent, 10, "mean")
    return spark.createDataFrame([(f, len(frequent[f]), kinds[f]) for f in kinds],
                                 "feature string, n_frequent bigint, kind string")


def string_index(spark, sf):
    part = _t(spark, sf, "part").select("p_partkey", "p_type")
    indexer, = encode.string_indexers(encode.learn_index_labels(part, ["p_type"]))
    return indexer.transform(part).select("p_partkey", F.col("p_type_index").alias("idx"))


def one_hot(spark, sf):
    part = _t(spark, sf, "part").select("p_partkey", "p_type")
    labels = encode.learn_index_labels(part, ["p_type"])
    out = encode.one_hot(part, labels)
    return out.select("p_partkey", vector_to_array("p_type_binary").cast(ArrayType(IntegerType())).alias("v"))


def assemble_features(spark, sf):
    li = _t(spark, sf, "lineitem")
    v = feat.assemble(li, ["l_quantity", "l_discount", "l_tax"])
    return v.select(*KEYS, vector_to_array("features").alias("features"))


def z_score(spark, sf):
    li = _t(spark, sf, "lineitem").select(*KEYS, "l_quantity")
    v = feat.assemble(li, ["l_quantity"], "x")
    z = mdl.make_scaler("x", "zx").fit(v).transform(v)
    return z.select(*KEYS, _r(vector_to_array("zx")[0], 9).alias("z"))


def _ols(spark, sf):
    li = _t(spark, sf, "lineitem").select(*KEYS, "l_quantity", LABEL)
    v = feat.assemble(li, ["l_quantity"])
    m = LinearRegression(featuresCol="features", labelCol=LABEL, regParam=0.0, solver="normal").fit(v)
    return m.transform(v)


def ols_score(spark, sf):
    return _ols(spark, sf).select(*KEYS, _r("prediction", 4).alias("prediction"))


def regression_metrics(spark, sf):
    m = mdl.regression_metrics(_ols(spark, sf), LABEL)
    return m.select(_r("rmse", 4).alias("rmse"), _r("mae", 4).alias("mae"), _r("r2", 9).alias("r2"))


# ---------------------------------------------------------------- composite jobs
def _tables(spark, sf):
    """lineitem and part with NULLs, the "None" sentinel and values that are rare: what the learned stage is for."""
    li = _t(spark, sf, "lineitem").withColumns({
        "l_quantity": F.nullif(F.col("l_quantity"), F.lit(18.0)),
        "l_linestatus": F.when(F.col("l_linenumber") == 4, F.lit("None")).otherwise(F.col("l_linestatus")),
        "l_shipdate": F.when((F.col("l_linenumber") != 3) | (F.col("l_quantity") <= 40), F.col("l_shipdate"))})
    part = _t(spark, sf, "part").withColumns({
        "p_type": F.when(F.col("p_partkey") % 11 != 0, F.col("p_type")),
        "p_brand": F.when(F.col("p_partkey") % 7 == 0, F.lit("None"))
        .when(F.col("p_partkey") % 13 != 0, F.col("p_brand"))})
    return li, part


def _static(spark, sf):
    return feat.static_features(*_tables(spark, sf), presets.TPCH)


def static_features(spark, sf):
    """Flagship: static preprocessing, then mean label and cyclic pair per (type, month).

    The pair is derived after the aggregate (72 rows), not per input row.
    """
    li = _t(spark, sf, "lineitem").withColumn("l_returnflag", F.nullif(F.col("l_returnflag"), F.lit("R")))
    df = feat.static_features(li, _t(spark, sf, "part"), presets.TPCH)
    g = df.groupBy("item_type", F.col("ship_month").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(LABEL).alias("avg_target"))
    g = feat.cyclic_columns(g, [presets.Cyclic("month", period=12)])
    return g.select("item_type", "month", "n", _r("avg_target", 6).alias("avg_target"),
                    _r("month_cos", 9).alias("month_cos"), _r("month_sin", 9).alias("month_sin"))


# some brands are rare at this share, and only the two flags are one-hot encoded; exact medians can be compared
SETTINGS = {"frequency_threshold": 0.031, "cardinality_threshold": 4, "high_cardinality_strategy": "mean",
            "relative_error": None}


def _fit(df):
    return feat.FeatureEstimator(presets.TPCH, **SETTINGS).fit(df)


def fit_params(spark, sf):
    """All learned parameters as a long table ``(feature, stat, value, num)``."""
    m = _fit(_static(spark, sf))
    st = m.params_dict
    rows = []
    for c in st["quantitative"]:
        rows.append((c, "median", None, st["fills"][c]))
    for c in st["sentinel_columns"]:
        rows.append((c, "mode", st["fills"][c], None))
    for c, vals in st["frequent"].items():
        rows += [(c, "frequent", v, None) for v in vals]
        rows.append((c, "kind", st["kinds"][c], None))
    for c, labels in st["labels"].items():
        rows += [(c, "label", v, float(i)) for i, v in enumerate(labels)]
    for c, means in st["means"].items():
        rows += [(c, "mean", k, round(v, 6)) for k, v in means.items()]
    return spark.createDataFrame(rows, "feature string, stat string, value string, num double")


def apply_params(spark, sf):
    df = _static(spark, sf)
    out = _fit(df).transform(df)
    return out.select("l_orderkey", "l_linenumber", _rounded_features(out))


def _prepared(spark, sf):
    df = _static(spark, sf)
    return _fit(df).transform(df)


def _rounded_features(df):
    # named twice, the vector is a step of its own: inlined, the whole encoding would be interpreted with the lambda
    return F.when(F.col("features").isNotNull(), F.transform(
        vector_to_array("features"), lambda x: F.round(x, 6) + F.lit(0.0))).alias("features")


def fit_save_load_apply(spark, sf):
    """C4/K5: fit, save through Spark's ML writer, load, apply."""
    df = _static(spark, sf)
    path = shared_path(spark, "feature_params")
    feat.fit_or_load(df, presets.TPCH, path, refit=True, **SETTINGS)
    loaded = feat.fit_or_load(df, presets.TPCH, path, refit=False)
    return loaded.transform(df).select("l_orderkey", "l_linenumber", _rounded_features(df))


def preprocess_new(spark, sf):
    """Parameters learned on the training split, saved, then used to
    preprocess the held-out rows from raw tables."""
    li, part = _tables(spark, sf)
    train, test = sampling.hash_split(li, "l_orderkey", 0.8)
    path = shared_path(spark, "preprocess_new")
    feat.fit_or_load(feat.static_features(train, part, presets.TPCH), presets.TPCH, path, refit=True, **SETTINGS)
    out = feat.preprocess_new(test, part, presets.TPCH, feat.FeatureModel.load(path))
    return out.select("l_orderkey", "l_linenumber", _rounded_features(out))


def split_fit_apply(spark, sf):
    """Hash split on the order key, learn on the training rows, apply to both."""
    train, test, _ = feat.split_fit_apply(*_tables(spark, sf), presets.TPCH, split_key="l_orderkey", **SETTINGS)
    cols = ["l_orderkey", "l_linenumber", _rounded_features(train)]
    return train.select(*cols, F.lit(True).alias("is_train")).unionByName(
        test.select(*cols, F.lit(False).alias("is_train")))


def build_feature_table(spark, sf):
    """Split, learn, apply, write train/test Parquet once, read back."""
    out = shared_path(spark, "feature_table")
    train, test = feat.build_feature_table(*_tables(spark, sf), presets.TPCH, out, split_key="l_orderkey", **SETTINGS)
    cols = ["l_orderkey", "l_linenumber", _rounded_features(train)]
    return train.select(*cols, F.lit(True).alias("is_train")).unionByName(
        test.select(*cols, F.lit(False).alias("is_train")))


def hash_split(spark, sf):
    o = _t(spark, sf, "orders")
    key = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderkey"))        # a tenth of the keys is NULL
    train, test = sampling.hash_split(o.select("o_orderkey", key.alias("k")), "k", 0.8)
    return train.select("o_orderkey", F.lit(True).alias("is_train")).unionByName(
        test.select("o_orderkey", F.lit(False).alias("is_train")))


def split_and_sample_invariants(spark, sf):
    """What must hold of every split and sample, whatever the random numbers.

    Each relation is tagged, the tagged rows are grouped by key once, and the
    groups are counted: a split gives every row to exactly one side, a sample
    holds only source rows, and without replacement none of them twice.
    """
    o = _t(spark, sf, "orders").select("o_orderkey")
    train, test = sampling.random_split(o, 0.8, 42)
    parts = {"source": o, "train": train, "test": test,
             "drawn": sampling.sample_rows(o, 0.5, with_replacement=True, seed=42),
             "taken": sampling.sample_rows(o, 0.5, with_replacement=False, seed=42)}
    tagged = None
    for name, df in parts.items():
        one = df.withColumn("part", F.lit(name))
        tagged = one if tagged is None else tagged.unionByName(one)
    per_key = tagged.groupBy("o_orderkey").agg(*[F.count(F.when(F.col("part") == n, 1)).alias(n) for n in parts])
    n = F.sum("source")

    def share(name):
        return F.sum(name).cast("double") / n

    return per_key.agg(
        n.alias("n_rows"), F.bool_and(F.col("train") + F.col("test") == F.col("source")).alias("split_complete"),
        F.bool_and((F.col("train") == 0) | (F.col("test") == 0)).alias("split_disjoint"),
        share("train").between(0.7, 0.9).alias("train_share"),
        F.bool_and((F.col("source") > 0) | (F.col("drawn") + F.col("taken") == 0)).alias("samples_from_source"),
        F.bool_and(F.col("taken") <= F.col("source")).alias("taken_once"),
        (F.max("drawn") > 1).alias("drawn_again"), share("drawn").between(0.4, 0.6).alias("drawn_share"),
        share("taken").between(0.4, 0.6).alias("taken_share"))


def _one_feature(spark, sf, x):
    li = _t(spark, sf, "lineitem").withColumn("x", x)
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(li.select(*KEYS, LABEL, "x"))


def _predicted(model, data):
    return model.transform(data).select(*KEYS, _r("prediction", 4).alias("prediction"))


def tree_depth_one(spark, sf):
    """M9: a tree of depth one on a feature of two values predicts the mean of each."""
    data = _one_feature(spark, sf, (F.col("l_linestatus") == "F").cast("double"))
    return _predicted(mdl.retrain_best(data, "Decision_Tree", LABEL, "maxDepth", 1), data)


def forest_one_tree(spark, sf):
    """A forest of one tree over all rows (no bootstrap) is that tree."""
    data = _one_feature(spark, sf, (F.col("l_linestatus") == "F").cast("double"))
    forest = mdl.make_estimator("Random_Forest", "scaledFeatures", LABEL).setNumTrees(1).setBootstrap(False)
    train = mdl.training_set(data, LABEL)
    try:
        return _predicted(mdl.scaled_pipeline(forest).fit(train), data)
    finally:
        train.unpersist()


def ridge_score(spark, sf):
    """The model retrained with a grid entry; one feature has a closed form."""
    data = _one_feature(spark, sf, F.col("l_quantity"))
    return _predicted(mdl.retrain_best(data, "Linear_Regression", LABEL, "regParam", 0.5), data)


def cv_ridge(spark, sf):
    """The whole grid over five folds by a hash of the order key."""
    data = _one_feature(spark, sf, F.col("l_quantity")).withColumn(
        "fold", F.pmod(sampling.hash32("l_orderkey"), F.lit(5)).cast("int"))
    cvm, pname, best = mdl.cross_validate(data, "Linear_Regression", LABEL, fold_col="fold")
    _, values = mdl.GRIDS["Linear_Regression"]
    rows = [(pname, float(v), round(float(cvm.avgMetrics[i]), 4), float(v) == float(best)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "param string, value double, avg_rmse double, is_best boolean")


def _fit_family(spark, sf, family, param, value):
    data = _prepared(spark, sf)
    model = mdl.retrain_best(data, family, LABEL, param, value)
    return model.transform(data).select("l_orderkey", "l_linenumber", LABEL, "prediction")


def tree_score(spark, sf):
    return _fit_family(spark, sf, "Decision_Tree", "maxDepth", 5)


def forest_score(spark, sf):
    return _fit_family(spark, sf, "Random_Forest", "numTrees", 10)


def cv_linear(spark, sf):
    data = _prepared(spark, sf).select("features", LABEL)
    cvm, pname, best = mdl.cross_validate(data, "Linear_Regression", LABEL)
    _, values = mdl.GRIDS["Linear_Regression"]
    rows = [(pname, float(v), float(cvm.avgMetrics[i]), float(v) == float(best)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "param string, value double, avg_rmse double, is_best boolean")


def model_comparison(spark, sf):
    metrics, _ = mdl.train_select(_prepared(spark, sf), LABEL)
    return metrics


def retrain_best(spark, sf):
    data = mdl.training_set(_prepared(spark, sf), LABEL)        # one for the search, the last fit and its metrics
    try:
        cvm, pname, best = mdl.cross_validate(data, "Linear_Regression", LABEL)
        model = mdl.retrain_best(data, "Linear_Regression", LABEL, pname, best)
        lr = model.stages[-1]
        m = mdl.regression_metrics(model.transform(data), LABEL).first()
    finally:
        data.unpersist()
    return spark.createDataFrame([(pname, float(lr.getOrDefault(pname)), float(m["rmse"]), float(m["r2"]))],
                                 "param string, value double, rmse double, r2 double")


def _saved_models(spark, sf):
    data = _prepared(spark, sf)
    root = shared_path(spark, "models")
    train = mdl.training_set(data, LABEL)               # one for all three fits
    try:
        for fam, p, v in [("Linear_Regression", "regParam", 0.1), ("Decision_Tree", "maxDepth", 5),
                          ("Random_Forest", "numTrees", 10)]:
            mdl.retrain_best(train, fam, LABEL, p, v).write().overwrite().save(f"{root}/retrained_{fam}")
    finally:
        train.unpersist()
    return data, root


def score_all_models(spark, sf):
    data, root = _saved_models(spark, sf)
    return mdl.score_all_models(spark, root, data, LABEL)


def score_and_write(spark, sf):
    data, root = _saved_models(spark, sf)
    out = shared_path(spark, "predictions")
    mdl.score(data, f"{root}/retrained_Linear_Regression", LABEL, out,
              output_columns=["l_orderkey", "l_linenumber", LABEL])
    return spark.read.option("header", True).option("inferSchema", True).csv(out)


def model_roundtrip(spark, sf):
    data = _prepared(spark, sf)
    path = shared_path(spark, "model_roundtrip")
    mdl.retrain_best(data, "Linear_Regression", LABEL, "regParam", 0.1).write().overwrite().save(path)
    pred, _ = mdl.score(data, path, LABEL)
    return pred.select("l_orderkey", "l_linenumber", "prediction")


def _saved_ols(spark, sf, name="retrained_ols"):
    """A one-feature OLS pipeline (assembler -> scaler -> regParam 0), saved.

    Without regularisation the predictions do not depend on the scaling, so
    they equal SQL's regr_slope / regr_intercept: the saved-model operators
    below get an exact oracle.
    """
    from pyspark.ml import Pipeline
    li = _t(spark, sf, "lineitem").select(*KEYS, "l_quantity", LABEL)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["l_quantity"], outputCol="features"),
                            mdl.make_scaler("features", "scaledFeatures"),
                            LinearRegression(featuresCol="scaledFeatures", labelCol=LABEL, regParam=0.0,
                                             solver="normal")])
    root = shared_path(spark, "ols_models")
    pipe.fit(li).write().overwrite().save(f"{root}/{name}")
    return li, root


def model_roundtrip_ols(spark, sf):
    """K6: save, load, predict."""
    li, root = _saved_ols(spark, sf)
    pred, _ = mdl.score(li, f"{root}/retrained_ols", LABEL)
    return pred.select(*KEYS, _r("prediction", 4).alias("prediction"))


def score_and_write_ols(spark, sf):
    """Score with a saved model, write the projected CSV, read it back."""
    li, root = _saved_ols(spark, sf)
    out = shared_path(spark, "ols_predictions")
    mdl.score(li, f"{root}/retrained_ols", LABEL, out, output_columns=KEYS)
    schema = "l_orderkey bigint, l_linenumber int, l_partkey bigint, prediction double"
    back = spark.read.option("header", True).schema(schema).csv(out)
    return back.select(*KEYS, _r("prediction", 4).alias("prediction"))


def score_all_models_ols(spark, sf):
    """Every saved model in a folder scored, metrics in one aggregate."""
    li, root = _saved_ols(spark, sf)
    m = mdl.score_all_models(spark, root, li, LABEL)
    return m.select("model", _r("rmse", 4).alias("rmse"), _r("mae", 4).alias("mae"), _r("r2", 9).alias("r2"))


def _label_profile(spark, sf):
    return prof.profile(_base(spark, sf), ["l_discount"], ["p_brand"], "l_quantity",
                        mean_numeric_features=["l_discount", "l_quantity"])


def profile_label_distribution(spark, sf):
    """Every value of the label with its share (no top-k cut)."""
    t = _label_profile(spark, sf)["label_distribution"]
    return t.select(F.col("value").cast("double").alias("quantity"), "count", "proportion")


def profile_mean_numeric(spark, sf):
    """Mean label by value of numeric columns, the label itself among them."""
    t = _label_profile(spark, sf)["mean_target_numeric"]
    return t.select("feature", F.col("value").cast("double").alias("value"), _r("avg_target", 6).alias("avg_target"), "n")


def profile_write(spark, sf):
    """K3: the proportions per feature as CSV folders, read back."""
    tables = prof.profile(_base(spark, sf), [], ["p_brand", "p_type"])
    path = shared_path(spark, "profile_write")
    prof.write_profile({"proportions_categorical": tables["proportions_categorical"]}, path, "csv")
    schema = "value string, count bigint, proportion double, feature string"
    back = spark.read.option("header", True).schema(schema).csv(f"{path}/proportions_categorical")
    return back.select("feature", "value", "count", "proportion")


def train_and_predict(spark, sf):
    """Feature table -> model selection over all families -> the best one scores the test rows."""
    root = shared_path(spark, "train_and_predict")
    train, test = feat.build_feature_table(*_tables(spark, sf), presets.TPCH, f"{root}/features",
                                           split_key="l_orderkey", **SETTINGS)
    metrics, models = mdl.train_select(train, LABEL, save_dir=f"{root}/models")
    best = metrics.orderBy("rmse", "model").first()["model"]
    pred, _ = mdl.score(test, models[best], LABEL)
    return pred.select("l_orderkey", "l_linenumber", LABEL, "prediction")


QUERIES = {
    # sources / sinks
    "scan_project_drop": scan_project_drop,
    "parquet_roundtrip": parquet_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "schema_roundtrip": schema_roundtrip,
    "ingest_cache": ingest_cache,
    "validate_dataset": validate_dataset,
    "repartition_invariant": repartition_invariant,
    # projections / predicates / casts
    "rename_inner_join": rename_inner_join,
    "filter_not_equal_drop_null": filter_not_equal_drop_null,
    "try_cast_dropna": try_cast_dropna,
    "output_projection": output_projection,
    "output_projection_by_name": output_projection_by_name,
    "sentinel_to_null": sentinel_to_null,
    "dataset_shape": dataset_shape,
    "head_rows": head_rows,
    "hhmm_to_minutes": hhmm_to_minutes,
    "cyclic_encode": cyclic_encode,
    # nulls
    "null_counts": null_counts,
    "null_percentages": null_percentages,
    "impute_median": impute_median,
    "impute_mode": impute_mode,
    "quantiles": quantiles,
    "quantiles_wide": quantiles_wide,
    # aggregates
    "value_proportions": value_proportions,
    "mode_values": mode_values,
    "top_k_categories": top_k_categories,
    "top_k_semi_join_mean": top_k_semi_join_mean,
    "mean_target_by_feature": mean_target_by_feature,
    "top_k_semi_join": top_k_semi_join,
    "profile_histograms": profile_histograms,
    "profile_proportions": profile_proportions,
    "profile_top_categories": profile_top_categories,
    "profile_mean_target": profile_mean_target,
    "profile_label_distribution": profile_label_distribution,
    "profile_mean_numeric": profile_mean_numeric,
    "profile_write": profile_write,
    "global_mean": global_mean,
    "frequent_values": frequent_values,
    "distinct_values": distinct_values,
    "summary_stats": summary_stats,
    "corr_matrix": corr_matrix,
    "histogram_30": histogram_30,
    "histogram_clipped": histogram_clipped,
    "union_all_fallback": union_all_fallback,
    # encoders
    "rare_to_other": rare_to_other,
    "mean_encode_fit": mean_encode_fit,
    "mean_encode_apply": mean_encode_apply,
    "lookup_table_roundtrip": lookup_table_roundtrip,
    "mean_encode_median_default": mean_encode_median_default,
    "encoder_choice": encoder_choice,
    "string_index": string_index,
    "one_hot": one_hot,
    "assemble_features": assemble_features,
    "z_score": z_score,
    "ols_score": ols_score,
    "regression_metrics": regression_metrics,
    # composite
    "static_features": static_features,
    "fit_params": fit_params,
    "apply_params": apply_params,
    "hash_split": hash_split,
    "split_and_sample_invariants": split_and_sample_invariants,
    "tree_depth_one": tree_depth_one,
    "forest_one_tree": forest_one_tree,
    "ridge_score": ridge_score,
    "cv_ridge": cv_ridge,
    # rows-only
    "fit_save_load_apply": fit_save_load_apply,
    "preprocess_new": preprocess_new,
    "split_fit_apply": split_fit_apply,
    "build_feature_table": build_feature_table,
    "tree_score": tree_score,
    "forest_score": forest_score,
    "cv_linear": cv_linear,
    "retrain_best": retrain_best,
    "model_roundtrip": model_roundtrip,
    "score_all_models": score_all_models,
    "model_roundtrip_ols": model_roundtrip_ols,
    "score_and_write_ols": score_and_write_ols,
    "score_all_models_ols": score_all_models_ols,
    "score_and_write": score_and_write,
    "model_comparison": model_comparison,
    "train_and_predict": train_and_predict,
    # long tails, skew, repeatable draws
    **SCALE_QUERIES,
}

"""Registered queries of the operators built for long tails, skew and repeatable draws.

As in ``registry``: each entry takes ``(spark, sf_dir)`` and returns a DataFrame
over whole tables; the DuckDB forms are in ``oracle_scale``.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from featureflow.operators import frequent, indexing, joins, sampling, sketches, stats
from featureflow.plans import model as mdl
from featureflow.session import shared_path
from featureflow.sources import ingest, io

LABEL = "l_extendedprice"
KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _r(c, d: int):
    return F.round(F.col(c) if isinstance(c, str) else c, d) + F.lit(0.0)


# ---------------------------------------------------------------- long tails
def _long_tail(spark, sf) -> DataFrame:
    """A near-unique category with a few frequent values, a unique one, and NULLs."""
    li = _t(spark, sf, "lineitem")
    tail = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")
    return li.select(
        F.when(F.col("l_quantity") <= 4, F.concat(F.lit("q"), F.col("l_quantity").cast("int").cast("string")))
        .when(F.col("l_quantity") < 50, tail).alias("mixed"), tail.alias("code"), "l_orderkey", "l_partkey", LABEL)


def frequent_values_tail(spark, sf):
    """A3: values above 1 % of a near-unique column; the tail is never shuffled."""
    f = stats.frequent_values(_long_tail(spark, sf), ["mixed", "code"], 0.01)
    return f.select("feature", "value", _r("frequency", 9).alias("frequency"))


def mode_values_tail(spark, sf):
    """Exact modes where no value, one value or many values are frequent."""
    modes = frequent.learn_modes(_long_tail(spark, sf), ["mixed", "code", "l_orderkey", "l_partkey"])
    return spark.createDataFrame(list(modes.items()), "feature string, value string")


def heavy_label_sums(spark, sf):
    """M3: label sums of frequent values, NULL and all other rows, as the feature stage learns them."""
    c = frequent.frequent_counts(_long_tail(spark, sf), ["mixed"], 0.01, LABEL)["mixed"]
    groups = [("value", v, x) for v, x in c.values.items()] + [("null", None, c.null), ("rest", None, c.rest)]
    rows = [(kind, v, x.n, x.label_n, x.label_sum) for kind, v, x in groups]
    return spark.createDataFrame(rows, "kind string, value string, n long, label_n long, label_sum double").select(
        "kind", "value", "n", "label_n", _r("label_sum", 2).alias("label_sum"))


# ---------------------------------------------------------------- quantiles
QUANTILE_COLUMNS = ["l_quantity", LABEL, "l_orderkey", "l_partkey"]


def quantiles_sketched(spark, sf):
    """Sketched quantiles beside exact ones: whether their ranks are within 1 % of the wanted ones."""
    error, probs = 0.01, (0.25, 0.5, 0.75)
    li = _t(spark, sf, "lineitem").withColumn("l_orderkey", F.nullif(F.col("l_orderkey"), F.lit(1).cast("long")))
    keys = [(c, p) for c in QUANTILE_COLUMNS for p in probs]
    row = sketches.approx_quantiles(li, {k: f"q{i}" for i, k in enumerate(keys)}, error).first()
    exact = stats.exact_quantiles(li, QUANTILE_COLUMNS, probs)
    ranks = li.agg(*[F.struct(F.count(c).alias("n"), F.count(F.when(F.col(c) < row[i], 1)).alias("below"),
                              F.count(F.when(F.col(c) <= row[i], 1)).alias("upto")).alias(f"r{i}")
                     for i, (c, _) in enumerate(keys)])
    return ranks.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit(p).alias("p"), F.col(f"r{i}.n").alias("n"),
                 F.lit(float(exact[c, p])).alias("exact"),
                 ((F.col(f"r{i}.below") <= (p + error) * F.col(f"r{i}.n"))
                  & (F.col(f"r{i}.upto") >= (p - error) * F.col(f"r{i}.n"))).alias("within"))
        for i, (c, p) in enumerate(keys)])))


# ---------------------------------------------------------------- labels without a limit
def string_index_unlimited(spark, sf):
    """M1: every order key and the near-unique category indexed by frequency; labels stay a table."""
    data = _long_tail(spark, sf)
    labels = indexing.label_table(data, ["mixed", "l_orderkey"])
    out = indexing.index_columns(data, labels, ["mixed", "l_orderkey"])
    return out.select("code", "mixed_index", "l_orderkey_index")


def one_hot_unlimited(spark, sf):
    """M2: the slot and width of each row's sparse one-hot vector, with one label in two unseen when learning."""
    data = _long_tail(spark, sf)
    labels = indexing.label_table(data.filter(F.col("l_orderkey") % 2 == 0), ["l_orderkey"])
    out = indexing.one_hot_columns(indexing.index_columns(data, labels, ["l_orderkey"]), ["l_orderkey"])
    text = F.col("l_orderkey_binary").cast("string")        # (size,[slot],[1.0])
    return out.select("code", F.regexp_extract(text, r"^\((\d+),", 1).cast("long").alias("width"),
                      F.regexp_extract(text, r"\[(\d+)\]", 1).cast("long").alias("slot"))


# ---------------------------------------------------------------- skewed joins
def _skewed(spark, sf) -> DataFrame:
    """A fact whose part key is one value in a third of the rows, NULL in some, unknown in others."""
    key = (F.when(F.col("l_linenumber") % 3 == 0, F.lit(7)).when(F.col("l_quantity") == 9, F.lit(None))
           .when(F.col("l_quantity") > 40, -F.col("l_partkey")).otherwise(F.col("l_partkey")))
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", key.cast("long").alias("p_partkey"))


def split_join_inner(spark, sf):
    """Hot keys against a broadcast of their own rows, the rest behind a key bitmap."""
    part = _t(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    return joins.split_join(_skewed(spark, sf), part, "p_partkey")


def split_join_left(spark, sf):
    """The same as a left lookup; rows without a key or a match stay."""
    part = _t(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    return joins.split_join(_skewed(spark, sf), part, "p_partkey", "left")


# ---------------------------------------------------------------- repeatable draws
ROW = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def random_split(spark, sf):
    """0.8 / 0.2 with seed 42, by the rows' draws: the same rows on any layout."""
    train, test = sampling.random_split(_t(spark, sf, "orders"), 0.8, 42, keys=["o_orderkey"])
    return train.withColumn("is_train", F.lit(True)).unionByName(test.withColumn("is_train", F.lit(False)))


def sample_with_replacement(spark, sf):
    """R2: 1 % with replacement, repeatable."""
    return sampling.sample_by_key(_t(spark, sf, "lineitem"), ROW, 0.01, with_replacement=True)


def sample_without_replacement(spark, sf):
    """10 % without replacement, repeatable."""
    return sampling.sample_by_key(_t(spark, sf, "lineitem"), ROW, 0.1)


def sample_stratified(spark, sf):
    """Fractions by return flag, with replacement (some above one); other flags are not taken."""
    return sampling.sample_by_key(_t(spark, sf, "lineitem").select(*ROW, "l_returnflag"), ROW, {"A": 0.5, "R": 1.5},
                                  with_replacement=True, seed=7, strata="l_returnflag")


# ---------------------------------------------------------------- models on a repeatable hold-out
def _one_feature(spark, sf) -> DataFrame:
    li = _t(spark, sf, "lineitem").withColumn("fold", F.pmod(sampling.hash32("l_orderkey"), F.lit(5)).cast("int"))
    li = li.withColumn("held", ~sampling.is_train("l_partkey", 0.8))
    return VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(
        li.select(*KEYS, "l_quantity", LABEL, "fold", "held"))


def model_comparison_ridge(spark, sf):
    """Cross-validation, hold-out metrics and the winning entry, on folds and a hold-out by hash."""
    metrics, _ = mdl.train_select(_one_feature(spark, sf), LABEL, families=("Linear_Regression",), holdout_col="held",
                                  fold_col="fold")
    return metrics.select("model", _r("rmse", 4).alias("rmse"), _r("mae", 4).alias("mae"), _r("r2", 7).alias("r2"),
                          "best_param", "best_value")


def train_and_predict_ridge(spark, sf):
    """Selection on the training rows, the saved winner scores all rows."""
    data = _one_feature(spark, sf)
    root = shared_path(spark, "train_and_predict_ridge")
    mdl.train_select(data, LABEL, families=("Linear_Regression",), holdout_col="held", fold_col="fold",
                     save_dir=root)
    pred, _ = mdl.score(data, f"{root}/retrained_Linear_Regression", LABEL)
    return pred.select(*KEYS, _r("prediction", 4).alias("prediction"))


def cv_tree_depths(spark, sf):
    """A depth grid over five hash folds, one tree a fold; on a feature of two values every depth predicts means."""
    li = _t(spark, sf, "lineitem").withColumn("x", (F.col("l_linestatus") == "F").cast("double"))
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        li.select("x", LABEL, F.pmod(sampling.hash32("l_orderkey"), F.lit(5)).cast("int").alias("fold")))
    depths = [1, 3, 6]
    cvm, pname, best = mdl.cross_validate_depths(data, LABEL, depths, fold_col="fold")
    rows = [(pname, d, round(cvm.avgMetrics[i], 4), d == best) for i, d in enumerate(depths)]
    return spark.createDataFrame(rows, "param string, value int, avg_rmse double, is_best boolean")


# ---------------------------------------------------------------- many columns
def _wide(spark, sf) -> DataFrame:
    li = _t(spark, sf, "lineitem")
    return li.select(*[F.when(F.col("l_linenumber") != 1 + i % 7, F.col("l_quantity") * (i % 5 + 1) + F.col("l_discount")
                              * (10 * i) + F.col("l_tax") * (i * i) + 1e6).alias(f"x{i:02d}") for i in range(24)],
                     F.lit(3.5).alias("x_same"))


def corr_matrix_wide(spark, sf):
    """A10: 25 columns with NULLs (as 0) and a constant one, from a Gramian over blocks of columns."""
    data = _wide(spark, sf)
    c = stats.corr_matrix(data, data.columns)
    return c.select("feature_a", "feature_b", _r("corr", 7).alias("corr"))


def corr_matrix_pairwise(spark, sf):
    """A10: the same without filling: each pair over the rows where both are known."""
    data = _wide(spark, sf)
    c = stats.corr_matrix(data, data.columns, zero_fill=False)
    return c.select("feature_a", "feature_b", _r("corr", 6).alias("corr"))


# ---------------------------------------------------------------- ingest
def _orders_csv(spark, sf, part: int, path: str, factor: float = 1.0) -> None:
    o = _t(spark, sf, "orders").filter(F.col("o_orderkey") % 4 == part).withColumn("o_totalprice", F.col("o_totalprice") * factor)
    io.write_csv(o.coalesce(1), f"{path}/k{part}/deep")


def _two_batches(spark, sf) -> tuple[DataFrame, str]:
    root, schema = shared_path(spark, "ingest_files"), _t(spark, sf, "orders").schema
    for part in (0, 1, 2):
        _orders_csv(spark, sf, part, f"{root}/raw")
    ingest.ingest_files(spark, f"{root}/raw", f"{root}/table", schema, prune=True)
    _orders_csv(spark, sf, 1, f"{root}/raw", 2.0)
    _orders_csv(spark, sf, 3, f"{root}/raw")
    return ingest.ingest_files(spark, f"{root}/raw", f"{root}/table", prune=True), f"{root}/table"


def ingest_incremental(spark, sf):
    """Three files of orders, then one replaced and one new: only those two are read again."""
    return _two_batches(spark, sf)[0]


def ingest_manifest(spark, sf):
    """What each batch of that read: files and rows (files that were gone apart)."""
    _, root = _two_batches(spark, sf)
    return (ingest.read_manifest(spark, root).groupBy("batch", "removed")
            .agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("n_rows")))


def _broken_orders(spark, sf) -> tuple[DataFrame, DataFrame]:
    o = _t(spark, sf, "orders")
    schema = StructType([o.schema[c] for c in ("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")])
    key, text = F.col("o_orderkey"), [F.col(c).cast("string") for c in schema.names]
    line = (F.when(key % 97 == 0, F.concat_ws(",", text[0], text[1], F.lit("n/a"), text[3]))
            .when(key % 89 == 0, F.concat_ws(",", text[0], text[1]))
            .when(key % 83 == 0, F.concat_ws(",", *text, F.lit("more"))).otherwise(F.concat_ws(",", *text)))
    path = shared_path(spark, "csv_quarantine")
    o.select(line.alias("value")).write.text(f"{path}/raw")
    return ingest.quarantine_csv(spark, f"{path}/raw", f"{path}/table", schema, header=False, most_rejects=0.1)


def csv_quarantine(spark, sf):
    """Broken lines are kept apart with a reason; rows in = rows out + rejects."""
    rows, rejects = _broken_orders(spark, sf)
    return rejects.select("record", "reason").unionByName(
        rows.agg(F.count(F.lit(1)).cast("string").alias("record")).withColumn("reason", F.lit("accepted")))


def csv_accepted(spark, sf):
    """The well-formed rows of the same files."""
    return _broken_orders(spark, sf)[0]


QUERIES = {
    "frequent_values_tail": frequent_values_tail,
    "mode_values_tail": mode_values_tail,
    "heavy_label_sums": heavy_label_sums,
    "quantiles_sketched": quantiles_sketched,
    "string_index_unlimited": string_index_unlimited,
    "one_hot_unlimited": one_hot_unlimited,
    "split_join_inner": split_join_inner,
    "split_join_left": split_join_left,
    "random_split": random_split,
    "sample_with_replacement": sample_with_replacement,
    "sample_without_replacement": sample_without_replacement,
    "sample_stratified": sample_stratified,
    "model_comparison_ridge": model_comparison_ridge,
    "train_and_predict_ridge": train_and_predict_ridge,
    "cv_tree_depths": cv_tree_depths,
    "corr_matrix_wide": corr_matrix_wide,
    "corr_matrix_pairwise": corr_matrix_pairwise,
    "ingest_incremental": ingest_incremental,
    "ingest_manifest": ingest_manifest,
    "csv_quarantine": csv_quarantine,
    "csv_accepted": csv_accepted,
}

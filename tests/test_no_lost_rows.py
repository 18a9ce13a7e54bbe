"""Splits, caches and histograms lose no row."""
import math

import pytest
from pyspark.sql import functions as F

from featureflow.operators import sampling, stats
from featureflow.session import shared_path
from featureflow.sources import io


@pytest.mark.parametrize("share", [0.005, 0.8, 0.996])
def test_hash_split_keeps_every_row(spark, share):
    df = spark.range(20_000).withColumn("k", F.when(F.col("id") % 10 != 0, F.col("id")))
    train, test = sampling.hash_split(df, "k", share)
    assert train.count() + test.count() == 20_000
    assert train.filter("k IS NOT NULL").count() == pytest.approx(18_000 * share, abs=6 * math.sqrt(18_000 * share * (1 - share)))
    assert test.filter("k IS NOT NULL").count() > 0


@pytest.mark.parametrize("share", [0, 1, -0.1, 1.5])
def test_hash_split_rejects_shares(share):
    with pytest.raises(ValueError, match="train_frac"):
        sampling.is_train("k", share)


def test_cache_follows_its_raw_files(spark):
    root = shared_path(spark, "cache")
    for name, n in (("one", 10), ("two", 7)):
        io.write_csv(spark.range(n).coalesce(1), f"{root}/{name}")
    args = (f"{root}/copy.parquet", f"{root}/schema")
    assert io.ingest_cached(spark, f"{root}/one", *args).count() == 10
    assert io.ingest_cached(spark, f"{root}/two", *args).count() == 7
    io.write_csv(spark.range(3), f"{root}/two")
    assert io.ingest_cached(spark, f"{root}/two", *args).count() == 3
    # an unfinished copy is built again
    spark.range(1).write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(args[0])
    assert io.ingest_cached(spark, f"{root}/two", *args).count() == 3


def test_nan_and_negative_zero(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (30.0,), (float("nan"),), (None,)], "x double")
    one = {r["bin"]: r["n"] for r in stats.histogram(df, "x", 30).collect()}
    many = {r["bin"]: r["n"] for r in stats.histograms(df, ["x"], 30).collect()}
    assert one == many == {1: 1, 2: 1, 30: 1}
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "x double")
    assert {r["value"]: r["n"] for r in stats.value_stats(zeros, ["x"]).collect()} == {"0.0": 2, "1.0": 1}

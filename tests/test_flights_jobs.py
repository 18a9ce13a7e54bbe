"""The airline preset end to end on a small hand-made CSV pair (the real
files are not available): ingest -> static -> fit -> apply -> train -> score,
through the spark-submit entry points."""
import random

import pytest
from pyspark.sql import functions as F

from featureflow import presets
from featureflow.jobs import build_features, score, train
from featureflow.plans import features as feat
from featureflow.session import shared_path
from featureflow.sources import io

FLIGHT_COLS = ("Year,Month,DayofMonth,DayOfWeek,DepTime,CRSDepTime,ArrTime,CRSArrTime,UniqueCarrier,FlightNum,"
               "TailNum,ActualElapsedTime,CRSElapsedTime,AirTime,ArrDelay,DepDelay,Origin,Dest,Distance,TaxiIn,"
               "TaxiOut,Cancelled,CancellationCode,Diverted,CarrierDelay,WeatherDelay,NASDelay,SecurityDelay,"
               "LateAircraftDelay").split(",")
PLANE_COLS = "tailnum,type,manufacturer,issue_date,model,status,aircraft_type,engine_type,year".split(",")


def _write_csv(spark, rows, cols, path):
    spark.createDataFrame(rows, ",".join(f"{c} string" for c in cols)).coalesce(1).write.option(
        "header", True).mode("overwrite").csv(path)


@pytest.fixture(scope="module")
def raw(spark):
    rng = random.Random(7)
    tails = [f"N{i:03d}" for i in range(30)]
    airports = ["ATL", "ORD", "DFW", "LAX", "DEN", "JFK", "SFO", "SEA", "BOS", "MIA", "PHX", "IAH"]
    flights = []
    for i in range(600):
        dep = rng.choice(["NA", str(rng.randint(0, 2359))]) if i % 17 == 0 else str(rng.randint(5, 2359))
        arr_delay = "NA" if i % 23 == 0 else str(rng.randint(-30, 180))
        flights.append([
            "2008", str(rng.randint(1, 12)), str(rng.randint(1, 28)), str(rng.randint(1, 7)), dep,
            str(rng.randint(5, 2359)), "1200", str(rng.randint(5, 2359)), "AA", str(rng.randint(1, 999)),
            rng.choice(tails + ["UNKNOWN"]), "100", "NA" if i % 29 == 0 else str(rng.randint(30, 300)), "90",
            arr_delay, str(rng.randint(-10, 150)), rng.choice(airports), rng.choice(airports),
            str(rng.randint(100, 2500)), "5", str(rng.randint(5, 40)), "1" if i % 31 == 0 else "0", "", "0",
            "0", "0", "0", "0", "0"])
    planes = []
    for i, t in enumerate(tails):
        planes.append([t, "Corporation", rng.choice(["BOEING", "AIRBUS", None]), "01/01/2000",
                       rng.choice(["737", "A320", "757", "MD-88"]), "Valid",
                       rng.choice(["Fixed Wing Multi-Engine", None]), rng.choice(["Turbo-Fan", "Turbo-Jet"]),
                       rng.choice(["1998", "2001", "None", None])])
    root = shared_path(spark, "flights-fixture")
    _write_csv(spark, flights, FLIGHT_COLS, f"{root}/flights_csv")
    _write_csv(spark, planes, PLANE_COLS, f"{root}/planes_csv")
    return root


def test_flights_preset_pipeline(spark, raw):
    fl = io.ingest_cached(spark, f"{raw}/flights_csv", f"{raw}/flights.parquet", f"{raw}/flights_schema")
    pl = io.ingest_cached(spark, f"{raw}/planes_csv", f"{raw}/planes.parquet", f"{raw}/planes_schema")
    df = feat.static_features(fl, pl, presets.FLIGHTS)
    assert df.filter(F.col("ArrDelay").isNull()).count() == 0
    assert "DepTime_minutes" in df.columns and "TaxiIn" not in df.columns and "TailNum" not in df.columns
    model = feat.FeatureEstimator(presets.FLIGHTS).fit(df)
    out = model.transform(df)
    assert out.count() == df.count()
    st = model.params_dict
    assert set(st["kinds"]) == set(presets.FLIGHTS.nominal)
    width = len(out.select("features").first()[0])
    assert width == len(model.feature_columns()) - sum(1 for k in st["kinds"].values() if k == "binary") + sum(
        len(v) + 1 for v in st["labels"].values())


def test_cli_build_train_score(spark, raw):
    out = shared_path(spark, "flights-cli")
    build_features.main(["--raw_flights", f"{raw}/flights_csv", "--raw_plane", f"{raw}/planes_csv", "--out", out])
    train.main(["--features", out, "--models", f"{out}/models", "--families", "Linear_Regression,Decision_Tree",
                "--folds", "2"])
    score.main(["--raw_flights", f"{raw}/flights_csv", "--raw_plane", f"{raw}/planes_csv", "--params",
                f"{out}/params", "--model", f"{out}/models/retrained_Linear_Regression", "--out", f"{out}/pred"])
    pred = spark.read.option("header", True).csv(f"{out}/pred")
    assert "prediction" in pred.columns and "Origin" in pred.columns and pred.count() > 0


def test_cli_profile(spark, raw):
    from featureflow.jobs import profile
    out = shared_path(spark, "flights-profile")
    profile.main(["--raw_flights", f"{raw}/flights_csv", "--raw_plane", f"{raw}/planes_csv", "--out", out,
                  "--format", "parquet"])
    props = spark.read.parquet(f"{out}/proportions_categorical")
    assert "feature" in props.columns and props.select("feature").distinct().count() >= 6
    hist = spark.read.parquet(f"{out}/histograms")
    assert hist.filter(F.col("feature") == "DepDelay").agg(F.max("bin")).first()[0] <= 30
    mean = spark.read.parquet(f"{out}/mean_target")
    assert mean.filter(F.col("feature") == "Origin").count() <= 20

import math

from pyspark.sql import functions as F

from featureflow.functions import bucket_rare, cyclic_pair, hhmm_to_minutes, lookup, month_length, null_if_in


def test_hhmm_padding_and_bad_text(spark):
    df = spark.createDataFrame([("955",), ("1955",), ("5",), ("0",), ("NA",), (None,), ("12345",)], "t string")
    got = [r[0] for r in df.select(hhmm_to_minutes("t")).collect()]
    assert got == [595, 1195, 5, 0, None, None, None]


def test_hhmm_int_column(spark):
    df = spark.createDataFrame([(955,), (2400,), (None,)], "t int")
    assert [r[0] for r in df.select(hhmm_to_minutes("t")).collect()] == [595, 1440, None]


def test_cyclic_unit_circle_and_null(spark):
    df = spark.createDataFrame([(m,) for m in range(1, 13)] + [(None,)], "m int")
    cos, sin = cyclic_pair("m", 12)
    rows = df.select(cos.alias("c"), sin.alias("s")).collect()
    for r in rows[:-1]:
        assert abs(r.c ** 2 + r.s ** 2 - 1) < 1e-12
    assert rows[-1].c is None and rows[-1].s is None
    assert abs(rows[2].c - math.cos(2 * math.pi * 3 / 12)) < 1e-12


def test_month_length(spark):
    df = spark.createDataFrame([(m,) for m in range(1, 13)], "m int")
    got = [r[0] for r in df.select(month_length("m")).collect()]
    assert got == [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]


def test_sentinel_on_int_column_does_not_raise(spark):
    df = spark.createDataFrame([(1,), (None,)], "y int")
    # sentinel text only touches string columns; on ints it is a no-op
    from featureflow.operators.clean import sentinels_to_null
    assert sentinels_to_null(df, ["y"], ["None"]).collect() == df.collect()
    s = spark.createDataFrame([("None",), ("a",)], "y string")
    assert [r[0] for r in s.select(null_if_in("y", ["None"])).collect()] == [None, "a"]


def test_bucket_rare_null_stays_null_and_int_categories(spark):
    df = spark.createDataFrame([(2008,), (1999,), (None,)], "y int")
    got = [r[0] for r in df.select(bucket_rare("y", ["2008"])).collect()]
    assert got == ["2008", "Other", None]


def test_lookup_default(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    got = [r[0] for r in df.select(lookup("k", {"a": 1.0, "Other": 9.0}, default=9.0)).collect()]
    assert got == [1.0, 9.0, 9.0]


def test_ansi_bad_text_cast_is_null(spark):
    from featureflow.operators.clean import try_cast_columns
    df = spark.createDataFrame([("NA",), ("12",)], "x string")
    assert [r[0] for r in try_cast_columns(df, ["x"], "int").collect()] == [None, 12]


def test_hhmm_and_cyclic_properties_random(spark):
    """Random clock values and calendar values against plain arithmetic."""
    import random
    rng = random.Random(11)
    rows = [(rng.randint(0, 23) * 100 + rng.randint(0, 59), rng.randint(1, 12), rng.randint(1, 28))
            for _ in range(2000)]
    df = spark.createDataFrame(rows, "t int, m int, d int")
    mc, ms = cyclic_pair("m", 12)
    dc, ds = cyclic_pair("d", month_length("m"))
    got = df.select("t", "m", "d", hhmm_to_minutes("t").alias("mins"),
                    hhmm_to_minutes(F.col("t").cast("string")).alias("mins_text"),
                    mc.alias("mc"), ms.alias("ms"), dc.alias("dc"), ds.alias("ds")).collect()
    lengths = {2: 28, 4: 30, 6: 30, 9: 30, 11: 30}
    for r in got:
        assert r.mins == r.mins_text == (r.t // 100) * 60 + r.t % 100
        assert abs(r.mc - math.cos(r.m / 12 * 2 * math.pi)) < 1e-12
        assert abs(r.ms ** 2 + r.mc ** 2 - 1) < 1e-12
        n = lengths.get(r.m, 31)
        assert abs(r.ds - math.sin(r.d / n * 2 * math.pi)) < 1e-12 and abs(r.dc ** 2 + r.ds ** 2 - 1) < 1e-12

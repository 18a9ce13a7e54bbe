"""Long tails, sketches, label ranks, split joins and keyed draws: properties and bounds."""
import collections
import random

import pytest
from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import functions as F

from featureflow.operators import frequent, indexing, joins, sampling, sketches, stats


def records_shuffled(df):
    """Rows written by all exchanges of an executed plan."""
    total, nodes = 0, [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            nodes.append(node.plan())
            continue
        metric = node.metrics().get("shuffleRecordsWritten")
        if name == "ShuffleExchangeExec" and metric.isDefined():
            total += metric.get().value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


def expected(rows, threshold):
    """{value: n} above the threshold, the mode, NULLs and the rest of one column, by hand."""
    counts = collections.Counter(rows)
    null = counts.pop(None, 0)

    def number(v):
        try:
            return (1, float(v))
        except ValueError:
            return (0, 0.0)

    mode = min(counts, key=lambda v: (-counts[v], number(v), v)) if counts else None
    kept = {v: n for v, n in counts.items() if n > threshold * len(rows) or v == mode}
    return kept, mode, null, len(rows) - null - sum(kept.values())


@pytest.mark.parametrize("buckets", [16, 1024])
def test_frequent_counts_equal_plain_counts(spark, buckets):
    rng = random.Random(1)
    columns = {
        "unique": [f"u{i}" for i in range(3000)],
        "tail": [rng.choice(["a", "b"]) if rng.random() < 0.2 else f"t{i}" for i in range(3000)],
        "rare_mode": [rng.choice(["x", None]) if i % 150 == 0 else f"{i % 1400}" for i in range(3000)],
        "none": [None] * 3000,
        "one": ["same"] * 3000,
        "tied": [str(i % 4) for i in range(3000)],
    }
    label = [float(i % 7) if i % 5 else None for i in range(3000)]
    df = spark.createDataFrame(list(zip(*columns.values(), label, strict=True)),
                               ", ".join(f"{c} string" for c in columns) + ", y double").repartition(3)
    got = frequent.frequent_counts(df, list(columns), 0.02, "y", modes=True, buckets=buckets)
    for c, values in columns.items():
        kept, mode, null, rest = expected(values, 0.02)
        f = got[c]
        assert ({v: x.n for v, x in f.values.items()}, f.mode, f.null.n, f.rest.n) == (kept, mode, null, rest), c
        for v, x in [*f.values.items(), (None, f.null)]:
            ys = [y for w, y in zip(values, label, strict=True) if w == v and y is not None]
            assert x.label_n == len(ys) and abs(x.label_sum - sum(ys)) < 1e-6, (c, v)
    assert got["none"].imputed().bucketed(0.02, "Other") == {}
    rare = got["rare_mode"].imputed()
    assert rare.values[rare.mode].n == got["rare_mode"].values[rare.mode].n + got["rare_mode"].null.n


def test_frequent_counts_of_nothing(spark):
    df = spark.createDataFrame([], "a string, b double")
    assert frequent.frequent_counts(df, ["a", "b"], 0.1, modes=True) == {c: frequent.FeatureCounts(0) for c in "ab"}
    assert frequent.frequent_counts(df, [], 0.1) == {}
    with pytest.raises(ValueError):
        frequent.frequent_counts(df, ["a"], 0.0)
    signed = spark.createDataFrame([(0.0,), (-0.0,), (1.5,)], "b double")
    assert frequent.learn_modes(signed, ["b"]) == {"b": "0.0"}


def test_the_long_tail_is_not_shuffled(spark):
    """200,000 unique values beside two frequent ones: what is exchanged is bounded by slots and survivors."""
    df = spark.range(0, 200_000, 1, 4).select(
        F.when(F.col("id") % 10 == 0, F.lit("a")).when(F.col("id") % 10 == 1, F.lit("b"))
        .otherwise(F.concat(F.lit("v"), F.col("id"))).alias("c"))
    slots = frequent.slot_counts(df, ["c"], 1024)
    counted = {r["slot"]: r["n"] for r in slots.collect()}
    assert records_shuffled(slots) <= 4 * (frequent.STAGES * 1024 + 1)
    heavy = [[s for s, n in counted.items() if s // 1024 == k and n > 2000] for k in range(frequent.STAGES)]
    second = frequent.candidate_counts(df, {"c": heavy}, 1024, None)
    rows = second.collect()
    survivors = sum(r["kind"] == 1 for r in rows)
    assert survivors <= 10 and 0 < records_shuffled(second) <= 4 * (survivors + 2)
    plain = stats.value_stats(df, ["c"])
    plain.collect()
    assert records_shuffled(plain) > 150_000                         # what is saved


# ---------------------------------------------------------------- sketches
def test_sketched_quantiles_keep_their_rank_error(spark):
    rng = random.Random(2)
    rows = [(int(rng.expovariate(0.001)), rng.gauss(0, 1e6), None if i % 3 else i % 17) for i in range(60_000)]
    df = spark.createDataFrame(rows, "a int, b double, c long").repartition(40)
    probs = (0.01, 0.25, 0.5, 0.9)
    wanted = {(c, p): f"{c}{i}" for c in "abc" for i, p in enumerate(probs)}
    for error in (0.02, 0.002):
        out = sketches.approx_quantiles(df, wanted, error, fan_in=7)
        assert [t for _, t in out.dtypes] == ["int"] * 4 + ["double"] * 4 + ["bigint"] * 4
        row = out.first()
        for (c, p), name in wanted.items():
            values = sorted(r["abc".index(c)] for r in rows if r["abc".index(c)] is not None)
            below = sum(v < row[name] for v in values) / len(values)
            upto = sum(v <= row[name] for v in values) / len(values)
            assert below - error <= p <= upto + error, (c, p, error)


def test_sketches_merge_in_two_levels(spark):
    df = spark.range(0, 4000, 1, 40).select(F.col("id").cast("double").alias("x"))
    row = sketches.merged_sketches(df, ["x"], 64, fan_in=5)
    assert row.select(F.kll_sketch_get_n_double("s0")).first()[0] == 4000
    plan = row._jdf.queryExecution().executedPlan().toString()
    assert plan.count("kll_merge_agg_double") >= 1 and "hashpartitioning(_group" in plan
    assert records_shuffled(row) in (0, 40 + 5) or records_shuffled(row) <= 40 + 5


def test_sketched_quantiles_of_odd_columns(spark):
    df = spark.createDataFrame([(None, float("nan"), 1), (None, float("inf"), 2), (None, -1.0, None)],
                               "a long, b double, c int")
    row = sketches.approx_quantiles(df, {("a", 0.5): "a", ("b", 0.5): "b", ("c", 0.5): "c"}, 0.01).first()
    assert tuple(row) == (None, -1.0, 1)
    assert sketches.approx_quantiles(df.limit(0), {("c", 0.5): "c"}, 0.01).first()["c"] is None
    with pytest.raises(ValueError):
        sketches.approx_quantiles(df, {("a", 0.5): "a"}, 1e-9)
    assert stats.wants_exact(1e-9) and not stats.wants_exact(0.001)


# ---------------------------------------------------------------- labels
def test_more_labels_than_the_driver_takes(spark):
    """200,000 labels: ranks equal a plain sort, and rows, order and NULLs survive the join."""
    df = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 50 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("v"), F.col("id"))).alias("c"), "id")
    labels = indexing.label_table(df, ["c"])
    first = labels.orderBy("idx").limit(3).collect()
    assert [(r["value"], r["idx"]) for r in first] == [("hot", 0), ("v10", 1), ("v100002", 2)]
    k = labels.count()
    assert k == 192_001 and labels.agg(F.min("idx"), F.max("idx"), F.countDistinct("idx")).first()[:] == (0, k - 1, k)
    out = indexing.one_hot_columns(indexing.index_columns(df, labels, ["c"]), ["c"])
    got = out.filter("id in (0, 1, 10, 52)").orderBy("id").collect()
    assert [r["c_index"] for r in got][:2] == [0.0, float(k)] and out.count() == 200_000
    assert got[0]["c_binary"].size == k + 1 and got[2]["c_binary"].indices[0] == 1


def test_one_hot_names_no_slot(spark):
    """The encoder's vectors, without a schema that grows with the labels."""
    rows = [(x,) for x in (0.0, 1.0, 3.0, 4.0, 9.0, float("nan"), None)]
    for k in (5, 3_000_000):
        df = spark.createDataFrame(rows, "c_index double").withMetadata(
            "c_index", {"ml_attr": {"name": "c_index", "type": "nominal", "num_vals": k}})
        out = indexing.one_hot_columns(df, ["c"])
        assert len(out.schema["c_binary"].json()) < 1000
        got = [r["c_binary"] for r in out.collect()]
        assert got[-1] is None and all(v.size == k for v in got[:-1])
        assert [list(v.indices) for v in got[:-1]] == [[0], [1], [3], [4], [9] if k > 9 else [], []]
    encoder = OneHotEncoder(inputCols=["c_index"], outputCols=["e"], handleInvalid="keep", dropLast=True)
    small = df.filter("c_index < 5").withMetadata("c_index", {"ml_attr": {"type": "nominal", "num_vals": 5}})
    both = indexing.one_hot_columns(encoder.fit(small).transform(small), ["c"]).collect()
    assert both and all(r["e"] == r["c_binary"] for r in both)
    with pytest.raises(Exception, match="not an index"):
        indexing.one_hot_columns(spark.createDataFrame([(-1.0,)], "c_index double").withMetadata(
            "c_index", {"ml_attr": {"type": "nominal", "num_vals": 5}}), ["c"]).collect()


def test_indexing_adds_one_join_a_column(spark, monkeypatch):
    """Large label tables: hot, rare, unseen and missing values of two columns; the plan reads the rows once."""
    monkeypatch.setattr(indexing, "is_small", lambda df: False)
    rows = [(i, "hot" if i % 2 else f"a{i}", None if i % 5 == 0 else f"b{i % 40}", "") for i in range(4000)]
    df = spark.createDataFrame(rows, "id int, a string, b string, e string")
    labels = indexing.label_table(df.filter("id < 3000"), ["a", "b", "e"])
    idx = {(r["feature"], r["value"]): r["idx"] for r in labels.collect()}
    size = collections.Counter(f for f, _ in idx)
    out = indexing.index_columns(df, labels, ["a", "b", "e"])
    assert out.count() == 4000
    scans = out._jdf.queryExecution().optimizedPlan().collectLeaves()
    assert scans.size() <= 1 + 3 * 4                          # the rows once; labels and hot labels with their shifts
    for r in out.collect():
        for c in "abe":
            assert r[f"{c}_index"] == idx.get((c, r[c]), size[c])


def test_dense_ranks_by_feature_over_many_partitions(spark):
    rng = random.Random(3)
    rows = {(f, f"v{rng.randrange(900)}") for f in "abc" for _ in range(700)}
    rows = [(f, v, rng.randrange(1, 6)) for f, v in rows]
    got = indexing.dense_ranks(spark.createDataFrame(rows, "feature string, value string, n long"), 13).collect()
    for f in "abc":
        order = [v for _, v in sorted((-n, v) for g, v, n in rows if g == f)]
        assert [r["value"] for r in sorted(got, key=lambda r: r["idx"]) if r["feature"] == f] == order
        assert sorted(r["idx"] for r in got if r["feature"] == f) == list(range(len(order)))


# ---------------------------------------------------------------- joins
def skewed(spark):
    fact = spark.range(0, 6000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 10 == 1, F.lit(None))
        .otherwise(F.col("id") % 2000 * 5).cast("long").alias("k"), "id")
    dim = spark.range(1000).select((F.col("id") * 7).alias("k"), F.col("id").alias("w"))
    return fact, dim.unionByName(dim.filter("k = 7 OR k = 35"))          # two keys twice


@pytest.mark.parametrize("how", joins.SALTED_JOINS)
@pytest.mark.parametrize("small", [True, False])
def test_split_join_equals_the_plain_join(spark, monkeypatch, how, small):
    if not small:
        monkeypatch.setattr(joins, "is_small", lambda df: False)
    fact, dim = skewed(spark)
    got, want = joins.split_join(fact, dim, "k", how, share=0.01), fact.join(dim, "k", how)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    none = joins.split_join(fact, dim.limit(0), "k", how)
    assert sorted(map(str, none.collect())) == sorted(map(str, fact.join(dim.limit(0), "k", how).collect()))


def test_split_join_refuses_and_prefilters(spark, monkeypatch):
    fact, dim = skewed(spark)
    with pytest.raises(ValueError):
        joins.split_join(fact, dim, "k", "right")
    kept = joins.drop_unmatched(fact.filter("k IS NOT NULL"), dim, "k", dim.count())
    matched = fact.join(dim, "k", "left_semi").count()
    assert matched <= kept.count() < matched + 0.25 * (fact.count() - matched)
    monkeypatch.setattr(joins, "MAX_BITMAP_ROWS", 0)
    assert joins.drop_unmatched(fact, dim, "k", 10) is fact


# ---------------------------------------------------------------- draws
def test_samples_do_not_depend_on_the_layout(spark):
    df = spark.range(0, 20_000, 1, 3).select("id", (F.col("id") % 4).alias("s"))
    moved = df.repartition(11).sortWithinPartitions(F.desc("id"))
    for options in ({"fraction": 0.3}, {"fraction": 1.7, "with_replacement": True},
                    {"fraction": {0: 0.5, 2: 0.1}, "strata": "s"}):
        a = sorted(map(tuple, sampling.sample_by_key(df, ["id"], **options).collect()))
        assert a == sorted(map(tuple, sampling.sample_by_key(moved, ["id"], **options).collect()))
    train, test = sampling.random_split(df, 0.8, keys=["id"])
    assert {r["id"] for r in train.collect()} == {r["id"] for r in sampling.random_split(moved, 0.8, keys=["id"])[0].collect()}
    assert train.count() + test.count() == 20_000 and abs(train.count() - 16_000) < 300
    assert sampling.sample_by_key(df, ["id"], 0.5, seed=1).count() != sampling.sample_by_key(df, ["id"], 0.5, seed=2).count()


def test_draws_follow_their_distributions(spark):
    df = spark.range(40_000)
    copies = collections.Counter(collections.Counter(
        r["id"] for r in sampling.sample_by_key(df, ["id"], 0.7, with_replacement=True).collect()).values())
    # Poisson(0.7): P(1) = 0.3476, P(2) = 0.1217, P(3) = 0.0284
    for k, p in ((1, 0.3476), (2, 0.1217), (3, 0.0284)):
        assert abs(copies[k] / 40_000 - p) < 0.01
    assert sampling.poisson_limits(0.0) == [] and sampling.poisson_limits(100.0)[-1] < 1 << 60
    assert sampling.sample_by_key(df, ["id"], 0.0).count() == 0 and sampling.sample_by_key(df, ["id"], 1.0).count() == 40_000
    for bad in ({"fraction": 1.2}, {"fraction": -0.1, "with_replacement": True}, {"fraction": {1: 0.5}}):
        with pytest.raises(ValueError):
            sampling.sample_by_key(df, ["id"], **bad)


def test_strata_without_a_fraction_are_not_taken(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2] if i % 5 else None) for i in range(1000)], "id int, s string")
    got = collections.Counter(r["s"] for r in sampling.sample_by_key(df, ["id"], {"a": 1.0, None: 0.5}, strata="s").collect())
    assert got["a"] == 400 and got["b"] == 0 and 60 < got[None] < 140


def test_a_draw_is_computed_once_a_row(spark):
    """One md5 in the plan, whatever the strata and the copies; mean 100 has the most limits."""
    df = spark.range(3000).select("id", (F.col("id") % 3).cast("string").alias("s"))
    for fraction, again, strata in (({"0": 0.5, "1": 1.5}, True, "s"), (0.7, True, None), (100.0, True, None),
                                    ({"0": 0.5, None: 0.2}, False, "s"), (0.3, False, None)):
        out = sampling.sample_by_key(df, ["id"], fraction, again, strata=strata)
        assert out._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1
        draws = df.withColumn("u", sampling.draw(["id"])).collect()
        want = collections.Counter()
        for r in draws:
            share = (fraction if strata is None else fraction.get(r["s"])) or 0.0
            n = sum(x <= r["u"] for x in sampling.poisson_limits(share)) if again else int(r["u"] < share * 2 ** 60)
            want.update({(r["id"], r["s"]): n} if n else {})
        assert collections.Counter(map(tuple, out.collect())) == want and out.columns == df.columns

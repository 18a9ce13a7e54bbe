"""Profiling aggregates.

Every statistic is one declarative aggregate: partial (map-side) aggregation
collapses hot keys before the shuffle, so a category holding a third of the
rows costs no more than any other.  Per-feature work is done in one pass by
unpivoting the features into ``(feature, value)`` rows and grouping once.
Scalars that feed a second step (a row total, a min/max) are scalar
subqueries or one bounded row, never a cross join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from featureflow.functions.columns import is_missing
from featureflow.operators import frequent, gram, sketches
from featureflow.operators.joins import DEFAULT_MAX_BROADCAST_ROWS
from featureflow.operators.quantiles import exact_quantiles
from featureflow.session import checkpoint_root


def wants_exact(relative_error: float | None) -> bool:
    """No error is allowed, or a smaller one than any sketch has."""
    return relative_error is None or relative_error <= 0 or sketches.sketch_size(relative_error) is None


# ---------------------------------------------------------------- one-pass core
def unpivot_features(df: DataFrame, features: Sequence[str], ids: Sequence[str] = (),
                     value_col: str = "value") -> DataFrame:
    """Long form ``(ids..., feature, value)`` with every value as text."""
    feats = list(features)
    cast = df.select(*ids, *[text.alias(f) for f, text in frequent.as_text(df, feats).items()])
    return cast.unpivot(list(ids), feats, "feature", value_col)


def value_stats(df: DataFrame, features: Sequence[str], label: str | None = None) -> DataFrame:
    """``(feature, value, n[, label_n, label_sum])`` for every feature in ONE job.

    The NULL value is its own group (as ``groupBy`` does).  The label may be
    one of the features.
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    if label:
        df = df.withColumn("_label", F.col(label).cast(DoubleType()))
        aggs += [F.count("_label").alias("label_n"), F.sum("_label").alias("label_sum")]
    long = unpivot_features(df, features, ["_label"] if label else [])
    return long.groupBy("feature", "value").agg(*aggs)


def value_stats_with_total(df: DataFrame, features: Sequence[str], label: str | None = None) -> DataFrame:
    """value_stats plus ``total`` (rows of the source) from the SAME scan.

    The grouped table is checkpointed to the shared folder, so the totals
    (the groups of a feature add up to the row count) are summed over it and
    not over the source.
    """
    checkpoint_root(df.sparkSession)
    detail = value_stats(df, features, label).checkpoint(eager=True)
    totals = detail.groupBy("feature").agg(F.sum("n").alias("total"))
    # one row per feature: a proven bound for the broadcast
    return detail.join(F.broadcast(totals), on="feature", how="inner")


def mode_from_stats(stats: DataFrame) -> DataFrame:
    """``(feature, value, n)``: most frequent non-NULL value per feature.

    Ties go to the smallest value (numerically when the values are numbers,
    else as text).  A ``min`` over a struct is a partial aggregate, so no
    feature's groups are gathered into one task.
    """
    num = F.col("value").try_cast(DoubleType())
    best = (stats.filter(F.col("value").isNotNull())
            .groupBy("feature")
            .agg(F.min(F.struct((-F.col("n")).alias("neg_n"), num.alias("num"),
                                F.col("value").alias("value"))).alias("m")))
    return best.select("feature", F.col("m.value").alias("value"), (-F.col("m.neg_n")).alias("n"))


def modes(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mode of each feature, one job: ``(feature, value)``."""
    return mode_from_stats(value_stats(df, features)).select("feature", "value")


# ---------------------------------------------------------------- counts and shares
def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def proportions(df: DataFrame, column: str, decimals: int = 2) -> DataFrame:
    """``(column, count, proportion)``: percentage of rows per value (one scan)."""
    p = proportions_long(df, [column], decimals)
    return p.select(F.col("value").cast(df.schema[column].dataType).alias(column), "count", "proportion")


def proportions_long(df: DataFrame, features: Sequence[str], decimals: int = 2) -> DataFrame:
    """``(feature, value, count, proportion)`` for many features in one pass."""
    stats = value_stats_with_total(df, features)
    return stats.select("feature", "value", F.col("n").alias("count"),
                        F.round(F.col("n").cast(DoubleType()) * 100.0 / F.col("total"), decimals).alias("proportion"))


def frequencies(df: DataFrame, features: Sequence[str], label: str | None = None) -> DataFrame:
    """value_stats plus ``frequency`` = share of rows, one scan."""
    stats = value_stats_with_total(df, features, label)
    return stats.withColumn("frequency", F.col("n").cast(DoubleType()) / F.col("total")).drop("total")


def frequent_values(df: DataFrame, features: Sequence[str], threshold: float) -> DataFrame:
    """``(feature, value, frequency)`` with frequency > threshold, NULL excluded.

    At most ``floor(1/threshold)`` values per feature can pass, which is what
    bounds every table learned from it.  They are found with a multistage
    filter (``frequent``): the long tail of a near-unique column is never
    shuffled.  Without a threshold (0) all values are counted.
    """
    if not threshold > 0:
        return frequencies(df, features).filter(F.col("value").isNotNull()).select("feature", "value", "frequency")
    rows = [(f, v, c.n / counts.total) for f, counts in frequent.frequent_counts(df, features, threshold).items()
            for v, c in counts.values.items()]
    return df.sparkSession.createDataFrame(rows, "feature string, value string, frequency double")


def top_k(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values; ties by value (TakeOrderedAndProject)."""
    return value_counts(df, column).orderBy(F.col("count").desc(), F.col(column).asc()).limit(k)


def distinct_values(df: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    return df.select(F.col(column).alias(alias or column)).distinct()


# ---------------------------------------------------------------- label by category
def mean_by(df: DataFrame, column: str, label: str, alias: str = "avg_target") -> DataFrame:
    return df.groupBy(column).agg(F.avg(label).alias(alias))


def global_mean(df: DataFrame, label: str, alias: str = "global_mean") -> DataFrame:
    return df.agg(F.avg(label).alias(alias))


def top_k_rows(df: DataFrame, column: str, k: int) -> DataFrame:
    """Rows whose category is among the k most frequent: a left semi join with
    the top-k keys (k rows, broadcast while that bound is small)."""
    keys = top_k(df, column, k).select(column)
    return df.join(F.broadcast(keys) if k <= DEFAULT_MAX_BROADCAST_ROWS else keys, on=column, how="left_semi")


def top_k_mean(df: DataFrame, column: str, label: str, k: int = 20,
               alias: str = "avg_target") -> DataFrame:
    """Mean label of the rows whose category is among the k most frequent.

    Restricting rows to the top-k categories and then averaging per category
    equals averaging per category and keeping the top-k groups, so this is
    one aggregate (count and mean together) and a bounded top-k, one scan.
    """
    g = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"), F.avg(label).alias(alias))
    return g.orderBy(F.col("_n").desc(), F.col(column).asc()).limit(k).select(column, alias)


# ---------------------------------------------------------------- nulls
def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: NULL (and NaN for floating columns) count per column."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.agg(*[F.count(F.when(is_missing(c, types.get(c)), 1)).alias(c) for c in columns])


def null_percentages(df: DataFrame, columns: Sequence[str], decimals: int = 4) -> DataFrame:
    """``(feature, pct)`` highest first, from one aggregate."""
    types = {f.name: f.dataType for f in df.schema.fields}
    counts = df.agg(F.count(F.lit(1)).alias("_total"),
                    *[F.count(F.when(is_missing(c, types.get(c)), 1)).alias(c) for c in columns])
    long = counts.unpivot(["_total"], list(columns), "feature", "nulls")
    return (long.select("feature", F.round(F.col("nulls").cast(DoubleType()) * 100.0 / F.col("_total"),
                                           decimals).alias("pct"))
            .orderBy(F.col("pct").desc(), F.col("feature")))


# ---------------------------------------------------------------- numeric summaries
def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = (0.5,),
              relative_error: float | None = None) -> DataFrame:
    """One row: ``<col>_q<100p>`` for every column and probability.

    ``relative_error`` > 0: KLL sketches merged in two levels (``sketches``).
    ``None``: exact values from ``exact_quantiles`` (a number of binning passes
    bounded by the type).
    """
    names = {(c, p): f"{c}_q{int(round(p * 100))}" for c in columns for p in probs}
    if wants_exact(relative_error):
        vals = exact_quantiles(df, columns, probs)
        types = {f.name: f.dataType for f in df.schema.fields}
        return df.sparkSession.range(1).select(*[F.lit(vals[k]).cast(types[k[0]]).alias(n) for k, n in names.items()])
    return sketches.approx_quantiles(df, names, relative_error)


def quartiles(df: DataFrame, columns: Sequence[str], relative_error: float | None = None) -> dict:
    """{(column, p): value} for p in 0.25, 0.5, 0.75: three numbers a column reach the driver."""
    probs = (0.25, 0.5, 0.75)
    if wants_exact(relative_error):
        return exact_quantiles(df, columns, probs)
    keys = [(c, p) for c in columns for p in probs]
    row = sketches.approx_quantiles(df, {k: f"q{i}" for i, k in enumerate(keys)}, relative_error).first()
    return {k: row[i] for i, k in enumerate(keys)}


def summary_stats(df: DataFrame, columns: Sequence[str], relative_error: float | None = None) -> DataFrame:
    """``(feature, n, mean, stddev, mn, p25, p50, p75, mx)`` per numeric column.

    One aggregate over all columns, then the single row is turned long.
    Quartiles are exact (``relative_error=None``, bounded binning passes) or
    from KLL sketches of the given relative error (one more scan).
    """
    qs = quartiles(df, columns, relative_error)
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"),
                 F.stddev_samp(x).alias(f"sd{i}"), F.min(x).cast(DoubleType()).alias(f"mn{i}"),
                 F.max(x).cast(DoubleType()).alias(f"mx{i}")]
    row = df.agg(*aggs)

    def q(c, p):
        return F.lit(qs[(c, p)]).cast(DoubleType())

    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("n"), F.col(f"mean{i}").alias("mean"),
                     F.col(f"sd{i}").alias("stddev"), F.col(f"mn{i}").alias("mn"),
                     q(c, 0.25).alias("p25"), q(c, 0.5).alias("p50"), q(c, 0.75).alias("p75"),
                     F.col(f"mx{i}").alias("mx"))
            for i, c in enumerate(columns)]
    return row.select(F.inline(F.array(*rows)))


PAIRWISE_COLUMNS = 16


def correlation(a, b):
    """Pearson correlation of the rows where both are known; NULL, not an error, if one is constant there."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    a, b = a.cast(DoubleType()), b.cast(DoubleType())
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def corr_matrix(df: DataFrame, columns: Sequence[str], zero_fill: bool = True) -> DataFrame:
    """Pearson correlation, long form ``(feature_a, feature_b, corr)`` for all pairs.

    NULLs are zero-filled first (as the profiling job does).  Up to
    ``PAIRWISE_COLUMNS`` columns one aggregate computes the k(k+1)/2 distinct
    pairs; more come from a Gramian over blocks of columns (``gram``), whose
    plan does not grow with the pairs.  A constant column has NULL.
    """
    cols = list(columns)
    if len(cols) > PAIRWISE_COLUMNS:
        return gram.correlations(df, cols, zero_fill)
    data = df.select(*cols)
    if zero_fill:
        data = data.fillna(0, subset=cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = data.agg(*[correlation(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    structs = []
    for i, (a, b) in enumerate(pairs):
        structs.append(F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
                                F.col(f"c{i}").alias("corr")))
        if a != b:
            structs.append(F.struct(F.lit(b).alias("feature_a"), F.lit(a).alias("feature_b"),
                                    F.col(f"c{i}").alias("corr")))
    return row.select(F.inline(F.array(*structs)))


def histogram(df: DataFrame, column: str, bins: int = 30, lo: float | None = None,
              hi: float | None = None) -> DataFrame:
    """``(bin, n)``: equal-width bins 1..bins, the last bin closed.

    With ``lo``/``hi`` rows outside the range are left out (display clipping);
    otherwise the range is the column's min/max (one bounded row).  NULL and NaN
    are in no bin.
    """
    x = F.col(column).cast(DoubleType())
    data = df.select(x.alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    if lo is not None and hi is not None:
        data = data.filter(F.col("x").between(lo, hi))
    else:
        mm = data.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
        if mm is None or mm["lo"] is None:
            return data.select(F.lit(None).cast("int").alias("bin"), F.lit(0).cast("long").alias("n")).limit(0)
        lo, hi = float(mm["lo"]), float(mm["hi"])
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.lit(bins), F.floor((F.col("x") - F.lit(lo)) / F.lit(width)).cast("int") + 1)
    return data.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def histograms(df: DataFrame, columns: Sequence[str], bins: int = 30, ranges: dict | None = None) -> DataFrame:
    """``(feature, bin, n)`` for many numeric columns: one aggregate for the
    ranges (a single bounded row), one unpivot + group for the counts."""
    ranges = dict(ranges or {})
    free = [c for c in columns if c not in ranges]
    if free:
        def number(c):
            x = F.col(c).cast(DoubleType())
            return F.when(~F.isnan(x), x)

        row = df.agg(*[F.min(number(c)).alias(f"lo{i}") for i, c in enumerate(free)],
                     *[F.max(number(c)).alias(f"hi{i}") for i, c in enumerate(free)]).first()
        for i, c in enumerate(free):
            if row[f"lo{i}"] is not None:
                ranges[c] = (float(row[f"lo{i}"]), float(row[f"hi{i}"]))
    cols = [c for c in columns if c in ranges]
    if not cols:
        return df.sparkSession.createDataFrame([], "feature string, bin int, n long")
    long = df.select(*[F.col(c).cast(DoubleType()).alias(c) for c in cols]).unpivot([], cols, "feature", "x")
    lo = {c: ranges[c][0] for c in cols}
    width = {c: ((ranges[c][1] - ranges[c][0]) / bins) if ranges[c][1] > ranges[c][0] else 1.0 for c in cols}
    hi = {c: ranges[c][1] for c in cols}
    from featureflow.functions.columns import lookup
    flo, fw, fhi = lookup("feature", lo), lookup("feature", width), lookup("feature", hi)
    kept = long.filter(F.col("x").isNotNull() & ~F.isnan("x") & (F.col("x") >= flo) & (F.col("x") <= fhi))
    b = F.least(F.lit(bins), F.floor((F.col("x") - flo) / fw).cast("int") + 1)
    return kept.groupBy("feature", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def top_k_per_feature(stats_table: DataFrame, features: Sequence[str], k: int) -> DataFrame:
    """``(feature, value, n)``: the k most frequent values of each feature.

    ``row_number() <= k`` over a per-feature window: Spark plans it with a
    WindowGroupLimit on both sides of the shuffle, so each map task forwards
    at most k rows per feature and no task ever holds a feature's full value
    list.  One pass over the count table for all features.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("feature").orderBy(F.col("n").desc(), F.col("value").asc_nulls_last())
    ranked = (stats_table.filter(F.col("feature").isin(list(features)))
              .select("feature", "value", "n", F.row_number().over(w).alias("_rn")))
    return ranked.filter(F.col("_rn") <= k).drop("_rn")


def dataset_shape(df: DataFrame) -> DataFrame:
    """One row ``(n_rows, n_columns)``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))

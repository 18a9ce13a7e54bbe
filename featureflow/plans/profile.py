"""Exploratory profile of a feature table.

Produces the tables behind every chart of the exploratory pass as long
DataFrames (charts themselves are not rendered): shape, null shares,
summary statistics, value proportions, top-k categories, histograms,
mean label per category and the correlation matrix.

Numeric work is ONE aggregate (null counts, summary statistics, zero-filled
correlations and histogram ranges together; its single row is checkpointed)
plus one unpivot for all histograms and one for the value proportions.
Categorical work is ONE ``(feature, value)`` count/label-sum pass; null
shares, proportions, top-k and mean labels are all read from it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from featureflow.functions.columns import is_missing
from featureflow.operators import stats
from featureflow.plans.features import static_features
from featureflow.session import checkpoint_root
from featureflow.spec import FeatureSpec


def profile(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str | None = None,
            top_k: int = 15, mean_top_k: int = 20, mean_top_k_features: Sequence[str] = (),
            bins: int = 30, clip: dict | None = None, relative_error: float | None = 0.001,
            mean_numeric_features: Sequence[str] = ()) -> dict:
    """Return ``{name: DataFrame}``; nothing is collected except bounded rows
    (histogram ranges).  Tables grouped by numeric values, which may be as long
    as the input, are computed only when they are read: the proportions, the
    mean label by ``mean_numeric_features`` and all values of the label."""
    numeric = [c for c in numeric if c in df.columns]
    categorical = [c for c in categorical if c in df.columns]
    out = {"shape": stats.dataset_shape(df)}
    if numeric:
        row, ranges = _numeric_overview(df, numeric, relative_error)
        out["shape"] = row.select(F.col("_total").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))
        out["null_pct_numeric"] = row.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("feature"),
                     F.round(F.col(f"null{i}").cast(DoubleType()) * 100.0 / F.col("_total"), 4).alias("pct"))
            for i, c in enumerate(numeric)]))).orderBy(F.col("pct").desc(), F.col("feature"))
        out["summary_numeric"] = _summary_from(row, df, numeric, relative_error)
        out["correlation"] = (_corr_from(row, numeric) if len(numeric) <= stats.PAIRWISE_COLUMNS
                              else stats.corr_matrix(df, numeric))
        clipped = {k: v for k, v in (clip or {}).items() if k in numeric}
        out["histograms"] = stats.histograms(df, numeric, bins, {**ranges, **clipped})
        out["proportions_numeric"] = _shares(stats.value_stats(df, numeric), row.select("_total").scalar())
    if categorical:
        lab = label if label and label in df.columns else None
        # the shared (feature, value) table is small; a reliable checkpoint in the
        # shared folder computes it once for all the tables below
        checkpoint_root(df.sparkSession)
        counts = stats.value_stats(df, categorical, lab).checkpoint(eager=True)
        total = counts.filter(F.col("feature") == F.lit(categorical[0])).agg(F.sum("n")).scalar()
        out["null_pct_categorical"] = (
            counts.groupBy("feature")
            .agg(F.round(F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(F.lit(0))).cast(DoubleType())
                         * 100.0 / total, 4).alias("pct"))
            .orderBy(F.col("pct").desc(), F.col("feature")))
        out["proportions_categorical"] = _shares(counts, total)
        out["top_categories"] = stats.top_k_per_feature(counts, categorical, top_k)
        if lab:
            per_value = counts.select("feature", "value", F.when(F.col("label_n") > 0, F.col("label_sum") / F.col("label_n"))
                                      .alias("avg_target"), "n")
            limited = [f for f in mean_top_k_features if f in categorical]
            rest = per_value.filter(~F.col("feature").isin(limited)) if limited else per_value
            if limited:
                top = stats.top_k_per_feature(counts, limited, mean_top_k).select("feature", "value")
                rest = rest.unionByName(per_value.join(F.broadcast(top), ["feature", "value"], "left_semi"))
            out["mean_target"] = rest
    if label and label in df.columns:
        rows = df.select(F.count(F.lit(1))).scalar()
        out["label_distribution"] = _shares(stats.value_stats(df, [label]), rows)
        grouped = [c for c in mean_numeric_features if c in df.columns]
        if grouped:
            out["mean_target_numeric"] = stats.value_stats(df, grouped, label).select(
                "feature", "value",
                F.when(F.col("label_n") > 0, F.col("label_sum") / F.col("label_n")).alias("avg_target"), "n")
    return out


def profile_frame(fact: DataFrame, dim: DataFrame | None, spec: FeatureSpec, years: Sequence[str] = ()) -> DataFrame:
    """What the profile describes: the joined table, typed, rows without label out.

    Unlike the feature table it keeps cancelled rows and the identifier
    columns.  ``years`` are categories profiled as numbers too: cast like the
    numeric columns.
    """
    df = static_features(fact, dim, replace(spec, exclude=None, useless=(), cyclic=()))
    return df.withColumns({c: F.col(c).try_cast(spec.cast_type) for c in years if c in df.columns})


def _shares(counts: DataFrame, total) -> DataFrame:
    """``(feature, value, count, proportion)``: percentages of ``total`` from a count table."""
    return counts.select("feature", "value", F.col("n").alias("count"),
                         F.round(F.col("n").cast(DoubleType()) * 100.0 / total, 2).alias("proportion"))


def _numeric_overview(df: DataFrame, cols: Sequence[str], relative_error: float | None):
    """One aggregate over all numeric columns, checkpointed (one row).

    Returns the row DataFrame and ``{column: (min, max)}`` for the histograms.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("_total")]
    for i, c in enumerate(cols):
        x = F.col(c)
        aggs += [F.count(x).alias(f"n{i}"), F.count(F.when(is_missing(c, types.get(c)), 1)).alias(f"null{i}"),
                 F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"sd{i}"),
                 F.min(x).cast(DoubleType()).alias(f"mn{i}"), F.max(x).cast(DoubleType()).alias(f"mx{i}")]
    zero = {c: F.nanvl(F.coalesce(F.col(c).cast(DoubleType()), F.lit(0.0)), F.lit(0.0)) for c in cols}
    for i, a in enumerate(cols if len(cols) <= stats.PAIRWISE_COLUMNS else ()):
        for j in range(i, len(cols)):
            aggs.append(stats.correlation(zero[a], zero[cols[j]]).alias(f"c{i}_{j}"))
    checkpoint_root(df.sparkSession)
    row = df.agg(*aggs).checkpoint(eager=True)
    r = row.first()
    ranges = {c: (r[f"mn{i}"], r[f"mx{i}"]) for i, c in enumerate(cols) if r[f"mn{i}"] is not None}
    return row, ranges


def _summary_from(row: DataFrame, df: DataFrame, cols: Sequence[str], relative_error: float | None) -> DataFrame:
    qs = stats.quartiles(df, cols, relative_error)

    def q(c, p):
        return F.lit(qs[(c, p)]).cast(DoubleType())

    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("n"), F.col(f"mean{i}").alias("mean"),
                 F.col(f"sd{i}").alias("stddev"), F.col(f"mn{i}").alias("mn"), q(c, 0.25).alias("p25"),
                 q(c, 0.5).alias("p50"), q(c, 0.75).alias("p75"), F.col(f"mx{i}").alias("mx"))
        for i, c in enumerate(cols)])))


def _corr_from(row: DataFrame, cols: Sequence[str]) -> DataFrame:
    structs = []
    for i, a in enumerate(cols):
        for j in range(i, len(cols)):
            b = cols[j]
            structs.append(F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
                                    F.col(f"c{i}_{j}").alias("corr")))
            if a != b:
                structs.append(F.struct(F.lit(b).alias("feature_a"), F.lit(a).alias("feature_b"),
                                        F.col(f"c{i}_{j}").alias("corr")))
    return row.select(F.inline(F.array(*structs)))


def write_profile(tables: dict, out_dir: str, fmt: str = "parquet") -> None:
    """One folder per table; long tables are partitioned by feature."""
    for name, df in tables.items():
        w = df.write.mode("overwrite")
        if "feature" in df.columns and name.startswith(("proportions", "label_distribution")):
            w = w.partitionBy("feature")
        if fmt == "csv":
            w.option("header", True).csv(f"{out_dir}/{name}")
        else:
            w.parquet(f"{out_dir}/{name}")


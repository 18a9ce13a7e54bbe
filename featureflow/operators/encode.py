"""Category encoders.

* rare values -> "Other" against a learned frequent-value list
* string index (frequency descending, ties alphabetical) and one-hot
* mean-target encoding with a fallback row for "Other"

Learned tables are bounded: a value is kept only when its share exceeds
``threshold``, so at most floor(1/threshold) values per feature survive, and
a mean-target table has at most that many rows plus "Other".
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from featureflow.functions.columns import bucket_rare
from featureflow.operators import stats
from featureflow.operators.joins import maybe_broadcast
from featureflow.session import checkpoint_root

OTHER = "Other"
MAX_LABELS = 100_000


def bound_for(threshold: float) -> int | None:
    """Most values that can have a share above ``threshold``."""
    return None if threshold <= 0 else int(math.floor(1.0 / threshold))


def learn_frequent(df: DataFrame, features: Sequence[str], threshold: float) -> dict:
    """{feature: sorted list of values with share > threshold}, NULL never kept."""
    out = {f: [] for f in features}
    if not features:
        return out
    for r in stats.frequent_values(df, features, threshold).collect():
        out[r["feature"]].append(r["value"])
    return {f: sorted(v) for f, v in out.items()}


def rare_to_other(df: DataFrame, frequent: dict, suffix: str = "_aggregated") -> DataFrame:
    """Add ``<feature><suffix>``: the value if frequent, else "Other" (NULL stays NULL)."""
    return df.withColumns({f"{f}{suffix}": bucket_rare(f, keep) for f, keep in frequent.items()})


def encoder_choice(frequent: dict, cardinality_threshold: int = 10,
                   strategy: str = "mean") -> dict:
    """{feature: "binary" | "mean" | "ignore"}: one-hot while frequent values + 1
    (the "Other" slot) fit under ``cardinality_threshold``."""
    out = {}
    for f, keep in frequent.items():
        if len(keep) + 1 <= cardinality_threshold:
            out[f] = "binary"
        elif strategy in ("mean", "ignore"):
            out[f] = strategy
        else:
            raise NotImplementedError(f"unknown high-cardinality strategy {strategy!r}")
    return out


# ---------------------------------------------------------------- mean target encoding
def mean_target_table(df: DataFrame, column: str, label: str, out_col: str,
                      fallback: float | None = None) -> DataFrame:
    """``(column, out_col)``: mean label per value, plus an "Other" row when absent.

    The key is unique and text, whatever the type of the column ("Other" is a
    key too).  The fallback for "Other" is the global mean label unless given
    (NULL without any label).  The grouped table is checkpointed to the shared
    folder; the fallback row is an aggregate over it, not over the rows.
    """
    y = F.col(label).cast(DoubleType())
    checkpoint_root(df.sparkSession)
    sums = (df.groupBy(F.col(column).cast(StringType()).alias(column))
            .agg(F.avg(y).alias(out_col), F.sum(y).alias("_sum"), F.count(y).alias("_n")).checkpoint(eager=True))
    mean = F.when(F.sum("_n") > 0, F.sum("_sum") / F.sum("_n"))
    extra = (sums.agg((mean if fallback is None else F.lit(float(fallback))).alias(out_col),
                      F.count(F.when(F.col(column) == F.lit(OTHER), 1)).alias("_others"))
             .filter(F.col("_others") == 0).select(F.lit(OTHER).alias(column), out_col))
    return sums.select(column, out_col).unionByName(extra)


def mean_encode(df: DataFrame, table: DataFrame, column: str, out_col: str,
                default=None, bound: int | None = None) -> DataFrame:
    """Left lookup join with a learned (key -> mean) table; unmatched rows get
    ``default`` (a number or a Column).  The table is broadcast when its size is
    proven small: by ``bound`` from the frequency threshold, else it is computed
    once into the shared checkpoint folder and its rows and bytes are counted there."""
    if bound is None:
        checkpoint_root(df.sparkSession)
        table = table.checkpoint(eager=True)
    if isinstance(table.schema[column].dataType, StringType) and not isinstance(df.schema[column].dataType, StringType):
        # learned keys are text: compare the column as text, keep its own type
        keyed = maybe_broadcast(table.withColumnRenamed(column, "_key"), known_bound=bound)
        joined = df.join(keyed, F.col(column).cast(StringType()) == F.col("_key"), "left").drop("_key")
    else:
        joined = df.join(maybe_broadcast(table, known_bound=bound), on=column, how="left")
    if default is None:
        return joined
    d = default if not isinstance(default, (int, float)) else F.lit(float(default))
    return joined.withColumn(out_col, F.coalesce(F.col(out_col), d))


def median_default_encode(df: DataFrame, table: DataFrame, column: str, out_col: str,
                          label: str, relative_error: float | None = 0.001) -> DataFrame:
    """Lookup encoding whose default is the label median (approximate with
    ``relative_error``, exact when it is None)."""
    median = stats.quantiles(df, [label], (0.5,), relative_error).first()[0]
    return mean_encode(df, table, column, out_col, default=F.lit(median).cast(df.schema[label].dataType))


# ---------------------------------------------------------------- index / one-hot
def index_labels_from_counts(counts: dict) -> list:
    """StringIndexer ``frequencyDesc`` order: count descending, then value."""
    return [v for v, _ in sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))]


def learn_index_labels(df: DataFrame, columns: Sequence[str], max_labels: int = MAX_LABELS) -> dict:
    """{column: labels}: frequency-descending order, one scan for all columns.

    Labels live in the driver and in every task, so more than ``max_labels`` of
    them are refused; bucket rare values first (``rare_to_other``).
    """
    checkpoint_root(df.sparkSession)
    counts = stats.value_stats(df, columns).filter(F.col("value").isNotNull()).checkpoint(eager=True)
    n = counts.count()
    if n > max_labels:
        raise ValueError(f"{n} distinct values in {list(columns)}, more than {max_labels} labels: "
                         "bucket rare values first")
    out = {c: {} for c in columns}
    for r in counts.collect():
        out[r["feature"]][r["value"]] = r["n"]
    return {c: index_labels_from_counts(v) for c, v in out.items()}


def string_indexers(labels: dict, suffix_in: str = "", suffix_out: str = "_index") -> list[StringIndexerModel]:
    """Fitted StringIndexerModels, one per column (unseen / NULL -> extra index).

    One model per column: the multi-column constructor pads shorter label
    lists with NULL labels, which corrupts the category metadata.
    """
    return [StringIndexerModel.from_labels(list(labels[c]), inputCol=f"{c}{suffix_in}",
                                           outputCol=f"{c}{suffix_out}", handleInvalid="keep")
            for c in labels]


def one_hot(df: DataFrame, labels: dict, suffix_in: str = "", index_suffix: str = "_index",
            out_suffix: str = "_binary") -> DataFrame:
    """Index then one-hot encode.  ``dropLast=True`` with ``keep``: a feature with
    k labels gives a vector of k+1 slots, the last one for NULL/unseen."""
    if not labels:
        return df
    for c in labels:
        df = df.withColumn(f"{c}{suffix_in}", F.col(f"{c}{suffix_in}").cast(StringType()))
    indexed = df
    for m in string_indexers(labels, suffix_in, index_suffix):
        indexed = m.transform(indexed)
    cols = list(labels)
    ohe = OneHotEncoder(inputCols=[f"{c}{index_suffix}" for c in cols],
                        outputCols=[f"{c}{out_suffix}" for c in cols],
                        handleInvalid="keep", dropLast=True)
    # the index columns carry their category count in the column metadata,
    # so this fit reads no data
    return ohe.fit(indexed).transform(indexed)

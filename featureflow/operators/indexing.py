"""String index and one-hot without a limit on labels.

Labels are ranked where they lie: the counted values are range-partitioned by
(feature, count descending, value), numbered inside each partition, and shifted
by the sizes of the partitions before it.  The label table stays a DataFrame
that is joined in; what reaches the driver is one number per feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from featureflow.operators import stats
from featureflow.operators.joins import HEAVY_SHARE, is_small
from featureflow.session import checkpoint_root

SALTS = 4096                    # tasks that settled rows and NULLs are spread over
_PLACE = (1 << 33) - 1          # monotonically_increasing_id: partition in the upper bits, place in the lower 33


def dense_ranks(counts: DataFrame, partitions: int | None = None) -> DataFrame:
    """(feature, value, n, idx): idx counts a feature's values from 0, most rows first, ties by value.

    ``counts`` is (feature, value, n) without repeated (feature, value).  One
    range partitioning; no task holds a whole feature, and no window spans more
    rows than there are partitions.
    """
    order = [F.col("feature"), F.col("n").desc(), F.col("value")]
    spread = counts.repartitionByRange(partitions, *order) if partitions else counts.repartitionByRange(*order)
    checkpoint_root(counts.sparkSession)
    # the checkpoint fixes the partitions: the ids stay what they are
    placed = (spread.sortWithinPartitions(*order).select("feature", "value", "n", F.monotonically_increasing_id().alias("_id"))
              .select("feature", "value", "n", F.shiftrightunsigned("_id", 33).alias("_part"),
                      F.col("_id").bitwiseAND(F.lit(_PLACE)).alias("_place")).checkpoint(eager=True))
    runs = placed.groupBy("feature", "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.partitionBy("feature").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = runs.select("feature", "_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    # one row per feature and partition it touches: at most features + partitions rows, computed once
    shifts = shifts.checkpoint(eager=True)
    return (placed.join(F.broadcast(shifts), ["feature", "_part"])
            .select("feature", "value", "n", (F.col("_place") + F.col("_shift")).alias("idx")))


def label_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n, idx) of the columns' values as text, NULL left out: ``StringIndexer``'s
    ``frequencyDesc`` order for any number of labels.  Ranked once, into the shared checkpoint folder."""
    checkpoint_root(df.sparkSession)
    counts = stats.value_stats(df, columns).filter(F.col("value").isNotNull()).checkpoint(eager=True)
    return dense_ranks(counts)


def index_columns(df: DataFrame, labels: DataFrame, columns: Sequence[str], suffix: str = "_index") -> DataFrame:
    """``df`` with ``<column><suffix>``: the label's index as a double, the number of labels for NULL and unseen values.

    A small label table is broadcast.  Of a large one only the labels of many rows
    (``HEAVY_SHARE``: at most 1/share) are; one shuffle join finds the others, in
    which rows that need it no more, and NULLs, are spread by a hash of the row.
    Every column adds one join to the plan, however many there are.  Rows are never lost or repeated.
    """
    sizes = {r["feature"]: (r["labels"], r["rows"]) for r in labels.groupBy("feature").agg(
        F.count(F.lit(1)).alias("labels"), F.sum("n").alias("rows")).collect()}
    for c in columns:
        k, rows = sizes.get(c, (0, 0))
        known = labels.filter(F.col("feature") == c).select(F.col("value").alias("_value"), F.col("idx").alias("_idx"), "n")
        keyed = df.withColumn("_value", stats.frequent.as_text(df, [c])[c].cast(StringType()))
        if is_small(known.drop("n")):
            joined = keyed.join(F.broadcast(known.drop("n")), "_value", "left")
        else:
            hot = known.filter(F.col("n") > F.lit(HEAVY_SHARE) * F.lit(rows)).select("_value", F.col("_idx").alias("_hot"))
            hashed = [F.col(f"`{name}`") for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
            settled = F.col("_value").isNull() | F.col("_hot").isNotNull()
            salted = keyed.join(F.broadcast(hot), "_value", "left").withColumns({
                "_value": F.coalesce("_value", F.lit("")),
                "_salt": F.when(settled, F.pmod(F.xxhash64(*hashed), F.lit(SALTS)) + F.lit(1)).otherwise(F.lit(0).cast("long"))})
            rest = known.select("_value", "_idx", F.lit(0).cast("long").alias("_salt"))
            joined = (salted.join(rest, ["_value", "_salt"], "left")
                      .withColumn("_idx", F.coalesce("_hot", "_idx")).drop("_hot", "_salt"))
        # the number of values is all an encoder needs to know; no label is listed
        index = F.coalesce(F.col("_idx"), F.lit(k)).cast("double")
        df = joined.withColumn(f"{c}{suffix}", index).drop("_value", "_idx").withMetadata(
            f"{c}{suffix}", {"ml_attr": {"name": f"{c}{suffix}", "type": "nominal", "num_vals": k + 1}})
    return df


def one_hot_columns(df: DataFrame, columns: Sequence[str], index_suffix: str = "_index",
                    suffix: str = "_binary") -> DataFrame:
    """Sparse one-hot vectors of indexed columns: labels + 1 slots, the last one for NULL and unseen values.

    What ``OneHotEncoder(handleInvalid="keep", dropLast=True)`` gives, but for its
    metadata: the encoder names every slot in the schema, which the driver cannot
    hold for millions of labels; here the schema says how many there are.
    Indices beyond the slots (or NaN) give a vector without any 1, NULL stays NULL, negative or broken ones are an error.
    The slots come from the columns' metadata; only without it rows are read (the largest index).
    """
    out = {}
    for c in columns:
        index = F.col(f"{c}{index_suffix}").cast("double")
        slots = _slots_of(df, f"{c}{index_suffix}")
        place = (F.when(F.isnan(index) | (index >= slots), F.lit(""))
                 .when((index < 0) | (index != F.floor(index)),
                       F.raise_error(F.concat(F.lit("not an index: "), index.cast("string"))))
                 .otherwise(index.cast("int").cast("string")))
        one = F.when(place == "", F.lit("")).otherwise(F.lit("1.0"))
        # a sparse vector's fields as Spark stores them: type 0, size, indices, values
        text = F.concat(F.lit(f'{{"v":{{"type":0,"size":{slots},"indices":['), place, F.lit('],"values":['), one, F.lit("]}}"))
        out[f"{c}{suffix}"] = F.from_json(text, StructType([StructField("v", VectorUDT())]))["v"]
    df = df.withColumns(out)
    for c in columns:
        df = df.withMetadata(f"{c}{suffix}", {"ml_attr": {"num_attrs": _slots_of(df, f"{c}{index_suffix}")}})
    return df


def _slots_of(df: DataFrame, column: str) -> int:
    about = df.schema[column].metadata.get("ml_attr", {})
    if "num_vals" in about or "vals" in about:
        return about.get("num_vals") or len(about["vals"])
    top = df.agg(F.max(column)).first()[0]
    return 0 if top is None else int(top) + 1

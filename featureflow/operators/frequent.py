"""Frequent values and modes without shuffling the long tail.

A multistage filter.  Scan 1 counts rows per (feature, slot): every value has
one slot in each of two stages, cut from one 64-bit hash.  A slot holds at
least the rows of each of its values, so a value above the threshold has a slot
above it in every stage.  Scan 2 groups only values whose slots all are above
it; every other row goes straight to "rest".  What crosses the exchange is
bounded by the slots and the survivors, however many distinct values there are.

The most frequent value of a feature without any frequent value is found
exactly too: one slot's best value gives a lower bound, and a third scan groups
only values whose slots all reach that bound (for a column of unique values
nothing can be ruled out, and its values are grouped).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

STAGES = 2
BUCKETS = 2048                  # slots of a stage, at least; 32 / threshold when that is more
MAX_BUCKETS = 1 << 20           # STAGES * 20 bits of one hash
_NULL = -1                      # the slot of NULL
_NOWHERE = -2                   # the slot of no value


@dataclass
class Counts:
    """Rows, rows with a label, and the sum of labels."""
    n: int = 0
    label_n: int = 0
    label_sum: float = 0.0

    def __add__(self, other: Counts) -> Counts:
        return Counts(self.n + other.n, self.label_n + other.label_n, self.label_sum + other.label_sum)

    def __sub__(self, other: Counts) -> Counts:
        return Counts(self.n - other.n, self.label_n - other.label_n, self.label_sum - other.label_sum)


@dataclass
class FeatureCounts:
    """A feature's values above the threshold (and its mode), its NULLs and all other rows."""
    total: int
    values: dict[str, Counts] = field(default_factory=dict)
    null: Counts = field(default_factory=Counts)
    rest: Counts = field(default_factory=Counts)
    mode: str | None = None

    def imputed(self) -> FeatureCounts:
        """The counts after NULLs were filled with the mode (without a mode they stay)."""
        if self.mode is None:
            return self
        values = {**self.values, self.mode: self.values[self.mode] + self.null}
        return FeatureCounts(self.total, values, Counts(), self.rest, self.mode)

    def frequent(self, threshold: float) -> list[str]:
        return sorted(v for v, c in self.values.items() if c.n > threshold * self.total)

    def bucketed(self, threshold: float, other: str) -> dict[str, Counts]:
        """Counts per frequent value, everything else but NULL under ``other`` (absent without rows)."""
        keep = set(self.frequent(threshold))
        out = {v: c for v, c in self.values.items() if v in keep}
        rest = sum((c for v, c in self.values.items() if v not in keep), self.rest)
        if rest.n:
            out[other] = out.get(other, Counts()) + rest
        return out


def as_text(df: DataFrame, features: Sequence[str]) -> dict[str, Column]:
    """Each feature as text; adding 0.0 makes one value of 0.0 and -0.0, as groupBy does."""
    types = dict(df.dtypes)
    return {f: (F.col(f) + F.lit(0.0) if types[f] in ("float", "double") else F.col(f)).cast(StringType())
            for f in features}


def _slots(value: Column, buckets: int) -> list[Column]:
    h = F.xxhash64(value)
    return [F.shiftrightunsigned(h, 20 * s).bitwiseAND(F.lit(buckets - 1)) + F.lit(s * buckets) for s in range(STAGES)]


def _buckets_for(threshold: float) -> int:
    wanted = max(BUCKETS, int(32 / threshold))
    return min(MAX_BUCKETS, 1 << (wanted - 1).bit_length())


def slot_counts(df: DataFrame, features: Sequence[str], buckets: int) -> DataFrame:
    """Scan 1: (feature, slot, n) for the slots of all stages and NULL."""
    text = as_text(df, features)
    wide = df.select(*[F.when(v.isNull(), F.array(F.lit(_NULL).cast("long"))).otherwise(F.array(*_slots(v, buckets)))
                       .alias(f) for f, v in text.items()])
    return (wide.unpivot([], list(features), "feature", "slots").select("feature", F.explode("slots").alias("slot"))
            .groupBy("feature", "slot").agg(F.count(F.lit(1)).alias("n")))


def candidate_counts(df: DataFrame, slots: dict[str, list[list[int]]], buckets: int, label: str | None) -> DataFrame:
    """Scan 2 and 3: (feature, kind, value, n, label_n, label_sum).

    ``slots`` names, per feature and stage, the slots a value must be in (an
    empty list: any).  kind is 1 for such values, 0 for NULL and 2 for all other
    rows, which lose their value before they are grouped.
    """
    text = as_text(df, slots)

    def tagged(f):
        v = text[f]
        inside = F.lit(True)
        for place, allowed in zip(_slots(v, buckets), slots[f], strict=True):
            if allowed:
                inside = inside & place.isin(allowed)
        return (F.when(v.isNull(), F.struct(F.lit(0).alias("kind"), v.alias("value")))
                .when(inside, F.struct(F.lit(1).alias("kind"), v.alias("value")))
                .otherwise(F.struct(F.lit(2).alias("kind"), F.lit(None).cast("string").alias("value"))).alias(f))

    y = F.col(label).cast(DoubleType()) if label else F.lit(None).cast(DoubleType())
    long = df.select(y.alias("_label"), *[tagged(f) for f in slots]).unpivot(["_label"], list(slots), "feature", "tag")
    return long.groupBy("feature", F.col("tag.kind").alias("kind"), F.col("tag.value").alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.count("_label").alias("label_n"),
        F.coalesce(F.sum("_label"), F.lit(0.0)).alias("label_sum"))


def _summary(grouped: DataFrame, least: float) -> dict:
    """Per feature, in one job: the values of more than ``least`` rows, NULL's and all other sums, and the best value
    (most rows; ties: numerically, then as text, the smallest).  At most total / least values a feature."""
    sums = F.struct(F.sum("n").alias("n"), F.sum("label_n").alias("ln"), F.sum("label_sum").alias("ls"))
    value = F.struct("value", "n", "label_n", "label_sum")
    best = F.struct((-F.col("n")).alias("less"), F.col("value").try_cast(DoubleType()).alias("num"), "value", "label_n",
                    "label_sum")
    kind = F.when(F.col("kind") == 0, F.lit("null")).otherwise(F.lit("rest"))
    rows = grouped.groupBy("feature", kind.alias("k")).agg(
        sums.alias("sums"), F.min(F.when(F.col("kind") == 1, best)).alias("best"),
        F.collect_list(F.when((F.col("kind") == 1) & (F.col("n") > F.lit(least)), value)).alias("values")).collect()
    out = {}
    for r in rows:
        f = out.setdefault(r["feature"], {"null": Counts(), "rest": Counts(), "values": {}, "best": None})
        f[r["k"]] = Counts(r["sums"]["n"], r["sums"]["ln"], r["sums"]["ls"])
        f["values"].update({v["value"]: Counts(v["n"], v["label_n"], v["label_sum"]) for v in r["values"]})
        if r["best"] is not None:
            f["best"] = (r["best"]["value"], Counts(-r["best"]["less"], r["best"]["label_n"], r["best"]["label_sum"]))
    return out


def frequent_counts(df: DataFrame, features: Sequence[str], threshold: float, label: str | None = None,
                    modes: bool = False, buckets: int | None = None) -> dict[str, FeatureCounts]:
    """{feature: FeatureCounts}: all values held by more than ``threshold`` of the rows, NULL apart.

    With ``modes`` the most frequent value is kept too, however rare (ties to
    the smallest, as numbers when they are numbers).  At most 1/threshold + 1
    values per feature reach the driver.  Two scans of ``df``; a third one with
    ``modes`` for features that have no frequent value.
    """
    features = list(dict.fromkeys(features))
    if not threshold > 0:
        raise ValueError("threshold must be > 0: it bounds what is learned")
    if not features:
        return {}
    buckets = buckets or _buckets_for(threshold)
    if buckets & (buckets - 1) or not 0 < buckets <= MAX_BUCKETS:
        raise ValueError(f"buckets must be a power of two up to {MAX_BUCKETS}, not {buckets}")
    # features * (STAGES * buckets + 1) rows, counted once
    counted = slot_counts(df, features, buckets).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _learn(df, features, threshold, label, modes, buckets, counted)
    finally:
        counted.unpersist()


def _learn(df: DataFrame, features: list[str], threshold: float, label: str | None, modes: bool, buckets: int,
           counted: DataFrame) -> dict[str, FeatureCounts]:
    stage = F.floor(F.col("slot") / buckets).cast("int")
    first = F.col("slot") < buckets                                          # NULL and the first stage: every row once
    whole = counted.groupBy("feature").agg(
        F.sum(F.when(first, F.col("n"))).alias("total"),
        F.max_by(F.when(F.col("slot") >= 0, F.col("slot")), F.when(first & (F.col("slot") >= 0), F.struct("n", "slot"))).alias("top"))
    # under STAGES / threshold slots a feature, and its fullest one; one row a feature is broadcast
    marked = counted.join(F.broadcast(whole), "feature").filter(
        (F.col("slot") == F.col("top")) | ((F.col("slot") >= 0) & (F.col("n") > F.lit(threshold) * F.col("total")))
        | F.col("top").isNull())
    heavy = {f: [[] for _ in range(STAGES)] for f in features}
    fullest, total = {}, 0
    for r in marked.select("*", stage.alias("stage")).collect():
        total = r["total"]
        fullest[r["feature"]] = r["top"]
        if r["slot"] >= 0 and r["n"] > threshold * total:
            heavy[r["feature"]][r["stage"]].append(r["slot"])
    if not total:
        return {f: FeatureCounts(0) for f in features}
    for f in features:
        if not all(heavy[f]):                                                # no frequent value
            # its fullest slot gives a lower bound for the mode; without modes no value is asked for
            ask = modes and fullest[f] is not None
            heavy[f] = [[fullest[f]]] + [[]] * (STAGES - 1) if ask else [[_NOWHERE]] * STAGES
    out = {f: FeatureCounts(total) for f in features}
    found = _summary(candidate_counts(df, heavy, buckets, label), threshold * total)
    for f, x in found.items():
        out[f].null, out[f].rest, out[f].values = x["null"], x["rest"], x["values"]
    if modes:
        best = {f: x["best"] for f, x in found.items() if x["best"]}
        unsure = {f: best[f][1].n for f in best if not out[f].values}
        if unsure:
            best.update({f: x["best"] for f, x in _summary(_reaching(df, counted, unsure, buckets, label), total).items()})
        for f, (value, counts) in best.items():
            out[f].mode = value
            out[f].values.setdefault(value, counts)
    for counts in out.values():
        for c in counts.values.values():
            counts.rest = counts.rest - c
    return out


def _reaching(df: DataFrame, counted: DataFrame, least: dict[str, int], buckets: int, label: str | None) -> DataFrame:
    """Scan 3: counts of values whose slots all hold at least ``least`` rows of their feature."""
    slots = {f: [[_NOWHERE] for _ in range(STAGES)] for f in least}
    full = F.lit(False)
    for f, n in least.items():
        full = full | ((F.col("feature") == F.lit(f)) & (F.col("n") >= F.lit(n)))
    for r in counted.filter((F.col("slot") >= 0) & full).collect():              # at most STAGES * buckets a feature
        slots[r["feature"]][r["slot"] // buckets].append(r["slot"])
    # a stage that rules out less than half of its slots is not worth the test
    slots = {f: [s if len(s) <= buckets // 2 else [] for s in stages] for f, stages in slots.items()}
    return candidate_counts(df, slots, buckets, label)


def learn_modes(df: DataFrame, features: Sequence[str], threshold: float = 0.01) -> dict:
    """{feature: most frequent non-NULL value as text, None without any}; ties to the smallest."""
    return {f: c.mode for f, c in frequent_counts(df, features, threshold, modes=True).items()}

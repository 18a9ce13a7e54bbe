"""Exact quantiles of numeric columns by distributed interval narrowing.

Values are compared in their own type: integers as BIGINT, decimals as they
are, everything else as DOUBLE.  One aggregate finds count, minimum and maximum
of each column; every further pass bins the rows of the intervals still open
with a partial aggregate (a bounded number of bins per interval and task) and
keeps the bin that holds the wanted rank, tightened to its own minimum and
maximum.  The number of passes is bounded by the type, so there is neither a
pass limit nor an approximate way out:

* integers and decimals: one pass splits by sign (after it, differences cannot
  overflow), then each pass divides the range by ``bins``: 7 passes at 1024
  bins for 64 bits, 13 for 37 digits;
* doubles: one pass bins by sign and power of two, with bins of their own for
  0 and the infinities; inside one power of two there are 2**52 values, 6
  linear passes.  The first pass is skipped for narrow ranges of one sign.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from decimal import Context, localcontext

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, IntegralType, LongType

# doubles whose largest and smallest magnitude differ by less are binned linearly at once
NARROW_RATIO = 1024.0
# larger than any power of two of a double
POWER_OFFSET = 2000


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = (0.5,),
                    bins: int = 1024) -> dict:
    """``{(column, p): value}``: the ceil(p*n)-th smallest value that is neither NULL nor NaN
    (None for a column without one), the rank rule of ``percentile_approx``.

    Integers come back as int, decimals as Decimal, other columns as float.
    Infinities are ordinary values; -0.0 counts as 0.0.  A DECIMAL may use 37
    digits; values that need the 38th raise an overflow error.  Columns of one
    type are narrowed together, so a pass is one scan for each type.
    """
    if bins < 2:
        raise ValueError(f"bins must be at least 2, not {bins}")
    families = {}
    for c in dict.fromkeys(columns):
        families.setdefault(_compared_as(df.schema[c].dataType), []).append(c)
    out = {}
    for kind, cols in families.items():
        out.update(_narrow(df, cols, kind, probs, bins))
    return out


def _compared_as(t: DataType) -> DataType:
    if isinstance(t, IntegralType):
        return LongType()
    if isinstance(t, DecimalType):
        if t.scale > 37:
            raise ValueError("DECIMAL(38, 38) has no spare digit for differences")
        return DecimalType(min(t.precision, 37), t.scale)
    return DoubleType()


def _narrow(df: DataFrame, cols: list[str], kind: DataType, probs: Sequence[float], bins: int) -> dict:
    x = {c: F.col(c).cast(kind) for c in cols}
    if isinstance(kind, DoubleType):
        x = {c: F.when(~F.isnan(v), v + F.lit(0.0)) for c, v in x.items()}
    wide = df.select(*[v.alias(c) for c, v in x.items()])
    long = wide.unpivot([], cols, "feature", "x").filter(F.col("x").isNotNull())
    whole = {r["feature"]: r for r in long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("mn"), F.max("x").alias("mx")).collect()}
    out, open_ = {}, {}

    def settle(feature, p, rank, below, r, into):
        """The value when the bin holds one, else the bin as the next interval."""
        if r["mn"] == r["mx"]:
            out[(feature, p)] = r["mn"]
        else:
            into.setdefault((feature, r["mn"], r["mx"]), (below, {}))[1][p] = rank

    for c in cols:
        for p in probs:
            if c not in whole:
                out[(c, p)] = None
            else:
                settle(c, p, max(1, math.ceil(p * whole[c]["n"] - 1e-9)), 0, whole[c], open_)
    while open_:
        counted = _count_bins(wide, kind, list(open_), bins)
        narrower = {}
        for i, ((feature, _, _), (below, ranks)) in enumerate(open_.items()):
            for p, rank in ranks.items():
                seen = below
                for r in counted[i]:
                    if seen + r["n"] >= rank:
                        settle(feature, p, rank, seen, r, narrower)
                        break
                    seen += r["n"]
        open_ = narrower
    return out


def _count_bins(wide: DataFrame, kind: DataType, intervals: list[tuple], bins: int) -> list[list]:
    """Rows (bin, n, mn, mx) of each interval in ascending order; one scan for all intervals.

    The intervals of a column are apart, so a value is in one of them at most; values in none
    are not grouped.
    """
    tags: dict[str, Column] = {}
    for i, (feature, lo, hi) in enumerate(intervals):
        x = F.col(feature)
        bin_ = _coarse_bin(kind, x) if _is_coarse(kind, lo, hi) else _linear_bin(kind, x, lo, _width(kind, lo, hi, bins), bins)
        tag = F.struct(F.lit(i).alias("tid"), bin_.alias("bin"), x.alias("x"))
        tags[feature] = tags.get(feature, F).when(x.between(F.lit(lo).cast(kind), F.lit(hi).cast(kind)), tag)
    rows = (wide.select(*[t.alias(f) for f, t in tags.items()]).unpivot([], list(tags), "feature", "tag")
            .filter(F.col("tag").isNotNull())
            .groupBy(F.col("tag.tid").alias("tid"), F.col("tag.bin").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("tag.x").alias("mn"), F.max("tag.x").alias("mx"))
            .collect())                                  # bounded: intervals x bins rows
    found = [[] for _ in intervals]
    for r in sorted(rows, key=lambda r: r["bin"]):
        found[r["tid"]].append(r)
    return found


def _is_coarse(kind: DataType, lo, hi) -> bool:
    """Whether the interval is first split by sign (and, for doubles, by power of two)."""
    if not isinstance(kind, DoubleType):
        return lo < 0 <= hi
    small, large = sorted((abs(lo), abs(hi)))
    return lo <= 0 <= hi or math.isinf(large) or large > NARROW_RATIO * small


def _width(kind: DataType, lo, hi, bins: int):
    if _is_coarse(kind, lo, hi):
        return 1
    if isinstance(kind, DoubleType):
        return max((hi - lo) / bins, 5e-324)
    if isinstance(kind, LongType):
        return (hi - lo) // bins + 1
    with localcontext(Context(prec=2 * 38)):
        return ((hi - lo).scaleb(kind.scale) // bins + 1).scaleb(-kind.scale)


def _coarse_bin(kind: DataType, x: Column) -> Column:
    if not isinstance(kind, DoubleType):
        return (x >= 0).cast("long")
    beyond = F.lit(2 * POWER_OFFSET).cast("long")
    power = F.floor(F.log2(F.abs(x))) + F.lit(POWER_OFFSET)
    return (F.when(F.abs(x) > F.lit(sys.float_info.max), F.when(x > 0, beyond).otherwise(-beyond))
            .when(x == 0, F.lit(0).cast("long")).when(x > 0, power).otherwise(-power))


def _linear_bin(kind: DataType, x: Column, lo, width, bins: int) -> Column:
    above, width = x - F.lit(lo).cast(kind), F.lit(width).cast(kind)
    if not isinstance(kind, DoubleType):
        return F.call_function("div", above, width)
    return F.least(F.lit(bins - 1).cast("long"), F.floor(above / width))

"""Approximate quantiles from KLL sketches merged in two levels.

Every task builds one sketch per column; the sketches are merged in
``FAN_IN`` groups of tasks first and the groups' sketches last, so the last
merge reads at most ``FAN_IN`` sketches however many tasks scanned the table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType

FAN_IN = 512
# fixed values: rank error of a KLL sketch of size k at 99 % confidence is ERROR_FACTOR / k ** ERROR_POWER
ERROR_FACTOR = 2.296
ERROR_POWER = 0.9723
SMALLEST_K, LARGEST_K = 8, 65535


def sketch_size(relative_error: float) -> int | None:
    """Sketch size whose 99 % rank error is half of ``relative_error``; None when no sketch is that fine."""
    k = math.ceil((2 * ERROR_FACTOR / relative_error) ** (1 / ERROR_POWER))
    return None if k > LARGEST_K else max(SMALLEST_K, k)


def _family(t: DataType):
    """(type the values are compared in, sketch, merge, count, quantile functions)."""
    if isinstance(t, IntegralType):
        return ("bigint", F.kll_sketch_agg_bigint, F.kll_merge_agg_bigint, F.kll_sketch_get_n_bigint,
                F.kll_sketch_get_quantile_bigint)
    return ("double", F.kll_sketch_agg_double, F.kll_merge_agg_double, F.kll_sketch_get_n_double,
            F.kll_sketch_get_quantile_double)


def merged_sketches(df: DataFrame, columns: Sequence[str], k: int, fan_in: int = FAN_IN) -> DataFrame:
    """One row with column ``s<i>``, the sketch of the i-th column over all rows (NULL and NaN are not in it)."""
    families = [_family(df.schema[c].dataType) for c in columns]
    rows = df.select(F.pmod(F.spark_partition_id(), F.lit(fan_in)).alias("_group"),
                     *[F.col(c).cast(f[0]).alias(f"x{i}") for i, (c, f) in enumerate(zip(columns, families, strict=True))])
    groups = rows.groupBy("_group").agg(*[f[1](F.col(f"x{i}"), k).alias(f"s{i}") for i, f in enumerate(families)])
    return groups.agg(*[f[2](F.col(f"s{i}"), k).alias(f"s{i}") for i, f in enumerate(families)])


def approx_quantiles(df: DataFrame, wanted: dict[tuple[str, float], str], relative_error: float,
                     fan_in: int = FAN_IN) -> DataFrame:
    """One row: for each (column, probability) its quantile under the given name, in the column's type.

    The value's rank is within ``relative_error`` of the wanted one (rank rule:
    the ceil(p * n)-th smallest, as ``percentile_approx``), with more than 99 %
    confidence; sketches draw at random, so repeated runs may differ within it.
    Columns with at most as many values as the sketch keeps are exact.  NULL
    and NaN are ignored, infinities are values, a column without values is
    NULL; integers are compared as BIGINT, all others as DOUBLE.
    """
    k = sketch_size(relative_error)
    if k is None:
        raise ValueError(f"no sketch has a rank error of {relative_error}; ask for exact quantiles")
    columns = list(dict.fromkeys(c for c, _ in wanted))
    place = {c: i for i, c in enumerate(columns)}
    row = merged_sketches(df, columns, k, fan_in)

    def quantile(c: str, p: float) -> Column:
        kind, _, _, count, at = _family(df.schema[c].dataType)
        s = F.col(f"s{place[c]}")
        return F.when(count(s) > 0, at(s, F.lit(float(p)))).cast(df.schema[c].dataType)

    return row.select(*[quantile(c, p).alias(name) for (c, p), name in wanted.items()])

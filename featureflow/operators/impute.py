"""Learned imputation: medians for numbers, modes for categories.

Medians of all numeric columns are learned together (KLL sketches merged in two
levels, or exact binning passes), modes of all categorical columns with one
multistage filter.  What comes back to the driver is one value per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.functions.columns import null_if_in
from featureflow.operators import frequent, sketches, stats


def learn_medians(df: DataFrame, columns: Sequence[str], relative_error: float | None = 0.025) -> dict:
    """Median per column (NULLs ignored): approximate with ``relative_error``
    (one scan), or exact when it is None (bounded binning passes)."""
    if not columns:
        return {}
    if stats.wants_exact(relative_error):
        vals = stats.exact_quantiles(df, columns, (0.5,))
    else:
        names = {(c, 0.5): f"q{i}" for i, c in enumerate(columns)}
        row = sketches.approx_quantiles(df, names, relative_error).first()
        vals = {key: row[name] for key, name in names.items()}
    return {c: (None if vals[(c, 0.5)] is None else float(vals[(c, 0.5)])) for c in columns}


def learn_modes(df: DataFrame, columns: Sequence[str], sentinels: Sequence[str] = ()) -> dict:
    """Most frequent non-NULL value per column (as text), ties to the smallest."""
    return frequent.learn_modes(with_sentinels_as_null(df, columns, sentinels), columns)


def with_sentinels_as_null(df: DataFrame, columns: Sequence[str], sentinels: Sequence[str]) -> DataFrame:
    types = dict(df.dtypes)
    cols = [c for c in columns if types.get(c) == "string"]
    if not cols or not sentinels:
        return df
    return df.withColumns({c: null_if_in(c, sentinels) for c in cols})


def fill_values(df: DataFrame, fills: dict) -> DataFrame:
    """Fill NULLs from ``{column: value}`` in one projection.

    The value is cast to the column's type (a 110.7 median fills an int
    column with 110; a "2008" mode fills an int column with 2008); a value
    that cannot be cast leaves the column as it is.
    """
    types = dict(df.dtypes)
    exprs = {}
    for c, v in fills.items():
        if c not in types or v is None:
            continue
        exprs[c] = F.coalesce(F.col(c), F.lit(v).try_cast(types[c]))
    return df.withColumns(exprs) if exprs else df


def apply_imputation(df: DataFrame, fills: dict, sentinel_columns: Sequence[str] = (),
                     sentinels: Sequence[str] = ()) -> DataFrame:
    return fill_values(with_sentinels_as_null(df, sentinel_columns, sentinels), fills)

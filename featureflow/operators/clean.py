"""Projection, predicate, cast and null-row operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from featureflow.functions.columns import null_if_in
from featureflow.functions.time import hhmm_to_minutes


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop names; names that are absent are ignored."""
    return df.drop(*list(columns))


def rename_columns(df: DataFrame, mapping) -> DataFrame:
    """Rename in one projection; ``mapping`` is a dict or (old, new) pairs."""
    mapping = dict(mapping)
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def exclude_value(df: DataFrame, column: str, value) -> DataFrame:
    """Keep rows where ``column != value``; NULL rows are dropped too (SQL semantics)."""
    return df.filter(F.col(column) != F.lit(value))


def try_cast_columns(df: DataFrame, columns: Iterable[str], to: str = "int") -> DataFrame:
    """Cast columns; text that is no number becomes NULL instead of raising."""
    cols = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.col(c).try_cast(to) for c in cols}) if cols else df


def drop_null_rows(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def sentinels_to_null(df: DataFrame, columns: Iterable[str], sentinels=("None",)) -> DataFrame:
    """Sentinel text -> NULL, on string columns only (an int column holds no text)."""
    types = dict(df.dtypes)
    cols = [c for c in columns if types.get(c) == "string"]
    return df.withColumns({c: null_if_in(c, sentinels) for c in cols}) if cols else df


def hhmm_columns(df: DataFrame, columns: Iterable[str], drop_source: bool = True) -> DataFrame:
    """HHMM clock columns -> ``<name>_minutes``."""
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return df
    out = df.withColumns({f"{c}_minutes": hhmm_to_minutes(c) for c in cols})
    return out.drop(*cols) if drop_source else out


def output_projection(df: DataFrame, columns: Iterable[str] | None = None,
                      exclude: Iterable[str] = (), no_underscore: bool = False) -> DataFrame:
    """Choose output columns: an explicit list, or every column without ``_``
    in its name (the scoring output rule), minus ``exclude``."""
    if columns is not None:
        keep = [c for c in columns if c in df.columns]
    elif no_underscore:
        keep = [c for c in df.columns if "_" not in c]
    else:
        keep = list(df.columns)
    ex = set(exclude)
    return df.select(*[c for c in keep if c not in ex])


def text_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Cast categories to text so integer categories and text share one encoder path."""
    cols = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.col(c).cast(StringType()) for c in cols}) if cols else df

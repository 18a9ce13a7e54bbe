"""Generic column expressions used by the cleaning and encoding operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c, dtype=None) -> Column:
    """NULL, or NaN for floating columns (isnan is only legal there under ANSI)."""
    col = _c(c)
    if isinstance(dtype, (DoubleType, FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def null_if_in(c, values) -> Column:
    """Values listed in ``values`` become NULL (sentinel text such as "None")."""
    col = _c(c)
    values = [v for v in values if v is not None]
    if not values:
        return col
    return F.when(col.isin(values), F.lit(None)).otherwise(col)


def bucket_rare(c, keep_values, other: str = "Other") -> Column:
    """Values outside ``keep_values`` become ``other``; NULL stays NULL.

    The category is compared as text, so integer categories (years) work
    under ANSI mode.  ``keep_values`` is a bounded list (at most 1/threshold
    entries for a frequency threshold), so ``isin`` stays a literal set.
    """
    col = _c(c).cast(StringType())
    keep = [str(v) for v in keep_values if v is not None]
    if not keep:
        return F.when(col.isNotNull(), F.lit(other))
    return F.when(col.isNull(), F.lit(None)).when(col.isin(keep), col).otherwise(F.lit(other))


MOST_CASES = 64                 # longer lookups are a map literal


def lookup(c, mapping: dict, default=None) -> Column:
    """Literal lookup (for small learned tables); unknown keys -> default.

    A CASE of up to MOST_CASES comparisons is compiled; a map literal is searched entry by entry.
    """
    col = _c(c)
    if not mapping:
        return F.lit(default)
    if len(mapping) <= MOST_CASES:
        found = F
        for k, v in mapping.items():
            found = found.when(col == F.lit(k), F.lit(v))
    else:
        found = F.try_element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), col)
    return found if default is None else F.coalesce(found, F.lit(default))

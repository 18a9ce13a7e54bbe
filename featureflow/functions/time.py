"""Clock and calendar column expressions (all native, codegen friendly)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_PI = 2.0 * math.pi


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hhmm_to_minutes(c) -> Column:
    """HHMM clock value (int or text) -> minutes after midnight.

    The value is left-padded to four digits first, so 955 is 9:55 (595) and
    5 is 0:05.  Text that is not a number ("NA") or longer than four
    characters gives NULL; nothing raises under ANSI mode.
    """
    s = F.trim(_c(c).cast("string"))
    padded = F.lpad(s, 4, "0")
    hours = F.substring(padded, 1, 2).try_cast("int")
    minutes = F.substring(padded, 3, 2).try_cast("int")
    return F.when(F.length(s) <= 4, hours * 60 + minutes)


def month_length(month) -> Column:
    """Days in a month, ignoring leap years (February = 28)."""
    m = _c(month)
    return (F.when(m == 2, F.lit(28))
            .when(m.isin(4, 6, 9, 11), F.lit(30))
            .otherwise(F.lit(31)))


def cyclic_pair(value, period) -> tuple[Column, Column]:
    """(cos, sin) of value/period of a full turn.  NULL in, NULL out."""
    p = period if isinstance(period, Column) else F.lit(float(period))
    angle = _c(value).cast("double") / p * F.lit(TWO_PI)
    return F.cos(angle), F.sin(angle)


def iso_weekday(ts) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return (F.dayofweek(_c(ts)) + 5) % 7 + 1

"""Feature roles of a fact/dimension table pair.

The library is generic over (table, columns, label); a ``FeatureSpec`` names
the columns and their roles.  Two presets live in ``featureflow.presets``.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Cyclic:
    """A calendar column encoded on the unit circle.

    ``period`` is a fixed cycle length (12 months, 7 weekdays).  When
    ``month_col`` is given instead, the cycle is the length of that month
    (February 28, April/June/September/November 30, else 31).
    """

    name: str
    period: int | None = None
    month_col: str | None = None


@dataclass(frozen=True)
class FeatureSpec:
    label: str
    key: str                                   # join key after dimension renames
    dim_renames: tuple = ()                    # (old, new) pairs applied to the dimension
    derived: tuple = ()                        # (name, SQL expression) computed from the fact row
    exclude: tuple | None = None               # (column, value): keep rows with column != value (NULL dropped)
    forbidden: tuple = ()                      # leakage columns, dropped before anything else
    useless: tuple = ()                        # dropped after the join
    quantitative: tuple = ()                   # cast with try_cast to ``cast_type``
    hhmm: tuple = ()                           # HHMM clock values -> <name>_minutes
    cyclic: tuple = ()                         # Cyclic entries -> <name>_cos / <name>_sin
    nominal: tuple = ()                        # categories (incl. non-cyclic ordinals)
    cast_type: str = "int"
    label_type: str = "int"
    sentinels: tuple = ("None",)               # text that means NULL in categorical columns
    keep: tuple = ()                           # id columns carried through untouched
    extra: dict = field(default_factory=dict)

    # ---- derived role lists (the reference's return values of static_preprocess)
    @property
    def quantitative_out(self) -> list[str]:
        return list(self.quantitative) + [f"{c}_minutes" for c in self.hhmm]

    @property
    def ordinal_out(self) -> list[str]:
        return [f"{c.name}_sin" for c in self.cyclic] + [f"{c.name}_cos" for c in self.cyclic]

    @property
    def nominal_out(self) -> list[str]:
        return list(self.nominal)

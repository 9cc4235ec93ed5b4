"""Named selection criteria over the columns of the asset table; a missing value fails a criterion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _over(**least: float) -> Column:
    """Each named column is above its bound."""
    return reduce(lambda a, b: a & b, [F.col(c) > x for c, x in least.items()])


def pixels() -> Column:
    return F.col("W").cast("long") * F.col("H")


#: Bounds of the named criteria; `side` is a side whose square the pixels must exceed, or reach where `reach` is true.
BOUNDS = {
    "1": ({"Q512": 50, "A_EAT": 5.5}, 896, False),
    "2": ({"Q512": 50, "A": 2}, 896, False),
    "3": ({"Q512": 10, "A": 2}, 896, False),
    "4": ({"Q512": 65, "A": 5.2}, 896, True),
    "QF": ({"Q512": 70, "QF": 80, "A": 5.2}, 896, True),
    "Finest": ({"Q512": 70, "A_EAT": 6}, None, False),
    "SPAQ": ({"SPAQ": 65}, 1024, True),
    "default": ({"Q512": 50, "A_EAT": 5.5}, 896, True),
}


def criterion(name: str) -> Column:
    bounds, side, reach = BOUNDS[name]
    chosen = _over(**bounds)
    if side:
        chosen = chosen & ((pixels() >= side * side) if reach else (pixels() > side * side))
    return F.coalesce(chosen, F.lit(False))


def worth_enlarging() -> Column:
    """Sharp images between 384 and 896 pixels squared, both excluded."""
    return F.coalesce((pixels() > 384 * 384) & (pixels() < 896 * 896) & (F.col("Q512") > 60), F.lit(False))


def worth_describing(field: str) -> Column:
    """Large and sharp enough, and without a value in the field (text or list)."""
    empty = F.col(field).isNull() | (F.length(F.col(field).cast("string")) == 0) | (F.col(field).cast("string") == "[]")
    return F.coalesce((pixels() > 384 * 384) & (F.col("Q512") > 35), F.lit(False)) & empty


def complete(*fields: str) -> Column:
    """All fields have a value."""
    return reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in fields], F.lit(True))

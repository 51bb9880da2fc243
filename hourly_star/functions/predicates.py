"""Comparisons with their NULL behaviour spelled out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def differs(a: Column, b: Column) -> Column:
    """Never NULL: two NULLs are the same, a NULL and a value differ."""
    return ~a.eqNullSafe(b)


def exceeds(value: Column, bound: Column) -> Column:
    """Strictly above; unknown when either side is unknown."""
    return value > bound


def outside(col: Column, low=None, high=None, inclusive: bool = True) -> Column:
    """Out of [low, high] (or ]low, high[); a NULL value is not out of range."""
    if low is None and high is None:
        raise ValueError("give a lower or an upper bound")
    broken = []
    if low is not None:
        broken.append(col < F.lit(low) if inclusive else col <= F.lit(low))
    if high is not None:
        broken.append(col > F.lit(high) if inclusive else col >= F.lit(high))
    either = broken[0] if len(broken) == 1 else broken[0] | broken[1]
    return col.isNotNull() & either

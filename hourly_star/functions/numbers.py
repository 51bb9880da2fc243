"""Aggregates that do not depend on how rows are partitioned."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(total: Column, n: Column) -> Column:
    """total / n to six places by decimal arithmetic, NULL for n = 0."""
    exact = total.cast("decimal(20,3)") / F.nullif(n, F.lit(0)).cast("decimal(18,0)")
    return F.round(exact, 6).cast("decimal(18,6)")


def exact_mean(value: Column) -> Column:
    """Mean of a decimal column; a sum of decimals has no summation order."""
    return ratio(F.sum(value), F.count(value))

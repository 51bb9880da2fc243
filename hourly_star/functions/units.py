"""Unit spellings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourly_star.schemas import UNIT_SPELLINGS


def normalised_unit(raw: Column, spellings: dict[str, str] = UNIT_SPELLINGS) -> Column:
    """The common spelling of a unit; NULL for one not known."""
    known = F.create_map(*[F.lit(part) for pair in spellings.items() for part in pair])
    return F.try_element_at(known, F.coalesce(raw, F.lit("")))

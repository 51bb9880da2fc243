"""Hash key over the natural key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reading_key(location: Column, pollutant: Column, measured_at_utc: Column) -> Column:
    """md5 of location|pollutant|UTC hour; NULL in any part gives NULL."""
    hour = F.date_format(measured_at_utc, "yyyy-MM-dd HH:mm:ss")
    return F.md5(F.concat(location, F.lit("|"), pollutant, F.lit("|"), hour))

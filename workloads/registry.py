"""All queries and the SQL they are compared with."""

from __future__ import annotations

from workloads import pipeline, readings, star

QUERIES = {**readings.QUERIES, **star.QUERIES, **pipeline.QUERIES}
ORACLES = {**readings.ORACLES, **star.ORACLES, **pipeline.ORACLES}

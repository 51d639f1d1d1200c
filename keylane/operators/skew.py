"""Broadcasts with a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded(side: DataFrame, max_rows: int) -> DataFrame:
    """Mark a join side for broadcast, after counting that it is small enough."""
    small = side.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(side) if small else side

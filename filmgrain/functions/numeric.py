"""Scaling and distance expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def min_max(value: Column, low: Column, high: Column) -> Column:
    """(value - low) / (high - low); a constant column scales to 0."""
    span = F.nullif((high - low).cast("double"), F.lit(0.0))
    return F.coalesce((value - low) / span, F.when(value.isNotNull(), F.lit(0.0)))


def euclid(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2))

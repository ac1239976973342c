"""Whole-number arithmetic that never leaves BIGINT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_div(value: Column, size: int) -> Column:
    """Floor division, also for negative values."""
    unit = F.lit(size).cast("long")
    return F.call_function("div", value - F.pmod(value, unit), unit)

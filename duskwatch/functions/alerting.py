"""Severity, identifiers and log level of an alert."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clock import SECOND
from .numbers import floor_div

# Severity scale; an unknown severity has level 0.
SEVERITY_LEVELS = {"LOW": 1, "MEDIUM": 2, "HIGH": 3, "CRITICAL": 4}
HIGH_PRIORITY_LEVEL = 3


def severity_level(severity: Column) -> Column:
    level = F.lit(0)
    for name, value in SEVERITY_LEVELS.items():
        level = F.when(severity == name, F.lit(value)).otherwise(level)
    return level


def is_high_priority(severity: Column) -> Column:
    return severity_level(severity) >= HIGH_PRIORITY_LEVEL


def log_level(severity: Column) -> Column:
    return F.when(is_high_priority(severity), F.lit("ERROR")).otherwise(F.lit("WARN"))


def alert_id(rule_name: Column, us: Column, source: Column) -> Column:
    """rule-unixSeconds-source."""
    seconds = floor_div(us, SECOND).cast("string")
    return F.concat_ws("-", rule_name, seconds, F.coalesce(source, F.lit("")))

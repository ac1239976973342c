"""Watchlist and geo range tables."""

from __future__ import annotations

import os
import warnings
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip

DEFAULT_WATCHLIST = Path(__file__).resolve().parent.parent / "data" / "watchlist.txt"
GEO_SCHEMA = (
    "start_ip long, end_ip long, country string, country_name string, city string, lat double, lon double"
)


def watchlist_from_lines(lines: DataFrame) -> DataFrame:
    """One address per line: trimmed, blanks and # comments skipped, distinct."""
    return (
        lines.select(strip(F.col("value")).alias("ip"))
        .where((F.col("ip") != "") & ~F.col("ip").startswith("#"))
        .distinct()
    )


def read_watchlist(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The watchlist as a one-column table; a missing file warns and gives no rows, other errors fail.

    Without a path, the list that comes with the package is read on the driver,
    so it needs no file system that the executors share.
    """
    path = path or os.environ.get("DUSKWATCH_INTEL_PATH")
    if path is None or path == "":
        packaged = [(line,) for line in DEFAULT_WATCHLIST.read_text().splitlines()]
        return watchlist_from_lines(spark.createDataFrame(packaged, "value string"))
    try:
        lines = spark.read.text(str(path))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        warnings.warn(f"watchlist not loaded: {e}")
        lines = spark.createDataFrame([], "value string")
    return watchlist_from_lines(lines)


def read_geo_ranges(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """IPv4 ranges with country, city and coordinates from Parquet or CSV."""
    reader = spark.read.schema(GEO_SCHEMA)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)

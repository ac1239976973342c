"""Raw log lines, batch and streaming."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_HOST = "my-server"
# Offsets up to 64 GB in a file, and 2^27 file numbers.
_OFFSET_BITS = 36
_FILE_SLOTS = 1 << 27
_ROW_MASK = (1 << 33) - 1


def _file_slot(path: Column) -> Column:
    """A number per file, in the high bits of ``seq``."""
    slot = F.pmod(F.xxhash64(path), F.lit(_FILE_SLOTS).cast("long"))
    return F.shiftleft(slot, _OFFSET_BITS)


def _host(path: Column, host_pattern: str | None) -> Column:
    if host_pattern is None:
        return F.lit(DEFAULT_HOST)
    name = F.regexp_extract(path, host_pattern, 1)
    return F.when(name == "", F.lit(DEFAULT_HOST)).otherwise(name)


def line_number() -> Column:
    """A number for each row of a text source, without a shuffle; it grows with the position in the file."""
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK).cast("long"))
    return _file_slot(F.col("_metadata.file_path")) + F.col("_metadata.file_block_start") + row


def read_log_lines(spark: SparkSession, path: str, host_pattern: str | None = None) -> DataFrame:
    """(seq, host, line) from text files, one row per line.

    ``seq`` grows with the position in the file: start of the file block plus
    the row number within it, which cannot pass the start of the next block as
    every line takes at least one byte.  No shuffle is needed to number lines.
    ``host_pattern`` is a regex whose first group takes the host from the path.
    """
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(
        line_number().alias("seq"),
        _host(F.col("_metadata.file_path"), host_pattern).alias("host"),
        F.col("value").alias("line"),
    )


def stream_log_files(
    spark: SparkSession, path: str, host_pattern: str | None = None, max_files: int = 1000
) -> DataFrame:
    """A stream of lines with their place (slot, start, host, line), over a landing directory of finished files.

    The file source reads each file once; land rotated files rather than
    appending.  Row numbers are no expression of a stream; ``number_lines`` adds them to each
    micro-batch, as ``foreachBatch`` hands it over.
    """
    raw = (
        spark.readStream.option("lineSep", "\n").option("maxFilesPerTrigger", max_files).format("text").load(path)
    )
    file = F.col("_metadata.file_path")
    return raw.select(
        _file_slot(file).alias("slot"),
        F.col("_metadata.file_block_start").alias("start"),
        _host(file, host_pattern).alias("host"),
        F.col("value").alias("line"),
    )


def number_lines(files: DataFrame) -> DataFrame:
    """(seq, host, line) of a micro-batch of ``stream_log_files``, numbered as ``line_number`` does, without Python or a shuffle."""
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK).cast("long"))
    return files.select((F.col("slot") + F.col("start") + row).alias("seq"), "host", "line")


def _number_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: dict[tuple, int] = {}
    for batch in batches:
        step = batch.groupby(["slot", "start"], sort=False).cumcount().to_numpy()
        base = [seen.get(k, 0) for k in zip(batch["slot"], batch["start"])]
        for k, n in batch.groupby(["slot", "start"], sort=False).size().items():
            seen[k] = seen.get(k, 0) + int(n)
        yield pd.DataFrame(
            {"seq": batch["slot"] + batch["start"] + step + base, "host": batch["host"], "line": batch["line"]}
        )


def stream_log_lines(
    spark: SparkSession, path: str, host_pattern: str | None = None, max_files: int = 1000
) -> DataFrame:
    """Streaming (seq, host, line) over a landing directory of finished files.

    The file source reads each file once; land rotated files rather than
    appending.  Row numbering is not available as an expression on streams, so
    an Arrow pass adds it, again without a shuffle.
    """
    raw = (
        spark.readStream.option("lineSep", "\n").option("maxFilesPerTrigger", max_files).format("text").load(path)
    )
    file = F.col("_metadata.file_path")
    return raw.select(
        _file_slot(file).alias("slot"),
        F.col("_metadata.file_block_start").alias("start"),
        _host(file, host_pattern).alias("host"),
        F.col("value").alias("line"),
    ).mapInPandas(_number_lines, "seq long, host string, line string")

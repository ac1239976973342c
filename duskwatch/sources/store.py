"""Event and alert tables in Parquet.

Layout: ``event_type=<type>/dt=<UTC day>/``.  Detectors and hunting queries
filter ``event_type``, so Spark prunes the other types at planning time, whoever
applies the filter; days are pruned by the bounds given to ``read_events`` or to a hunting query.  Within a file
the flat metadata columns are pruned by the scan.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.clock import DAY
from ..functions.export import event_from_json, event_json
from ..functions.numbers import floor_div
from ..plans.alerts import as_log_records
from ..schema import ACCEPTED_LOGIN, ALERT_SCHEMA, EVENT_SCHEMA, FAILED_LOGIN, META_KEYS, PROCESS, micros
from .logs import line_number

EVENT_TYPES = {t.lower(): t for t in (FAILED_LOGIN, ACCEPTED_LOGIN, PROCESS)}
STORE_SCHEMA = T.StructType(
    [f for f in EVENT_SCHEMA.fields if f.name != "event_type"]
    + [T.StructField("event_type", T.StringType()), T.StructField("dt", T.DateType())]
)


def _day(us: Column) -> Column:
    return F.date_from_unix_date(floor_div(us, DAY).cast("int"))


def _laid_out(events: DataFrame) -> DataFrame:
    return events.withColumn("dt", _day(micros()))


def _write(rows: DataFrame, path: str, mode: str, batch: int | None, *by: str) -> None:
    """Rows by the columns ``by``; those of a micro-batch take the place of what an earlier attempt at it wrote."""
    writer = rows.hint("rebalance", *by).write.mode(mode)
    if batch is not None:
        rows, by = rows.withColumn("batch", F.lit(batch).cast("long")), (*by, "batch")
        writer = rows.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


def write_events(events: DataFrame, path: str, mode: str = "append", batch: int | None = None) -> None:
    """Write events by type and day, and by micro-batch if one is named, which then can be written again.

    The rebalance hint merges small output files and splits partitions that
    are too large, so one busy day or type does not end up in one task.
    """
    _write(_laid_out(events), path, mode, batch, "event_type", "dt")


def stream_events(events: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """The streaming counterpart of ``write_events``; exactly once by its checkpoint."""
    writer = _laid_out(events).writeStream.format("parquet").partitionBy("event_type", "dt").outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start(path)


def read_events(
    spark: SparkSession,
    path: str,
    event_type: str | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
    with_day: bool = False,
) -> DataFrame:
    """Stored events with the fixed schema; type and days prune partitions.

    ``with_day`` adds the day ``dt``, by which the bounds that a hunting query is given later prune as well.
    """
    stored = spark.read.schema(STORE_SCHEMA).parquet(path)
    if event_type is not None:
        stored = stored.where(F.lower("event_type") == event_type.lower())
    for bound, op in ((start, "ge"), (end, "le")):
        if bound is not None:
            at = bound if bound.tzinfo else bound.replace(tzinfo=timezone.utc)
            us = int((at - datetime(1970, 1, 1, tzinfo=timezone.utc)).total_seconds() * 1_000_000)
            day = at.astimezone(timezone.utc).date()
            in_day = F.col("dt") >= F.lit(day) if op == "ge" else F.col("dt") <= F.lit(day)
            in_time = F.col("ts") >= F.timestamp_micros(F.lit(us)) if op == "ge" else F.col("ts") <= F.timestamp_micros(F.lit(us))
            stored = stored.where(in_day & in_time)
    return stored.select(*[f.name for f in EVENT_SCHEMA.fields], *(["dt"] if with_day else []))


def write_event_documents(events: DataFrame, path: str, mode: str = "append") -> None:
    """Events as JSON documents, one directory per lower-case event type."""
    events.select(F.lower("event_type").alias("index"), event_json().alias("value")).hint(
        "rebalance", "index"
    ).write.mode(mode).partitionBy("index").text(path)


def read_event_documents(spark: SparkSession, path: str, host: str = "my-server") -> DataFrame:
    """JSON documents back to events; keys outside the fixed set go to ``extra``, ``seq`` numbers the documents."""
    doc = spark.read.text(path).select(line_number().alias("seq"), event_from_json(F.col("value")).alias("d"))
    known = F.array(*[F.lit(k) for k in META_KEYS])
    extra = F.map_filter("d.Metadata", lambda k, _: ~F.array_contains(known, k))
    return doc.select(
        "seq",
        F.lit(host).alias("host"),
        F.to_timestamp("d.Timestamp").alias("ts"),
        F.col("d.EventType").alias("event_type"),
        F.col("d.Source").alias("source"),
        *[F.try_element_at("d.Metadata", F.lit(k)).alias(k) for k in META_KEYS],
        F.when(F.size(extra) > 0, extra).alias("extra"),
    )


def write_alerts(alerts: DataFrame, path: str, mode: str = "append", batch: int | None = None) -> None:
    """Alert records with id and log level, by day, and by micro-batch if one is named."""
    _write(as_log_records(alerts).withColumn("dt", _day(micros())), path, mode, batch, "dt")


def write_quarantine(lines: DataFrame, path: str, mode: str = "append", batch: int | None = None) -> None:
    """Lines that gave no event (seq, host, line, disposition), by disposition."""
    _write(lines.select("seq", "host", "line", "disposition"), path, mode, batch, "disposition")


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    schema = "seq long, host string, line string, disposition string"
    return spark.read.schema(schema).parquet(path).select("seq", "host", "line", "disposition")


def stream_alerts(alerts: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    writer = as_log_records(alerts).withColumn("dt", _day(micros())).writeStream.format("parquet").partitionBy("dt")
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start(path)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType(
        ALERT_SCHEMA.fields
        + [
            T.StructField("alert_id", T.StringType()),
            T.StructField("log_level", T.StringType()),
            T.StructField("dt", T.DateType()),
        ]
    )
    return spark.read.schema(schema).parquet(path)

"""Streaming detectors: events in, hits out, with the columns of the batch detectors.

Stateless detectors use the batch functions unchanged.  Keyed ones prefilter
and trim the stream, then run a keyed rule.  Chains over several keys are
separate queries joined by file sinks (``chain`` module functions below), each
exactly once by its own checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import contains_any, first_field_with_prefix
from ..operators import chains
from ..operators.thresholds import FailedLoginParams, RapidParams, SprayParams
from ..schema import ACCEPTED_LOGIN, FAILED_LOGIN, PROCESS, micros
from . import rules
from .keyed import apply_rule, trimmed


def _failed(events: DataFrame) -> DataFrame:
    return events.where(
        (F.col("event_type") == FAILED_LOGIN) & (F.coalesce("user", F.lit("")) != "")
    ).select("host", "ts", micros().alias("us"), "seq", F.coalesce("source", F.lit("")).alias("source"), "user")


def failed_login_hits(
    events: DataFrame, params: FailedLoginParams = FailedLoginParams(), watermark: str | None = None
) -> DataFrame:
    rows = trimmed(_failed(events), rules.trim_failed_logins(params))
    return apply_rule(rows, rules.failed_logins(params), watermark)


def spray_hits(events: DataFrame, params: SprayParams = SprayParams(), watermark: str | None = None) -> DataFrame:
    rows = trimmed(_failed(events).where(F.col("source") != ""), rules.trim_spray(params))
    return apply_rule(rows, rules.spray(params), watermark)


def new_country_hits(events: DataFrame) -> DataFrame:
    rows = events.where(
        (F.col("event_type") == ACCEPTED_LOGIN)
        & (F.coalesce("user", F.lit("")) != "")
        & (F.coalesce("country", F.lit("")) != "")
    ).select("host", micros().alias("us"), "seq", "source", "user", "country")
    return apply_rule(trimmed(rows, rules.trim_new_country), rules.new_country())


def _per_time(k: int):
    """Starts of a batch as (host, time, count, the first k seqs and sources)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            groups = batch.sort_values("seq").groupby(["host", "us"], sort=False)
            yield groups.agg(
                ts=("ts", "first"),
                seq=("seq", "min"),
                n=("seq", "size"),
                seqs=("seq", lambda s: s.head(k).tolist()),
                sources=("source", lambda s: s.head(k).tolist()),
            ).reset_index()[["host", "ts", "us", "seq", "n", "seqs", "sources"]]

    return run


def rapid_process_hits(
    events: DataFrame, params: RapidParams = RapidParams(), watermark: str | None = None
) -> DataFrame:
    starts = events.where(F.col("event_type") == PROCESS).select(
        "host", "ts", micros().alias("us"), "seq", F.coalesce("source", F.lit("")).alias("source")
    )
    per_time = starts.mapInPandas(
        _per_time(params.threshold),
        "host string, ts timestamp, us long, seq long, n long, seqs array<long>, sources array<string>",
    )
    return apply_rule(per_time, rules.rapid_process(params), watermark)


def new_account_hits(
    events: DataFrame, window_us: int = chains.NEW_ACCOUNT_WINDOW, watermark: str | None = None
) -> DataFrame:
    made = chains.created_accounts(events, keep=("ts",)).select(
        "host", "ts", "user", "us", "seq", F.lit("").alias("source"), F.lit(True).alias("opens")
    )
    logins = events.where(
        (F.col("event_type") == ACCEPTED_LOGIN) & (F.coalesce("user", F.lit("")) != "")
    ).select("host", "ts", "user", micros().alias("us"), "seq", "source", F.lit(False).alias("opens"))
    return apply_rule(made.unionByName(logins), rules.new_account(window_us), watermark)


def download_execute_hits(
    events: DataFrame, window_us: int = chains.EXECUTE_WINDOW, watermark: str | None = None
) -> DataFrame:
    command = F.coalesce("command", F.lit(""))
    downloads = F.coalesce("process_name", F.lit("")).isin(*chains.DOWNLOADERS)
    rows = (
        events.where((F.col("event_type") == PROCESS) & contains_any(command, chains.STAGING_PREFIXES))
        .select(
            "host",
            "ts",
            micros().alias("us"),
            "seq",
            "source",
            "command",
            downloads.alias("downloads"),
            F.when(downloads, first_field_with_prefix(command, chains.STAGING_PREFIXES)).alias("path"),
        )
        .where(~F.col("downloads") | F.col("path").isNotNull())
        .drop("downloads")
    )
    return apply_rule(rows, rules.download_execute(window_us), watermark)


# --- chains over several keys -------------------------------------------------------------


def _stage(df: DataFrame, kind: str, pid: str | None = None, command: str | None = None) -> DataFrame:
    def col(name):
        return F.col(name) if name else F.lit(None).cast("string")

    return df.select(
        F.lit(kind).alias("kind"), "host", "us", "seq", "source", col(pid).alias("pid"), col(command).alias("command")
    )


def _sink(df: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start(path)


def _read_stage(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of an earlier stage, in whole batches of it: a cut through a batch would lose its order."""
    return spark.readStream.schema(schema).parquet(path)


def brute_force_stage(
    events: DataFrame,
    path: str,
    checkpoint: str,
    params: FailedLoginParams = FailedLoginParams(),
    watermark: str | None = None,
    **trigger,
) -> StreamingQuery:
    """First query: failed-login alerts, with the logins and evasion commands of the same batch."""
    logins = events.where(F.col("event_type") == ACCEPTED_LOGIN).withColumn("us", micros())
    evasions = events.where(
        (F.col("event_type") == PROCESS)
        & contains_any(F.col("command"), chains.EVASION_PATTERNS)
        & F.col("ppid").isNotNull()
    ).withColumn("us", micros())
    out = (
        _stage(failed_login_hits(events, params, watermark), "alert")
        .unionByName(_stage(logins, "login", pid="sshd_pid"))
        .unionByName(_stage(evasions, "evasion", pid="ppid", command="command"))
    )
    return _sink(out, path, checkpoint, **trigger)


def session_stage(
    spark: SparkSession, source: str, path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Second query: sessions of the first login after an alert, with the evasion commands."""
    rows = _read_stage(spark, source, rules.STAGE)
    linked = rows.where(F.col("kind").isin("alert", "login") & F.col("source").isNotNull())
    sessions = apply_rule(linked, rules.armed_sessions())
    return _sink(sessions.unionByName(rows.where(F.col("kind") == "evasion")), path, checkpoint, **trigger)


def evasion_hits(
    spark: SparkSession, source: str, window_us: int = chains.EVASION_WINDOW, watermark: str | None = None
) -> DataFrame:
    """Third query: hits of the chain."""
    rows = _read_stage(spark, source, rules.STAGE).withColumn("ts", F.timestamp_micros("us"))
    return apply_rule(rows, rules.evasion(window_us), watermark)


LINKED = "kind string, link string, host string, us long, seq long, source string"


def new_country_stage(
    events: DataFrame, path: str, checkpoint: str, link_col: str = "source", **trigger
) -> StreamingQuery:
    """First query: new-country logins, with the escalation commands of the same batch."""
    if link_col not in ("source", "host"):
        raise ValueError("link_col must be 'source' or 'host'")
    attempts = events.where(
        (F.col("event_type") == PROCESS) & contains_any(F.col("command"), chains.ESCALATION_PATTERNS)
    ).withColumn("us", micros())
    columns = [F.col(link_col).alias("link"), "host", "us", "seq", "source"]
    out = new_country_hits(events).select(F.lit("alert").alias("kind"), *columns).unionByName(
        attempts.select(F.lit("attempt").alias("kind"), *columns)
    )
    return _sink(out, path, checkpoint, **trigger)


def escalation_hits(
    spark: SparkSession, source: str, window_us: int = chains.ESCALATION_WINDOW, watermark: str | None = None
) -> DataFrame:
    """Second query: hits of the chain."""
    rows = _read_stage(spark, source, LINKED).withColumn("ts", F.timestamp_micros("us"))
    return apply_rule(rows, rules.escalation(window_us), watermark)

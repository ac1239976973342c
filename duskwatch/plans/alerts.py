"""Detector hits to alert rows.

Detectors return typed hit columns; the wording, severity and metadata of each
rule are added here, once, for the batch and the streaming path alike.

Fixed values: rule names, severities, metadata keys and message texts below are
part of the alert format, their spelling included.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.alerting import alert_id, log_level
from ..functions.clock import duration_text
from ..schema import EXTRA_TYPE, micros


def _metadata(values: dict[str, Column]) -> Column:
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in sorted(values.items())])
    return F.map_from_entries(F.filter(pairs, lambda e: e["value"].isNotNull())).cast(EXTRA_TYPE)


def _alert(hits: DataFrame, order: int | Column, name, severity, message: Column, values: dict[str, Column]) -> DataFrame:
    def col(x):
        return x if isinstance(x, Column) else F.lit(x)

    return hits.select(
        col(order).cast("int").alias("rule_order"),
        col(name).alias("rule_name"),
        message.alias("message"),
        col(severity).alias("severity"),
        F.timestamp_micros("us").alias("ts"),
        "source",
        "host",
        "seq",
        _metadata(values).alias("metadata"),
    )


# Positions of the built-in rules after the pattern rules, which use their own index.
STATEFUL_BASE, CHAIN_BASE = 1_000_000, 2_000_000

c = F.col


def pattern_alerts(hits: DataFrame) -> DataFrame:
    return _alert(
        hits,
        c("rule_idx"),
        c("name"),
        c("severity"),
        c("description"),
        {
            "mitre_technique_id": c("technique_id"),
            "pid": F.coalesce("pid", F.lit("")),
            "command": c("command"),
            "process_name": c("process_name"),
        },
    )


def failed_login_alerts(hits: DataFrame) -> DataFrame:
    text = F.format_string(
        "Detected %d failed SSH logins from %s for user %s in the last minute.", c("attempt_count"), c("source"), c("user")
    )
    return _alert(
        hits,
        STATEFUL_BASE,
        "TooManyFailedLogins",
        "HIGH",
        text,
        {"attempt_count": c("attempt_count"), "time_window": duration_text(c("window_us")), "user": c("user")},
    )


def new_country_alerts(hits: DataFrame) -> DataFrame:
    text = F.format_string(
        "User '%s' logged in from a new country: %s (IP: %s)",
        c("user"),
        c("country"),
        F.coalesce("source", F.lit("")),
    )
    return _alert(
        hits, STATEFUL_BASE + 1, "NewCountryLogin", "MEDIUM", text, {"user": c("user"), "country": c("country")}
    )


def rapid_process_alerts(hits: DataFrame) -> DataFrame:
    window = duration_text(c("window_us"))
    text = F.format_string("Detected %d processes executed in %s from %s", c("process_count"), window, c("source"))
    return _alert(
        hits,
        STATEFUL_BASE + 2,
        "RapidProcessExecution",
        "MEDIUM",
        text,
        {"process_count": c("process_count"), "time_window": window},
    )


def watchlist_alerts(hits: DataFrame) -> DataFrame:
    text = F.format_string("Traffic detected from a known bad IP address: %s", c("source"))
    return _alert(
        hits,
        STATEFUL_BASE + 3,
        "IPWatchlistMatch",
        "HIGH",
        text,
        {"mitre_tactic": F.lit("TA0011"), "event_type": c("event_type")},
    )


def spray_alerts(hits: DataFrame) -> DataFrame:
    window = duration_text(c("window_us"))
    text = F.format_string(
        "Detected failed SSH logins from %s against %d distinct users in %s.", c("source"), c("user_count"), window
    )
    return _alert(
        hits,
        STATEFUL_BASE + 4,
        "PasswordSpray",
        "HIGH",
        text,
        {"user_count": c("user_count"), "time_window": window},
    )


def brute_force_evasion_alerts(hits: DataFrame) -> DataFrame:
    text = F.format_string(
        "Attach Chain Detected: A successful login from %s after a brute-force was followed by the "
        "defenseive evasion command: '%s'",
        c("source"),
        c("command"),
    )
    return _alert(
        hits,
        CHAIN_BASE,
        "CorrelatedBruteForceAndEvasion",
        "CRITICAL",
        text,
        {
            "mitre_tactic": F.lit("TA0005"),
            "correlated_events": F.lit("TooManyFailedLogins, SSHD_Accepted_Password, DefenseEvasionCommand"),
            "source_ip": c("source"),
            "evasion_command": c("command"),
            "linked_sshd_pid": c("ppid"),
        },
    )


def download_execute_alerts(hits: DataFrame) -> DataFrame:
    text = F.format_string("Attack Chain Detected: A file was download to %s and then executed.", c("path"))
    return _alert(
        hits,
        CHAIN_BASE + 1,
        "CorrelatedDownloadAndExecute",
        "CRITICAL",
        text,
        {
            "mitre_technique": F.lit("T1105"),
            "time_to_execution": duration_text(c("gap_us")),
            "executed_command": c("command"),
            "staged_filepath": c("path"),
        },
    )


def new_account_alerts(hits: DataFrame) -> DataFrame:
    text = F.format_string(
        "Attack Chain Detected: A new local account for user '%s' was created and used to log in shortly after.",
        c("user"),
    )
    return _alert(
        hits,
        CHAIN_BASE + 2,
        "CorrelatedNewAccountUsage",
        "HIGH",
        text,
        {
            "mitre_tactic": F.lit("TA0003"),
            "username": c("user"),
            "time_to_login": duration_text(c("gap_us")),
        },
    )


def login_escalation_alerts(hits: DataFrame) -> DataFrame:
    text = F.format_string(
        "Attack Chain Detected: A Login from a new country (%s) was followed by a privile escalation attempt",
        F.coalesce("source", F.lit("")),
    )
    return _alert(
        hits,
        CHAIN_BASE + 3,
        "CorrelatedLoginAndEscalation",
        "CRITICAL",
        text,
        {
            "mitre_tactic": F.lit("TA0004"),
            "correlated_events": F.lit("NewCountryLogin, PrivilegeEscalationAttempt"),
            "time_to_escalation": duration_text(c("gap_us")),
        },
    )


def as_log_records(alerts: DataFrame) -> DataFrame:
    """Alerts with their identifier and log level, as the alert log stores them."""
    return alerts.withColumns(
        {
            "alert_id": alert_id(c("rule_name"), micros(), c("source")),
            "log_level": log_level(c("severity")),
        }
    )


def counters(df: DataFrame, *by: str) -> DataFrame:
    """Row count, in total or per column value."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("count"))


AlertFormat = Callable[[DataFrame], DataFrame]

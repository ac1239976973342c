"""The registered queries: every operator run over the shared test tables.

Results are flat (no maps) and carry times as BIGINT microseconds, so that
another SQL engine can restate and compare them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.alerting import is_high_priority, severity_level
from ..functions.clock import HOUR, duration_text
from ..functions.export import event_json
from ..functions.net import ipv4_to_long, is_private_ip
from ..operators import stateless
from ..operators.enrich import enrich_geo, enrich_geo_stream
from ..operators.parse import events_of, parse_lines, quarantine_of
from ..schema import ACCEPTED_LOGIN, FAILED_LOGIN, PROCESS, micros
from ..sources import fixtures as fx
from ..sources import store
from ..sources.checkpoint import shared_folder
from ..streaming import detect as live
from ..streaming.engine import RuleEngine
from . import alerts as fmt
from . import hunt
from .engine import DETECTORS, DetectionContext, detect

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

HUNTED_PID = "1005"
HUNTED_IP = "203.0.0.1"
RANGE_START, RANGE_END = fx.EPOCH_US + 500 * 1_000_000, fx.EPOCH_US + 7_500 * 1_000_000 + 250_000
WIDE_EVASION_WINDOW = 12 * HOUR


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def context(spark: SparkSession, sf_dir: str, **params) -> DetectionContext:
    """Detection over the projected tables, linked by host."""
    return DetectionContext(
        events=fx.security_events(spark, sf_dir), link_col="host", geo_ranges=fx.geo_ranges(spark, sf_dir), **params
    )


def _of(key: str) -> Column:
    return F.col("metadata").getItem(key).alias(key)


def _flat(alerts: DataFrame, *keys: str, count: str | None = None) -> DataFrame:
    extra = [_of(k) for k in keys]
    if count:
        extra.append(F.col("metadata").getItem(count).cast("long").alias(count))
    return alerts.select("rule_name", "severity", micros().alias("us"), "seq", "host", "source", "message", *extra)


# --- parsing -----------------------------------------------------------------------------


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_lines(fx.log_lines(fx.security_events(spark, sf_dir)), fx.ASSUMED_YEAR)


def _parsed_events(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return events_of(_parsed(spark, sf_dir)).where(F.col("event_type") == kind)


@query
def parse_failed_login(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed_events(spark, sf_dir, FAILED_LOGIN).select(
        "seq", "host", micros().alias("us"), "event_type", "source", F.col("user").alias("usr")
    )


@query
def parse_accepted_login(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed_events(spark, sf_dir, ACCEPTED_LOGIN).select(
        "seq", "host", micros().alias("us"), "event_type", "source", F.col("user").alias("usr"), "sshd_pid"
    )


@query
def parse_process_exec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed_events(spark, sf_dir, PROCESS).select(
        "seq", "host", micros().alias("us"), "event_type", "source",
        "uid", "process_name", "pid", "ppid", "return_code", "command",
    )


@query
def parse_disposition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fmt.counters(_parsed(spark, sf_dir), "disposition")


# --- enrichment and scalar functions -------------------------------------------------------


@query
def private_ip_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    firsts = "10, 172, 192, 203, 127, 256"
    ip = F.expr(
        f"concat_ws('.', element_at(array({firsts}), CAST(event_id % 6 AS INT) + 1), "
        "(event_id * 7 + user_id) % 256, event_id % 256, user_id % 256)"
    )
    return raw.select(F.col("event_id").alias("seq"), ip.alias("ip")).select(
        "seq", "ip", ipv4_to_long(F.col("ip")).alias("ip_number"), is_private_ip(F.col("ip")).alias("is_private")
    )


@query
def geo_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_geo(fx.security_events(spark, sf_dir), fx.geo_ranges(spark, sf_dir)).select(
        "seq", "source", "country", "country_name", "city", "latitude", "longitude"
    )


@query
def alert_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = fmt.as_log_records(detect(context(spark, sf_dir), ["rules_stateless", "failed_logins"]))
    return alerts.select(
        "seq",
        "rule_name",
        "severity",
        severity_level(F.col("severity")).cast("long").alias("severity_level"),
        is_high_priority(F.col("severity")).alias("high_priority"),
        "log_level",
    )


@query
def alert_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = fmt.as_log_records(detect(context(spark, sf_dir), ["rules_stateless", "failed_logins"]))
    return alerts.select("seq", "rule_name", "alert_id")


@query
def duration_text_of_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    gap = F.expr(
        "CASE event_id % 4 WHEN 0 THEN event_id % 1000 WHEN 1 THEN (event_id * 37) % 1000000 "
        "WHEN 2 THEN (event_id * 12345) % 60000000 ELSE event_id * 987654 END"
    )
    return raw.select(F.col("event_id").alias("seq"), gap.alias("gap_us")).select(
        "seq", "gap_us", duration_text(F.col("gap_us")).alias("gap_text")
    )


QUERIES["duration_text"] = QUERIES.pop("duration_text_of_gaps")


@query
def event_json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.security_events(spark, sf_dir).select("seq", event_json().alias("document"))


QUERIES["event_json"] = QUERIES.pop("event_json_documents")


# --- detectors -----------------------------------------------------------------------------


@query
def rules_stateless(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = detect(context(spark, sf_dir), ["rules_stateless"])
    return _flat(alerts, "mitre_technique_id", "pid", "command", "process_name")


@query
def ip_watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(detect(context(spark, sf_dir, watchlist=fx.watched(spark)), ["ip_watchlist"]), "mitre_tactic", "event_type")


@query
def failed_logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = detect(context(spark, sf_dir), ["failed_logins"])
    return _flat(alerts, "time_window", "user", count="attempt_count").withColumnRenamed("user", "usr")


@query
def password_spray(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(detect(context(spark, sf_dir), ["password_spray"]), "time_window", count="user_count")


@query
def new_country_login(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = detect(context(spark, sf_dir), ["new_country_login"])
    return _flat(alerts, "user", "country").withColumnRenamed("user", "usr")


@query
def rapid_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(detect(context(spark, sf_dir), ["rapid_process"]), "time_window", count="process_count")


@query
def download_execute(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = detect(context(spark, sf_dir), ["download_execute"])
    return _flat(alerts, "mitre_technique", "time_to_execution", "executed_command", "staged_filepath")


@query
def download_execute_contested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events, but commands name two staged paths, so they compete for downloads."""
    events = fx.security_events(spark, sf_dir)
    named = F.concat(F.lit("sh /tmp/p"), F.pmod("seq", F.lit(5)), F.lit(".sh /dev/shm/q"), F.pmod(F.floor(F.col("seq") / 3), F.lit(5)))
    runs = F.col("command").startswith("bash /tmp/") | F.col("command").startswith("chmod 777 ")
    ctx = DetectionContext(events.withColumn("command", F.when(runs, named).otherwise(F.col("command"))))
    alerts = detect(ctx, ["download_execute"])
    return _flat(alerts, "mitre_technique", "time_to_execution", "executed_command", "staged_filepath")


@query
def new_account_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(
        detect(context(spark, sf_dir), ["new_account_use"]), "mitre_tactic", "username", "time_to_login"
    )


@query
def login_escalation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(
        detect(context(spark, sf_dir), ["login_escalation"]), "mitre_tactic", "correlated_events", "time_to_escalation"
    )


_EVASION_KEYS = ("mitre_tactic", "correlated_events", "source_ip", "evasion_command", "linked_sshd_pid")


@query
def brute_force_evasion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(detect(context(spark, sf_dir), ["brute_force_evasion"]), *_EVASION_KEYS)


@query
def brute_force_evasion_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = context(spark, sf_dir, evasion_window_us=WIDE_EVASION_WINDOW)
    return _flat(detect(ctx, ["brute_force_evasion"]), *_EVASION_KEYS)


def _every_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(context(spark, sf_dir, watchlist=fx.watched(spark)), list(DETECTORS))


@query
def all_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_every_alert(spark, sf_dir))


@query
def events_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fmt.counters(fx.security_events(spark, sf_dir))


@query
def alerts_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fmt.counters(_every_alert(spark, sf_dir), "rule_name")


@query
def alerts_by_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fmt.counters(_every_alert(spark, sf_dir), "severity")


# --- hunting -------------------------------------------------------------------------------


def _found(df: DataFrame) -> DataFrame:
    return df.select("us", "seq", "process_name", "command", "pid", "ppid", "uid")


@query
def search_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(hunt.search_events(fx.security_events(spark, sf_dir), {"process_name": "wget"}, limit=None))


@query
def search_first_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(hunt.search_events(fx.security_events(spark, sf_dir), {"process_name": "wget"}, limit=10))


@query
def search_command(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.security_events(spark, sf_dir)
    return hunt.search_events(events, {"command": "Sudo /bin/BASH"}, limit=None).select(
        "us", "seq", "process_name", "command", "pid", "ppid", "uid", F.col("matched").cast("long").alias("matched")
    )


@query
def search_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(hunt.search_events(fx.security_events(spark, sf_dir), {}, RANGE_START, RANGE_END, limit=None))


@query
def search_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    filters = {"process_name": "bash", "uid": "1000", "command": "history tmp"}
    return _found(hunt.search_events(fx.security_events(spark, sf_dir), filters, RANGE_START, RANGE_END, limit=None))


@query
def top_process_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hunt.top_events(fx.security_events(spark, sf_dir), "process_name")


@query
def top_uid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hunt.top_events(fx.security_events(spark, sf_dir), "uid")


@query
def top_with_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hunt.top_events(fx.security_events(spark, sf_dir), "command", 5, RANGE_START, RANGE_END)


@query
def process_ancestry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hunt.process_ancestry(fx.security_events(spark, sf_dir), HUNTED_PID).select(
        F.col("depth").cast("long").alias("depth"), "us", "seq", "process_name", "command", "pid", "ppid", "uid"
    )


@query
def process_ancestry_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hunt.process_ancestry_all(fx.security_events(spark, sf_dir)).select(
        "start_pid", F.col("depth").cast("long").alias("depth"), "us", "seq", "command", "pid", "ppid"
    )


@query
def process_ancestry_by_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hunt.process_ancestry_all(fx.security_events(spark, sf_dir), by_host=True).select(
        "host", "start_pid", F.col("depth").cast("long").alias("depth"), "us", "seq", "command", "pid", "ppid"
    )


@query
def process_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(hunt.process_history(fx.security_events(spark, sf_dir)))


@query
def failed_login_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hunt.failed_login_times(fx.security_events(spark, sf_dir), HUNTED_IP).select("us", "seq")


# --- sinks ----------------------------------------------------------------------------------


@query
def alert_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts written to the alert store and read back."""
    path = shared_folder(spark, "alerts")
    store.write_alerts(detect(context(spark, sf_dir), ["rules_stateless", "failed_logins"]), path)
    return _flat(store.read_alerts(spark, path).withColumn("metadata", F.map_from_arrays(F.array(F.lit("alert_id"), F.lit("log_level")), F.array("alert_id", "log_level"))), "alert_id", "log_level")


@query
def log_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are no events, written to the quarantine and read back."""
    path = shared_folder(spark, "quarantine")
    store.write_quarantine(quarantine_of(_parsed(spark, sf_dir)), path)
    return store.read_quarantine(spark, path)


@query
def event_documents_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as JSON documents and read back; documents carry neither host nor number."""
    path = shared_folder(spark, "documents")
    store.write_event_documents(fx.security_events(spark, sf_dir), path)
    return store.read_event_documents(spark, path).select(
        micros().alias("us"), "event_type", "source", F.col("user").alias("usr"), "sshd_pid", "process_name", "pid", "ppid", "uid", "return_code", "command"
    )


@query
def stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the store between two times, days and type pruned."""
    path = shared_folder(spark, "events")
    store.write_events(fx.security_events(spark, sf_dir), path)
    return _found(hunt.search_events(store.read_events(spark, path, with_day=True), {}, RANGE_START, RANGE_END, limit=None))


# --- streaming twins ------------------------------------------------------------------------


def _engine_on_lines(spark: SparkSession, sf_dir: str) -> RuleEngine:
    """The online engine run over all available log lines."""
    engine = RuleEngine(
        shared_folder(spark, "engine"), fx.watched, fx.geo_ranges(spark, sf_dir), link_col="host", assumed_year=fx.ASSUMED_YEAR
    )
    engine.start_on_lines(fx.log_lines(_stream(spark, sf_dir))).awaitTermination()
    return engine


@query
def stream_all_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log text to all rules to the alert store."""
    return _flat(store.read_alerts(spark, _engine_on_lines(spark, sf_dir).alerts_path))


@query
def stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _engine_on_lines(spark, sf_dir).counters(spark)


def _drained(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A stream run over all available input into a file sink, read back as a table."""
    folder = shared_folder(spark, "stream")
    q = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{folder}/state")
    q.trigger(availableNow=True).start(f"{folder}/out").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.security_events(spark, sf_dir, stream=True)


@query
def stream_rules_stateless(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = fmt.pattern_alerts(_drained(spark, stateless.pattern_hits(_stream(spark, sf_dir))))
    return _flat(alerts, "mitre_technique_id", "pid", "command", "process_name")


@query
def stream_ip_watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = _drained(spark, stateless.watchlist_hits(_stream(spark, sf_dir), fx.watched(spark)))
    return _flat(fmt.watchlist_alerts(hits), "mitre_tactic", "event_type")


@query
def stream_failed_logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = fmt.failed_login_alerts(_drained(spark, live.failed_login_hits(_stream(spark, sf_dir))))
    return _flat(alerts, "time_window", "user", count="attempt_count").withColumnRenamed("user", "usr")


@query
def stream_password_spray(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = fmt.spray_alerts(_drained(spark, live.spray_hits(_stream(spark, sf_dir))))
    return _flat(alerts, "time_window", count="user_count")


def _located(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_geo_stream(_stream(spark, sf_dir), fx.geo_ranges(spark, sf_dir))


@query
def stream_new_country_login(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = fmt.new_country_alerts(_drained(spark, live.new_country_hits(_located(spark, sf_dir))))
    return _flat(alerts, "user", "country").withColumnRenamed("user", "usr")


@query
def stream_rapid_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = fmt.rapid_process_alerts(_drained(spark, live.rapid_process_hits(_stream(spark, sf_dir))))
    return _flat(alerts, "time_window", count="process_count")


@query
def stream_download_execute(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = fmt.download_execute_alerts(_drained(spark, live.download_execute_hits(_stream(spark, sf_dir))))
    return _flat(alerts, "mitre_technique", "time_to_execution", "executed_command", "staged_filepath")


@query
def stream_new_account_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = fmt.new_account_alerts(_drained(spark, live.new_account_hits(_stream(spark, sf_dir))))
    return _flat(alerts, "mitre_tactic", "username", "time_to_login")


@query
def stream_login_escalation(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "stage")
    live.new_country_stage(_located(spark, sf_dir), f"{folder}/s1", f"{folder}/c1", "host").awaitTermination()
    alerts = fmt.login_escalation_alerts(_drained(spark, live.escalation_hits(spark, f"{folder}/s1")))
    return _flat(alerts, "mitre_tactic", "correlated_events", "time_to_escalation")


@query
def stream_brute_force_evasion(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "stage")
    live.brute_force_stage(_stream(spark, sf_dir), f"{folder}/s1", f"{folder}/c1").awaitTermination()
    live.session_stage(spark, f"{folder}/s1", f"{folder}/s2", f"{folder}/c2").awaitTermination()
    hits = _drained(spark, live.evasion_hits(spark, f"{folder}/s2", WIDE_EVASION_WINDOW))
    return _flat(fmt.brute_force_evasion_alerts(hits), *_EVASION_KEYS)

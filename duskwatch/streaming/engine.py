"""The online rule engine: one streaming query from log lines or events to all sinks.

Each micro-batch runs the batch detectors over its own events and over what earlier
events left open.  That carried state is a handful of small tables, one version a
batch: recent attempts, keys that have alerted, hosts in cooldown, and the latest unused opener of
each chain and key.  Every table and sink is written under the number of the batch, and a batch that is
tried again reads the version before it and writes the same rows in the same places, so
alerts, events, quarantined lines and counters are each stored exactly once, across restarts too.

Events should come in the order of their time, as rotated logs do.  A late event is evaluated
against what is still carried: it can complete a window or a chain that is open, but it can't
take back alerts, and openers that are out of their window are gone.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import chains, stateless
from ..operators import thresholds as th
from ..operators.asof import still_open
from ..operators.enrich import enrich_geo
from ..operators.parse import events_of, parse_lines, quarantine_of
from ..plans import alerts as fmt
from ..schema import EVENT_SCHEMA, FAILED_LOGIN, PROCESS, micros
from ..sources import store
from ..sources.checkpoint import remove_folder, remove_stages, stages_made
from ..sources.logs import number_lines

# Openers are (keys, us, seq, ...); ``alerted`` and ``countries`` hold a row for each key that has alerted.
STATES = {
    "clock": "newest_us long",
    "recent": "host string, ts timestamp, seq long, event_type string, source string, user string",
    "alerted_pairs": "source string, user string",
    "alerted_sources": "source string",
    "countries": "user string, country string",
    "cooldown": "host string, free_us long",
    "accounts": "host string, user string, us long, seq long",
    "downloads": "host string, path string, us long, seq long",
    "armed": "source string, us long, seq long",
    "sessions": "host string, pid string, us long, seq long, source string",
    "logins": "link string, us long, seq long",
}
COUNTERS = "counter string, label string, n long"
# Independent small jobs of a micro-batch that run side by side.
AT_ONCE = 8


@dataclass
class RuleEngine:
    """Rules and their parameters, and the folder of the engine's sinks and state.

    ``watchlist`` is called for every micro-batch, so a list that is replaced while the query runs
    counts from the next batch on.  Sinks: events/, quarantine/, alerts/ and counters/ in ``folder``.
    """

    folder: str
    watchlist: Callable[[SparkSession], DataFrame] | None = None
    geo_ranges: DataFrame | None = None
    rules: list[tuple] | None = None
    link_col: str = "source"
    assumed_year: int | None = None
    failed_login: th.FailedLoginParams = field(default_factory=th.FailedLoginParams)
    spray: th.SprayParams = field(default_factory=th.SprayParams)
    rapid: th.RapidParams = field(default_factory=th.RapidParams)
    evasion_window_us: int = chains.EVASION_WINDOW
    execute_window_us: int = chains.EXECUTE_WINDOW
    account_window_us: int = chains.NEW_ACCOUNT_WINDOW
    escalation_window_us: int = chains.ESCALATION_WINDOW

    @property
    def events_path(self) -> str:
        return f"{self.folder}/events"

    @property
    def alerts_path(self) -> str:
        return f"{self.folder}/alerts"

    @property
    def quarantine_path(self) -> str:
        return f"{self.folder}/quarantine"

    @property
    def counters_path(self) -> str:
        return f"{self.folder}/counters"

    def start_on_lines(self, lines: DataFrame, **trigger) -> StreamingQuery:
        """Parse lines, store events and other lines, and evaluate all rules.

        ``lines`` is a stream of (seq, host, line), or of what ``stream_log_files`` gives, which is numbered here.
        """
        return self._start(lines, self.on_lines, trigger)

    def start_on_events(self, events: DataFrame, **trigger) -> StreamingQuery:
        return self._start(events, self.on_events, trigger)

    def _start(self, df: DataFrame, handler, trigger: dict) -> StreamingQuery:
        writer = df.writeStream.foreachBatch(handler).option("checkpointLocation", f"{self.folder}/checkpoint")
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def on_lines(self, lines: DataFrame, batch: int) -> None:
        numbered = number_lines(lines) if "seq" not in lines.columns else lines
        parsed = self._staged(parse_lines(numbered, self.assumed_year), f"inbox/{batch}/parsed")
        store.write_quarantine(quarantine_of(parsed), self.quarantine_path, batch=batch)
        self.on_events(events_of(parsed), batch)

    def on_events(self, events: DataFrame, batch: int) -> None:
        """Evaluate one micro-batch; may be called again for the last batch, with the same events."""
        spark, stages = events.sparkSession, stages_made()
        if self.geo_ranges is not None:
            events = enrich_geo(events, self.geo_ranges)
        events = events.select(*[f.name for f in EVENT_SCHEMA.fields])
        events = self._staged(events, f"inbox/{batch}/events")
        store.write_events(events, self.events_path, batch=batch)
        before = {name: self._state(spark, name, batch - 1) for name in STATES}
        hits, after = self._evaluate(events, before, batch)
        alerts = self._staged(reduce(DataFrame.unionByName, hits), f"inbox/{batch}/alerts")
        store.write_alerts(alerts, self.alerts_path, batch=batch)
        counted = [events.select(F.lit("events_total").alias("counter"), F.lit(None).cast("string").alias("label"))]
        counted += [alerts.select(F.lit(f"alerts_by_{c}").alias("counter"), F.col(of).alias("label")) for c, of in (("rule", "rule_name"), ("severity", "severity"))]
        totals = reduce(DataFrame.union, counted).groupBy("counter", "label").agg(F.count(F.lit(1)).alias("n"))
        totals.coalesce(1).write.mode("overwrite").parquet(f"{self.counters_path}/batch={batch}")
        with ThreadPoolExecutor(AT_ONCE) as pool:
            list(pool.map(lambda s: s[1].write.mode("overwrite").parquet(f"{self.folder}/state/{s[0]}/{batch}"), after.items()))
        # The batch may be tried again until its checkpoint is written, so the version it read stays.
        for name in (f"inbox/{batch}", *(f"state/{name}/{batch - 2}" for name in STATES)):
            remove_folder(spark, f"{self.folder}/{name}")
        remove_stages(spark, stages)

    def _evaluate(self, events: DataFrame, before: dict[str, DataFrame], batch: int) -> tuple[list[DataFrame], dict[str, DataFrame]]:
        """Alerts of the new events, and the state after them."""

        newest = events.agg(F.max(micros()).alias("us")).unionByName(before["clock"].select(F.col("newest_us").alias("us"))).agg(F.max("us")).first()[0]
        newest = newest if newest is not None else 0
        recent = events.select(*before["recent"].columns).where(F.col("event_type").isin(FAILED_LOGIN, PROCESS)).unionByName(before["recent"])
        tail = events.unionByName(before["recent"], allowMissingColumns=True)

        rules: dict[str, Callable[[], DataFrame]] = {
            "brute": lambda: th.failed_login_hits(tail, self.failed_login).join(before["alerted_pairs"], ["source", "user"], "left_anti"),
            "spray": lambda: th.spray_hits(tail, self.spray).join(before["alerted_sources"], "source", "left_anti"),
            "countries": lambda: th.new_country_hits(events).join(before["countries"], ["user", "country"], "left_anti"),
            "rapid": lambda: th.rapid_process_hits(tail, self.rapid, before["cooldown"]),
            "downloads": lambda: chains.download_execute_hits(events, self.execute_window_us, before["downloads"]),
        }
        with ThreadPoolExecutor(AT_ONCE) as pool:
            found = dict(zip(rules, pool.map(lambda r: self._staged(r[1](), f"inbox/{batch}/{r[0]}"), rules.items()), strict=True))
        brute, spray, countries, rapid, downloads = (found[r] for r in rules)
        armed = brute.select("source", "us", "seq").unionByName(before["armed"])
        sessions = self._staged(chains.armed_sessions(events, armed).unionByName(before["sessions"]), f"inbox/{batch}/sessions")
        hits = [
            fmt.pattern_alerts(stateless.pattern_hits(events, self.rules)),
            fmt.failed_login_alerts(brute),
            fmt.spray_alerts(spray),
            fmt.new_country_alerts(countries),
            fmt.rapid_process_alerts(rapid),
            fmt.download_execute_alerts(downloads),
            fmt.new_account_alerts(chains.new_account_hits(events, self.account_window_us, before["accounts"])),
            fmt.brute_force_evasion_alerts(chains.session_evasion_hits(events, sessions, self.evasion_window_us)),
            fmt.login_escalation_alerts(
                chains.login_escalation_hits(events, countries, self.link_col, self.escalation_window_us, before["logins"])
            ),
        ]
        if self.watchlist is not None:
            hits.append(fmt.watchlist_alerts(stateless.watchlist_hits(events, self.watchlist(events.sparkSession))))

        window = max(self.failed_login.window_us, self.spray.window_us, self.rapid.window_us)
        free = rapid.select("host", (F.col("us") + self.rapid.cooldown_us).alias("free_us")).unionByName(before["cooldown"])
        staged = chains.staged_downloads(events).unionByName(before["downloads"])
        newest_of = staged.groupBy("host", "path").agg(F.max(F.struct("us", "seq")).alias("at")).select("host", "path", "at.us", "at.seq")
        used = downloads.select("host", "path", F.col("dseq").alias("seq"))
        countries_by_link = countries.select(F.col(self.link_col).alias("link"), "us", "seq").unionByName(before["logins"])
        attempts = chains.escalation_attempts(events, self.link_col)
        return hits, {
            "clock": events.sparkSession.range(1).select(F.lit(newest).cast("long").alias("newest_us")),
            "recent": recent.where(micros() >= newest - window),
            "alerted_pairs": brute.select("source", "user").unionByName(before["alerted_pairs"]),
            "alerted_sources": spray.select("source").unionByName(before["alerted_sources"]),
            "countries": countries.select("user", "country").unionByName(before["countries"]),
            "cooldown": free.where(F.col("free_us") > newest).groupBy("host").agg(F.max("free_us").alias("free_us")),
            "accounts": still_open(
                chains.created_accounts(events).unionByName(before["accounts"]), chains.account_logins(events),
                ["host", "user"], newest, self.account_window_us,
            ),
            "downloads": newest_of.join(used, ["host", "path", "seq"], "left_anti").where(F.col("us") >= newest - self.execute_window_us),
            "armed": still_open(armed, chains.session_logins(events), ["source"], newest, None),
            "sessions": still_open(sessions, chains.evasions(events), ["host", "pid"], newest, self.evasion_window_us),
            "logins": still_open(countries_by_link, attempts, ["link"], newest, self.escalation_window_us),
        }

    def _state(self, spark: SparkSession, name: str, batch: int) -> DataFrame:
        schema = T.StructType.fromDDL(STATES[name])
        if batch < 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{self.folder}/state/{name}/{batch}")

    def _staged(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def counters(self, spark: SparkSession) -> DataFrame:
        """(counter, label, n): events_total, alerts_by_rule and alerts_by_severity up to now."""
        return spark.read.schema(COUNTERS).parquet(self.counters_path).groupBy("counter", "label").agg(F.sum("n").alias("n"))

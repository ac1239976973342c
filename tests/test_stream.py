"""Streaming detectors give the hits of their batch twins, with the input split over several files."""

import pandas as pd
import pytest
from samples import S, frame, random_events

from duskwatch.operators import chains, stateless
from duskwatch.operators import thresholds as th
from duskwatch.schema import ACCEPTED_LOGIN, EVENT_SCHEMA, FAILED_LOGIN, PROCESS
from duskwatch.streaming import detect as sd
from duskwatch.streaming import rules


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """A directory of event files in time order, their stream, and the same rows as a batch."""
    events = sorted(random_events(11, n=2500), key=lambda e: (e["us"], e["seq"]))
    for e in events:  # some processes come from an address that logs in, so that chains link by source too
        if e["event_type"] == PROCESS and e["seq"] % 3 == 0:
            e["source"] = "10.0.0.1"
        if e["seq"] % 2:  # and many sessions have one number, which evasions name as their parent
            e.update({"sshd_pid": "100"} if e["event_type"] == ACCEPTED_LOGIN else {"ppid": "100"} if e["event_type"] == PROCESS else {})
    path = str(tmp_path_factory.mktemp("landed"))
    size = 600
    for i in range(0, len(events), size):
        frame(spark, events[i : i + size]).coalesce(2).write.mode("append").parquet(path)
    batch = spark.read.schema(EVENT_SCHEMA).parquet(path).cache()

    def stream():
        return spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 2).parquet(path)

    return stream, batch


def drain(spark, df, name):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(300)
    assert q.exception() is None
    return spark.table(name)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


CASES = {
    "failed_login_hits": (sd.failed_login_hits, th.failed_login_hits, ["us", "seq", "source", "user", "attempt_count"]),
    "spray_hits": (sd.spray_hits, th.spray_hits, ["us", "seq", "source", "user_count"]),
    "new_country_hits": (sd.new_country_hits, th.new_country_hits, ["us", "seq", "source", "user", "country"]),
    "rapid_process_hits": (sd.rapid_process_hits, th.rapid_process_hits, ["us", "seq", "host", "process_count"]),
    "new_account_hits": (sd.new_account_hits, chains.new_account_hits, ["us", "seq", "host", "user", "gap_us"]),
    "download_execute_hits": (
        sd.download_execute_hits, chains.download_execute_hits, ["us", "seq", "host", "path", "gap_us"],
    ),
    "pattern_hits": (stateless.pattern_hits, stateless.pattern_hits, ["us", "seq", "host", "name"]),
}


@pytest.mark.parametrize("name", list(CASES))
def test_stream_equals_batch(spark, landed, name):
    stream, batch = landed
    live, whole, cols = CASES[name]
    got, want = rows(drain(spark, live(stream()), name), *cols), rows(whole(batch), *cols)
    assert got == want and got


@pytest.mark.parametrize(
    "name", ["failed_login_hits", "spray_hits", "rapid_process_hits", "new_account_hits", "download_execute_hits"]
)
def test_expiry_does_not_change_results(spark, landed, name):
    stream, batch = landed
    live, whole, cols = CASES[name]
    got = rows(drain(spark, live(stream(), watermark="1 second"), name + "_wm"), *cols)
    assert got == rows(whole(batch), *cols) and got


@pytest.mark.parametrize("name", ["failed_login_hits", "spray_hits"])
def test_keys_that_never_alert_expire(spark, scratch, name):
    """Ten addresses with too few attempts leave no state behind; the one that alerted stays settled."""
    def attempts(start, source, n):
        return [
            {"event_type": FAILED_LOGIN, "host": "h", "us": (start + i) * S, "seq": start + i, "source": source, "user": "u" if name == "failed_login_hits" else f"u{i}"}
            for i in range(n)
        ]

    landed = [
        [e for i in range(10) for e in attempts(1000 + i, f"10.0.0.{i}", 2)],
        attempts(1100, "10.0.1.1", 30),
        attempts(90_000, "10.0.2.1", 1),
        attempts(180_000, "10.0.1.1", 30),
        attempts(270_000, "10.0.2.2", 1),
    ]
    for events in landed:
        frame(spark, events).coalesce(1).write.mode("append").parquet(f"{scratch}/landed")
    live = CASES[name][0]

    def left(watermark, label):
        stream = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/landed")
        q = (
            live(stream, watermark=watermark).writeStream.format("memory").queryName(f"{name}_{label}")
            .outputMode("append").trigger(availableNow=True).start()
        )
        q.awaitTermination(300)
        rows_left = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]][-1]
        return spark.table(f"{name}_{label}").select("us", "source").collect(), rows_left

    kept_hits, kept = left(None, "kept")
    hits, expired = left("1 second", "expired")
    assert hits == kept_hits and [h["source"] for h in hits] == ["10.0.1.1"]
    # Settled: 10.0.1.1. The newest attempt may still be waiting for its time.
    assert kept == 13 and expired <= 2


def test_brute_force_chain(spark, landed, scratch):
    stream, batch = landed
    sd.brute_force_stage(stream(), f"{scratch}/s1", f"{scratch}/c1").awaitTermination(300)
    sd.session_stage(spark, f"{scratch}/s1", f"{scratch}/s2", f"{scratch}/c2").awaitTermination(300)
    got = drain(spark, sd.evasion_hits(spark, f"{scratch}/s2", 2400 * S), "evasion")
    want = chains.brute_force_evasion_hits(batch, th.failed_login_hits(batch), 2400 * S)
    cols = ["us", "seq", "host", "source", "ppid"]
    assert rows(got, *cols) == rows(want, *cols) and rows(got, *cols)


@pytest.mark.parametrize("link", ["host", "source"])
def test_escalation_chain(spark, landed, scratch, link):
    stream, batch = landed
    sd.new_country_stage(stream(), f"{scratch}/s1", f"{scratch}/c1", link).awaitTermination(300)
    got = drain(spark, sd.escalation_hits(spark, f"{scratch}/s1"), f"escalation_{link}")
    want = chains.login_escalation_hits(batch, th.new_country_hits(batch), link)
    cols = ["us", "seq", "host", "gap_us"]
    assert rows(got, *cols) == rows(want, *cols) and rows(got, *cols)


def test_restart_writes_each_alert_once(spark, landed, scratch):
    stream, batch = landed

    def run():
        q = (
            sd.failed_login_hits(stream()).writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", f"{scratch}/c").trigger(availableNow=True).start(f"{scratch}/out")
        )
        q.awaitTermination(300)

    run()
    run()
    cols = ["us", "seq", "source", "user"]
    assert rows(spark.read.parquet(f"{scratch}/out"), *cols) == rows(th.failed_login_hits(batch), *cols)


def steps(rule, key, *batches):
    state, hits = None, []
    for batch in batches:
        state, more = rule.step(key, state, pd.DataFrame(batch).sort_values(["us", "seq"], ignore_index=True))
        hits += more
    return hits


def at(*seconds, **more):
    return [{"host": "h", "us": int(t * S), "seq": int(t * 10), "source": "s", **more} for t in seconds]


def test_late_rows_raise_no_false_alerts():
    logins = rules.failed_logins(th.FailedLoginParams(threshold=5, window_us=60 * S))
    assert steps(logins, ("s", "u"), at(1000, 1001, 1002, 1003), at(0)) == []
    assert [h[1] for h in steps(logins, ("s", "u"), at(1000, 1001, 1002, 1003), at(999))] == [1003 * S]
    assert steps(logins, ("s", "u"), at(61), at(0, 1, 2, 3)) == []
    spray = rules.spray(th.SprayParams(threshold=3, window_us=60 * S))
    late = [*at(1000, user="a"), *at(1001, user="b")], at(0, user="c")
    assert steps(spray, ("s",), *late) == []
    account = rules.new_account(300 * S)
    assert steps(account, ("h", "u"), at(6000, opens=True), at(1000, opens=False)) == []
    newest = at(6000, opens=True), at(5000, opens=True), at(6200, opens=False)
    assert [h[-1] for h in steps(account, ("h", "u"), *newest)] == [200 * S]
    staged = rules.download_execute(300 * S)
    assert steps(staged, ("h",), at(6000, command=None, path="/tmp/a"), at(1000, command="sh /tmp/a", path=None)) == []
    session = [{**r, "kind": "session"} for r in at(6000, command=None)]
    early = [{**r, "kind": "evasion"} for r in at(1000, command="history -c")]
    assert steps(rules.evasion(300 * S), ("h", "5"), session, early) == []
    alert, attempt = [{**r, "kind": "alert"} for r in at(6000)], [{**r, "kind": "attempt"} for r in at(1000)]
    assert steps(rules.escalation(300 * S), ("h",), alert, attempt) == []

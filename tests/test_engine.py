"""The online engine gives the alerts of one batch run, however the input is cut, and once each across restarts."""

import pytest
from samples import S, frame, random_events

from duskwatch.operators import thresholds as th
from duskwatch.plans.engine import DetectionContext, detect
from duskwatch.schema import EVENT_SCHEMA
from duskwatch.sources import store
from duskwatch.sources.logs import read_log_lines, stream_log_files
from duskwatch.streaming.engine import RuleEngine

FILES = 50
PARAMS = {"rapid": th.RapidParams(threshold=6, window_us=30 * S, cooldown_us=120 * S), "evasion_window_us": 900 * S}
COLUMNS = ["rule_name", "ts", "seq", "host", "source", "message", "metadata"]


def rows(df):
    return sorted(str(tuple(r)) for r in df.select(*COLUMNS).collect())


@pytest.fixture(scope="module")
def events():
    return sorted(random_events(21, n=1500, span_s=3000, hot=0.5), key=lambda e: (e["us"], e["seq"]))


@pytest.fixture(scope="module")
def landed(spark, events, tmp_path_factory):
    path = tmp_path_factory.mktemp("landed")
    size = -(-len(events) // FILES)
    for i in range(FILES):
        frame(spark, events[i * size : (i + 1) * size]).coalesce(1).write.parquet(f"{path}/{i:03d}")
    return str(path)


def watched(spark):
    return spark.createDataFrame([("10.0.0.3",)], "ip string")


@pytest.fixture(scope="module")
def whole(spark, events):
    ctx = DetectionContext(frame(spark, events), watchlist=watched(spark), link_col="host", **PARAMS)
    alerts = rows(detect(ctx))
    assert len({a.split("'")[1] for a in alerts}) >= 14  # stateful rules and chains among them
    return alerts


def stream(spark, path, files):
    return spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", files).parquet(f"{path}/*")


@pytest.mark.parametrize("files", [17])
def test_alerts_do_not_depend_on_the_batches(spark, landed, whole, scratch, files):
    engine = RuleEngine(f"{scratch}/e", watched, link_col="host", **PARAMS)
    engine.start_on_events(stream(spark, landed, files)).awaitTermination(600)
    assert rows(store.read_alerts(spark, engine.alerts_path)) == whole
    n = {r["counter"]: 0 for r in engine.counters(spark).collect()}
    for r in engine.counters(spark).collect():
        n[r["counter"]] += r["n"]
    assert n == {"events_total": 1500, "alerts_by_rule": len(whole), "alerts_by_severity": len(whole)}
    assert store.read_events(spark, engine.events_path).count() == 1500


def test_restart_and_a_batch_that_is_tried_again(spark, events, whole, scratch):
    for batch, (a, b) in [(0, (0, 900)), (1, (900, 1500)), (1, (900, 1500))]:  # the last batch's checkpoint was lost
        engine = RuleEngine(f"{scratch}/e", watched, link_col="host", **PARAMS)  # a new process knows the folder only
        engine.on_events(frame(spark, events[a:b]), batch)
    assert rows(store.read_alerts(spark, engine.alerts_path)) == whole
    assert store.read_events(spark, engine.events_path).count() == 1500


def test_watchlist_is_replaced_between_batches(spark, events, scratch):
    lists = [["10.0.0.3"], ["10.0.0.4"]]
    engine = RuleEngine(f"{scratch}/e", lambda s: s.createDataFrame([(ip,) for ip in lists[0]], "ip string"))
    found = []
    for batch, part in enumerate((events[:200], events[200:400])):
        engine.on_events(frame(spark, part), batch)
        alerts = store.read_alerts(spark, engine.alerts_path).where("rule_name = 'IPWatchlistMatch'")
        found.append({r["source"] for r in alerts.where(f"seq in ({', '.join(str(e['seq']) for e in part)})").collect()})
        lists.pop(0) if len(lists) > 1 else None
    assert found == [{"10.0.0.3"}, {"10.0.0.4"}]


def test_log_files_to_every_sink(spark, scratch):
    import os

    os.makedirs(f"{scratch}/logs/web1")
    line = "Jun 19 12:00:{:02d} my-server sshd[7]: Failed password for root from 203.0.113.9 port 22 ssh2\n"
    for k in range(3):
        with open(f"{scratch}/logs/web1/auth{k}.log", "w") as f:
            f.write("".join(line.format(10 * k + i) for i in range(3)) + "\nnothing known\n2024-13-01T00:00:00Z 0 ls 1 1 0 ls\n")
    engine = RuleEngine(f"{scratch}/e", assumed_year=2026)
    files = stream_log_files(spark, f"{scratch}/logs/*", r"/logs/([^/]+)/", max_files=2)
    engine.start_on_lines(files).awaitTermination(600)
    alerts = store.read_alerts(spark, engine.alerts_path).collect()
    assert [(r["rule_name"], r["host"], r["source"]) for r in alerts] == [("TooManyFailedLogins", "web1", "203.0.113.9")]
    events = store.read_events(spark, engine.events_path)
    batch = read_log_lines(spark, f"{scratch}/logs/*", r"/logs/([^/]+)/")
    numbers = {r["seq"] for r in batch.where("line like '%Failed%'").collect()}
    assert {r["seq"] for r in events.collect()} == numbers and len(numbers) == 9
    quarantined = store.read_quarantine(spark, engine.quarantine_path).groupBy("disposition").count().collect()
    assert {r["disposition"]: r["count"] for r in quarantined} == {"ignored": 3, "error": 3}

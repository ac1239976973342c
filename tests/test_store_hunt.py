"""From log files to stored events, and hunting over them."""

import ipaddress
import os
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from samples import BASE, S, accepted, failed, frame, process

from duskwatch.operators.enrich import disjoint_ranges, enrich_geo, enrich_geo_stream
from duskwatch.operators.parse import events_of, parse_lines
from duskwatch.plans import alerts as fmt
from duskwatch.plans import hunt
from duskwatch.plans.engine import DETECTORS, DetectionContext, detect, register_detector
from duskwatch.schema import EVENT_SCHEMA, PROCESS
from duskwatch.sources import store
from duskwatch.sources.logs import read_log_lines, stream_log_lines

EXEC = "2026-06-19T12:%02d:%02dZ 1000 %s %d %d 0 %s"


@pytest.fixture
def logs(scratch):
    """Two host logs in one directory."""
    for host in ("web1", "web2"):
        os.makedirs(f"{scratch}/logs/{host}")
        with open(f"{scratch}/logs/{host}/auth.log", "w") as f:
            for i in range(200):
                f.write(EXEC % (i // 60, i % 60, "bash", 100 + i, 99 + i, f"run {host} {i}") + "\n")
            f.write("\nnoise\n" + "Jun 40 12:00:00 my-server sshd[1]: Failed password for x from 1.1.1.1 port 1 ssh2\n")
    return f"{scratch}/logs"


HOST = r"/logs/([^/]+)/"


def test_log_files_batch_and_stream(spark, logs, scratch):
    lines = read_log_lines(spark, f"{logs}/*", HOST)
    assert lines.groupBy("host").count().count() == 2
    assert lines.select("seq").distinct().count() == lines.count() == 2 * 203
    parsed = parse_lines(lines, 2026)
    assert {r[0]: r[1] for r in parsed.groupBy("disposition").count().collect()} == {
        "event": 400, "blank": 2, "ignored": 2, "error": 2}
    # Order of lines within a file is order of seq.
    ordered = [r["command"] for r in events_of(parsed).where("host = 'web1'").orderBy("seq").collect()]
    assert ordered == [f"run web1 {i}" for i in range(200)]

    live = events_of(parse_lines(stream_log_lines(spark, f"{logs}/*", HOST, max_files=1), 2026))
    store.stream_events(live, f"{scratch}/store", f"{scratch}/ck").awaitTermination(120)
    stored = store.read_events(spark, f"{scratch}/store", PROCESS)
    cols = ["host", "ts", "command", "pid"]
    assert sorted(map(str, stored.select(*cols).collect())) == sorted(map(str, events_of(parsed).select(*cols).collect()))
    ordered = [r["command"] for r in stored.where("host = 'web2'").orderBy("seq").collect()]
    assert ordered == [f"run web2 {i}" for i in range(200)]


def sample(spark):
    events = [process(i, i * 600, "bash", f"cmd {i}", pid=str(100 + i), ppid=str(99 + i), uid="0") for i in range(300)]
    events += [accepted(1000 + i, i, "u", sshd_pid="5") for i in range(5)] + [failed(2000 + i, i) for i in range(5)]
    return frame(spark, events)


def test_store_layout_and_pruning(spark, scratch):
    events = sample(spark)
    store.write_events(events, f"{scratch}/e")
    assert sorted(d for d in os.listdir(f"{scratch}/e") if d.startswith("event_type")) == sorted(
        f"event_type={t}" for t in store.EVENT_TYPES.values())
    back = store.read_events(spark, f"{scratch}/e")
    assert back.schema == events.schema
    assert sorted(map(str, back.collect())) == sorted(map(str, events.collect()))
    start, end = datetime(2026, 6, 20, tzinfo=timezone.utc), datetime(2026, 6, 20, 23, 59, 59, tzinfo=timezone.utc)
    part = store.read_events(spark, f"{scratch}/e", PROCESS, start, end)
    assert part.count() == 144
    plan = part.select("pid")._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("PartitionFilters: [") :]
    assert "event_type#" in scan[: scan.index("PushedFilters")] and "dt#" in scan[: scan.index("PushedFilters")]
    assert "ReadSchema: struct<ts:timestamp,pid:string>" in plan
    assert "PushedFilters: [IsNotNull(ts)" in plan


def test_search_pushes_filters_down(spark, scratch):
    store.write_events(sample(spark), f"{scratch}/e")
    events = store.read_events(spark, f"{scratch}/e", PROCESS)
    plan = hunt.search_events(events, {"pid": "105"}, BASE, BASE + 10**12, limit=10)._jdf.queryExecution().executedPlan().toString()
    assert plan.startswith("TakeOrderedAndProject(limit=10")
    # The plan text cuts long lists; the scan node has them whole.
    scan = plan[plan.index("DataFilters: ") :]
    assert "pid#" in scan and "(ts#" in scan and "IsNotNull(pid)" in scan


def test_any_reader_of_the_store_prunes_types(spark, scratch):
    store.write_events(sample(spark), f"{scratch}/e")
    events = store.read_events(spark, f"{scratch}/e")
    for df in (hunt.search_events(events, {"pid": "105"}), hunt.top_events(events, "pid", 3)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        filters = plan[plan.index("PartitionFilters: [") :]
        assert "event_type#" in filters[: filters.index("]")]


def test_event_documents(spark, scratch):
    events = sample(spark)
    store.write_event_documents(events, f"{scratch}/d")
    back = store.read_event_documents(spark, f"{scratch}/d")
    assert back.select("seq").distinct().count() == events.count() and back.where("seq is null").isEmpty()
    cols = ["ts", "event_type", "source", "user", "command", "pid"]
    assert sorted(map(str, back.select(*cols).collect())) == sorted(map(str, events.select(*cols).collect()))


def test_alert_sink(spark, scratch):
    alerts = detect(DetectionContext(sample(spark)), ["failed_logins"])
    store.write_alerts(alerts, f"{scratch}/a")
    row = store.read_alerts(spark, f"{scratch}/a").first()
    assert row["alert_id"] == f"TooManyFailedLogins-{BASE // S + 4}-203.0.113.10" and row["log_level"] == "ERROR"
    assert fmt.counters(store.read_alerts(spark, f"{scratch}/a"), "severity").first()["count"] == 1


def test_search(spark):
    events = frame(spark, [
        process(0, 0, "bash", "Sudo rm -rf /tmp/x", uid="0"), process(1, 1, "bash", "sudo rm x", uid="1"),
        process(2, 2.5, "bash", "ls", uid="0"), process(3, 3, "Bash", "rm", uid="0"), failed(4, 4)])

    def seqs(**kw):
        return [r["seq"] for r in hunt.search_events(events, **kw).collect()]

    assert seqs() == [3, 2, 1, 0]
    assert seqs(filters={"process_name": "bash"}) == [2, 1, 0]
    assert seqs(filters={"command": "SUDO tmp"}) == [0, 1]
    assert seqs(filters={"command": "rm", "uid": "0"}) == [3, 0]
    assert seqs(filters={"return_code": "0"}) == []
    many = frame(spark, [process(i, i, "bash", "ls", uid="0") for i in range(25)])
    assert hunt.search_events(many).count() == 25
    assert seqs(limit=1) == [3] and len(seqs(limit=None)) == 4
    # Bounds are inclusive and cut to whole seconds; one bound alone is no range.
    assert seqs(start=BASE + S, end=BASE + 2 * S + 900_000) == [1]
    assert seqs(start=BASE + S) == [3, 2, 1, 0] and seqs(start=0, end=BASE) == [3, 2, 1, 0]
    assert seqs(start=datetime(2026, 6, 19, 12, 0, 3), end=datetime(2026, 6, 19, 12, 0, 3)) == [3]


def test_top(spark):
    events = frame(spark, [process(i, i, n, "c") for i, n in enumerate("bbaacd")] + [failed(9, 9)])
    assert [tuple(r) for r in hunt.top_events(events, "process_name", 3).collect()] == [("a", 2), ("b", 2), ("c", 1)]
    assert hunt.top_events(events, "uid").count() == 0
    for field, n in (("", 1), ("pid", 0)):
        with pytest.raises(ValueError):
            hunt.top_events(events, field, n)


def test_ancestry(spark):
    links = {"10": "9", "9": "8", "8": "1", "20": "21", "21": "20", "30": "99", "40": None}
    events = [process(i, i, "p", f"c{p}", pid=p, ppid=q) for i, (p, q) in enumerate(links.items())]
    events.append(process(50, -1, "old", "old", pid="9", ppid="20"))
    events.append(process(51, 51, "root", "root", pid="1", ppid="10"))
    df = frame(spark, events)
    chain = hunt.process_ancestry(df, "10").collect()
    assert [(r["depth"], r["pid"]) for r in chain] == [(0, "10"), (1, "9"), (2, "8")]
    every = hunt.process_ancestry_all(df).groupBy("start_pid").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {r["start_pid"]: r["n"] for r in every} == {"10": 3, "9": 2, "8": 1, "20": 20, "21": 20, "30": 1, "40": 1}
    assert hunt.process_ancestry_all(df, max_depth=7, pid="20").count() == 7
    assert hunt.process_ancestry(df, "404").count() == 0 == hunt.process_ancestry(df, "1").count()
    assert hunt.process_ancestry(df, "10", host="elsewhere").count() == 0


def test_history_and_login_times(spark):
    df = sample(spark)
    assert [r["seq"] for r in hunt.process_history(df).limit(3).collect()] == [0, 1, 2]
    assert [r["seq"] for r in hunt.failed_login_times(df, "203.0.113.10").collect()] == [2000, 2001, 2002, 2003, 2004]
    assert hunt.failed_login_times(df, "1.1.1.1").count() == 0


def test_detector_registry(spark):
    @register_detector("nothing")
    def nothing(ctx):
        return fmt.failed_login_alerts(ctx.brute_force).where(F.lit(False))

    try:
        assert detect(DetectionContext(sample(spark)), ["nothing"]).count() == 0
    finally:
        del DETECTORS["nothing"]


def test_bounds_of_a_search_prune_days(spark, scratch):
    events = frame(spark, [process(i, i * 43_200, "ls", f"ls {i}") for i in range(10)])
    store.write_events(events, f"{scratch}/days")
    at = datetime.fromtimestamp(BASE // S + 86_400, timezone.utc)
    found = hunt.search_events(store.read_events(spark, f"{scratch}/days", with_day=True), start=at, end=at + timedelta(days=1))
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = [x for x in plan.split("\n") if "PartitionFilters" in x][0].split("PartitionFilters")[1].split("PushedFilters")[0]
    assert filters.count("dt#") >= 2 and "event_type#" in filters
    assert [r["command"] for r in found.collect()] == ["ls 4", "ls 3", "ls 2"]


def test_ancestry_of_one_pid_equals_that_of_all(spark):
    r = random.Random(4)
    events = [process(i, i, "sh", f"c{i}", pid=str(r.randrange(2, 40)), ppid=str(r.choice([0, 1, *range(2, 60)]))) for i in range(120)]
    df = frame(spark, events).cache()
    every = hunt.process_ancestry_all(df, 12).collect()
    for pid in ("2", "9", "17", "59", "none"):
        want = sorted(tuple(x)[1:] for x in every if x["start_pid"] == pid)
        assert [tuple(x) for x in hunt.process_ancestry(df, pid, 12).collect()] == want


def ipv4(text: str) -> int:
    return int(ipaddress.IPv4Address(text))


def test_overlapping_ranges_give_one_row_an_event_in_a_stream(spark, scratch):
    r = random.Random(5)
    ranges = []
    for i in range(40):
        start = ipv4(f"203.{r.randrange(3)}.{r.randrange(256)}.{r.randrange(256)}")
        ranges.append((start, start + r.choice([0, 3, 300, 70_000, 200_000]), f"C{i}", f"c{i}", f"t{i}", 1.5, 2.5))
    ranges.append((ipv4("203.0.0.0"), ipv4("203.2.255.255"), "ALL", "all", "t", 1.0, 1.0))
    geo = spark.createDataFrame(ranges, "start_ip long, end_ip long, country string, country_name string, city string, lat double, lon double")
    events = frame(spark, [accepted(i, i, source=f"203.{r.randrange(4)}.{r.randrange(256)}.{r.randrange(256)}") for i in range(400)])
    events.write.parquet(f"{scratch}/geo")
    live = enrich_geo_stream(spark.readStream.schema(EVENT_SCHEMA).parquet(f"{scratch}/geo"), geo)
    q = live.writeStream.format("memory").queryName("overlapping").trigger(availableNow=True).start()
    q.awaitTermination(300)
    cols = ["seq", "country", "city", "latitude", "longitude"]
    got = sorted(map(str, spark.table("overlapping").select(*cols).collect()))
    assert got == sorted(map(str, enrich_geo(events, geo).select(*cols).collect())) and len(got) == 400
    cut = [tuple(x) for x in disjoint_ranges(geo).select("start_ip", "end_ip").orderBy("start_ip").collect()]
    assert all(a[1] < b[0] for a, b in zip(cut, cut[1:], strict=False))

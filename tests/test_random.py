"""Batch plans against a sequential restatement, on random logs with ties and hot keys."""

import re

import naive
import pytest
from samples import BASE, S, frame, process, random_events

from duskwatch.operators import chains, cooldown
from duskwatch.operators import thresholds as th
from duskwatch.operators.cooldown import COOLDOWNS_PER_CHUNK, pick_with_cooldown


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("seed,span_s,step_us", [(1, 2400, S), (2, 600, S), (3, 6000, 1)])
def test_detectors_match(spark, seed, span_s, step_us):
    events = random_events(seed, span_s=span_s, step_us=step_us)
    df = frame(spark, events).cache()
    brute, countries = th.failed_login_hits(df).cache(), th.new_country_hits(df).cache()
    assert rows(brute, "us", "seq", "source", "user", "attempt_count") == sorted(naive.failed_logins(events))
    assert rows(th.spray_hits(df), "us", "seq", "source", "user_count") == sorted(naive.spray(events))
    assert rows(countries, "us", "seq", "source", "user", "country") == sorted(naive.new_country(events))
    got = rows(th.rapid_process_hits(df), "us", "seq", "host", "process_count")
    assert got == sorted(naive.rapid(events)) and got
    got = rows(chains.download_execute_hits(df), "us", "seq", "host", "path", "gap_us")
    assert got == sorted(naive.download_execute(events)) and got
    got = rows(chains.new_account_hits(df), "us", "seq", "host", "user", "gap_us")
    assert got == sorted(naive.new_account(events)) and got
    for link in ("host", "source"):
        got = rows(chains.login_escalation_hits(df, countries, link), "us", "seq", "host", "gap_us")
        assert got == sorted(naive.escalation(events, link))
    got = rows(chains.brute_force_evasion_hits(df, brute), "us", "seq", "host", "source", "ppid")
    assert got == sorted(naive.evasion(events))


@pytest.mark.parametrize("k,cooldown", [(3, 7 * S), (2, 90 * S)])
def test_rapid_cooldown_over_many_chunks(spark, k, cooldown):
    events = random_events(7, n=4000, span_s=20_000, hot=0.8)
    params = th.RapidParams(threshold=k, window_us=30 * S, cooldown_us=cooldown)
    got = rows(th.rapid_process_hits(frame(spark, events), params), "us", "seq", "host", "process_count")
    assert got == sorted(naive.rapid(events, k, 30 * S, cooldown)) and len(got) > 50


def test_one_host_one_second(spark):
    """All rows on one key at one time."""
    events = [e | {"us": 1_700_000_000 * S, "host": "h0", "source": "10.0.0.1"} for e in random_events(5, n=1500)]
    df = frame(spark, events)
    assert rows(th.failed_login_hits(df), "us", "seq", "source", "user", "attempt_count") == sorted(naive.failed_logins(events))
    assert rows(th.spray_hits(df), "us", "seq", "source", "user_count") == sorted(naive.spray(events))
    assert rows(th.rapid_process_hits(df), "us", "seq", "host", "process_count") == naive.rapid(events)
    got = rows(chains.download_execute_hits(df), "us", "seq", "host", "path")
    assert got == sorted(h[:4] for h in naive.download_execute(events))


@pytest.mark.parametrize("gap_s,cooldown", [(2, 7), (7, 7), (5, 11)])
def test_cooldown_of_evenly_spaced_candidates(spark, gap_s, cooldown):
    """Selections that start apart never coincide, over hundreds of chunks of one host."""
    events = [process(i, i * gap_s, "ls", "ls", host="h0" if i % 5 else "h1") for i in range(6000)]
    params = th.RapidParams(threshold=1, window_us=S, cooldown_us=cooldown * S)
    hits = th.rapid_process_hits(frame(spark, events), params)
    got = rows(hits, "us", "seq", "host", "process_count")
    assert got == sorted(naive.rapid(events, 1, S, cooldown * S)) and len(got) > 1000
    assert len({us // (cooldown * S * COOLDOWNS_PER_CHUNK) for us, *_ in got}) > 100


def test_cooldown_goes_on_from_before(spark):
    """What is taken later, given when the key is free, equals one run over all."""
    events = [process(i, i * 3, "ls", "ls", host=f"h{i % 2}") for i in range(900)]
    candidates = frame(spark, events).selectExpr("host", "unix_micros(ts) AS us")
    whole = rows(pick_with_cooldown(candidates, "host", "us", 50 * S), "host", "us")
    cut = BASE + 1300 * S
    free = spark.createDataFrame([(h, max(us for k, us in whole if k == h and us < cut) + 50 * S) for h in ("h0", "h1")], "host string, free_us long")
    later = pick_with_cooldown(candidates.where(f"us >= {cut}"), "host", "us", 50 * S, free)
    assert rows(later, "host", "us") == [x for x in whole if x[1] >= cut]
    assert rows(pick_with_cooldown(candidates.limit(0), "host", "us", S), "host", "us") == []


def test_no_step_of_the_cooldown_is_dealt_by_the_key_alone(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(cooldown, "checkpointed", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), df.checkpoint())[1])
    candidates = spark.range(5000).selectExpr("'h' AS host", "id * 60000000 AS us")
    plans.append(pick_with_cooldown(candidates, "host", "us", 300 * S)._jdf.queryExecution().executedPlan().toString())
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", "\n".join(plans))
    assert len(plans) > 3 and dealt and all(len(re.findall(r"#\d+", keys)) >= 2 for keys in dealt)


def disputes(hosts: int = 1, spans: int = 240) -> list[dict]:
    """A host with contested commands in every window, over paths that are named in pairs, and some downloads that reach into the next."""
    out = []
    for i in range(spans):
        t, a, b = i * 100, f"/tmp/a{i % 7}", f"/tmp/b{i % 5}"
        for k, (dt, name, command) in enumerate([
            (0, "wget", f"wget -O {a} http://x"), (1, "wget", f"wget -O {b} http://x"), (20, "bash", f"sh {a} {b}"), (21, "bash", f"cat {b} {a}"),
            (22, "bash", f"sh {a}"), (60 if i % 9 else 99, "curl", f"curl -o /dev/shm/z{i % 3} http://x"), (61 if i % 9 else 119, "bash", f"sh /dev/shm/z{i % 3} {b}"), (62, "bash", f"sh {b}"),
        ]):
            out.append(process(10 * i + k, t + dt, name, command, host=f"h{i % hosts}"))
    return out


@pytest.mark.parametrize("hosts", [1, 2])
def test_contested_downloads_in_every_window(spark, monkeypatch, hosts):
    events = disputes(hosts)
    groups, islands = [], chains._islands
    monkeypatch.setattr(chains, "_islands", lambda items, w: (groups.append(islands(items, w)), groups[0])[1])
    got = rows(chains.download_execute_hits(frame(spark, events)), "us", "seq", "host", "path", "gap_us")
    assert got == sorted(naive.download_execute(events)) and len(got) > 400
    assert groups[0].select("host", "island").distinct().count() > 100  # many sessions, none as long as the host's day

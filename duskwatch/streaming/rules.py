"""Keyed rules: the stateful detectors as steps over the new rows of one key."""

from __future__ import annotations

from collections import deque

import pandas as pd

from ..operators.thresholds import FailedLoginParams, RapidParams, SprayParams
from .keyed import KeyedRule

HIT = "host string, us long, seq long, source string"


def failed_logins(params: FailedLoginParams) -> KeyedRule:
    """Key (source, user); state: recent attempt times, or the fact that the key has alerted."""
    k, span = params.threshold, params.window_us

    def step(key, state, rows):
        times, alerted = state or ([], False)
        if alerted:
            return ([], True), []
        for host, us, seq in zip(rows["host"], rows["us"].tolist(), rows["seq"].tolist()):
            times = sorted([*times, us])
            times = [t for t in times if times[-1] - t <= span]
            # In order, the window ends at this row; a late row may fill one that ends later.
            if len(times) >= k:
                return ([], True), [(host, times[-1], seq, *key, len(times), span)]
        return (times, False), []

    return KeyedRule(
        ("source", "user"),
        step,
        "times array<long>, alerted boolean",
        HIT + ", user string, attempt_count long, window_us long",
        span,
        lambda s: max(s[0], default=0),
        lambda s: s[1],
    )


def trim_failed_logins(params: FailedLoginParams):
    """The first k attempts of a (source, user) in a window-long cell decide it."""

    def keep(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values(["us", "seq"])
        cell = ordered["us"] // params.window_us
        return ordered.groupby([ordered["source"], ordered["user"], cell], sort=False).head(params.threshold)

    return keep


def spray(params: SprayParams) -> KeyedRule:
    """Key source; state: last attempt time per recent user, or alerted.

    The last attempt per user is all that a distinct count over a closed
    look-back window needs.
    """
    k, span = params.threshold, params.window_us

    def step(key, state, rows):
        users, lasts, alerted = state or ([], [], False)
        if alerted:
            return ([], [], True), []
        last = dict(zip(users, lasts))
        for host, us, seq, user in zip(rows["host"], rows["us"].tolist(), rows["seq"].tolist(), rows["user"]):
            last[user] = max(us, last.get(user, us))
            if len(last) >= k:
                end = max(last.values())  # this row, unless it is late
                last = {u: t for u, t in last.items() if end - t <= span}
            if len(last) >= k:
                return ([], [], True), [(host, end, seq, *key, len(last), span)]
        return (list(last), list(last.values()), False), []

    return KeyedRule(
        ("source",),
        step,
        "users array<string>, lasts array<long>, alerted boolean",
        HIT + ", user_count long, window_us long",
        span,
        lambda s: max(s[1], default=0),
        lambda s: s[2],
    )


def trim_spray(params: SprayParams):
    """Of a source and cell, the first k users decide it, by their first and last attempt."""

    def keep(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values(["us", "seq"])
        cell = ordered["us"] // params.window_us
        by_user = ordered.groupby([ordered["source"], cell, ordered["user"]], sort=False)
        first, last = by_user.cumcount() == 0, by_user.cumcount(ascending=False) == 0
        rank = first.groupby([ordered["source"], cell], sort=False).cumsum()
        rank = rank.where(first).groupby([ordered["source"], cell, ordered["user"]], sort=False).ffill()
        return ordered[(first | last) & (rank <= params.threshold)]

    return keep


def new_country() -> KeyedRule:
    """Key (user, country); state: seen."""

    def step(key, state, rows):
        if state is not None:
            return (True,), []
        first = rows.iloc[0]
        return (True,), [(first["host"], int(first["us"]), int(first["seq"]), first["source"], *key)]

    return KeyedRule(
        ("user", "country"), step, "seen boolean", HIT + ", user string, country string"
    )


def trim_new_country(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.sort_values(["us", "seq"]).groupby(["user", "country"], sort=False).head(1)


def rapid_process(params: RapidParams) -> KeyedRule:
    """Key host; rows are (time, number of starts, first seqs); state: recent counts, last alert."""
    k, span, cooldown = params.threshold, params.window_us, params.cooldown_us

    def step(key, state, rows):
        times, counts, last = state or ([], [], None)
        recent, prior = deque(zip(times, counts)), sum(counts)
        hits = []
        for us, group in rows.groupby("us", sort=True):
            us, here = int(us), int(group["n"].sum())
            while recent and recent[0][0] <= us - span:
                prior -= recent.popleft()[1]
            nth = max(1, k - prior)
            if here >= nth and (last is None or us - last >= cooldown):
                starts = sorted((int(s), src) for row in group.itertuples() for s, src in zip(row.seqs, row.sources))
                seq, source = starts[nth - 1]
                hits.append((key[0], us, seq, source, prior + nth, span))
                last = us
            recent.append((us, here))
            prior += here
            if len(recent) > 1 and recent[-2][0] > us:  # a late row
                recent = deque(sorted(recent))
        return ([t for t, _ in recent], [n for _, n in recent], last), hits

    return KeyedRule(
        ("host",),
        step,
        "times array<long>, counts array<long>, last_us long",
        HIT + ", process_count long, window_us long",
        cooldown + span,
        lambda s: max(s[0], default=0),
    )


def new_account(window_us: int) -> KeyedRule:
    """Key (host, user); state: time of the newest unused account creation."""

    def step(key, state, rows):
        made = state[0] if state else None
        hits = []
        for us, seq, source, created in zip(rows["us"].tolist(), rows["seq"].tolist(), rows["source"], rows["opens"]):
            if created:
                made = us if made is None else max(made, us)
            elif made is not None and 0 <= us - made <= window_us:
                hits.append((key[0], us, seq, source, key[1], us - made))
                made = None
        return (None if made is None else (made,)), hits

    return KeyedRule(
        ("host", "user"), step, "made_us long", HIT + ", user string, gap_us long", window_us, lambda s: s[0]
    )


def download_execute(window_us: int) -> KeyedRule:
    """Key host; state: staged paths with the time and number of their newest download."""

    def step(key, state, rows):
        staged = {p: (us, seq) for p, us, seq in zip(*state)} if state else {}
        hits = []
        columns = zip(rows["us"].tolist(), rows["seq"].tolist(), rows["source"], rows["command"], rows["path"])
        for us, seq, source, command, path in columns:
            if path is not None:
                staged[path] = max(staged.get(path, (us, seq)), (us, seq))
                continue
            usable = [(at, p) for p, at in staged.items() if at < (us, seq) and us - at[0] <= window_us and p in command]
            if usable:
                (at, _), p = max(usable)
                del staged[p]
                hits.append((key[0], us, seq, source, command, p, us - at))
        newest = max([int(rows["us"].iloc[-1]), *(at[0] for at in staged.values())])
        live = {p: at for p, at in staged.items() if newest - at[0] <= window_us}
        if not live:
            return None, hits
        return (list(live), [a[0] for a in live.values()], [a[1] for a in live.values()]), hits

    return KeyedRule(
        ("host",),
        step,
        "paths array<string>, times array<long>, seqs array<long>",
        HIT + ", command string, path string, gap_us long",
        window_us,
        lambda s: max(s[1]),
    )


def armed_sessions() -> KeyedRule:
    """Key source; rows are failed-login alerts and accepted logins; state: armed."""

    def step(key, state, rows):
        armed, hits = state is not None, []
        columns = zip(rows["kind"], rows["host"], rows["us"].tolist(), rows["seq"].tolist(), rows["pid"])
        for kind, host, us, seq, pid in columns:
            if kind == "alert":
                armed = True
            elif armed:
                armed = False
                if pid:
                    hits.append(("session", host, us, seq, key[0], pid, None))
        return ((True,) if armed else None), hits

    return KeyedRule(("source",), step, "armed boolean", STAGE)


# Rows that one streaming query hands to the next.
STAGE = "kind string, host string, us long, seq long, source string, pid string, command string"


def evasion(window_us: int) -> KeyedRule:
    """Key (host, pid); rows are sessions and evasion commands; state: newest unused session."""

    def step(key, state, rows):
        session, hits = state, []
        columns = zip(rows["kind"], rows["us"].tolist(), rows["seq"].tolist(), rows["source"], rows["command"])
        for kind, us, seq, source, command in columns:
            if kind == "session":
                if session is None or us >= session[0]:
                    session = (us, source)
            elif session is not None and 0 <= us - session[0] <= window_us:
                hits.append((key[0], us, seq, session[1], command, key[1]))
                session = None
        return session, hits

    return KeyedRule(
        ("host", "pid"),
        step,
        "login_us long, source string",
        HIT + ", command string, ppid string",
        window_us,
        lambda s: s[0],
    )


def escalation(window_us: int) -> KeyedRule:
    """Key link; rows are new-country logins and escalation commands; state: newest unused login."""

    def step(key, state, rows):
        login, hits = (state[0] if state else None), []
        columns = zip(rows["kind"], rows["host"], rows["us"].tolist(), rows["seq"].tolist(), rows["source"])
        for kind, host, us, seq, source in columns:
            if kind == "alert":
                login = us if login is None else max(login, us)
            elif login is not None and 0 <= us - login <= window_us:
                hits.append((host, us, seq, source, us - login))
                login = None
        return (None if login is None else (login,)), hits

    return KeyedRule(("link",), step, "login_us long", HIT + ", gap_us long", window_us, lambda s: s[0])

"""Hunting queries over stored events."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import DAY, SECOND
from ..functions.text import search_tokens
from ..schema import FAILED_LOGIN, KEYWORD_KEYS, PROCESS, meta, micros
from ..sources.checkpoint import checkpointed

ROW_KEYS = ("process_name", "command", "pid", "ppid", "uid")
DEFAULT_TOP = 10
MAX_DEPTH = 20
# A process walk ends at these parents.
ROOT_PIDS = ("", "0", "1")


def _processes(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == PROCESS)


def _process_row() -> list[Column]:
    return [F.coalesce(F.col(k), F.lit("")).alias(k) for k in ROW_KEYS]


def _whole_second_us(at: datetime | int) -> int:
    """A bound as microseconds, cut to its second; an int is microseconds already."""
    if isinstance(at, datetime):
        at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
        return int(at.timestamp() // 1) * SECOND
    return at - at % SECOND


def in_time_range(events: DataFrame, start: datetime | int | None, end: datetime | int | None) -> DataFrame:
    """Inclusive range, applied only when both bounds are given and after the epoch.

    The comparison is on ``ts`` itself, so it reaches the Parquet statistics, and on the day where
    the events have one (``read_events(with_day=True)``), so it prunes partitions.
    """
    if start is None or end is None:
        return events
    lo, hi = _whole_second_us(start), _whole_second_us(end)
    if lo <= 0 or hi <= 0:
        return events
    if "dt" in events.columns:
        first, last = (F.date_from_unix_date(F.lit(us // DAY)) for us in (lo, hi))
        events = events.where(F.col("dt").between(first, last))
    return events.where(
        F.col("ts").between(F.timestamp_micros(F.lit(lo)), F.timestamp_micros(F.lit(hi)))
    )


def search_events(
    events: DataFrame,
    filters: dict[str, str] | None = None,
    start: datetime | int | None = None,
    end: datetime | int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Process events that match every filter.

    Keyword keys match exactly; ``command`` and other keys match when they
    share a word with the filter, ignoring case.  Order: number of matched
    words, then newest first.  ``limit`` is the page size; without it all are returned.
    """
    found = in_time_range(_processes(events), start, end)
    scores = [F.lit(0)]
    for key, wanted in (filters or {}).items():
        if key in KEYWORD_KEYS:
            found = found.where(meta(key) == wanted)
            continue
        words = F.array_distinct(search_tokens(F.lit(wanted)))
        shared = F.size(F.array_intersect(search_tokens(meta(key)), words))
        found = found.where(F.coalesce(shared, F.lit(0)) > 0)
        scores.append(shared)
    ranked = found.select(
        micros().alias("us"), "seq", "ts", *_process_row(), reduce(lambda a, b: a + b, scores).alias("matched")
    ).orderBy(F.desc("matched"), F.desc("us"), "seq")
    if limit is not None:
        ranked = ranked.limit(limit)
    return ranked.select("ts", *ROW_KEYS, "us", "seq", "matched")


def top_events(
    events: DataFrame,
    field: str,
    n: int = DEFAULT_TOP,
    start: datetime | int | None = None,
    end: datetime | int | None = None,
) -> DataFrame:
    """The n most frequent values of a metadata key among process events, exact."""
    if not field or n <= 0:
        raise ValueError("field must be specified and n must be positive")
    return (
        in_time_range(_processes(events), start, end)
        .select(meta(field).alias("item"))
        .where(F.col("item").isNotNull())
        .groupBy("item")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "item")
        .limit(n)
    )


def latest_per_pid(events: DataFrame, by_host: bool = False) -> DataFrame:
    """The newest process event of every pid; a map-side reduced maximum."""
    keys = ["host", "pid"] if by_host else ["pid"]
    row = F.struct(micros().alias("us"), "seq", *[c for c in _process_row()])
    return (
        _processes(events)
        .where(~F.coalesce("pid", F.lit("")).isin(*ROOT_PIDS))
        .groupBy(*keys)
        .agg(F.max_by(row, F.struct(micros(), F.col("seq"))).alias("row"))
    )


def process_ancestry_all(
    events: DataFrame, max_depth: int = MAX_DEPTH, by_host: bool = False, pid: str | None = None
) -> DataFrame:
    """The ancestor list of every pid, or of one: (start_pid, depth, row), child first, depth from 0.

    A walk goes from a pid to the parent of its newest event and ends at a
    root pid, an unknown pid or ``max_depth`` rows; a cycle runs to the limit.
    Instead of one join per level, jump tables double their reach, so 20
    levels take 5 rounds.  Each round is written to the checkpoint folder,
    which keeps the plan short and makes a lost executor cheap.
    """
    host = ["host"] if by_host else []
    latest = checkpointed(latest_per_pid(events, by_host))
    known = latest.select(*host, F.col("pid").alias("to_pid"))
    # jump: pid -> the pid 2^k levels up; only pids that have an event of their own.
    jump = checkpointed(
        latest.select(*host, "pid", F.col("row.ppid").alias("to_pid")).join(known, [*host, "to_pid"])
    )
    starts = latest if pid is None else latest.where(F.col("pid") == pid)
    walk = starts.select(*host, F.col("pid").alias("start_pid"), F.col("pid").alias("at_pid"), F.lit(0).alias("depth"))
    reach = 1
    while reach < max_depth:
        step = jump.select(*host, F.col("pid").alias("at_pid"), "to_pid")
        further = walk.join(step, [*host, "at_pid"]).select(
            *host, "start_pid", F.col("to_pid").alias("at_pid"), (F.col("depth") + reach).alias("depth")
        )
        walk = checkpointed(walk.unionByName(further.where(F.col("depth") < max_depth)))
        reach *= 2
        if reach < max_depth:
            hop = jump.select(*host, F.col("pid").alias("to_pid"), F.col("to_pid").alias("next_pid"))
            jump = checkpointed(
                jump.join(hop, [*host, "to_pid"]).select(*host, "pid", F.col("next_pid").alias("to_pid"))
            )
    rows = latest.select(*host, F.col("pid").alias("at_pid"), "row")
    return walk.join(rows, [*host, "at_pid"]).select(
        *host, "start_pid", "depth", F.col("row.us").alias("us"), F.col("row.seq").alias("seq"),
        *[F.col(f"row.{k}").alias(k) for k in ROW_KEYS],
    )


def process_ancestry(
    events: DataFrame, pid: str, max_depth: int = MAX_DEPTH, host: str | None = None
) -> DataFrame:
    """The ancestor list of one pid, child first.

    A recursion whose frontier is one row: the newest events are found once, and each level looks one of them up.
    """
    if host is not None:
        events = events.where(F.col("host") == host)
    latest = checkpointed(latest_per_pid(events))
    name = f"latest_{uuid.uuid4().hex}"
    latest.createOrReplaceTempView(name)
    spark = latest.sparkSession
    try:
        walk = spark.sql(
            f"""WITH RECURSIVE walk (depth, pid, row) MAX RECURSION LEVEL {max(max_depth, 1)} AS (
                  SELECT 0, pid, row FROM {name} WHERE pid = :pid
                  UNION ALL
                  SELECT w.depth + 1, p.pid, p.row FROM walk w JOIN {name} p ON p.pid = w.row.ppid
                  WHERE w.depth + 1 < {int(max_depth)})
                SELECT * FROM walk""",
            {"pid": pid},
        )
    finally:
        spark.catalog.dropTempView(name)
    row = [F.col(f"row.{k}").alias(k) for k in ("us", "seq", *ROW_KEYS)]
    return walk.select("depth", *row).orderBy("depth")


def process_history(events: DataFrame) -> DataFrame:
    """All process executions in time order."""
    return (
        _processes(events)
        .select(micros().alias("us"), "seq", "ts", *_process_row())
        .orderBy("us", "seq")
        .select("ts", *ROW_KEYS, "us", "seq")
    )


def failed_login_times(events: DataFrame, ip: str) -> DataFrame:
    """Times of failed logins from one address, in order."""
    return (
        events.where((F.col("event_type") == FAILED_LOGIN) & (F.col("source") == ip))
        .select("ts", micros().alias("us"), "seq")
        .orderBy("us", "seq")
    )

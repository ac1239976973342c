"""Log lines to events, with a disposition for every line.

A parser is a set of column expressions; parsers are tried in order, the first
one that recognises a line decides it, and a recognised line with a bad
timestamp is an error rather than a candidate for the next parser.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import RFC3339_CLOCK, SYSLOG_CLOCK, Captured, Clock, bind, capture, year_column
from ..functions.text import strip
from ..schema import ACCEPTED_LOGIN, EXTRA_TYPE, FAILED_LOGIN, META_KEYS, PROCESS, conform

# The line patterns.  (?d) limits "." to stopping at a newline.
FAILED_LINE = (
    r"(?d)^(\w+[\t\n\f\r ]+\d+[\t\n\f\r ]+[\d:]+)[\t\n\f\r ]+my-server sshd\[\d+\]: Failed password for .*?(\S+) from ([\d\.]+).*$"
)
ACCEPTED_LINE = (
    r"(?d)^(\w+[\t\n\f\r ]+\d+[\t\n\f\r ]+[\d:]+)[\t\n\f\r ]+my-server sshd\[(\d+)\]: Accepted password for (\S+) from ([\d\.]+).*$"
)
PROCESS_LINE = r"(?d)^([\dTZ:.\-]+)[\t\n\f\r ]+(\d+)[\t\n\f\r ]+(\S+)[\t\n\f\r ]+(\d+)[\t\n\f\r ]+(\d+)[\t\n\f\r ]+(\d+)[\t\n\f\r ]+(.*)$"
PROCESS_SOURCE = "127.0.0.1"


@dataclass(frozen=True)
class LineParser:
    """One log format.

    ``groups`` maps a line to a ``capture`` column; the other members read the
    captured groups.
    """

    event_type: str
    groups: Callable[[Column], Column]
    stamp: Callable[[Captured], Column]
    clock: Clock
    source: Callable[[Captured], Column]
    metadata: dict[str, Callable[[Captured], Column]] = field(default_factory=dict)


def _guarded(marker: str, pattern: str, n: int) -> Callable[[Column], Column]:
    # The literal test spares most lines the regex.
    return lambda line: F.when(line.contains(marker), capture(line, pattern, n))


FAILED_LOGIN_PARSER = LineParser(
    FAILED_LOGIN,
    _guarded("]: Failed password for ", FAILED_LINE, 3),
    lambda g: g[0],
    SYSLOG_CLOCK,
    lambda g: g[2],
    {"user": lambda g: g[1]},
)
ACCEPTED_LOGIN_PARSER = LineParser(
    ACCEPTED_LOGIN,
    _guarded("]: Accepted password for ", ACCEPTED_LINE, 4),
    lambda g: g[0],
    SYSLOG_CLOCK,
    lambda g: g[3],
    {"user": lambda g: g[2], "sshd_pid": lambda g: g[1]},
)
PROCESS_PARSER = LineParser(
    PROCESS,
    lambda line: capture(line, PROCESS_LINE, 7),
    lambda g: g[0],
    RFC3339_CLOCK,
    lambda g: F.lit(PROCESS_SOURCE),
    {
        "uid": lambda g: g[1],
        "process_name": lambda g: strip(g[2]),
        "pid": lambda g: g[3],
        "ppid": lambda g: g[4],
        "return_code": lambda g: g[5],
        "command": lambda g: strip(g[6]),
    },
)
DEFAULT_PARSERS = (FAILED_LOGIN_PARSER, ACCEPTED_LOGIN_PARSER, PROCESS_PARSER)


def parse_lines(
    lines: DataFrame,
    assumed_year: int | Column | None = None,
    parsers: tuple[LineParser, ...] = DEFAULT_PARSERS,
) -> DataFrame:
    """(seq, host, line) to event columns plus ``line`` and ``disposition``.

    disposition is event, ignored (no parser), error (bad timestamp) or blank.
    Row-local: one projection, no shuffle; works on batch and streaming input.
    """
    line = F.col("line")
    staged = bind(lines, {f"_g{i}": p.groups(line) for i, p in enumerate(parsers)})
    groups = [Captured(F.col(f"_g{i}")) for i in range(len(parsers))]
    winner = F.coalesce(*[F.when(g.matched, F.lit(i)) for i, g in enumerate(groups)])
    staged = staged.withColumn("_w", winner)

    def pick(values: dict[int, Column], kind: str = "string") -> Column:
        return reduce(
            lambda rest, i: F.when(F.col("_w") == i, values[i]).otherwise(rest),
            sorted(values, reverse=True),
            F.lit(None).cast(kind),
        )

    keys = {k for p in parsers for k in p.metadata}
    meta_cols = {
        k: pick({i: p.metadata[k](g) for i, (p, g) in enumerate(zip(parsers, groups)) if k in p.metadata})
        for k in keys
    }
    extra = sorted(keys - set(META_KEYS))
    extra_map = F.lit(None).cast(EXTRA_TYPE)
    if extra:
        pairs = F.array(*[F.struct(F.lit(k).alias("key"), meta_cols[k].alias("value")) for k in extra])
        extra_map = F.map_from_entries(F.filter(pairs, lambda e: e["value"].isNotNull()))

    # The stamp is taken apart once per format, in a step of its own.
    stamp = pick({i: p.stamp(g) for i, (p, g) in enumerate(zip(parsers, groups))})
    clocks = list(dict.fromkeys(p.clock for p in parsers))
    owners = [[i for i, p in enumerate(parsers) if p.clock == clock] for clock in clocks]
    parts = {
        f"_t{j}": F.when(F.col("_w").isin(owners[j]), capture(stamp, clock.shape, clock.groups))
        for j, clock in enumerate(clocks)
    }
    parsed = bind(
        staged,
        {
            **parts,
            "event_type": pick({i: F.lit(p.event_type) for i, p in enumerate(parsers)}),
            "source": pick({i: p.source(g) for i, (p, g) in enumerate(zip(parsers, groups))}),
            **{k: meta_cols[k] for k in META_KEYS if k in keys},
            "extra": extra_map,
        },
    )
    year = year_column(assumed_year)
    us = F.coalesce(*[clock.micros(Captured(F.col(f"_t{j}")), year) for j, clock in enumerate(clocks)])
    timed = bind(parsed, {"_us": us})
    disposition = (
        F.when(line == "", "blank")
        .when(F.col("_w").isNull(), "ignored")
        .when(F.col("_us").isNull(), "error")
        .otherwise("event")
    )
    return timed.select(
        "seq",
        "host",
        "line",
        disposition.alias("disposition"),
        F.timestamp_micros("_us").alias("ts"),
        "event_type",
        "source",
        *[k for k in META_KEYS if k in keys],
        "extra",
    )


def events_of(parsed: DataFrame) -> DataFrame:
    """The rows that became events."""
    return conform(parsed.where(F.col("disposition") == "event"))


def quarantine_of(parsed: DataFrame) -> DataFrame:
    """Lines that are neither events nor blank, with the reason."""
    return parsed.where(F.col("disposition").isin("ignored", "error")).select(
        "seq", "host", "line", "disposition"
    )

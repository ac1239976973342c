"""Log timestamps to microseconds, and durations to text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbers import floor_div

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR

# Shapes of the two timestamp formats and the month names.
SYSLOG_SHAPE = r"^([A-Za-z]{3}) +(\d{1,2}) +(\d{1,2}):(\d{2}):(\d{2})$"
RFC3339_SHAPE = r"^(\d{4})-(\d{2})-(\d{2})T(\d{1,2}):(\d{2}):(\d{2})(\.\d+)?(?:Z|-(\d{2}):(\d{2}))$"
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"


class Captured:
    """The groups of one pattern match, held in an array column; ``[0]`` is the first group."""

    def __init__(self, parts: Column):
        self.parts = parts

    def __getitem__(self, i: int) -> Column:
        return F.get(self.parts, F.lit(i + 1))

    @property
    def matched(self) -> Column:
        return self[0].isNotNull()


def capture(text: Column, pattern: str, groups: int) -> Column:
    """All groups of an anchored pattern from a single regex pass, to be read by ``Captured``.

    The groups follow an empty first element; a text without a match stays in
    one piece, or becomes NULL if it holds newlines, which separate the groups.
    """
    swap = "".join(f"\n${i}" for i in range(1, groups + 1))
    parts = F.split(F.regexp_replace(text, F.lit(pattern), F.lit(swap)), "\n")
    return F.when(~text.contains("\n") | text.rlike(pattern), parts)


def bind(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are computed once, whatever reads them later.

    Plain projections are merged into later filters and expressions, which
    would repeat a regex per use.  Predicates on generated columns stay above
    the generator.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _civil_micros(y: Column, mo: Column, d: Column, h: Column, mi: Column, s: Column) -> Column:
    stamp = F.try_make_timestamp_ntz(y, mo, d, h, mi, s)
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    micros = F.timestamp_diff("MICROSECOND", epoch, stamp)
    return F.when(s < 60, micros)


def current_utc_year() -> Column:
    days = floor_div(F.unix_micros(F.current_timestamp()), DAY).cast("int")
    return F.year(F.date_from_unix_date(days))


@dataclass(frozen=True)
class Clock:
    """A timestamp format: its shape, and how captured parts become microseconds."""

    shape: str
    groups: int
    micros: Callable[[Captured, Column], Column]


def _syslog(part: Captured, year: Column) -> Column:
    slot = F.instr(F.lit(MONTHS), F.lower(part[0]))
    month = F.when(F.pmod(slot, F.lit(3)) == 1, ((slot + 2) / 3).cast("int"))
    day, hour = part[1].cast("int"), part[2].cast("int")
    minute, second = part[3].cast("int"), part[4].cast("int")
    leap_day = (month == 2) & (day == 29)
    at = _civil_micros(year, month, F.when(leap_day, 28).otherwise(day), hour, minute, second)
    return at + F.when(leap_day, F.lit(DAY)).otherwise(F.lit(0))


def _rfc3339(part: Captured, year: Column) -> Column:
    at = _civil_micros(*[part[i].cast("int") for i in range(6)])
    fraction = F.when(part[6] == "", 0).otherwise(F.rpad(F.substring(part[6], 2, 6), 6, "0").cast("long"))
    hours, minutes = part[7].cast("long"), part[8].cast("long")
    # An offset out of range makes the time malformed.
    behind = F.when(part[7] == "", 0).when((hours <= 24) & (minutes <= 60), hours * HOUR + minutes * MINUTE)
    return at + fraction + behind


# Year-less UTC time.  29 February is always accepted and becomes 1 March in a common year.
SYSLOG_CLOCK = Clock(SYSLOG_SHAPE, 5, _syslog)
# Z or a negative offset; the fraction is cut to microseconds.
RFC3339_CLOCK = Clock(RFC3339_SHAPE, 9, _rfc3339)


def clock_micros(text: Column, clock: Clock, year: Column | int | None = None) -> Column:
    """Text to microseconds, NULL when malformed."""
    return clock.micros(Captured(capture(text, clock.shape, clock.groups)), year_column(year))


def year_column(year: Column | int | None) -> Column:
    """The year for year-less times: as given, or the current one at processing time."""
    if year is None:
        return current_utc_year()
    return F.lit(year) if isinstance(year, int) else year


def duration_text(us: Column) -> Column:
    """A duration in h/m/s text with a trimmed fraction: 1m0s, 5.002638s, 1.5ms."""
    size = F.abs(us.cast("long"))

    def with_fraction(value: Column, unit: int, digits: int) -> Column:
        rest = F.pmod(value, F.lit(unit).cast("long"))
        tail = F.regexp_replace(F.lpad(rest.cast("string"), digits, "0"), "0+$", "")
        whole = floor_div(value, unit).cast("string")
        return F.when(rest == 0, whole).otherwise(F.concat(whole, F.lit("."), tail))

    secs = F.concat(with_fraction(F.pmod(size, F.lit(MINUTE).cast("long")), SECOND, 6), F.lit("s"))
    mins = F.pmod(floor_div(size, MINUTE), F.lit(60).cast("long")).cast("string")
    text = (
        F.when(size == 0, F.lit("0s"))
        .when(size < 1000, F.concat(size.cast("string"), F.lit("µs")))
        .when(size < SECOND, F.concat(with_fraction(size, 1000, 3), F.lit("ms")))
        .when(size < MINUTE, secs)
        .when(size < HOUR, F.concat(mins, F.lit("m"), secs))
        .otherwise(F.concat(floor_div(size, HOUR).cast("string"), F.lit("h"), mins, F.lit("m"), secs))
    )
    return F.when(us < 0, F.concat(F.lit("-"), text)).otherwise(text)


def rfc3339_text(us: Column) -> Column:
    """Microseconds to RFC 3339 UTC text with a trimmed fraction."""
    days = floor_div(us, DAY)
    clock = F.pmod(us, F.lit(DAY).cast("long"))
    sec = floor_div(clock, SECOND)
    frac = F.pmod(us, F.lit(SECOND).cast("long"))

    def two(value: Column) -> Column:
        return F.lpad(value.cast("string"), 2, "0")

    sixty = F.lit(60).cast("long")
    tail = F.regexp_replace(F.lpad(frac.cast("string"), 6, "0"), "0+$", "")
    return F.concat(
        F.date_from_unix_date(days.cast("int")).cast("string"),
        F.lit("T"),
        two(floor_div(sec, 3600)),
        F.lit(":"),
        two(F.pmod(floor_div(sec, 60), sixty)),
        F.lit(":"),
        two(F.pmod(sec, sixty)),
        F.when(frac == 0, F.lit("Z")).otherwise(F.concat(F.lit("."), tail, F.lit("Z"))),
    )

"""Sliding-window threshold detectors and first-seen detection.

None of them sorts or collects all rows of a key in one task.  The two
once-per-key detectors cut each key into cells of one window length and keep
only the first few rows of a cell, which is exact because

* a cell that reaches the threshold alerts no later than on the row that
  reaches it, so later rows of the cell cannot be the first alert, and
* such a cell also ends the search for its key, so the rows cut from it are
  never needed as look-back for the next cell.

``row_number() <= k`` is applied before the shuffle as well as after it, so
a cell that holds a third of all rows sends k rows per input task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import MINUTE, SECOND
from ..functions.numbers import floor_div
from ..schema import ACCEPTED_LOGIN, FAILED_LOGIN, PROCESS, micros
from ..sources.checkpoint import checkpointed
from .cooldown import pick_with_cooldown


@dataclass(frozen=True)
class FailedLoginParams:
    threshold: int = 5
    window_us: int = 60 * SECOND


@dataclass(frozen=True)
class SprayParams:
    threshold: int = 5
    window_us: int = 60 * SECOND


@dataclass(frozen=True)
class RapidParams:
    threshold: int = 10
    window_us: int = 30 * SECOND
    cooldown_us: int = 5 * MINUTE


def _failed_logins(events: DataFrame) -> DataFrame:
    return events.where(
        (F.col("event_type") == FAILED_LOGIN) & (F.coalesce("user", F.lit("")) != "")
    ).select("host", micros().alias("us"), "seq", F.coalesce("source", F.lit("")).alias("source"), "user")


def failed_login_hits(events: DataFrame, params: FailedLoginParams = FailedLoginParams()) -> DataFrame:
    """First time an (address, user) pair has ``threshold`` failures within the closed window."""
    k, span = params.threshold, params.window_us
    attempts = _failed_logins(events).withColumn("cell", floor_div(F.col("us"), span))
    in_cell = Window.partitionBy("source", "user", "cell").orderBy("us", "seq")
    heads = attempts.withColumn("rn", F.row_number().over(in_cell)).where(F.col("rn") <= k).drop("rn")
    # Each head also serves as look-back for the next cell.
    slotted = heads.withColumn("slot", F.explode(F.array(F.col("cell"), F.col("cell") + 1)))
    in_slot = Window.partitionBy("source", "user", "slot").orderBy("us", "seq")
    reached = (
        slotted.withColumn("oldest", F.lag("us", k - 1).over(in_slot))
        .where((F.col("cell") == F.col("slot")) & (F.col("us") - F.col("oldest") <= span))
    )
    return (
        reached.groupBy("source", "user")
        .agg(F.min(F.struct("us", "seq", "host")).alias("first"))
        .select(
            "first.host",
            "first.us",
            "first.seq",
            "source",
            "user",
            F.lit(k).cast("long").alias("attempt_count"),
            F.lit(span).cast("long").alias("window_us"),
        )
    )


def spray_hits(events: DataFrame, params: SprayParams = SprayParams()) -> DataFrame:
    """First time an address fails for ``threshold`` distinct users within the closed window.

    A cell is reduced to the first and last attempt per user, then to the
    first ``threshold`` users; the count can only rise on a user's first
    attempt in a cell, so those are the only candidates.
    """
    k, span = params.threshold, params.window_us
    per_user = (
        _failed_logins(events)
        .where(F.col("source") != "")
        .groupBy("source", floor_div(F.col("us"), span).alias("cell"), "user")
        .agg(F.min(F.struct("us", "seq", "host")).alias("first"), F.max("us").alias("last_us"))
    )
    in_cell = Window.partitionBy("source", "cell").orderBy("first.us", "first.seq")
    heads = per_user.withColumn("rn", F.row_number().over(in_cell)).where(F.col("rn") <= k)
    slotted = heads.withColumn("slot", F.explode(F.array(F.col("cell"), F.col("cell") + 1)))
    # At most 2k rows per group.
    groups = slotted.groupBy("source", "slot").agg(
        F.array_sort(
            F.collect_list(F.when(F.col("cell") == F.col("slot"), F.struct("rn", "first", "user")))
        ).alias("own"),
        F.collect_list(F.when(F.col("cell") < F.col("slot"), F.struct("last_us", "user"))).alias("before"),
    )
    still_open = F.transform(
        F.filter("before", lambda b: b["last_us"] >= F.col("at.first.us") - span), lambda b: b["user"]
    )
    seen = F.transform(F.filter("own", lambda o: o["rn"] <= F.col("at.rn")), lambda o: o["user"])
    reached = (
        groups.where(F.size("own") + F.size("before") >= k)
        .withColumn("at", F.explode("own"))
        .where(F.size(F.array_union(seen, still_open)) >= k)
    )
    return (
        reached.groupBy("source")
        .agg(F.min("at.first").alias("first"))
        .select(
            "first.host",
            "first.us",
            "first.seq",
            "source",
            F.lit(k).cast("long").alias("user_count"),
            F.lit(span).cast("long").alias("window_us"),
        )
    )


def new_country_hits(events: DataFrame) -> DataFrame:
    """First accepted login of every (user, country); a map-side reduced minimum."""
    return (
        events.where(
            (F.col("event_type") == ACCEPTED_LOGIN)
            & (F.coalesce("user", F.lit("")) != "")
            & (F.coalesce("country", F.lit("")) != "")
        )
        .groupBy("user", "country")
        .agg(F.min(F.struct(micros().alias("us"), "seq", "host", "source")).alias("first"))
        .select("first.host", "first.us", "first.seq", "first.source", "user", "country")
    )


def rapid_process_hits(
    events: DataFrame, params: RapidParams = RapidParams(), free: DataFrame | None = None
) -> DataFrame:
    """``threshold`` process starts on a host within a window open at its old end, with a cooldown.

    ``free`` (host, free_us) tells from when on hosts with earlier alerts may alert again.

    1. Starts are counted per (host, microsecond) with map-side reduction.
    2. Counts are kept in slots of one window length, as a running sum of
       arrivals and departures, so that the work does not grow with the number
       of rows inside a window; a slot holds at most two rows per microsecond,
       however many events they stand for.
    3. The first row at a time that reaches the threshold is its candidate,
       and the cooldown picks among candidates.
    """
    k, span = params.threshold, params.window_us
    starts = events.where(F.col("event_type") == PROCESS).select(
        "host", micros().alias("us"), "seq", F.coalesce("source", F.lit("")).alias("source")
    )
    per_time = starts.groupBy("host", "us").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("seq", "source")).alias("first")
    )
    # Each time arrives in its own slot and leaves the window one slot later.
    cell = floor_div(F.col("us"), span)

    def change(slot, at, arrives: bool):
        return F.struct(slot.alias("slot"), at.alias("at"), F.lit(arrives).alias("arrives"))

    changes = per_time.select(
        "*", F.inline(F.array(change(cell, F.col("us"), True), change(cell + 1, F.col("us") + span, False)))
    )
    leaving = F.when(~F.col("arrives"), F.col("n")).otherwise(0)
    in_slot = Window.partitionBy("host", "slot")
    so_far = in_slot.orderBy("at", "arrives").rowsBetween(Window.unboundedPreceding, -1)
    at_start = F.sum(leaving).over(in_slot)
    since = F.sum(F.when(F.col("arrives"), F.col("n")).otherwise(-F.col("n"))).over(so_far)
    counted = (
        changes.withColumn("prior", (at_start + F.coalesce(since, F.lit(0))).cast("long"))
        .where(F.col("arrives") & (F.col("prior") + F.col("n") >= k))
        .withColumn("nth", F.greatest(F.lit(1).cast("long"), F.lit(k) - F.col("prior")))
        .select(
            "host",
            "us",
            "nth",
            (F.col("prior") + F.col("nth")).alias("process_count"),
            F.col("first.seq").alias("seq"),
            F.col("first.source").alias("source"),
        )
    )
    # At most one row per host and cooldown.
    picked = checkpointed(pick_with_cooldown(counted, "host", "us", params.cooldown_us, free))
    within = F.col("nth") > 1
    if picked.where(within).isEmpty():
        rows = picked.drop("nth")
    else:
        # A burst that crosses the threshold within one timestamp: find the row itself.
        in_time = Window.partitionBy("host", "us").orderBy("seq")
        heads = starts.withColumn("rn", F.row_number().over(in_time)).where(F.col("rn") <= k)
        later = picked.where(within).select("host", "us", F.col("nth").cast("int").alias("rn"), "process_count")
        rows = picked.where(~within).drop("nth").unionByName(
            heads.join(later, ["host", "us", "rn"]).select("host", "us", "process_count", "seq", "source")
        )
    return rows.withColumn("window_us", F.lit(span).cast("long"))

"""As-of matching of two event roles on a key, split over time.

``latest_before`` gives every closer the latest opener before it.  Each key is
cut into short time slots; a slot sees its own rows plus one carried row, the
last opener of the slots before it.  So a key that owns a third of the events
is spread over its slots, and the only per-key step sees one row per key and
slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import MINUTE
from ..functions.numbers import floor_div

SLOT_US = MINUTE
SLOTS_PER_WINDOW = 4


def _carry_within(per_slot: DataFrame, keys: list[str], reach: int) -> DataFrame:
    """Each slot's last opener, copied to the ``reach`` slots after it or up to the next opener."""
    order = Window.partitionBy(*keys).orderBy("slot")
    limit = F.col("slot") + F.lit(reach).cast("long")
    until = F.least(limit, F.coalesce(F.lead("slot").over(order), limit))
    later = F.sequence(F.col("slot") + 1, F.col("until"))
    return (
        per_slot.withColumn("until", until)
        .where(F.col("until") > F.col("slot"))
        .select(*keys, F.explode(later).alias("slot"), "opener")
    )


def _carry_forever(per_slot: DataFrame, closed: DataFrame, keys: list[str]) -> DataFrame:
    """The last opener before every slot that holds a closer; closer slots are reduced map-side."""
    wanted = closed.select(*keys, "slot").distinct()
    slots = per_slot.unionByName(wanted, allowMissingColumns=True).groupBy(*keys, "slot").agg(
        F.max("opener").alias("opener")
    )
    earlier = Window.partitionBy(*keys).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return slots.withColumn("opener", F.last("opener", ignorenulls=True).over(earlier)).where(
        F.col("opener").isNotNull()
    )


def latest_before(
    openers: DataFrame,
    closers: DataFrame,
    keys: list[str],
    window_us: int | None,
) -> DataFrame:
    """Closers with their latest earlier opener of the same key as struct ``opener``.

    Both inputs have ``keys``, ``us`` and ``seq``; order is (us, seq), and no
    event is in both.  Closers without an opener within ``window_us`` (closed;
    None = no bound) are dropped.
    """
    slot_us = SLOT_US if window_us is None else max(SLOT_US, window_us // SLOTS_PER_WINDOW)
    payload = [c for c in openers.columns if c not in (*keys, "us", "seq")]
    rest = [c for c in closers.columns if c not in (*keys, "us", "seq")]
    slot = floor_div(F.col("us"), slot_us).alias("slot")
    opened = openers.select(*keys, slot, "us", "seq", F.struct("us", "seq", *payload).alias("opener"))
    closed = closers.select(*keys, slot, "us", "seq", F.struct("us", "seq", *rest).alias("closer"))

    per_slot = opened.groupBy(*keys, "slot").agg(F.max("opener").alias("opener"))
    if window_us is None:
        carried = _carry_forever(per_slot, closed, keys)
    else:
        carried = _carry_within(per_slot, keys, window_us // slot_us + 1)
    carried = carried.select(*keys, "slot", F.col("opener.us").alias("us"), F.col("opener.seq").alias("seq"), "opener")

    so_far = (
        Window.partitionBy(*keys, "slot").orderBy("us", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    matched = (
        opened.unionByName(carried)
        .unionByName(closed, allowMissingColumns=True)
        .withColumn("opener", F.last("opener", ignorenulls=True).over(so_far))
        .where(F.col("closer").isNotNull() & F.col("opener").isNotNull())
    )
    if window_us is not None:
        matched = matched.where(F.col("us") - F.col("opener.us") <= window_us)
    return matched.select(*keys, "us", "seq", *[F.col(f"closer.{c}").alias(c) for c in rest], "opener")


def consume_once(
    openers: DataFrame, closers: DataFrame, keys: list[str], window_us: int | None
) -> DataFrame:
    """The first closer after each opener that is still the latest one of its key.

    The opener is used up by that closer.  A closer that comes too late uses
    nothing up, and all later closers are too late as well, so the earliest
    closer within the window is the match: a map-side reduced minimum.
    """
    pairs = latest_before(openers, closers, keys, window_us)
    rest = [c for c in pairs.columns if c not in (*keys, "us", "seq", "opener")]
    first = F.min_by(F.struct("us", "seq", *rest, "opener"), F.struct("us", "seq"))
    return (
        pairs.groupBy(*keys, F.col("opener.us").alias("_ous"), F.col("opener.seq").alias("_oseq"))
        .agg(first.alias("m"))
        .select(*keys, *[F.col(f"m.{c}").alias(c) for c in ("us", "seq", *rest, "opener")])
    )


def still_open(
    openers: DataFrame, closers: DataFrame, keys: list[str], newest_us: int, window_us: int | None
) -> DataFrame:
    """Openers that closers yet to come may match, after ``consume_once``: the latest of each key, if no closer
    follows it.  A closer that does follow has used it or came too late, as all later ones would.
    """
    payload = [c for c in openers.columns if c not in (*keys, "us", "seq")]
    at = F.struct("us", "seq")
    opened = openers.select(*keys, F.struct("us", "seq", *payload).alias("opener"))
    used = closers.select(*keys, at.alias("closed"))
    latest = opened.unionByName(used, allowMissingColumns=True).groupBy(*keys).agg(
        F.max("opener").alias("opener"), F.max("closed").alias("closed")
    )
    left = latest.where(
        F.col("opener").isNotNull()
        & (F.col("closed").isNull() | (F.col("closed") < F.struct("opener.us", "opener.seq")))
    )
    if window_us is not None:
        left = left.where(F.col("opener.us") >= newest_us - window_us)
    return left.select(*keys, *[F.col(f"opener.{c}").alias(c) for c in ("us", "seq", *payload)])

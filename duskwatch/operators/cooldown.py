"""Greedy selection with a cooldown, without walking a key in one task.

The rule is sequential: a candidate is taken when at least ``cooldown`` has
passed since the last one taken.  It is split into hour-like chunks of time:

1. per (key, chunk), for every time at which the key may become free again
   within the chunk, find when the chunk hands the key on (a step function
   with few steps, because selections that start apart soon coincide);
2. compose these functions: up a tree, FANOUT neighbouring nodes become one, and
   each keeps the composition of those before it (a prefix scan); then down the tree, the
   time at which the key is free at the parent gives that of its children;
3. per (key, chunk), take the candidates, now that the entry time is known.

No step gathers more than a chunk or FANOUT functions of a key, so a key that never falls silent
is spread over its chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import floor_div
from ..sources.checkpoint import checkpointed

COOLDOWNS_PER_CHUNK = 12
FANOUT = 16
# Free since before any time.
ALWAYS = -(2**63)


def _next_free(times: np.ndarray, cooldown: int) -> np.ndarray:
    """Index of the first candidate at least one cooldown after each candidate."""
    return np.searchsorted(times, times + cooldown, side="left")


def _steps(pdf: pd.DataFrame, cooldown: int, span: int) -> pd.DataFrame:
    times = np.sort(pdf["us"].to_numpy())
    chunk = int(pdf["chunk"].iloc[0])
    start = chunk * span
    after = _next_free(times, cooldown)
    # Entry is at most one cooldown into the chunk, so later starts cannot occur.
    entries = min(int(np.searchsorted(times, start + cooldown, side="right")) + 1, len(times))
    last = np.arange(entries)
    while True:
        ahead = after[last]
        more = ahead < len(times)
        if not more.any():
            break
        last = np.where(more, ahead, last)
    leave = np.maximum(start + span, times[last] + cooldown)
    keep = np.append(leave[1:] != leave[:-1], True)
    return pd.DataFrame({"grp": [pdf["grp"].iloc[0]], "chunk": [chunk], "upto": [times[:entries][keep]], "leave": [leave[keep]]})


def _then(first: tuple, second: tuple) -> tuple:
    """The function that applies ``first`` and then ``second``, a later one.

    A function maps an entry to the leave of the first step up to which it holds, and beyond its steps to itself.
    An entry that passes the first unchanged lies before the second, and so meets its first step.
    """
    upto, leave = first
    at = np.minimum(np.searchsorted(second[0], leave, side="left"), len(second[0]) - 1)
    through = np.where(second[0][at] >= leave, second[1][at], leave)
    upto, leave = np.append(upto, second[0][0]), np.append(through, second[1][0])
    keep = np.append(leave[1:] != leave[:-1], True)
    return upto[keep], leave[keep]


def _composed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each parent's function, and for each child the function of the children before it (none for the first)."""
    for batch in batches:
        out = []
        for grp, parent, children in zip(batch["grp"], batch["parent"], batch["children"], strict=True):
            whole, before = None, []
            for child in children:
                upto, leave = whole or (np.zeros(0, np.int64), np.zeros(0, np.int64))
                before.append({"node": child["node"], "upto": upto.tolist(), "leave": leave.tolist()})
                own = (np.array(child["upto"], np.int64), np.array(child["leave"], np.int64))
                whole = _then(whole, own) if whole else own
            out.append((grp, parent, whole[0].tolist(), whole[1].tolist(), before))
        yield pd.DataFrame(out, columns=["grp", "parent", "upto", "leave", "children"])


def _applied(upto: Column, leave: Column, entry: Column) -> Column:
    """The step function at ``entry``."""
    steps = F.arrays_zip(upto.alias("upto"), leave.alias("leave"))
    met = F.filter(steps, lambda s: s["upto"] >= entry)
    return F.coalesce(F.get(met, F.lit(0))["leave"], entry)


def _entries(steps: DataFrame, kind: str) -> DataFrame:
    """(grp, chunk, entry_us): when the key is free, as each chunk with candidates begins, from the chunks' functions."""
    steps = checkpointed(steps)
    ends = steps.agg(F.min("chunk").alias("low"), F.max("chunk").alias("high")).first()
    low, width = ends["low"] or 0, (ends["high"] or 0) - (ends["low"] or 0) + 1
    nodes = steps.select("grp", (F.col("chunk") - low).alias("node"), "upto", "leave")
    schema = f"grp {kind}, parent long, upto array<long>, leave array<long>, children array<struct<node: long, upto: array<long>, leave: array<long>>>"
    levels = []
    while width > 1:
        family = nodes.groupBy("grp", floor_div(F.col("node"), FANOUT).alias("parent")).agg(
            F.sort_array(F.collect_list(F.struct("node", "upto", "leave"))).alias("children")
        )
        level = checkpointed(family.mapInPandas(_composed, schema))
        levels.append(level.select("grp", "parent", "children"))
        nodes = level.select("grp", F.col("parent").alias("node"), "upto", "leave")
        width = -(-width // FANOUT)
    entry = nodes.select("grp", "node", F.lit(ALWAYS).alias("entry_us"))
    for level in reversed(levels):
        met = level.join(entry.withColumnRenamed("node", "parent"), ["grp", "parent"]).select("grp", "entry_us", F.explode("children").alias("c"))
        entry = met.select("grp", F.col("c.node").alias("node"), _applied(F.col("c.upto"), F.col("c.leave"), F.col("entry_us")).alias("entry_us"))
    return entry.select("grp", (F.col("node") + low).alias("chunk"), "entry_us")


def _take(pdf: pd.DataFrame, cooldown: int) -> pd.DataFrame:
    pdf = pdf.sort_values("us", ignore_index=True)
    times = pdf["us"].to_numpy()
    after = _next_free(times, cooldown)
    taken, i = [], int(np.searchsorted(times, pdf["entry_us"].iloc[0], side="left"))
    while i < len(times):
        taken.append(i)
        i = int(after[i])
    return pdf.iloc[taken].drop(columns=["entry_us"])


def pick_with_cooldown(candidates: DataFrame, key: str, time: str, cooldown_us: int, free: DataFrame | None = None) -> DataFrame:
    """Rows of ``candidates`` taken greedily in time order, per key.

    Needs one row per (key, time) and a positive cooldown.  ``free`` (key, free_us) says from when on
    a key is free, where that is known from before; others are.
    """
    if cooldown_us <= 0:
        raise ValueError("cooldown must be positive")
    span = cooldown_us * COOLDOWNS_PER_CHUNK
    columns = candidates.columns
    if free is not None:
        open_now = F.col("free_us").isNull() | (F.col(time) >= F.col("free_us"))
        candidates = candidates.join(free, key, "left").where(open_now).select(*columns)
    chunked = checkpointed(
        candidates.withColumnsRenamed({key: "grp", time: "us"})
        .withColumn("chunk", floor_div(F.col("us"), span))
        .where(F.col("grp").isNotNull() & F.col("chunk").isNotNull())
    )
    kind = dict(chunked.dtypes)
    steps = chunked.select("grp", "chunk", "us").groupBy("grp", "chunk").applyInPandas(
        lambda pdf: _steps(pdf, cooldown_us, span), f"grp {kind['grp']}, chunk long, upto array<long>, leave array<long>"
    )
    entries = _entries(steps, kind["grp"])
    joined = chunked.join(entries, ["grp", "chunk"])
    schema = ", ".join(f"`{c}` {t}" for c, t in joined.dtypes if c != "entry_us")
    taken = joined.groupBy("grp", "chunk").applyInPandas(lambda pdf: _take(pdf, cooldown_us), schema)
    return taken.withColumnsRenamed({"grp": key, "us": time}).select(*columns)

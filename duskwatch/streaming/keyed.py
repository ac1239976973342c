"""Running a keyed rule over a stream with state.

A rule sees the new rows of one key in (us, seq) order together with the
key's state.  State lives in the checkpointed state store, and output is
append-only, so an alert is written once even across restarts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# (key, state or None, rows sorted by time) -> (new state or None, hit rows)
Step = Callable[[tuple, tuple | None, pd.DataFrame], tuple[tuple | None, list[tuple]]]


@dataclass(frozen=True)
class KeyedRule:
    keys: tuple[str, ...]
    step: Step
    state_schema: str
    hit_schema: str
    # State that can no longer matter this long after the last event; None = kept for ever.
    expiry_us: int | None = None
    # Newest time that a state holds; a late batch must not bring its end forward.
    newest_us: Callable[[tuple], int] | None = None
    # State that must outlive the expiry, such as the fact that a key has alerted.
    settled: Callable[[tuple], bool] | None = None

    @property
    def hit_columns(self) -> list[str]:
        return [c.strip().split(" ")[0] for c in self.hit_schema.split(",")]


def trimmed(df: DataFrame, keep: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """Drop rows that cannot matter within each Arrow batch, before the shuffle to the state.

    This takes the place of a map-side combine, so that a key that floods a
    micro-batch does not send all its rows to one task.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield keep(batch)

    return df.mapInPandas(run, df.schema)


def apply_rule(df: DataFrame, rule: KeyedRule, watermark: str | None = None) -> DataFrame:
    """Hits of a keyed rule.

    Without a watermark late rows are accepted as they come and state is kept.
    With one (a delay on ``ts``), rows later than it are dropped by Spark and
    state is removed once it can no longer matter; a settled key stays.
    """
    expires = watermark is not None and rule.expiry_us is not None
    hit_columns, step, expiry_us, newest_us = rule.hit_columns, rule.step, rule.expiry_us, rule.newest_us
    settled = rule.settled

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(frames), ignore_index=True).sort_values(["us", "seq"], ignore_index=True)
        before = state.get if state.exists else None
        after, hits = step(key, before, rows)
        if after is None:
            if state.exists:
                state.remove()
        else:
            state.update(after)
            if expires and not (settled and settled(after)):
                # Strictly after the window, whose end still counts.
                newest = max(int(rows["us"].iloc[-1]), newest_us(after) if newest_us else 0)
                due = (newest + expiry_us) // 1000 + 1
                state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(hits, columns=hit_columns)

    timeout = GroupStateTimeout.EventTimeTimeout if expires else GroupStateTimeout.NoTimeout
    if expires:
        df = df.withWatermark("ts", watermark)
    return df.groupBy(*rule.keys).applyInPandasWithState(
        run, rule.hit_schema, rule.state_schema, "append", timeout
    )

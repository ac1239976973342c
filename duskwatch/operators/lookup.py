"""Joining events to a per-key table without a hint that could outgrow memory.

The table carries ``n``, the number of events per key.  Small tables are
broadcast behind a row count.  For larger ones the keys that own at least one
event in ``HOT_SHARE`` are split off and broadcast -- there can be no more than
``HOT_SHARE`` of them -- and only the even remainder is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
HOT_SHARE = 10_000


def attach(
    events: DataFrame, table: DataFrame, key: str, how: str, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``events`` joined (left or inner) with ``table``, unique on ``key``; ``n`` is dropped.

    ``table`` is counted here, so it should be materialised.
    """
    rows, total = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    payload = table.drop("n")
    if rows <= broadcast_rows:
        return events.join(F.broadcast(payload), key, how)
    is_hot = F.col("n") * F.lit(HOT_SHARE) >= F.lit(total)
    hot, cold = table.where(is_hot).drop("n"), table.where(~is_hot).drop("n")
    on_hot = events.join(F.broadcast(hot), key)
    on_rest = events.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, how)
    return on_hot.unionByName(on_rest)

"""Level crossings: emit (team, total) whenever a team's running total passes a
multiple of the threshold; one row even when several multiples are jumped.

Batch form: a skew-safe running sum (``ordered.running_sum``) in
(event time, event id) order, then a row-local quotient test.  The stream
form lives in ``rillet.streaming.levels``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.functions.times import display_time, floor_ms
from rillet.model import LEVEL_THRESHOLD
from rillet.operators.ordered import DEFAULT_CHUNK_MS, running_sum


def crossed(total_col: str, score_col: str, threshold: int):
    """``(total - score) div t < total div t`` (integer division, truncating)."""
    t = int(threshold)
    return F.expr(f"(({total_col} - {score_col}) div {t}) < ({total_col} div {t})")


def level_crossings(events: DataFrame, threshold: int = LEVEL_THRESHOLD, keys: Sequence[str] = ("team",),
                    chunk_ms: int = DEFAULT_CHUNK_MS) -> DataFrame:
    """``*keys, event_id, total_score`` for each crossing event."""
    keys = list(keys)
    r = running_sum(events.select(*keys, "event_id", "timestamp_ms", "score"), keys,
                    ["timestamp_ms", "event_id"], "score", "timestamp_ms", "total_score", chunk_ms)
    return r.where(crossed("total_score", "score", threshold)).select(*keys, "event_id", "total_score")


def windowed_level_crossings(events: DataFrame, window_minutes: int, threshold: int = LEVEL_THRESHOLD,
                             chunk_ms: int | None = None) -> DataFrame:
    """``window_start, team, event_id, total_score``: the same state per team and window.

    The window is part of the key, so chunks must be shorter than it to split
    a hot (team, window): by default a twelfth of the window.
    """
    chunk_ms = chunk_ms or max(1, window_minutes * 60_000 // 12)
    ev = events.withColumn("ws", floor_ms(F.col("timestamp_ms"), window_minutes * 60_000))
    out = level_crossings(ev, threshold, ["ws", "team"], chunk_ms)
    return out.select(display_time(F.col("ws")).alias("window_start"), "team", "event_id", "total_score")

"""User sessions (gap-based) and the mean session length per fixed window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.functions.times import display_time, floor_ms
from rillet.model import SESSION_GAP_MINUTES, SESSION_MEAN_WINDOW_MINUTES
from rillet.operators.ordered import DEFAULT_CHUNK_MS, session_starts


def sessions(events: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES,
             chunk_ms: int = DEFAULT_CHUNK_MS) -> DataFrame:
    """``user, start_ms, end_ms, minutes, n_events``; end = last event + gap.

    ``minutes`` is the whole number of minutes from start to end (gap included,
    truncated).  The final ``groupBy`` is partial-aggregated, so even one
    huge session is combined per task before its shuffle.
    """
    gap_ms = gap_minutes * 60_000
    # Rows at the same (user, millisecond) are one point of the session scan:
    # combined map-side first, so a chunk of any user holds at most one point
    # per millisecond of chunk_ms, however hot or bursty it is, and needs no
    # counting pass that slices heavy cells.
    points = events.groupBy("user", "timestamp_ms").agg(F.count(F.lit(1)).alias("_n"))
    tagged = session_starts(points, ["user"], "timestamp_ms", gap_ms, chunk_ms, extra_order=["_n"],
                            target_rows=None)
    s = tagged.groupBy("user", "session_start").agg(
        F.max("timestamp_ms").alias("_last"), F.sum("_n").alias("n_events"))
    end = F.col("_last") + F.lit(gap_ms)
    return s.select(
        "user", F.col("session_start").alias("start_ms"), end.alias("end_ms"),
        F.floor((end - F.col("session_start")) / F.lit(60_000)).cast("bigint").alias("minutes"),
        "n_events")


def user_sessions(events: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES,
                  chunk_ms: int = DEFAULT_CHUNK_MS) -> DataFrame:
    """``user, session_start, session_end, minutes, n_events`` with display times."""
    s = sessions(events, gap_minutes, chunk_ms)
    return s.select("user", display_time(F.col("start_ms")).alias("session_start"),
                    display_time(F.col("end_ms")).alias("session_end"), "minutes", "n_events")


def session_mean(events: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES,
                 window_minutes: int = SESSION_MEAN_WINDOW_MINUTES,
                 chunk_ms: int = DEFAULT_CHUNK_MS) -> DataFrame:
    """``window_start, mean_duration``: mean session minutes per fixed window.

    A session is placed by its end-of-window time (end - 1 ms), so one that
    ends exactly on a boundary belongs to the earlier window.
    """
    s = sessions(events, gap_minutes, chunk_ms)
    ws = floor_ms(F.col("end_ms") - 1, window_minutes * 60_000)
    m = s.groupBy(ws.alias("ws")).agg(F.avg("minutes").alias("mean_duration"))
    return m.select(display_time(F.col("ws")).alias("window_start"), "mean_duration")

"""Accumulating panes with early, on-time and late firings (leader board, teams).

One rule, three forms:

* ``PaneMachine``: the per-(key, window) step function, plain Python.
  Processing time and watermark are explicit inputs, so scripted streams
  test it exactly (Spark has no test clock).
* ``replay_panes``: a batch replay over a table of events with an event time
  and an arrival (processing) time.  Processing time advances in one-minute
  ticks, like a stream with a one-minute trigger: the watermark after minute
  ``m`` is the largest event time that arrived up to ``m``.
* ``rillet.streaming.leaderboard.team_panes``: the same machine inside
  ``applyInPandasWithState`` for a live stream.

With no window (``window_minutes=None``, the per-user leader board) there is
no on-time pane and nothing is ever too late: panes fire only on the clock.

Rule, with window end E, allowed lateness L, watermark w, processing time p:
1. an element arriving when ``w >= E + L`` is dropped; otherwise it is added
   to the total and, if nothing was pending, starts the pending clock at p;
2. when ``p >= pending_since + d`` (d = early delay before the on-time
   firing, late delay after it) the total fires as EARLY or LATE;
3. when w first reaches E the total fires once as ON_TIME;
4. when w reaches E + L pending elements fire as LATE and the state ends.
The watermark is checked before the clock, so at most one pane fires per tick.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillet.functions.times import display_time
from rillet.session import materialize
from rillet.model import (
    ALLOWED_LATENESS_MINUTES, EARLY, EARLY_FIRING_MINUTES, LATE, LATE_FIRING_MINUTES, ON_TIME,
    TEAM_WINDOW_MINUTES,
)

INF = float("inf")
NEVER = 2 ** 62          # tick that is never reached (the global window has no end)


@dataclass
class PaneMachine:
    window_end: float            # E; INF for the global window (no on-time pane)
    lateness: float              # L
    early_delay: float
    late_delay: float
    total: int = 0
    pending: bool = False
    pending_since: float = 0.0
    on_time_fired: bool = False
    closed: bool = False
    panes: list = field(default_factory=list)   # (timing, total, processing_time)

    def _fire(self, timing: str, p: float) -> None:
        self.panes.append((timing, self.total, p))
        self.pending = False

    def element(self, score: int, p: float, w: float) -> bool:
        """Add an element; False when it is dropped (too late or state closed)."""
        if self.closed or w >= self.window_end + self.lateness:
            return False
        self.total += score
        if not self.pending:
            self.pending, self.pending_since = True, p
        return True

    def watermark(self, w: float, p: float) -> None:
        if self.closed:
            return
        if not self.on_time_fired and self.window_end < INF and w >= self.window_end:
            self.on_time_fired = True
            self._fire(ON_TIME, p)
        if w >= self.window_end + self.lateness:
            if self.pending:
                self._fire(LATE, p)
            self.closed = True

    def clock(self, p: float) -> None:
        if self.closed or not self.pending:
            return
        delay = self.late_delay if self.on_time_fired else self.early_delay
        if p >= self.pending_since + delay:
            self._fire(LATE if self.on_time_fired else EARLY, p)

    def next_deadline(self) -> float:
        if self.closed or not self.pending:
            return INF
        return self.pending_since + (self.late_delay if self.on_time_fired else self.early_delay)


def run_script(steps: Iterable[tuple], window_ms: int | None, lateness_ms: int,
               early_ms: int, late_ms: int) -> list[tuple]:
    """Drive machines with a scripted stream.

    Steps: ``("event", key, event_time_ms, score)``, ``("watermark", w_ms)``
    (``INF`` allowed) and ``("clock", advance_ms)``.  Returns
    ``(key, window_start, timing, total)`` in firing order.
    """
    machines: dict[tuple, PaneMachine] = {}
    w, p = -INF, 0.0
    out: list[tuple] = []

    def collect(k, m, before):
        for timing, total, _ in m.panes[before:]:
            out.append((k[0], k[1], timing, total))

    for step in steps:
        kind = step[0]
        if kind == "event":
            _, key, t, score = step
            ws = (t // window_ms) * window_ms if window_ms else None
            end = ws + window_ms if window_ms else INF
            k = (key, ws)
            m = machines.get(k)
            if m is None:
                if w >= end + lateness_ms:
                    continue
                m = machines[k] = PaneMachine(end, lateness_ms, early_ms, late_ms)
            m.element(score, p, w)
        elif kind == "watermark":
            w = max(w, step[1])
            for k, m in machines.items():
                n = len(m.panes)
                m.watermark(w, p)
                collect(k, m, n)
        elif kind == "clock":
            p += step[1]
            for k, m in machines.items():
                n = len(m.panes)
                m.clock(p)
                collect(k, m, n)
        else:
            raise ValueError(f"unknown step {kind!r}")
    return out


def replay_group(arrivals: list[tuple[int, int]], on_time_at: int, close_at: int,
                 early_min: int, late_min: int) -> list[tuple[str, int, int]]:
    """Replay one (key, window) in minute ticks.

    ``arrivals``: ``(minute, score_sum)`` sorted by minute.  ``on_time_at`` /
    ``close_at``: the first tick at which the watermark is at least E / E + L
    (the end-of-input tick when it never gets there).  At each tick the
    watermark is checked, then the clock, then that minute's elements are
    added.  Returns ``(timing, total, tick)`` per pane.
    """
    on_time_at = INF if on_time_at >= NEVER else on_time_at
    close_at = INF if close_at >= NEVER else close_at
    if not arrivals or arrivals[0][0] >= close_at:
        return []                     # every element too late: no state, no pane
    # Drive the machine with the watermark expressed in ticks: w(t) = t, so
    # "w >= E" is "t >= on_time_at" and "w >= E + L" is "t >= close_at".
    lateness = close_at - on_time_at if close_at < INF else INF
    m = PaneMachine(on_time_at, lateness, early_min, late_min)
    i, n = 0, len(arrivals)
    t = arrivals[0][0]
    started = False
    while True:
        if started:
            m.watermark(t, t)
            if m.closed:
                break
            m.clock(t)
        while i < n and arrivals[i][0] == t:
            m.element(arrivals[i][1], t, t)
            i += 1
        started = True
        nxt = min(arrivals[i][0] if i < n else INF, INF if m.on_time_fired else on_time_at,
                  close_at, m.next_deadline())
        if nxt == INF:
            break
        t = int(max(nxt, t + 1))
    return m.panes


PANE_SCHEMA = T.StructType([
    T.StructField("team", T.StringType()),
    T.StructField("ws", T.LongType()),
    T.StructField("pane_index", T.IntegerType()),
    T.StructField("timing", T.StringType()),
    T.StructField("total_score", T.LongType()),
    T.StructField("fired_minute", T.LongType()),
])


_SUPER = 1024   # event-time buckets per super-bucket of the two-level scan


def clock_table(per_min: DataFrame, window_ms: int, lateness_ms: int, bucket_ms: int,
                end_tick: int) -> DataFrame:
    """``window_idx, on_time_at, close_at``: the first tick at which the watermark
    reaches each window's end E and E + L.

    The watermark after minute m is the largest event time that arrived up to
    m, so it first reaches E in the minute of the earliest arrival of any
    event with time >= E: ``on_time_at(E) = 1 + min(arrival minute over event
    buckets >= E)`` (buckets of ``bucket_ms`` divide both W and L).  That
    suffix minimum runs as a two-level scan: a running min per super-bucket
    of 1,024 buckets (many partitions), and a carry from later super-buckets
    (one row each).  Ends never reached get the end-of-input tick, where the
    watermark jumps to +inf.
    """
    per_w, per_l = window_ms // bucket_ms, lateness_ms // bucket_ms
    null_i, null_s = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    data = per_min.groupBy("bucket").agg(F.min("minute").alias("a")).select(
        F.col("bucket").alias("pos"), "a", F.lit(1).alias("kind"), null_i.alias("window_idx"), null_s.alias("which"))
    wins = per_min.select("window_idx").distinct()
    end_pos = (F.col("window_idx") + 1) * F.lit(per_w)
    queries = (wins.select(end_pos.alias("pos"), null_i.alias("a"), F.lit(0).alias("kind"), "window_idx",
                           F.lit("on_time_at").alias("which"))
               .unionByName(wins.select((end_pos + F.lit(per_l)).alias("pos"), null_i.alias("a"), F.lit(0).alias("kind"),
                                        "window_idx", F.lit("close_at").alias("which"))))
    u = data.unionByName(queries).withColumn("super", F.floor(F.col("pos") / F.lit(_SUPER)).cast("bigint"))
    # within a super-bucket, scanned from the top down: a running min (linear);
    # at equal positions data rows come first, so a bucket at E itself counts
    down = (Window.partitionBy("super").orderBy(F.col("pos").desc(), F.col("kind").desc())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    u = u.withColumn("within", F.min("a").over(down))
    supers = u.groupBy("super").agg(F.min("a").alias("sa"))
    later = supers.select("super", F.min("sa").over(
        Window.orderBy(F.col("super").desc()).rowsBetween(Window.unboundedPreceding, -1)).alias("later"))
    q = u.where(F.col("kind") == 0).join(later, "super", "left")
    first = F.least(F.col("within"), F.col("later"))
    tick = F.coalesce(first + 1, F.lit(end_tick)).cast("bigint")
    return q.groupBy("window_idx").agg(
        F.max(F.when(F.col("which") == "on_time_at", tick)).alias("on_time_at"),
        F.max(F.when(F.col("which") == "close_at", tick)).alias("close_at"))


def replay_panes(events: DataFrame, window_minutes: int | None = TEAM_WINDOW_MINUTES,
                 lateness_minutes: int = ALLOWED_LATENESS_MINUTES, early_minutes: int = EARLY_FIRING_MINUTES,
                 late_minutes: int = LATE_FIRING_MINUTES, key: str = "team") -> DataFrame:
    """``team, ws, pane_index, timing, total_score, fired_minute`` from events with
    ``timestamp_ms`` and ``arrival_ms``.

    Rows are first summed per (key, window, arrival minute): partial
    aggregation, and each replay group then holds at most one row per minute
    of its window's life, however hot the key.
    """
    global_window = window_minutes is None
    window_ms = 0 if global_window else window_minutes * 60_000
    lateness_ms = lateness_minutes * 60_000
    minute = F.floor(F.col("arrival_ms") / F.lit(60_000)).cast("bigint").alias("minute")
    if global_window:
        # One window for all time: no on-time pane, nothing is ever too late,
        # and pending elements fire when the clock reaches their deadline.
        rows = events.select(F.col(key).alias("team"), "score", "timestamp_ms", minute,
                             F.lit(0).cast("bigint").alias("window_idx"))
        per_min = (rows.groupBy("team", "window_idx", "minute").agg(F.sum("score").alias("score_sum"))
                   .withColumn("on_time_at", F.lit(NEVER)).withColumn("close_at", F.lit(NEVER)))
    else:
        bucket_ms = math.gcd(window_ms, lateness_ms) if lateness_ms else window_ms
        rows = events.select(
            F.col(key).alias("team"), "score", "timestamp_ms", minute,
            F.floor(F.col("timestamp_ms") / F.lit(window_ms)).cast("bigint").alias("window_idx"),
            F.floor(F.col("timestamp_ms") / F.lit(bucket_ms)).cast("bigint").alias("bucket"))
        # One pre-aggregate feeds the clock, the window list and the replay
        # groups.  Catalyst would prune it differently per branch and scan the
        # events three times, so it is written once to the checkpoint folder.
        per_min = materialize(rows.groupBy("team", "window_idx", "bucket", "minute").agg(
            F.sum("score").alias("score_sum")), "pane-minutes")
        # the end of input: one number, read from the (small) materialized table
        end_tick = int(per_min.agg(F.max("minute")).first()[0] or 0) + 1
        clocks = clock_table(per_min, window_ms, lateness_ms, bucket_ms, end_tick)
    # The clock table has one row per event-time window with data (about
    # 720 for a month of hourly windows); AQE broadcasts it after measuring
    # it (corrupt timestamps could make it large, so no forced broadcast).
    # The groups are then spread on both keys with an explicit partition
    # count: a partitioning on window_idx alone would put every team of a hot
    # window in one task, and this stage is Python-bound, so it must not be
    # coalesced to a few tasks.
    n_parts = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Rows that arrive after their window closed are dropped before the stage.
    g = per_min if global_window else per_min.join(clocks, "window_idx").where("minute < close_at")
    g = (g.repartition(n_parts, "team", "window_idx")
         .sortWithinPartitions("team", "window_idx", "minute"))
    early, late = early_minutes, late_minutes

    def replay_batch(pdf: pd.DataFrame) -> pd.DataFrame:
        teams = pdf["team"].to_numpy()
        widx = pdf["window_idx"].to_numpy(dtype="int64")
        minutes = pdf["minute"].to_numpy(dtype="int64").tolist()
        sums = pdf["score_sum"].to_numpy(dtype="int64").tolist()
        on_t = pdf["on_time_at"].to_numpy(dtype="int64")
        close = pdf["close_at"].to_numpy(dtype="int64")
        n = len(pdf)
        change = np.ones(n, dtype=bool)
        change[1:] = (teams[1:] != teams[:-1]) | (widx[1:] != widx[:-1])
        starts = np.flatnonzero(change).tolist() + [n]
        out = {f.name: [] for f in PANE_SCHEMA.fields}
        for a, b in zip(starts[:-1], starts[1:]):
            fired = replay_group(list(zip(minutes[a:b], sums[a:b])), int(on_t[a]), int(close[a]), early, late)
            for k, (timing, total, tick) in enumerate(fired):
                out["team"].append(teams[a])
                out["ws"].append(int(widx[a]) * window_ms)
                out["pane_index"].append(k)
                out["timing"].append(timing)
                out["total_score"].append(int(total))
                out["fired_minute"].append(int(tick))
        return pd.DataFrame({
            "team": pd.Series(out["team"], dtype=object),
            "ws": pd.Series(out["ws"], dtype="int64"),
            "pane_index": pd.Series(out["pane_index"], dtype="int32"),
            "timing": pd.Series(out["timing"], dtype=object),
            "total_score": pd.Series(out["total_score"], dtype="int64"),
            "fired_minute": pd.Series(out["fired_minute"], dtype="int64"),
        })

    def scan(batches):
        # Rows of a group are contiguous (sorted within the partition); the group
        # at a batch's end is held until it is over, its frames joined once.
        # It has one row per arrival minute at most.
        held = []
        for pdf in batches:
            if pdf.empty:
                continue
            team, widx = pdf["team"].iloc[-1], pdf["window_idx"].iloc[-1]
            last = (pdf["team"] == team) & (pdf["window_idx"] == widx)
            goes_on = not held or (held[-1]["team"].iloc[-1] == team and held[-1]["window_idx"].iloc[-1] == widx)
            if last.all() and goes_on:
                held.append(pdf)
                continue
            yield replay_batch(pd.concat([*held, pdf[~last]], ignore_index=True))
            held = [pdf[last]]
        if held:
            yield replay_batch(pd.concat(held, ignore_index=True))

    cols = ["team", "window_idx", "minute", "score_sum", "on_time_at", "close_at"]
    return g.select(*cols).mapInPandas(scan, PANE_SCHEMA)


def team_panes(events: DataFrame, **kw) -> DataFrame:
    """``window_start, team, pane_index, timing, total_score``."""
    p = replay_panes(events, **kw)
    return p.select(display_time(F.col("ws")).alias("window_start"), "team", "pane_index", "timing",
                    "total_score")


def final_panes(events: DataFrame, **kw) -> DataFrame:
    """``window_start, team, total_score`` of the last pane of each (team, window)."""
    p = replay_panes(events, **kw)
    last = p.groupBy("team", "ws").agg(F.max_by("total_score", "pane_index").alias("total_score"))
    return last.select(display_time(F.col("ws")).alias("window_start"), "team", "total_score")


def user_panes(events: DataFrame, delay_minutes: int = LATE_FIRING_MINUTES) -> DataFrame:
    """``user, pane_index, timing, total_score``: the global-window leader board,
    firing ``delay_minutes`` after the first unfired element of each user."""
    p = replay_panes(events, window_minutes=None, early_minutes=delay_minutes, late_minutes=delay_minutes,
                     key="user")
    return p.select(F.col("team").alias("user"), "pane_index", "timing", "total_score")


def user_final_panes(events: DataFrame, delay_minutes: int = LATE_FIRING_MINUTES) -> DataFrame:
    """``user, total_score`` of each user's last pane."""
    p = user_panes(events, delay_minutes)
    return p.groupBy("user").agg(F.max_by("total_score", "pane_index").alias("total_score"))

"""Leader board streams: per-user totals in the global window, per-team totals in
hourly windows with allowed lateness, and the exact early/on-time/late panes.

Simple forms use Spark's own state (update mode, watermark for lateness); the
exact forms keep their panes in ``applyInPandasWithState``, with timers at the
deadlines (``user_panes``) or at the windows' ends (``team_panes``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rillet.functions.times import display_time, floor_ms
from rillet.model import (
    ALLOWED_LATENESS_MINUTES, EARLY_FIRING_MINUTES, LATE_FIRING_MINUTES, TEAM_WINDOW_MINUTES,
)
from rillet.operators.panes import INF, PaneMachine
from rillet.sinks.table import batch_path


def user_totals(events: DataFrame) -> DataFrame:
    """Global window, accumulating, no lateness limit: run in update mode.

    No watermark on purpose: late rows always count, so the state holds one
    row per user (bounded by users, as in the reference).
    """
    return events.groupBy("user").agg(F.sum("score").alias("total_score"))


def team_totals(events: DataFrame, window_minutes: int = TEAM_WINDOW_MINUTES,
                lateness_minutes: int = ALLOWED_LATENESS_MINUTES) -> DataFrame:
    """Accumulating window sums; rows later than the lateness are dropped by the watermark."""
    return (events.withWatermark("event_time", f"{lateness_minutes} minutes")
            .groupBy(F.window("event_time", f"{window_minutes} minutes").alias("window"), "team")
            .agg(F.sum("score").alias("total_score")))


def latest_updates(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Last emitted value per key from an update-mode log with ``batch_id``."""
    return updates.groupBy(*keys).agg(F.max_by("total_score", "batch_id").alias("total_score"))


PANE_OUT = T.StructType([
    T.StructField("team", T.StringType()),
    T.StructField("ws", T.LongType()),
    T.StructField("timing", T.StringType()),
    T.StructField("total_score", T.LongType()),
    T.StructField("processing_ms", T.LongType()),
])
PANE_STATE = T.StructType([
    T.StructField("total", T.LongType()),
    T.StructField("pending", T.BooleanType()),
    T.StructField("pending_since", T.LongType()),
    T.StructField("on_time_fired", T.BooleanType()),
])


def _sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        yield f.groupby(["team", "ws"], as_index=False, dropna=False).agg({"score": "sum", "event_time": "max"})


def pane_step(window_end: int, delays: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState,
              poll_ms: int | None = None, slack_ms: int = 0) -> list[tuple]:
    """One visit of a (key, window): the panes it fires.

    All rows of a visit share one processing time and watermark, so they count as one element.  A
    window without state takes its rows before the watermark is looked at, and rows that come
    beyond the lateness leave no state and no pane.

    With ``poll_ms`` the next visit is due at the pending deadline or after ``poll_ms``, whichever is
    sooner (processing time); without, when the watermark reaches the window's end or its close
    (event time).  ``slack_ms`` is how far the query's watermark lags behind the greatest event time.
    """
    p, lagging = state.getCurrentProcessingTimeMs(), state.getCurrentWatermarkMs()
    w = lagging + slack_ms if lagging > 0 or not slack_ms else -INF        # 0: no watermark yet
    m = PaneMachine(window_end, *delays)
    scores = [int(f["score"].sum()) for f in pdfs if len(f)]
    if state.exists:
        total, pending, since, fired = state.get
        m.total, m.pending, m.pending_since, m.on_time_fired = int(total), bool(pending), since, bool(fired)
        m.watermark(w, p)
        m.clock(p)
        if scores:
            m.element(sum(scores), p, w)
    elif scores and m.element(sum(scores), p, w):
        m.watermark(w, p)
    else:
        return []
    m.clock(p)                                             # a delay of 0 is due at once
    if m.closed:
        state.remove()
    else:
        state.update((m.total, m.pending, int(m.pending_since), m.on_time_fired))
        if poll_ms is not None:
            state.setTimeoutDuration(int(max(1, min(poll_ms, m.next_deadline() - p))))
        else:
            due = window_end + (delays[0] if m.on_time_fired else 0) - slack_ms
            # a timer runs when the watermark is past it
            state.setTimeoutTimestamp(int(max(due - 1, lagging + 1, 1)))
    return m.panes


def team_panes(events: DataFrame, window_minutes: int = TEAM_WINDOW_MINUTES,
               lateness_minutes: int = ALLOWED_LATENESS_MINUTES, early_minutes: int = EARLY_FIRING_MINUTES,
               late_minutes: int = LATE_FIRING_MINUTES, poll_ms: int | None = 60_000,
               delay_seconds: int = 0) -> DataFrame:
    """Exact panes on a stream (append mode).

    Spark gives a keyed state timers of one kind, so there are two forms:

    * with ``poll_ms`` (a live leader board on a processing-time trigger): a processing-time timer
      revisits each open (team, window) at its pending deadline, and every ``poll_ms`` at least, so
      early and late panes come on time without new rows and the watermark is looked at;
    * with ``poll_ms=None``: event-time timers at the window's end and close, so on-time panes and
      closing follow the watermark without new rows and ``availableNow`` ends.  The early and late
      clock is looked at when rows arrive or a timer runs; with delays of 0 every micro-batch with
      rows of a window fires it.

    Rows are dropped by their window (too late once the watermark is at its end plus the lateness),
    not by their own time.  Spark drops rows older than its watermark where event-time timers are
    used, so that watermark lags by window and lateness, and the step adds them back.
    """
    wms, lms = window_minutes * 60_000, lateness_minutes * 60_000
    ems, lams = early_minutes * 60_000, late_minutes * 60_000
    slack = wms + lms if poll_ms is None else 0
    keyed = events.select("team", F.col("score").cast("bigint").alias("score"),
                          floor_ms(F.col("timestamp_ms"), wms).alias("ws"), "event_time")
    # a hot window's rows are summed before the shuffle: one row per Arrow batch and key reaches its
    # task, with the batch's latest event time, so the watermark is that of the rows
    keyed = keyed.mapInPandas(_sums, "team string, ws bigint, score bigint, event_time timestamp") \
        .withWatermark("event_time", f"{delay_seconds * 1000 + slack} milliseconds")

    def step(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        team, ws = key
        panes = pane_step(int(ws) + wms, (lms, ems, lams), pdfs, state, poll_ms, slack)
        if panes:
            yield pd.DataFrame({"team": [team] * len(panes), "ws": [int(ws)] * len(panes),
                                "timing": [x[0] for x in panes], "total_score": [int(x[1]) for x in panes],
                                "processing_ms": [int(x[2]) for x in panes]})

    timers = GroupStateTimeout.EventTimeTimeout if poll_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return keyed.groupBy("team", "ws").applyInPandasWithState(step, PANE_OUT, PANE_STATE, "append", timers)


USER_OUT = T.StructType([
    T.StructField("user", T.StringType()),
    T.StructField("total_score", T.LongType()),
    T.StructField("processing_ms", T.LongType()),
])
USER_STATE = T.StructType([
    T.StructField("total", T.LongType()),
    T.StructField("pending", T.BooleanType()),
    T.StructField("deadline", T.LongType()),
])


def user_step(delay_ms: int, pdfs: Iterator[pd.DataFrame], state: GroupState) -> tuple | None:
    """One visit of a user: ``(total, processing time)`` if the total fires.

    The first row after a firing sets the deadline, and a timer at the deadline is the only one.  A
    visit fires once at most: a due total fires before the visit's own rows are added (they start the
    next deadline), unless nothing was due and the delay is 0.
    """
    p = state.getCurrentProcessingTimeMs()
    total, pending, deadline = state.get if state.exists else (0, False, 0)
    fired = None
    if pending and p >= deadline:
        fired, pending = (int(total), p), False
    scores = [int(f["score"].sum()) for f in pdfs if len(f)]
    if scores:
        total += sum(scores)
        if not pending:
            pending, deadline = True, p + delay_ms
        if fired is None and p >= deadline:
            fired, pending = (int(total), p), False
    state.update((int(total), bool(pending), int(deadline)))
    if pending:
        state.setTimeoutDuration(int(max(1, deadline - p)))
    return fired


def user_panes(events: DataFrame, delay_minutes: float = LATE_FIRING_MINUTES) -> DataFrame:
    """``user, total_score, processing_ms``: the running total of each user in the global window.

    A user fires ``delay_minutes`` after the first row that no firing has told yet (append mode, exact
    to the trigger's interval).  Nothing is too late; the state holds one row per user.  With a delay of 0 every
    micro-batch with rows of a user fires it; no timers are needed then, so ``availableNow`` ends.
    """
    delay_ms = int(delay_minutes * 60_000)

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.groupby("user", as_index=False, dropna=False).agg({"score": "sum"})

    def step(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        fired = user_step(delay_ms, pdfs, state)
        if fired:
            yield pd.DataFrame({"user": [key[0]], "total_score": [fired[0]], "processing_ms": [fired[1]]})

    # a hot user's rows are summed before the shuffle
    keyed = events.select("user", F.col("score").cast("bigint").alias("score")) \
        .mapInPandas(sums, "user string, score bigint")
    timers = GroupStateTimeout.ProcessingTimeTimeout if delay_ms else GroupStateTimeout.NoTimeout
    return keyed.groupBy("user").applyInPandasWithState(step, USER_OUT, USER_STATE, "append", timers)


TEAM, USER = "team", "user"
BOARD_OUT = T.StructType([T.StructField("kind", T.StringType()), T.StructField("name", T.StringType()),
                          *PANE_OUT.fields[1:]])
BOARD_STATE = T.StructType([*PANE_STATE.fields, T.StructField("deadline", T.LongType())])


class _Part:
    """A group state as one of the two steps sees it: the fields of its own."""

    def __init__(self, state: GroupState, fields: tuple):
        self._state, self._fields = state, fields

    def __getattr__(self, name):
        return getattr(self._state, name)

    @property
    def get(self) -> tuple:
        held = dict(zip(BOARD_STATE.names, self._state.get))
        return tuple(held[f] for f in self._fields)

    def update(self, values: tuple) -> None:
        held = dict(zip(self._fields, values))
        self._state.update(tuple(held.get(f) for f in BOARD_STATE.names))


def leader_board(events: DataFrame, window_minutes: int = TEAM_WINDOW_MINUTES,
                 lateness_minutes: int = ALLOWED_LATENESS_MINUTES, early_minutes: int = EARLY_FIRING_MINUTES,
                 late_minutes: int = LATE_FIRING_MINUTES, user_minutes: float = LATE_FIRING_MINUTES,
                 poll_ms: int = 60_000, delay_seconds: int = 0) -> DataFrame:
    """Both leader boards from one reading of ``events``: ``kind, name, ws, timing, total_score, processing_ms``.

    Each row goes to its team's window and to its user (``ws`` -1) as a key of one stateful operator, so the
    input is read and parsed once and one checkpoint holds both.  Steps and timers are those of
    ``team_panes`` and ``user_panes``.
    """
    wms, user_ms = window_minutes * 60_000, int(user_minutes * 60_000)
    delays = (lateness_minutes * 60_000, early_minutes * 60_000, late_minutes * 60_000)
    rows = events.select("team", "user", F.col("score").cast("bigint").alias("score"),
                         floor_ms(F.col("timestamp_ms"), wms).alias("ws"), "event_time")

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for kind, part in ((TEAM, f), (USER, f.assign(ws=-1))):
                found = part.groupby([kind, "ws"], as_index=False, dropna=False).agg({"score": "sum", "event_time": "max"})
                yield found.rename(columns={kind: "name"}).assign(kind=kind)[["kind", "name", "ws", "score", "event_time"]]

    # hot teams and users are summed before the shuffle
    keyed = rows.mapInPandas(sums, "kind string, name string, ws bigint, score bigint, event_time timestamp") \
        .withWatermark("event_time", f"{delay_seconds} seconds")

    def step(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kind, name, ws = key
        if kind == TEAM:
            panes = pane_step(int(ws) + wms, delays, pdfs, _Part(state, tuple(PANE_STATE.names)), poll_ms)
        else:
            fired = user_step(user_ms, pdfs, _Part(state, tuple(USER_STATE.names)))
            panes = [(None, *fired)] if fired else []
        if panes:
            yield pd.DataFrame({"kind": [kind] * len(panes), "name": [name] * len(panes), "ws": [int(ws)] * len(panes),
                                "timing": [x[0] for x in panes], "total_score": [int(x[1]) for x in panes],
                                "processing_ms": [int(x[2]) for x in panes]})

    return keyed.groupBy("kind", "name", "ws").applyInPandasWithState(
        step, BOARD_OUT, BOARD_STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


def board_outputs(board: DataFrame, team_path: str, user_path: str, checkpoint: str):
    """Team panes and user totals of ``leader_board``, each micro-batch written once to a folder of its own in both."""
    shown = display_time(F.unix_millis(F.current_timestamp())).alias("processing_time")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            teams = batch.where(F.col("kind") == TEAM).select(
                F.col("name").alias("team"), "total_score", display_time(F.col("ws")).alias("window_start"), shown, "timing")
            users = batch.where(F.col("kind") == USER).select(F.col("name").alias("user"), "total_score", shown)
            for part, path in ((teams, team_path), (users, user_path)):
                part.write.mode("overwrite").parquet(batch_path(path, batch_id))
        finally:
            batch.unpersist()

    return board.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(per_batch)


def with_display_window(df: DataFrame) -> DataFrame:
    return df.select(display_time(F.unix_millis(F.col("window.start"))).alias("window_start"),
                     *[c for c in df.columns if c != "window"])

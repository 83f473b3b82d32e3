"""Game events: parse lines, sum scores per key (and window), render text.

Plans are narrow projections plus one aggregation; Catalyst plans the sum as
partial (map-side) + final around one exchange, so a hot user or team is
pre-combined in every task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.functions.strings import java_trim, render_fields, strict_int, strict_long
from rillet.functions.times import display_time, event_time_from_ms, floor_ms, local_option_to_ms
from rillet.model import (
    DEFAULT_START, DEFAULT_STOP, HOURLY_TEAM_TEXT_FIELDS, RANGE_OPTION_FORMAT, TEAM_WINDOW_MINUTES,
    USER_SCORE_TEXT_FIELDS,
)


def tag_game_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Add ``user, team, score, timestamp_ms`` and a ``parse_ok`` flag; keeps every input column.

    Staged projections: the line is split once and each field trimmed and
    cast once (Catalyst does not collapse projections that would repeat
    these non-trivial expressions).
    """
    base = lines.columns
    x = lines.withColumn("_parts", F.split(F.col(value_col), ",", -1))
    x = x.select(*base, F.size("_parts").alias("_n"),
                 java_trim(F.get(F.col("_parts"), 0)).alias("user"),
                 java_trim(F.get(F.col("_parts"), 1)).alias("team"),
                 java_trim(F.get(F.col("_parts"), 2)).alias("_score"),
                 java_trim(F.get(F.col("_parts"), 3)).alias("_ms"))
    x = x.select(*base, "_n", "user", "team", strict_int(F.col("_score")).alias("score"),
                 strict_long(F.col("_ms")).alias("timestamp_ms"))
    ok = (F.col("_n") >= 4) & F.col("score").isNotNull() & F.col("timestamp_ms").isNotNull()
    return x.select(*base, "user", "team", "score", "timestamp_ms", ok.alias("parse_ok"))


def parse_game_events(lines: DataFrame, value_col: str = "value", keep: Sequence[str] = (),
                      attribute_col: str | None = None, counter: str | None = None) -> DataFrame:
    """Parse ``user,team,score,ms[,...]`` lines; bad lines are dropped.

    With ``attribute_col`` the event time is that column's (ms; the line's own where it is null).
    With ``counter`` the plan observes ``n_lines`` and ``n_errors`` under that name, in a batch or a stream.

    Output: ``*keep, user, team, score, timestamp_ms, event_time``.  Written as
    a 0-or-1-output flat map (``inline`` of an empty or one-element array)
    rather than a filter: a filter on the parsed flag would be pushed below
    the projections and re-evaluate the line's expression once per field.
    """
    tagged = tag_game_lines(lines, value_col)
    if counter:
        tagged = tagged.observe(counter, F.count(F.lit(1)).alias("n_lines"), F.count_if(~F.col("parse_ok")).alias("n_errors"))
    ms = F.coalesce(attribute_col, "timestamp_ms") if attribute_col else F.col("timestamp_ms")
    row = F.struct(*[F.col(k) for k in keep], "user", "team", "score", ms.alias("timestamp_ms"),
                   event_time_from_ms(ms).alias("event_time"))
    # NULL (bad line) -> no output row
    return tagged.select(F.inline(F.when(F.col("parse_ok"), F.array(row))))


def parse_error_count(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """One row ``n_errors``: lines the parser rejects (a global count, partial-aggregated)."""
    tagged = tag_game_lines(lines, value_col)
    return tagged.agg(F.count_if(~F.col("parse_ok")).alias("n_errors"))


def observe_parse_errors(lines: DataFrame, name: str = "parse_errors", value_col: str = "value"):
    """Counter form: ``(observed_df, observation)``; read ``observation.get`` after an action."""
    from pyspark.sql import Observation

    obs = Observation(name)
    tagged = tag_game_lines(lines, value_col)
    observed = tagged.observe(obs, F.count_if(~F.col("parse_ok")).alias("n_errors"))
    return observed.where("parse_ok").drop("parse_ok"), obs


def sum_scores(events: DataFrame, key: str, extra_keys: Sequence[str | Column] = ()) -> DataFrame:
    """``extra_keys..., key, total_score`` (BIGINT): sum of score per key.

    ``key`` is ``team`` or ``user`` (anything else means user, as in the reference).
    """
    k = "team" if key == "team" else "user"
    return events.groupBy(*extra_keys, k).agg(F.sum("score").alias("total_score"))


def in_time_range(events: DataFrame, start_min: str = DEFAULT_START, stop_min: str = DEFAULT_STOP,
                  fmt: str = RANGE_OPTION_FORMAT) -> DataFrame:
    """Keep events strictly after ``start_min`` and strictly before ``stop_min`` (LA wall clock).

    The bounds are literal expressions; Catalyst folds them to constants.
    """
    lo = local_option_to_ms(start_min, fmt)
    hi = local_option_to_ms(stop_min, fmt)
    return events.where((F.col("timestamp_ms") > lo) & (F.col("timestamp_ms") < hi))


def window_start(minutes: int, ms_col: str = "timestamp_ms") -> Column:
    """Start of an event's fixed window in epoch milliseconds (any BIGINT time has one)."""
    return floor_ms(F.col(ms_col), minutes * 60_000)


def windowed_team_score(events: DataFrame, minutes: int = TEAM_WINDOW_MINUTES,
                        key: str = "team") -> DataFrame:
    """``team, window_start, total_score`` per fixed event-time window."""
    agg = sum_scores(events, key, [window_start(minutes).alias("ws")])
    k = "team" if key == "team" else "user"
    return agg.select(k, display_time(F.col("ws")).alias("window_start"), "total_score")


def user_score_text(scores: DataFrame) -> DataFrame:
    """``line``: ``total_score: N, user: U`` (declared field order)."""
    fields = [(name, F.col(name)) for name in USER_SCORE_TEXT_FIELDS]
    return scores.select(render_fields(fields).alias("line"))


def hourly_team_text(scores: DataFrame) -> DataFrame:
    """``line``: ``window_start: T, total_score: N, team: X``."""
    fields = [(name, F.col(name)) for name in HOURLY_TEAM_TEXT_FIELDS]
    return scores.select(render_fields(fields).alias("line"))

"""The reference's pipelines as job functions: typed options in, files or tables out.

Each job reads its input path (text lines), runs the operators in the
reference's order and writes with the matching sink.  They hold no state
beyond the session and return what they wrote (or the observation metrics).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.model import (
    DISPLAY_ZONE, DebuggingWordCountOptions, ExternalProgramOptions, GameStatsOptions, HourlyTeamScoreOptions, LeaderBoardOptions, PersonOptions,
    StatefulTeamScoreOptions, UserScoreOptions, WindowedWordCountOptions, WordCountOptions,
)
from rillet.operators import abuse, checks, people, scores, sessions, words
from rillet.sinks import text as text_sink
from rillet.sinks.table import append_table
from rillet.functions.times import display_time
from rillet.session import materialize
from rillet.sources.text import read_lines


def minimal_word_count(spark: SparkSession, opts: WordCountOptions) -> DataFrame:
    """Q1: read, tokenise, drop empties, count, format, write."""
    counts = words.count_words(words.tokenize(read_lines(spark, opts.input), pattern=opts.pattern))
    out = words.format_counts(counts)
    text_sink.write_text(out, opts.output)
    return out


def word_count(spark: SparkSession, opts: WordCountOptions) -> dict:
    """Q2: as Q1 plus the blank-line counter and line-length distribution."""
    lines, obs = words.observe_line_stats(read_lines(spark, opts.input))
    counts = words.count_words(words.tokenize(lines, pattern=opts.pattern))
    text_sink.write_text(words.format_counts(counts), opts.output)
    return obs.get


def debugging_word_count(spark: SparkSession, opts: DebuggingWordCountOptions) -> dict:
    """Q3: counts filtered by a full-match pattern, checked against expected pairs."""
    counts = materialize(words.count_words(words.tokenize(read_lines(spark, opts.input))), "word-counts")
    kept = words.filter_full_match(counts, opts.filter_pattern)
    stats = words.match_stats(counts, opts.filter_pattern).first().asDict()
    if opts.expected:
        expected = spark.createDataFrame(list(opts.expected), "word string, cnt bigint")
        checks.assert_same_multiset(kept, expected)
    return stats


def windowed_word_count(spark: SparkSession, opts: WindowedWordCountOptions) -> None:
    """Q4: random event time in [min, max), fixed windows, counts, one file set per window."""
    min_ms = opts.min_timestamp_ms if opts.min_timestamp_ms is not None else int(time.time() * 1000)
    max_ms = opts.max_timestamp_ms if opts.max_timestamp_ms is not None else min_ms + 3_600_000
    lines = words.with_random_event_time(read_lines(spark, opts.input), min_ms, max_ms, opts.seed)
    toks = words.tokenize(lines, keep=["event_time"])
    counts = words.count_words(toks, [F.window("event_time", f"{opts.window_minutes} minutes").alias("window")])
    out = counts.select("window", F.concat(F.col("word"), F.lit(": "), F.col("cnt").cast("string")).alias("line"))
    text_sink.write_per_window(out, opts.output, num_shards=opts.num_shards)


def user_score(spark: SparkSession, opts: UserScoreOptions) -> dict:
    """Q5: parse, sum per user, render ``total_score: N, user: U``; returns the parse-error counter."""
    events, obs = scores.observe_parse_errors(read_lines(spark, opts.input))
    text_sink.write_text(scores.user_score_text(scores.sum_scores(events, "user")), opts.output)
    return obs.get


def hourly_team_score(spark: SparkSession, opts: HourlyTeamScoreOptions) -> None:
    """Q6: parse, keep (start, stop), hourly windows, team sums, three shards per window."""
    events = scores.parse_game_events(read_lines(spark, opts.input))
    events = scores.in_time_range(events, opts.start_min, opts.stop_min)
    sums = scores.sum_scores(events, "team", [scores.window_start(opts.window_minutes).alias("ws")])
    window = F.struct(F.timestamp_millis("ws").alias("start"),
                      F.timestamp_millis(F.col("ws") + opts.window_minutes * 60_000).alias("end"))
    rendered = sums.select(window.alias("window"), F.concat_ws(", ",
        F.concat(F.lit("window_start: "), display_time(F.col("ws"))),
        F.concat(F.lit("total_score: "), F.col("total_score").cast("string")),
        F.concat(F.lit("team: "), F.col("team"))).alias("line"))
    text_sink.write_windowed_text(rendered, opts.output, zone=DISPLAY_ZONE)


def game_stats(spark: SparkSession, opts: GameStatsOptions) -> None:
    """Q9-Q11 in batch: spam-free team sums and mean session length, appended to tables."""
    events = scores.parse_game_events(read_lines(spark, opts.input))
    teams = abuse.team_score_without_spammers(events, opts.fixed_window_minutes, opts.score_weight)
    append_table(teams.select("team", "total_score", "window_start", _processing_time()),
                 path=f"{opts.output}/team_scores")
    means = sessions.session_mean(events, opts.session_gap_minutes, opts.user_activity_window_minutes)
    append_table(means.select("window_start", "mean_duration", _processing_time()), path=f"{opts.output}/session_means")


def stateful_team_score(spark: SparkSession, opts: StatefulTeamScoreOptions) -> None:
    """Q12 in batch: level crossings appended to a table."""
    from rillet.operators.levels import level_crossings

    lines = read_lines(spark, opts.input).withColumn("event_id", F.monotonically_increasing_id())
    events = scores.parse_game_events(lines, keep=("event_id",))
    append_table(level_crossings(events, opts.threshold).select("*", _processing_time()), path=opts.output)


def leader_board_batch(spark: SparkSession, opts: LeaderBoardOptions, arrivals: DataFrame) -> DataFrame:
    """Q7 over a recorded stream (event time + arrival time): exact panes, replayed."""
    from rillet.operators.panes import team_panes

    return team_panes(arrivals, window_minutes=opts.team_window_minutes,
                      lateness_minutes=opts.allowed_lateness_minutes,
                      early_minutes=opts.early_minutes, late_minutes=opts.late_minutes)


def person_records(spark: SparkSession, opts: PersonOptions) -> None:
    """Q13: split into ``_invalid`` (raw lines) and ``_valid`` (rendered people) text outputs."""
    tagged = materialize(people.tag_lines(read_lines(spark, opts.input)), "people")    # read and checked once
    invalid = tagged.where(F.col("tag") == people.INVALID).select(F.col("value").alias("line"))
    text_sink.write_text(invalid, f"{opts.output}_invalid")
    text_sink.write_text(people.people_text(people.people(tagged.where(F.col("tag") == people.VALID))),
                         f"{opts.output}_valid")


# -- live (streaming) jobs -------------------------------------------------------
# Each returns the started StreamingQuery objects; the caller awaits or stops them.

# A query's checkpoint has a fixed place (``checkpoint`` option, or next to the output),
# so a job that is stopped and started again goes on where it was: state kept, each
# input file read once, each micro-batch's folder written once.

def checkpoint_path(opts, query: str) -> str:
    output = opts.output or getattr(opts, "output_topic", "")
    return f"{opts.checkpoint or output.rstrip('/') + '_checkpoint'}/{query}"


def _processing_time():
    return display_time(F.unix_millis(F.current_timestamp())).alias("processing_time")


def counter_path(opts) -> str:
    return f"{opts.output.rstrip('/')}_counters"


def live_counters(opts) -> dict:
    """A live game job's counters so far: ``n_lines`` and ``n_errors`` read, for game statistics ``n_spammers`` too."""
    from rillet.streaming import counters

    return counters.totals(counter_path(opts))


def _live_events(spark: SparkSession, opts, keep=(), prepare=lambda lines: lines, counted: bool = True) -> DataFrame:
    """Game events of a live job's input: lines, or messages (of files or a topic) whose event time is an attribute."""
    from rillet.sources import topics
    from rillet.sources.text import stream_lines, stream_messages
    from rillet.streaming import counters

    counter = counters.metric(counters.listen(spark, counter_path(opts)), "lines") if counted else None
    if opts.input_topic:
        lines = topics.stream_messages(spark, opts.input_topic, opts.timestamp_attribute or topics.TIMESTAMP_ATTRIBUTE)
        return scores.parse_game_events(prepare(lines), keep=keep, attribute_col="attribute_ms", counter=counter)
    if opts.timestamp_attribute:
        lines = stream_messages(spark, opts.input, opts.timestamp_attribute, opts.max_files_per_trigger)
        return scores.parse_game_events(prepare(lines), keep=keep, attribute_col="attribute_ms", counter=counter)
    lines = stream_lines(spark, opts.input, opts.max_files_per_trigger)
    return scores.parse_game_events(prepare(lines), keep=keep, counter=counter)


def leader_board_stream(spark: SparkSession, opts: LeaderBoardOptions, trigger: str = "10 seconds"):
    """Q7 + Q8 live: one query that reads and parses its input once and keeps both boards.

    Teams: exact early/on-time/late panes per hourly window, appended to ``<output>/team_panes`` with the
    window start, timing and processing time.  Users: the global-window running totals, each user's
    ``user_minutes`` after the first row not yet told, appended to ``<output>/user_totals`` with the
    processing time.
    """
    from rillet.streaming import leaderboard

    board = leaderboard.leader_board(_live_events(spark, opts), opts.team_window_minutes, opts.allowed_lateness_minutes,
                                     opts.early_minutes, opts.late_minutes, opts.user_minutes,
                                     delay_seconds=opts.watermark_delay_seconds)
    return (leaderboard.board_outputs(board, f"{opts.output}/team_panes", f"{opts.output}/user_totals",
                                      checkpoint_path(opts, "board"))
            .trigger(processingTime=trigger).start())


def windowed_word_count_stream(spark: SparkSession, opts: WindowedWordCountOptions, trigger: str = "10 seconds"):
    """Q4 live: word counts per window, written as ``num_shards`` text files when the watermark passes the window.

    A line's event time is its message's attribute, or the time it is read.
    """
    from rillet.sinks.windows import stream_per_window
    from rillet.sources import topics
    from rillet.sources.text import stream_lines, stream_messages

    if opts.input_topic or opts.timestamp_attribute:
        name = opts.timestamp_attribute or topics.TIMESTAMP_ATTRIBUTE
        lines = topics.stream_messages(spark, opts.input_topic, name) if opts.input_topic else \
            stream_messages(spark, opts.input, name, opts.max_files_per_trigger)
        at = F.coalesce(F.timestamp_millis("attribute_ms"), F.current_timestamp())
    else:
        lines, at = stream_lines(spark, opts.input, opts.max_files_per_trigger), F.current_timestamp()
    lines = lines.select("value", at.alias("event_time")).withWatermark("event_time", f"{opts.watermark_delay_seconds} seconds")
    toks = words.tokenize(lines, keep=["event_time"])
    counts = words.count_words(toks, [F.window("event_time", f"{opts.window_minutes} minutes").alias("window")])
    out = counts.select("window", F.concat(F.col("word"), F.lit(": "), F.col("cnt").cast("string")).alias("line"))
    return (stream_per_window(out, opts.output, checkpoint_path(opts, "windows"), opts.num_shards or 3)
            .trigger(processingTime=trigger).start())


def person_records_stream(spark: SparkSession, opts: PersonOptions, trigger: str = "10 seconds"):
    """Q14 (``mode='stream_topics'``): valid people and invalid raw lines to two topics (messages, or text folders);
    Q15 (``mode='stream_table'``): valid people's five columns appended to a table."""
    from rillet.sources import topics
    from rillet.sources.text import stream_lines
    from rillet.streaming import people as people_stream

    if opts.input_topic:
        lines = topics.stream_messages(spark, opts.input_topic)
    else:
        lines = stream_lines(spark, opts.input, opts.max_files_per_trigger)
    if opts.mode == "stream_topics" and opts.output_topic:
        writer = people_stream.split_to_message_topics(
            lines, opts.output_topic, opts.invalid_topic or f"{opts.output_topic.rstrip('/')}_invalid",
            checkpoint_path(opts, opts.mode))
    elif opts.mode == "stream_topics":
        writer = people_stream.split_to_topics(lines, f"{opts.output}_valid", f"{opts.output}_invalid",
                                               checkpoint_path(opts, opts.mode))
    elif opts.mode == "stream_table":
        writer = people_stream.to_table(lines, opts.output, checkpoint_path(opts, opts.mode))
    else:
        raise ValueError(f"unknown stream mode {opts.mode!r}")
    return writer.trigger(processingTime=trigger).start()


def game_stats_stream(spark: SparkSession, opts: GameStatsOptions, trigger: str = "10 seconds"):
    """Q9-Q11 live: spammers and spam-free team sums per closed window
    (``<output>/spammers``, ``<output>/team_scores``) and mean session length
    per window (``<output>/session_means``); append mode, default trigger."""
    from rillet.sinks.table import stream_append
    from rillet.streaming import gamestats

    events = _live_events(spark, opts)
    delay = f"{opts.watermark_delay_seconds} seconds"
    sums = gamestats.window_user_team_sums(events, opts.fixed_window_minutes, delay)
    q_spam = (gamestats.spam_outputs(f"{opts.output}/spammers", f"{opts.output}/team_scores",
                                     checkpoint_path(opts, "spam"), sums, opts.score_weight, counters=counter_path(opts))
              .trigger(processingTime=trigger).start())
    told = _live_events(spark, opts, counted=False)                    # the same lines: the other query counts them
    means = gamestats.session_mean_stream(told, opts.session_gap_minutes, opts.user_activity_window_minutes,
                                          delay).select(display_time(F.col("ws")).alias("window_start"),
                                                        "mean_duration", _processing_time())
    q_sessions = (stream_append(means, None, f"{opts.output}/session_means", checkpoint_path(opts, "sessions"))
                  .trigger(processingTime=trigger).start())
    return q_spam, q_sessions


def stateful_team_score_stream(spark: SparkSession, opts: StatefulTeamScoreOptions, trigger: str = "10 seconds"):
    """Q12 live: (team, total) whenever a team's running total passes a multiple
    of the threshold; the running totals are a table per micro-batch.  Lines may carry a trailing event id
    (used to order rows of one micro-batch); otherwise the event time alone orders them."""
    from rillet.streaming import levels

    parts = F.split("value", ",", -1)
    event_id = F.when(F.size(parts) > 5, F.element_at(parts, -1).try_cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    events = _live_events(spark, opts, ("event_id",), lambda lines: lines.withColumn("event_id", event_id))
    return (levels.crossings_sink(events, opts.output, f"{opts.output.rstrip('/')}_totals", checkpoint_path(opts, "levels"),
                                  opts.threshold, shown=[_processing_time()])
            .trigger(processingTime=trigger).start())


def external_program(spark: SparkSession, opts: ExternalProgramOptions) -> None:
    """Q16: (key, value) rows through an external program ``passes`` times, then
    written as ``key,value`` lines.  Keys are the row numbers (or 0..n-1)."""
    from rillet.operators import external

    if opts.input:
        rows = read_lines(spark, opts.input).select(
            F.monotonically_increasing_id().cast("string").alias("key"), "value")
    else:
        rows = spark.range(opts.n_rows).select(F.col("id").cast("string").alias("key"),
                                               F.col("id").cast("string").alias("value"))
    for _ in range(opts.passes):
        through = external.run_per_row if opts.per_row else external.exchange_frames if opts.framed else external.pipe_values
        rows = through(rows, opts.command, opts.timeout_sec)
    text_sink.write_text(rows.select(F.concat_ws(",", "key", "value").alias("line")), opts.output)

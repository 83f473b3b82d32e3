"""Keyed stream queries: stage lines derived from the tables, run the stream
with ``availableNow``, return the sink read back.

The leader board and level keys get their lines in several parts by arrival time.
Append-mode forms hold the last windows until the watermark passes them; a
bounded input ends with a mark line (after the latest event, under a name that
only this run knows, left out of every result) that moves the watermark past
all real windows, as a bounded source's watermark jumps to +inf when it is
exhausted; the no-data batch that ``availableNow`` runs last then emits them.

Each stream runs in its own session (``newSession``: same cluster, own SQL
conf) whose shuffle partitions, and so state-store partitions, match the
cluster's default parallelism; the caller's session conf is left untouched.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillet.functions.times import display_time
from rillet.operators import people as people_ops
from rillet.operators.scores import parse_game_events
from rillet.session import scratch_path
from rillet.sinks.table import stream_append
from rillet.sources import topics
from rillet.sources.derived import game_lines, person_lines
from rillet.streaming import gamestats, leaderboard, levels
from rillet.streaming import people as people_stream
from rillet.sources.text import stage_lines, stream_lines
from rillet.streaming.runner import run_available_now


def _parse_with_id(lines: DataFrame) -> DataFrame:
    ev = lines.withColumn("event_id", F.element_at(F.split("value", ",", -1), -1).try_cast("bigint"))
    return parse_game_events(ev, keep=("event_id",))


def _stream_session(spark: SparkSession) -> SparkSession:
    ss = spark.newSession()
    ss.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return ss


def _stage(spark: SparkSession, lines: DataFrame, kind: str):
    """Stage ``lines.value`` as text files; return (stream over them in a stream session, path)."""
    path = scratch_path(spark, f"{kind}-input")
    stage_lines(lines.select("value"), path)
    return stream_lines(_stream_session(spark), path), path


def _stage_game(spark: SparkSession, sf_dir: str, kind: str):
    return _stage(spark, game_lines(spark, sf_dir), kind)


def _run_to_end(spark: SparkSession, path: str, build_writer) -> None:
    """Run an append-mode stream over ``path`` until every real window is emitted.

    A bounded input's watermark must pass its last windows.  A mark line two
    days after the latest event does that; its user and team are a name drawn
    for this run, which no data can hold, and ``build_writer(lines, mark)``
    leaves that name out of the results.  The mark rides in the batch with the
    data; ``availableNow`` then runs one no-data batch that evicts every real
    window.
    """
    mark = f"~end-{uuid.uuid4().hex}~"
    last = parse_game_events(spark.read.text(path)).agg(F.max("timestamp_ms")).first()[0] or 0
    line = f"{mark},{mark},0,{last + 2 * 86_400_000},end"
    # appended as a file of the watched folder itself (a file stream does not read subfolders)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(path)
    run_available_now(build_writer(stream_lines(_stream_session(spark), path), mark))


ARRIVAL_PARTS = 4


def _run_by_arrival(spark: SparkSession, sf_dir: str, kind: str, build_writer, with_ids: bool = False) -> None:
    """Feed the game lines in ``ARRIVAL_PARTS`` equal spans of their arrival time.

    Each part is added to the watched folder and the stream run over it from the same checkpoint:
    state, watermark and output go on across micro-batches and restarts, and rows that arrive too
    late for their window are dropped as the watermark of the earlier parts says.
    """
    lines = game_lines(spark, sf_dir)
    lo, hi = lines.agg(F.min("arrival_ms"), F.max("arrival_ms")).first()
    value = F.concat_ws(",", "value", F.col("event_id").cast("string")) if with_ids else F.col("value")
    part = F.expr(f"(arrival_ms - {lo or 0}L) * {ARRIVAL_PARTS} div {(hi or 0) - (lo or 0) + 1}L")
    # stored by part, so that each part reads its own files only
    store = scratch_path(spark, f"{kind}-lines")
    lines.select(value.alias("value"), part.cast("int").alias("part")).write.partitionBy("part").parquet(store)
    staged = spark.read.schema("value string, part int").parquet(store)
    path, session = scratch_path(spark, f"{kind}-input"), _stream_session(spark)
    for k in range(ARRIVAL_PARTS):
        staged.where(F.col("part") == k).select("value").write.mode("append").text(path)
        run_available_now(build_writer(stream_lines(session, path)))


def leaderboard_user(spark, sf_dir):
    out, ck = scratch_path(spark, "leaderboard-user-out"), scratch_path(spark, "checkpoint")
    _run_by_arrival(spark, sf_dir, "leaderboard-user", lambda lines: stream_append(
        leaderboard.user_totals(parse_game_events(lines)), None, out, ck, "update"))
    return leaderboard.latest_updates(spark.read.parquet(out), ["user"])


def leaderboard_team_totals(spark, sf_dir):
    out, ck = scratch_path(spark, "leaderboard-team-out"), scratch_path(spark, "checkpoint")
    _run_by_arrival(spark, sf_dir, "leaderboard-team", lambda lines: stream_append(
        leaderboard.team_totals(parse_game_events(lines), 60, 120).select(
            F.unix_millis(F.col("window.start")).alias("ws"), "team", "total_score"), None, out, ck, "update"))
    last = leaderboard.latest_updates(spark.read.parquet(out), ["ws", "team"])
    return last.select(display_time(F.col("ws")).alias("window_start"), "team", "total_score")


def _pane_numbers(panes: DataFrame, keys: list[str]) -> DataFrame:
    """Panes numbered from 0 in the order of their micro-batches (a key fires once a batch at most)."""
    order = Window.partitionBy(*keys).orderBy("batch_id")
    return panes.withColumn("pane_index", (F.row_number().over(order) - 1).cast("int"))


def leaderboard_team_live_panes(spark, sf_dir):
    """Early panes with every part's rows, the on-time pane as the watermark passes, then late ones."""
    out, ck = scratch_path(spark, "leaderboard-panes-out"), scratch_path(spark, "checkpoint")
    _run_by_arrival(spark, sf_dir, "leaderboard-panes", lambda lines: stream_append(
        leaderboard.team_panes(parse_game_events(lines), 60, 120, 0, 0, poll_ms=None), None, out, ck))
    panes = _pane_numbers(spark.read.parquet(out), ["team", "ws"])
    return panes.select(display_time(F.col("ws")).alias("window_start"), "team", "pane_index", "timing", "total_score")


def leaderboard_user_live_panes(spark, sf_dir):
    """Each user's running total after every part that has rows of the user."""
    out, ck = scratch_path(spark, "leaderboard-users-out"), scratch_path(spark, "checkpoint")
    _run_by_arrival(spark, sf_dir, "leaderboard-users", lambda lines: stream_append(
        leaderboard.user_panes(parse_game_events(lines), 0), None, out, ck))
    return _pane_numbers(spark.read.parquet(out), ["user"]).select("user", "pane_index", "total_score")


def team_level_crossings_stream(spark, sf_dir):
    out, totals, ck = (scratch_path(spark, k) for k in ("levels-out", "levels-totals", "checkpoint"))
    _run_by_arrival(spark, sf_dir, "levels", lambda lines: levels.crossings_sink(
        _parse_with_id(lines), out, totals, ck, 5000), with_ids=True)
    return spark.read.parquet(out).select("team", "event_id", "total_score")


def _spam_run(spark, sf_dir):
    _, path = _stage_game(spark, sf_dir, "gamestats")
    spam_p, team_p = (scratch_path(spark, f"gamestats-{k}") for k in ("spam", "team"))
    ck = scratch_path(spark, "checkpoint")

    def writer(lines, mark):
        sums = gamestats.window_user_team_sums(parse_game_events(lines), 60)
        return gamestats.spam_outputs(spam_p, team_p, ck, sums, 2.5, without_user=mark)

    _run_to_end(spark, path, writer)
    return spam_p, team_p


def spammy_users_stream(spark, sf_dir):
    spam_p, _ = _spam_run(spark, sf_dir)
    sp = spark.read.parquet(spam_p)
    return sp.select(display_time(F.col("ws")).alias("window_start"), "user", "total_score")


def team_score_no_spam_stream(spark, sf_dir):
    _, team_p = _spam_run(spark, sf_dir)
    t = spark.read.parquet(team_p)
    return t.select(display_time(F.col("ws")).alias("window_start"), "team", "total_score")


def session_mean_stream(spark, sf_dir):
    _, path = _stage_game(spark, sf_dir, "sessions")
    out, ck = scratch_path(spark, "sessions-out"), scratch_path(spark, "checkpoint")

    def writer(lines, mark):
        means = gamestats.session_mean_stream(parse_game_events(lines), 5, 30, without_user=mark)
        return stream_append(means, None, out, ck, "append")

    _run_to_end(spark, path, writer)
    m = spark.read.parquet(out)
    return m.select(display_time(F.col("ws")).alias("window_start"), "mean_duration")


def bio_stream_split(spark, sf_dir):
    """A topic of person lines, split by one query into a topic of people and one of the other lines."""
    source, valid, invalid = (scratch_path(spark, f"topic-{k}") for k in ("people", "valid", "invalid"))
    ck = scratch_path(spark, "checkpoint")
    topics.send(person_lines(spark, sf_dir).select("value"), source)
    lines = topics.stream_messages(spark, source)
    run_available_now(people_stream.split_to_message_topics(lines, valid, invalid, ck))
    told = [topics.read_messages(spark, t).select(F.lit(tag).alias("tag"), "value")
            for tag, t in ((people_ops.VALID, valid), (people_ops.INVALID, invalid))]
    return told[0].unionByName(told[1])


def bio_table(spark, sf_dir):
    lines, _ = _stage(spark, person_lines(spark, sf_dir), "people")
    out, ck = scratch_path(spark, "people-table"), scratch_path(spark, "checkpoint")
    run_available_now(people_stream.to_table(lines, out, ck))
    return spark.read.parquet(out).select("name", "sex", "age", "weight", "height")


STREAM_QUERIES = {
    "leaderboard_user": leaderboard_user,
    "leaderboard_team_totals": leaderboard_team_totals,
    "leaderboard_team_live_panes": leaderboard_team_live_panes,
    "leaderboard_user_live_panes": leaderboard_user_live_panes,
    "team_level_crossings_stream": team_level_crossings_stream,
    "spammy_users_stream": spammy_users_stream,
    "team_score_no_spam_stream": team_score_no_spam_stream,
    "session_mean_stream": session_mean_stream,
    "bio_stream_split": bio_stream_split,
    "bio_table": bio_table,
}

"""The whole-job functions (read text, run the pipeline, write outputs)."""

import glob

from pyspark.sql import functions as F

from rillet.model import (
    DebuggingWordCountOptions, GameStatsOptions, HourlyTeamScoreOptions, PersonOptions, StatefulTeamScoreOptions,
    UserScoreOptions, WindowedWordCountOptions, WordCountOptions,
)
from rillet.operators import abuse
from rillet.plans import jobs
from rillet.session import scratch_path
from rillet.sinks.table import stream_append
from rillet.streaming import leaderboard
from rillet.operators.scores import parse_game_events
from rillet.streaming.runner import run_available_now
from test_games import BAD, GOOD, LATER
from test_people import SAMPLE


def _input(spark, lines):
    path = scratch_path(spark, "job-input")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_word_count_jobs(spark):
    src = _input(spark, ["hi there", "hi", "hi sue bob", "hi sue", "", "bob hi"])
    out = scratch_path(spark, "wc")
    jobs.minimal_word_count(spark, WordCountOptions(src, out))
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["bob: 2", "hi: 5", "sue: 2", "there: 1"]
    metrics = jobs.word_count(spark, WordCountOptions(src, scratch_path(spark, "wc2")))
    assert metrics["n_blank"] == 1 and metrics["n_lines"] == 6 and metrics["max_len"] == 10


def test_debugging_word_count_checks_expected(spark):
    src = _input(spark, ["stomach secret Flourish message Flourish here Flourish"])
    opts = DebuggingWordCountOptions(src, "Flourish|stomach", (("Flourish", 3), ("stomach", 1)))
    assert jobs.debugging_word_count(spark, opts) == {"n_matched": 2, "n_unmatched": 3}
    bad = DebuggingWordCountOptions(src, "Flourish|stomach", (("Flourish", 2),))
    try:
        jobs.debugging_word_count(spark, bad)
        raise RuntimeError("expected a failed check")
    except AssertionError:
        pass


def test_windowed_word_count_job(spark):
    src = _input(spark, ["a b a", "c"])
    out = scratch_path(spark, "wwc").replace("file:", "")
    jobs.windowed_word_count(spark, WindowedWordCountOptions(src, out, 10, 0, 3_600_000, 2, seed=1))
    assert len(glob.glob(out + "/window_start=*/window_end=*")) >= 1
    assert sorted(r.value for r in spark.read.text(out).collect())[0].split(": ")[0] in {"a", "b", "c"}


def test_user_score_job_counts_parse_errors(spark):
    out = scratch_path(spark, "us")
    metrics = jobs.user_score(spark, UserScoreOptions(_input(spark, GOOD + BAD), out))
    assert metrics["n_errors"] == 2
    assert "total_score: 23, user: user7_AndroidGreenKookaburra" in [r.value for r in spark.read.text(out).collect()]


def test_hourly_team_score_job(spark):
    out = scratch_path(spark, "hts").replace("file:", "")
    jobs.hourly_team_score(spark, HourlyTeamScoreOptions(_input(spark, GOOD + LATER), out,
                                                         start_min="2015-11-19-10-00"))
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert len(lines) == 5 and lines[0].startswith("window_start: 2015-11-19 12:00:00.000, total_score: ")
    assert all(len(glob.glob(d + "/shard=*")) <= 3 for d in glob.glob(out + "/window_start=*/window_end=*"))


def test_game_stats_and_levels_jobs(spark):
    src = _input(spark, GOOD + LATER)
    out = scratch_path(spark, "gs")
    jobs.game_stats(spark, GameStatsOptions(src, out))
    assert spark.read.parquet(out + "/team_scores").count() > 0
    assert spark.read.parquet(out + "/session_means").count() == 2
    lv = scratch_path(spark, "lv")
    jobs.stateful_team_score(spark, StatefulTeamScoreOptions(src, lv, threshold=10))
    # BananaEmu totals 7, 24, 25 (same instant, line order): one crossing at 24
    assert [r.total_score for r in spark.read.parquet(lv).where("team = 'BananaEmu'").collect()] == [24]


def test_person_records_job(spark):
    out = scratch_path(spark, "people")
    jobs.person_records(spark, PersonOptions(_input(spark, SAMPLE), out))
    assert spark.read.text(out + "_invalid").count() == 2
    valid = [r.value for r in spark.read.text(out + "_valid").collect()]
    assert len(valid) == 16 and "Ivan, M, 13, 72, 175, true" in valid


def test_spammer_counter(spark):
    from test_abuse import PAIRS, _events
    sp, obs = abuse.observe_spammers(abuse.spammy_users(_events(spark, PAIRS), 60, 2.5))
    assert sp.count() == 2 and obs.get["n_spammers"] == 2


def test_one_stream_feeds_two_queries(spark):
    src = _input(spark, GOOD + LATER)
    ev = parse_game_events(spark.readStream.schema("value string").text(src))
    users_out, teams_out = scratch_path(spark, "t9u"), scratch_path(spark, "t9t")
    w1 = stream_append(leaderboard.user_totals(ev), None, users_out, scratch_path(spark, "ck"), "update")
    teams = leaderboard.team_totals(ev, 60, 120).select(F.unix_millis("window.start").alias("ws"), "team", "total_score")
    w2 = stream_append(teams, None, teams_out, scratch_path(spark, "ck"), "update")
    q1, q2 = w1.trigger(availableNow=True).start(), w2.trigger(availableNow=True).start()
    q1.awaitTermination()
    q2.awaitTermination()
    users = leaderboard.latest_updates(spark.read.parquet(users_out), ["user"])
    assert users.where("user = 'user18_BananaEmu'").first().total_score == 8
    assert leaderboard.latest_updates(spark.read.parquet(teams_out), ["ws", "team"]).count() == 11


def test_live_leader_board_job(spark):
    import time

    from rillet.model import LeaderBoardOptions

    src = scratch_path(spark, "lb-in")
    spark.createDataFrame([(x,) for x in GOOD + ["late,BananaEmu,5,1447965690000,x"]], "value string") \
        .coalesce(1).write.text(src)
    out = scratch_path(spark, "lb-out")
    query = jobs.leader_board_stream(spark, LeaderBoardOptions(src, out, user_minutes=0), trigger="200 milliseconds")
    try:
        deadline = time.time() + 90
        while time.time() < deadline:
            try:
                if spark.read.parquet(out + "/user_totals").count() >= 7:
                    break
            except Exception:  # noqa: BLE001 - nothing written yet
                pass
            time.sleep(0.5)
    finally:
        query.stop()
    users = spark.read.parquet(out + "/user_totals")
    assert set(users.columns) == {"user", "total_score", "processing_time", "batch_id"}
    assert users.where("user = 'user7_AndroidGreenKookaburra'").first().total_score == 23


def test_person_stream_jobs(spark):
    from rillet.operators.people import INVALID  # noqa: F401

    src = _input(spark, SAMPLE)
    out = scratch_path(spark, "ps")
    q = jobs.person_records_stream(spark, PersonOptions(src, out, "stream_table"), trigger="200 milliseconds")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(out).count() == 16
    out2 = scratch_path(spark, "ps2")
    q = jobs.person_records_stream(spark, PersonOptions(src, out2, "stream_topics"), trigger="200 milliseconds")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.text(out2 + "_invalid").count() == 2 and spark.read.text(out2 + "_valid").count() == 16


def _wait_rows(spark, path, n, seconds=90):
    import time

    deadline = time.time() + seconds
    while time.time() < deadline:
        try:
            if spark.read.parquet(path).count() >= n:
                return
        except Exception:  # noqa: BLE001 - nothing written yet
            pass
        time.sleep(0.5)


def test_live_level_crossings_job(spark):
    src = _input(spark, ["r,red,99,1,x,0", "r,red,1,2,x,1", "r,red,0,3,x,2", "r,red,100,4,x,3", "r,red,201,5,x,4"])
    out = scratch_path(spark, "lvl-live")
    q = jobs.stateful_team_score_stream(spark, StatefulTeamScoreOptions(src, out, 100), trigger="200 milliseconds")
    try:
        _wait_rows(spark, out, 3)
    finally:
        q.stop()
    got = sorted((r.event_id, r.total_score) for r in spark.read.parquet(out).collect())
    assert got == [(1, 100), (3, 200), (4, 401)]


def test_live_game_stats_job(spark):
    from test_abuse import PAIRS

    lines = [f"{u},t,{s},1000,x" for u, s in PAIRS] + ["marker,t,0,7200000,x"]   # pushes the watermark past hour 0
    src = _input(spark, lines)
    out = scratch_path(spark, "gs-live")
    q_spam, q_sess = jobs.game_stats_stream(spark, GameStatsOptions(src, out), trigger="200 milliseconds")
    try:
        _wait_rows(spark, out + "/spammers", 2)
    finally:
        q_spam.stop()
        q_sess.stop()
    assert sorted(r.user for r in spark.read.parquet(out + "/spammers").collect()) == ["Robot-1", "Robot-2"]


def test_cli_runs_a_job(spark, capsys):
    from rillet.cli import main

    src = _input(spark, ["stomach secret Flourish message Flourish here Flourish"])
    rc = main(["debugging_word_count", "--input", src, "--filter-pattern", "Flourish|stomach",
               "--expected", '[["Flourish", 3], ["stomach", 1]]'])
    assert rc == 0 and '"n_matched": 2' in capsys.readouterr().out
    assert main([]) == 2


def test_external_program_job(spark):
    from rillet.model import ExternalProgramOptions

    out = scratch_path(spark, "echo")
    jobs.external_program(spark, ExternalProgramOptions(out, n_rows=100))
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert lines == sorted(f"{i},{i}" for i in range(100))

"""Live jobs over restarts and late rows, pane steps on a stub state, and odd times in the batch keys."""

import json
import os
import subprocess
import sys
import types

import pandas as pd
import pytest

from conftest import ROOT, lines_df, rows
from rillet.functions.times import event_time_from_ms
from rillet.model import GameStatsOptions, PersonOptions, StatefulTeamScoreOptions
from rillet.operators import abuse, levels, people, scores, sessions
from rillet.plans import jobs
from rillet.session import ensure_checkpoint_dir, scratch_path
from rillet.sinks.table import stream_append
from rillet.streaming import gamestats, leaderboard
from rillet.streaming.runner import run_available_now

M = 60_000


def _add(spark, path, lines):
    lines_df(spark, lines).coalesce(1).write.mode("append").text(path)


def _settle(query, n=1):
    """Run until everything that is there is processed, then stop."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


# -- session -------------------------------------------------------------------------

def test_submitted_settings_stay():
    code = ("from rillet.session import build_session; s = build_session('local[1]');"
            "print('GOT', s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.adaptive.enabled'))")
    env = dict(os.environ, PYSPARK_SUBMIT_ARGS="--conf spark.sql.shuffle.partitions=777 "
               "--conf spark.sql.adaptive.enabled=false --conf spark.ui.enabled=false pyspark-shell")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, env=env, capture_output=True, text=True, timeout=120)
    assert "GOT 777 false" in out.stdout, out.stderr[-2000:]


@pytest.mark.parametrize("master, fails", [("spark://host:7077", True), ("yarn", True), ("local-cluster[2,1,1024]", True),
                                           ("local[4]", False)])
def test_a_cluster_needs_a_shared_folder(master, fails, tmp_path, monkeypatch):
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    conf = types.SimpleNamespace(get=lambda *a: None, set=lambda *a: None)
    context = types.SimpleNamespace(master=master, getConf=lambda: conf, getCheckpointDir=lambda: "set")
    stub = types.SimpleNamespace(conf=conf, sparkContext=context)
    if fails:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(stub)
    else:
        assert ensure_checkpoint_dir(stub).startswith(str(tmp_path))


# -- restarts ------------------------------------------------------------------------

LEVEL_LINES = [["r,red,99,1,x,0"], ["r,red,1,2,x,1", "r,red,0,3,x,2"], ["r,red,100,4,x,3"], ["r,red,201,5,x,4"]]


def test_level_job_goes_on_after_a_restart(spark):
    src, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    opts = StatefulTeamScoreOptions(src, out, 100, max_files_per_trigger=1)
    for k, lines in enumerate(LEVEL_LINES):
        _add(spark, src, lines)
        if k in (1, 3):
            _settle(jobs.stateful_team_score_stream(spark, opts, trigger="100 milliseconds"))
    _settle(jobs.stateful_team_score_stream(spark, opts, trigger="100 milliseconds"))      # nothing new
    got = spark.read.parquet(out)
    assert rows(got, "event_id", "total_score") == [(1, 100), (3, 200), (4, 401)]
    assert {"team", "processing_time"} <= set(got.columns)


def test_person_jobs_go_on_after_a_restart(spark):
    lines = [["Ann,  F,  17,  60,  170", "bad line"], ["Bob,  M,  40,  80,  180"]]
    src, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    for mode in ("stream_topics", "stream_table"):
        for k in (0, 1):
            if mode == "stream_topics":
                _add(spark, src, lines[k])
            _settle(jobs.person_records_stream(spark, PersonOptions(src, f"{out}_{mode}", mode), "100 milliseconds"))
    valid = rows(spark.read.text(f"{out}_stream_topics_valid"), "value")
    assert valid == [("Ann, F, 17, 60, 170, true",), ("Bob, M, 40, 80, 180, false",)]
    assert rows(spark.read.text(f"{out}_stream_topics_invalid"), "value") == [("bad line",)]
    assert spark.read.parquet(f"{out}_stream_table").count() == 2


def test_game_stats_job_goes_on_after_a_restart(spark):
    src, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    opts = GameStatsOptions(src, out)
    # the hour's rows arrive in two files with a restart between; the third closes the hour
    parts = [["a,red,1,1000,x", "b,red,1,2000,x", "c,blue,1,2500,x"], ["s,red,50,3000,x"], [f"z,z,0,{3 * 60 * M},x"]]
    for lines in parts:
        _add(spark, src, lines)
        for q in jobs.game_stats_stream(spark, opts, trigger="100 milliseconds"):
            _settle(q)
    spam = spark.read.parquet(f"{out}/spammers").where("ws = 0")
    assert rows(spam, "user", "total_score") == [("s", 50)]
    teams = spark.read.parquet(f"{out}/team_scores").where("ws = 0")
    assert rows(teams, "team", "total_score") == [("blue", 1), ("red", 2)]
    assert {"window_start", "processing_time"} <= set(teams.columns)


def test_event_time_from_a_message_attribute(spark):
    """A window is that of the attribute, not of the line's own time; a missing attribute falls back on the line."""
    src, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    far = 9 * 60 * M                                   # one bad payload time must not move the watermark
    said = [(f"a,red,1,{far},x", "1000"), ("b,red,1,2000,x", None), ("c,blue,1,5,x", "2500"), ("s,red,50,3000,x", "soon")]
    for messages in (said, [("z,z,0,0,x", str(3 * 60 * M))]):
        _add(spark, src, [json.dumps({"value": v, "attributes": {} if t is None else {"ts": t}}) for v, t in messages])
        for q in jobs.game_stats_stream(spark, GameStatsOptions(src, out, timestamp_attribute="ts"), trigger="100 milliseconds"):
            _settle(q)
    teams = spark.read.parquet(f"{out}/team_scores")
    assert rows(teams.where("ws = 0"), "team", "total_score") == [("blue", 1), ("red", 2)]
    assert rows(spark.read.parquet(f"{out}/spammers").where("ws = 0"), "user", "total_score") == [("s", 50)]


# -- lateness --------------------------------------------------------------------------

@pytest.mark.parametrize("delay, total", [("0 seconds", 1), ("7200 seconds", 8)])
def test_a_row_late_by_less_than_the_delay_counts(spark, delay, total):
    src, out, ck = (scratch_path(spark, k) for k in ("in", "out", "ck"))
    for lines in (["a,red,1,1000,x"], [f"b,red,1,{2 * 60 * M},x"], ["a,red,7,2000,x"], [f"z,red,1,{9 * 60 * M},x"]):
        _add(spark, src, lines)
        events = scores.parse_game_events(spark.readStream.schema("value string").text(src))
        run_available_now(stream_append(gamestats.window_user_team_sums(events, 60, delay), None, out, ck))
    assert rows(spark.read.parquet(out).where("ws = 0"), "user", "score_sum") == [("a", total)]


def test_session_means_agree_beyond_2100(spark):
    far = 4_200_000_000_000                                  # in 2103
    lines = ["a,red,1,1000,x", "a,red,1,61000,x", f"a,red,1,{far},x", f"b,red,1,{far + 120_000},x"]
    src, out, ck = (scratch_path(spark, k) for k in ("in", "out", "ck"))
    _add(spark, src, lines)
    from rillet.functions.times import display_time
    from rillet.plans.streams import _run_to_end

    def writer(stream, mark):
        return stream_append(gamestats.session_mean_stream(scores.parse_game_events(stream), 5, 30, without_user=mark),
                             None, out, ck)

    _run_to_end(spark, src, writer)
    got = spark.read.parquet(out)
    batch = sessions.session_mean(scores.parse_game_events(lines_df(spark, lines)), 5, 30)
    assert rows(got.select(display_time(got.ws).alias("window_start"), "mean_duration")) == rows(batch)
    assert batch.count() == 2


# -- pane steps ------------------------------------------------------------------------

class State:
    """What the step function uses of a group state."""

    def __init__(self):
        self.get, self.p, self.w = None, 0, 0

    exists = property(lambda self: self.get is not None)
    getCurrentProcessingTimeMs = lambda self: self.p            # noqa: E731
    getCurrentWatermarkMs = lambda self: self.w                 # noqa: E731
    setTimeoutDuration = lambda self, ms: None                  # noqa: E731

    def update(self, value):
        self.get = value

    def remove(self):
        self.get = None


def _visit(state, p, w, *scores_):
    state.p, state.w = p * M, w * M
    frames = iter([pd.DataFrame({"score": list(scores_)})] if scores_ else [])
    got = leaderboard.pane_step(60 * M, (120 * M, 5 * M, 10 * M), frames, state, 1)
    return [(timing, total) for timing, total, _ in got]


def test_a_row_beyond_the_lateness_emits_nothing():
    s = State()
    assert _visit(s, 0, 180, 5) == [] and _visit(s, 1, 200, 5) == [] and s.get is None


def test_a_late_first_row_emits_its_sum_once():
    s = State()
    assert _visit(s, 0, 70, 3, 4) == [("ON_TIME", 7)]
    assert _visit(s, 11, 70) == [] and _visit(s, 12, 180) == [] and s.get is None


def test_early_on_time_and_late_panes():
    s = State()
    assert _visit(s, 0, 0, 1, 2) == []
    assert _visit(s, 5, 0) == [("EARLY", 3)]
    assert _visit(s, 6, 10, 4) == []
    assert _visit(s, 7, 60) == [("ON_TIME", 7)]
    assert _visit(s, 8, 61, 5) == [] and _visit(s, 9, 62, 1) == []
    assert _visit(s, 18, 63) == [("LATE", 13)]
    assert _visit(s, 19, 64, 2) == [] and _visit(s, 20, 180) == [("LATE", 15)] and s.get is None


# -- odd times ---------------------------------------------------------------------------

ODD = ["a,red,5,1447955630000,x", "b,red,7,999999999999999999,x", "b,blue,2,-999999999999999999,x"]


def test_a_huge_timestamp_keeps_its_row(spark):
    events = scores.parse_game_events(lines_df(spark, ODD))
    assert rows(scores.sum_scores(events, "user")) == [("a", 5), ("b", 9)]
    far = 999999999999999999 - 999999999999999999 % (60 * M)
    assert rows(scores.windowed_team_score(events, 60), "team", "window_start", "total_score")[-1] == ("red", str(far), 7)
    assert scores.windowed_team_score(events, 60).count() == 3
    assert events.where(event_time_from_ms(events.timestamp_ms).isNull()).count() == 2
    assert abuse.team_score_without_spammers(events, 60, 2.5).count() == 3
    assert abuse.spammy_users(events, 60, 0.5).count() == 3          # each alone in its window: above half its mean
    assert sessions.user_sessions(events, 5).count() == 3 and sessions.session_mean(events, 5, 30).count() == 3
    ids = scores.parse_game_events(lines_df(spark, ODD).selectExpr("value", "1L event_id"), keep=("event_id",))
    assert rows(levels.windowed_level_crossings(ids, 60, 4), "total_score") == [(5,), (7,)]
    assert rows(levels.level_crossings(ids, 4), "total_score") == [(5,), (12,)]   # red: 5, then 12; blue stays at 2


def test_valid_topic_holds_rendered_people(spark):
    lines = lines_df(spark, ["Ann,  F,  17,  60,  170"])
    assert rows(people.people_text(people.valid_people(lines)), "line") == [("Ann, F, 17, 60, 170, true",)]


def test_a_batch_job_leaves_no_intermediates(tmp_path):
    (tmp_path / "in").write_text("Ann,  F,  17,  60,  170\nbad line\n")
    env = dict(os.environ, PYSPARK_SUBMIT_ARGS=f"--conf spark.checkpoint.dir={tmp_path}/ckpt --conf spark.ui.enabled=false pyspark-shell")
    done = subprocess.run([sys.executable, "-m", "rillet", "person_records", "--master", "local[1]", "--input", str(tmp_path / "in"),
                           "--output", str(tmp_path / "out")], cwd=ROOT, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    assert (tmp_path / "out_valid" / "_SUCCESS").exists()
    assert not list((tmp_path / "ckpt" / "rillet").rglob("*.parquet"))


def test_window_folders_are_named_in_local_time(spark, tmp_path):
    from rillet.model import HourlyTeamScoreOptions

    src = scratch_path(spark, "in")
    _add(spark, src, ["a,red,5,1447955630000,x"])             # 2015-11-19 09:53:50 in Los Angeles
    jobs.hourly_team_score(spark, HourlyTeamScoreOptions(src, str(tmp_path / "out")))
    assert [p.name for p in (tmp_path / "out").glob("window_start=*")] == ["window_start=2015-11-19T09-00-00"]

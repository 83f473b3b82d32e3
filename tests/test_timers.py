"""Leader board timers: user deadlines in processing time, window ends in event time, over restarts."""

import glob
import os
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import lines_df, rows
from rillet.model import LeaderBoardOptions
from rillet.operators.scores import parse_game_events
from rillet.plans import jobs
from rillet.session import scratch_path
from rillet.sinks.table import stream_append
from rillet.streaming import leaderboard
from rillet.streaming.runner import run_available_now

M = 60_000


class State:
    """What the step functions use of a group state, with the timer that was set last."""

    def __init__(self):
        self.get, self.p, self.w, self.timer = None, 0, 0, None

    exists = property(lambda self: self.get is not None)

    def getCurrentProcessingTimeMs(self):
        return self.p

    def getCurrentWatermarkMs(self):
        return self.w

    def setTimeoutDuration(self, ms):
        assert ms > 0
        self.timer = self.p + ms

    def setTimeoutTimestamp(self, ms):
        assert ms > self.w
        self.timer = ms

    def update(self, value):
        self.get, self.timer = value, None

    def remove(self):
        self.get = self.timer = None


def frames(*scores):
    return iter([pd.DataFrame({"score": list(scores)})] if scores else [])


# -- users ---------------------------------------------------------------------------

def visit_user(state, p, *scores, delay=10):
    state.p = p * M
    fired = leaderboard.user_step(delay * M, frames(*scores), state)
    return None if fired is None else fired[0]


def test_a_user_fires_at_its_own_deadline():
    s = State()
    assert visit_user(s, 3, 5) is None and s.timer == 13 * M
    assert visit_user(s, 7, 1, 2) is None and s.timer == 13 * M          # later rows don't move it
    assert visit_user(s, 13) == 8 and s.timer is None                    # told: nothing is due any more
    assert visit_user(s, 40, 4) is None and s.timer == 50 * M
    assert visit_user(s, 55) == 12 and s.timer is None


def test_a_visit_fires_once_and_its_rows_start_the_next_deadline():
    s = State()
    visit_user(s, 0, 1)
    assert visit_user(s, 12, 100) == 1 and s.timer == 22 * M
    assert visit_user(s, 22) == 101
    s = State()
    assert [visit_user(s, k, 1, delay=0) for k in range(3)] == [1, 2, 3] and s.timer is None


def add(spark, path, lines):
    lines_df(spark, lines).coalesce(1).write.mode("append").text(path)


def read(spark, path, n, seconds=90):
    """The rows of a growing Parquet folder once there are ``n``."""
    end = time.time() + seconds
    while True:
        try:
            got = spark.read.parquet(path)
            if got.count() >= n or time.time() > end:
                return got
        except Exception:  # noqa: BLE001 - no file yet
            if time.time() > end:
                raise
        time.sleep(0.3)


def test_user_deadlines_go_on_over_a_restart(spark):
    src, out, ck = (scratch_path(spark, k) for k in ("in", "out", "ck"))

    def start():
        lines = spark.readStream.schema("value string").text(src)
        return stream_append(leaderboard.user_panes(parse_game_events(lines), 15 / 60), None, out, ck) \
            .trigger(processingTime="200 milliseconds").start()

    add(spark, src, ["a,red,1,1000,x", "a,red,2,2000,x", "b,red,5,1000,x"])
    q = start()
    try:
        end = time.time() + 30                                # the rows are in the state, nothing is due yet
        while time.time() < end and not any(p["numInputRows"] for p in q.recentProgress):
            time.sleep(0.1)
    finally:
        q.stop()
    add(spark, src, ["a,red,10,3000,x"])
    q = start()
    try:
        got = read(spark, out, 2)
        assert rows(got, "user", "total_score") == [("a", 13), ("b", 5)]          # once each, with the row from after
        time.sleep(2)
        assert spark.read.parquet(out).count() == 2                               # silence fires nothing
        add(spark, src, ["b,red,1,9000,x"])
        assert rows(read(spark, out, 3), "user", "total_score") == [("a", 13), ("b", 5), ("b", 6)]
        first, again = (r.processing_ms for r in spark.read.parquet(out).where("user = 'b'").orderBy("processing_ms").collect())
        assert again - first >= 15_000
    finally:
        q.stop()


def test_the_job_waits_for_the_deadline(spark):
    src, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    add(spark, src, ["a,red,1,1000,x"])
    query = jobs.leader_board_stream(spark, LeaderBoardOptions(src, out), trigger="200 milliseconds")
    try:
        end = time.time() + 30
        while time.time() < end and not any(p["numInputRows"] for p in query.recentProgress):
            time.sleep(0.1)
        time.sleep(1)
        assert spark.read.schema("user string").option("recursiveFileLookup", "true").parquet(f"{out}/user_totals").count() == 0
    finally:
        query.stop()

def test_both_boards_from_one_reading(spark):
    """Input rows are counted once, and a micro-batch that runs again writes both outputs once."""
    src, out, ck = (scratch_path(spark, k) for k in ("in", "out", "ck"))
    t = 6000 * M

    def run():
        """One micro-batch: the next would come in an hour."""
        lines = spark.readStream.schema("value string").text(src)
        board = leaderboard.leader_board(parse_game_events(lines), 60, 120, 0, 0, 0, poll_ms=100)
        q = leaderboard.board_outputs(board, f"{out}/teams", f"{out}/users", ck).trigger(processingTime="1 hour").start()
        try:
            end = time.time() + 60
            while not q.recentProgress and q.isActive and time.time() < end:
                time.sleep(0.1)
            return [p["numInputRows"] for p in q.recentProgress]
        finally:
            q.stop()

    add(spark, src, [f"a,red,1,{t},x", f"b,red,2,{t},x", "no line"])
    assert run() == [3]
    add(spark, src, [f"a,blue,4,{t + 61 * M},x"])
    assert run() == [1]
    commits = [p for p in glob.glob(f"{ck}/commits/*") if os.path.basename(p).isdigit()]
    for p in (last := max(commits, key=lambda p: int(os.path.basename(p))), f"{ck}/commits/.{os.path.basename(last)}.crc"):
        if os.path.exists(p):
            os.remove(p)                                   # the query was killed before its commit
    run()
    add(spark, src, [f"z,zz,0,{t + 61 * M},x"])
    run()                                                  # the watermark is at red's end now
    users = spark.read.parquet(f"{out}/users").orderBy("batch_id")
    assert [(r.user, r.total_score) for r in users.where("user = 'a'").collect()] == [("a", 1), ("a", 5)]
    assert rows(users.where("user = 'b'"), "total_score") == [(2,)]
    teams = spark.read.parquet(f"{out}/teams").orderBy("batch_id")
    assert [(r.timing, r.total_score) for r in teams.where("team = 'red'").collect()] == [("EARLY", 3), ("ON_TIME", 3)]
    assert rows(teams.where("team = 'blue'"), "timing", "total_score") == [("EARLY", 4)]




# -- windows -------------------------------------------------------------------------

SLACK = 180 * M


def visit(state, p, w, *scores):
    """A visit at processing minute ``p``; the greatest event time before it is at minute ``w``."""
    state.p, state.w = p * M, max(0, w * M - SLACK)
    got = leaderboard.pane_step(600 * M, (120 * M, 5 * M, 10 * M), frames(*scores), state, None, SLACK)
    return [(timing, total) for timing, total, _ in got]


def test_event_time_timers_stand_at_the_end_and_at_the_close():
    s = State()
    assert visit(s, 0, 500, 1) == [] and s.timer == 600 * M - SLACK - 1
    assert visit(s, 6, 550, 2) == [("EARLY", 1)] and s.timer == 600 * M - SLACK - 1
    assert visit(s, 7, 600) == [("ON_TIME", 3)] and s.timer == 720 * M - SLACK - 1
    assert visit(s, 8, 640, 4) == []
    assert visit(s, 9, 720) == [("LATE", 7)] and s.get is None
    assert visit(s, 10, 720, 9) == [] and s.get is None


@pytest.mark.parametrize("minute, counts", [(1, True), (719, True), (720, False), (900, False)])
def test_rows_are_late_by_their_window(spark, minute, counts):
    """A row is dropped once the greatest event time is at its window's end plus the lateness, whatever its own time."""
    src, out, ck = (scratch_path(spark, k) for k in ("in", "out", "ck"))
    # the last row is of the window from minute 540 to 600, one millisecond after its start
    parts = [[f"z,zz,0,{541 * M},x"], [f"z,zz,0,{max(minute, 541) * M},x"], [f"a,red,7,{540 * M + 1},x"]]
    for lines in parts:
        add(spark, src, lines)
        events = parse_game_events(spark.readStream.schema("value string").text(src))
        run_available_now(stream_append(leaderboard.team_panes(events, 60, 120, 0, 0, poll_ms=None), None, out, ck))
    red = spark.read.parquet(out).where("team = 'red'")
    assert rows(red, "total_score") == ([(7,)] if counts else [])


def test_panes_of_parts_end_with_available_now(spark):
    src, out, ck = (scratch_path(spark, k) for k in ("in", "out", "ck"))
    t = 6000 * M
    parts = [[f"a,red,1,{t},x", f"a,red,2,{t + 1000},x"], [f"a,red,3,{t + 59 * M},x", f"b,blue,1,{t + 61 * M},x"],
             [f"a,red,4,{t + 5},x"], [f"z,zz,0,{t + 181 * M},x"], [f"a,red,5,{t + 6},x"]]
    for lines in parts:
        add(spark, src, lines)
        events = parse_game_events(spark.readStream.schema("value string").text(src))
        run_available_now(stream_append(leaderboard.team_panes(events, 60, 120, 0, 0, poll_ms=None), None, out, ck))
    red = spark.read.parquet(out).where("team = 'red'").orderBy("batch_id")
    assert [(r.timing, r.total_score) for r in red.collect()] == [
        ("EARLY", 3), ("EARLY", 6), ("ON_TIME", 6), ("LATE", 10)]           # the last row is beyond the lateness


# -- levels --------------------------------------------------------------------------

def test_level_totals_go_on_from_batch_to_batch_and_repeat_once(spark):
    from rillet.streaming import levels

    src, out, totals, ck = (scratch_path(spark, k) for k in ("in", "out", "totals", "ck"))

    def run():
        lines = spark.readStream.schema("value string").text(src)
        events = parse_game_events(lines.withColumn("event_id", F.element_at(F.split("value", ","), -1).try_cast("bigint")),
                                   keep=("event_id",))
        run_available_now(levels.crossings_sink(events, out, totals, ck, 100, chunk_ms=1000, target_rows=20))

    rng = random.Random(4)
    parts = [[("hot" if rng.random() < 0.8 else f"t{rng.randrange(3)}", rng.randrange(-20, 60), rng.choice([0, 0, 0, 1, 2500, 9000]), i)
              for i in range(k * 200, k * 200 + 200)] for k in range(3)]            # most of a team's rows at one instant
    parts.insert(2, [])
    for part in parts:
        add(spark, src, [f"u,{team},{score},{ms},{i}" for team, score, ms, i in part] or ["no line"])
        run()
    commits = [p for p in glob.glob(f"{ck}/commits/*") if os.path.basename(p).isdigit()]
    last = max(commits, key=lambda p: int(os.path.basename(p)))
    for p in (last, f"{ck}/commits/.{os.path.basename(last)}.crc"):
        if os.path.exists(p):
            os.remove(p)
    run()
    want, held = [], {}
    for part in parts:
        for team, score, ms, i in sorted(part, key=lambda x: (x[2], x[3])):
            old = held.get(team, 0)
            held[team] = old + score
            if int(old / 100) < int(held[team] / 100):
                want.append((i, held[team], team))
    assert rows(spark.read.parquet(out), "event_id", "total_score", "team") == sorted(want) and len(want) > 20

import random

import pytest
from pyspark.sql import functions as F

from rillet.operators.panes import INF, PaneMachine, replay_panes, run_script, user_panes

M = 60_000
W, L = 20 * M, 60 * M


def ev(team, s, t=0):
    return ("event", team, t, s)


def wm(x):
    return ("watermark", x)


def clk(x):
    return ("clock", x)


def fired(steps, window=W, lateness=L, early=5 * M, late=10 * M):
    return sorted((k, timing, total) for k, _, timing, total in run_script(steps, window, lateness, early, late))


def test_on_time():
    s = [wm(0), ev("blue", 3), ev("blue", 2), ev("red", 3), ev("blue", 5), wm(3 * M), ev("red", 1),
         ev("blue", 2), wm(INF)]
    assert fired(s) == [("blue", "ON_TIME", 12), ("red", "ON_TIME", 4)]


def test_early_panes():
    s = [wm(0), ev("blue", 3), ev("blue", 2), clk(10 * M), ev("red", 5), clk(12 * M), ev("blue", 3),
         clk(10 * M), ev("red", 4), ev("blue", 2), wm(INF)]
    assert fired(s) == sorted([("blue", "EARLY", 5), ("red", "EARLY", 5), ("blue", "EARLY", 8),
                               ("blue", "ON_TIME", 10), ("red", "ON_TIME", 9)])


def test_late_but_not_observable():
    s = [wm(0), ev("blue", 3), ev("blue", 5), ev("red", 4), ev("blue", 3), wm(19 * M), ev("red", 2),
         ev("red", 5), ev("blue", 2), ev("red", 3), wm(21 * M), wm(INF)]
    assert fired(s) == [("blue", "ON_TIME", 13), ("red", "ON_TIME", 14)]


def test_late_observable():
    s = [wm(0), ev("blue", 3), ev("blue", 5), clk(10 * M), wm(3 * M), ev("red", 3), ev("red", 4),
         ev("blue", 3), wm(79 * M), ev("red", 2), ev("red", 5), ev("red", 3), clk(12 * M), ev("red", 9),
         ev("red", 1), wm(INF)]
    out = run_script(s, W, L, 5 * M, 10 * M)
    assert ("red", 0, "ON_TIME", 7) in out and ("blue", 0, "ON_TIME", 11) in out
    assert out[-1] == ("red", 0, "LATE", 27)
    assert fired(s) == sorted([("blue", "EARLY", 8), ("blue", "ON_TIME", 11), ("red", "ON_TIME", 7),
                               ("red", "LATE", 17), ("red", "LATE", 27)])


def test_dropped_after_lateness():
    s = [ev("blue", 12), ev("red", 3), wm(20 * M - 1), ev("red", 4), ev("blue", 3), ev("blue", 3), wm(20 * M),
         wm(81 * M), ev("blue", 3), ev("red", 7), wm(INF)]
    assert fired(s) == [("blue", "ON_TIME", 18), ("red", "ON_TIME", 7)]


def test_users_global_window():
    s = [ev("navy", 12), ev("scarlet", 3), clk(7 * M), ev("scarlet", 4), ev("sky", 3), ev("navy", 3),
         clk(5 * M), wm(13 * 60 * M), ev("scarlet", 3), ev("scarlet", 2), clk(6 * M), ev("sky", 5), clk(20 * M),
         wm(INF)]
    assert fired(s, window=None, lateness=0, early=10 * M, late=10 * M) == sorted([
        ("navy", "EARLY", 15), ("scarlet", "EARLY", 7), ("scarlet", "EARLY", 12), ("sky", "EARLY", 3),
        ("sky", "EARLY", 8)])


def brute_replay(data, window_ms, lateness_ms, early_min, late_min):
    """Minute-by-minute simulation over every tick (no clock table, no skipping)."""
    by_minute = {}
    for team, score, t, arr in data:
        by_minute.setdefault(arr // M, []).append((team, score, t))
    first, last = min(by_minute), max(by_minute)
    machines, out = {}, []
    w = -INF
    for tick in range(first, last + 2):
        wt = INF if tick == last + 1 else w                  # input ends: watermark to +inf
        for key, m in machines.items():
            n = len(m.panes)
            m.watermark(wt, tick)
            m.clock(tick)
            out += [(key[0], key[1], timing, total) for timing, total, _ in m.panes[n:]]
        for team, score, t in by_minute.get(tick, []):
            ws = (t // window_ms) * window_ms
            key = (team, ws)
            # ticks are minutes; the machine compares watermarks in ms against E in ms
            m = machines.get(key)
            if m is None:
                if wt >= ws + window_ms + lateness_ms:
                    continue
                m = machines[key] = _MinuteMachine(ws + window_ms, lateness_ms, early_min, late_min)
            m.element(score, tick, wt)
        for team, score, t in by_minute.get(tick, []):
            w = max(w, t)
    return sorted(out)


class _MinuteMachine(PaneMachine):
    """PaneMachine with watermarks in ms and the clock in minutes."""

    def clock(self, p):
        if self.closed or not self.pending:
            return
        d = self.late_delay if self.on_time_fired else self.early_delay
        if p >= self.pending_since + d:
            self._fire("LATE" if self.on_time_fired else "EARLY", p)

    def watermark(self, w, p):
        if self.closed:
            return
        if not self.on_time_fired and w >= self.window_end:
            self.on_time_fired = True
            self._fire("ON_TIME", p)
        if w >= self.window_end + self.lateness:
            if self.pending:
                self._fire("LATE", p)
            self.closed = True


@pytest.mark.parametrize("seed", [1, 2])
def test_replay_matches_minute_simulation(spark, seed):
    rnd = random.Random(seed)
    data = []
    for i in range(700):
        t = rnd.randint(0, 12 * 60) * M + rnd.randint(0, M - 1)
        delay = rnd.choice([0, 0, 0, 2 * M, 10 * M, 3 * 60 * M])
        data.append((rnd.choice(["red", "blue", "hot", "hot", "hot"]), rnd.randint(0, 20), t, t + delay))
    df = spark.createDataFrame(data, "team string, score int, timestamp_ms long, arrival_ms long")
    got = sorted((r.team, r.ws, r.timing, r.total_score) for r in
                 replay_panes(df, window_minutes=60, lateness_minutes=120, early_minutes=5, late_minutes=10).collect())
    assert got == brute_replay(data, 60 * M, 120 * M, 5, 10)


def test_global_window_replay_matches_simulation(spark):
    from rillet.operators.panes import user_panes

    rnd = random.Random(5)
    data = []
    for _ in range(400):
        t = rnd.randint(0, 6 * 60) * M + rnd.randint(0, M - 1)
        data.append((rnd.choice(["navy", "sky", "hot", "hot"]), rnd.randint(0, 20), t, t + rnd.choice([0, 0, 7 * M])))
    df = spark.createDataFrame(data, "user string, score int, timestamp_ms long, arrival_ms long")
    got = sorted((r.user, r.pane_index, r.timing, r.total_score) for r in user_panes(df, 10).collect())
    # brute force: every minute, fire users whose first pending element is 10+ minutes old, then add arrivals
    by_minute = {}
    for u, s, _, arr in data:
        by_minute.setdefault(arr // M, []).append((u, s))
    state, out = {}, []
    for tick in range(min(by_minute), max(by_minute) + 12):
        for u, st in sorted(state.items()):
            if st["pending"] and tick >= st["since"] + 10:
                out.append((u, st["n"], "EARLY", st["total"]))
                st["n"] += 1
                st["pending"] = False
        for u, s in by_minute.get(tick, []):
            st = state.setdefault(u, {"total": 0, "pending": False, "since": 0, "n": 0})
            st["total"] += s
            if not st["pending"]:
                st["pending"], st["since"] = True, tick
    assert got == sorted(out)
    assert all(timing == "EARLY" for _, _, timing, _ in got)


def test_replay_with_outlier_event_time(spark):
    # one corrupt far-future event time (arriving on time) must not blow up the
    # clock and closes every window after its minute, as the rule says
    rnd = random.Random(11)
    data = []
    for _ in range(300):
        t = rnd.randint(0, 4 * 60) * M + rnd.randint(0, M - 1)
        data.append((rnd.choice(["red", "blue"]), rnd.randint(0, 20), t, t + rnd.choice([0, 3 * M])))
    data.append(("red", 1, 10 ** 13, 120 * M))
    df = spark.createDataFrame(data, "team string, score int, timestamp_ms long, arrival_ms long")
    got = sorted((r.team, r.ws, r.timing, r.total_score) for r in
                 replay_panes(df, window_minutes=60, lateness_minutes=120, early_minutes=5, late_minutes=10).collect())
    assert got == brute_replay(data, 60 * M, 120 * M, 5, 10)


def test_replay_with_lateness_not_a_multiple_of_the_window(spark):
    rnd = random.Random(23)
    data = []
    for _ in range(500):
        t = rnd.randint(0, 8 * 60) * M + rnd.randint(0, M - 1)
        data.append((rnd.choice(["red", "blue", "hot", "hot"]), rnd.randint(0, 20), t,
                     t + rnd.choice([0, 0, 4 * M, 50 * M, 100 * M])))
    df = spark.createDataFrame(data, "team string, score int, timestamp_ms long, arrival_ms long")
    got = sorted((r.team, r.ws, r.timing, r.total_score) for r in
                 replay_panes(df, window_minutes=60, lateness_minutes=90, early_minutes=5, late_minutes=10).collect())
    assert got == brute_replay(data, 60 * M, 90 * M, 5, 10)


def test_replay_groups_cut_by_arrow_batches(spark):
    # tiny Arrow batches cut most groups across batches: the carry must glue them
    rnd = random.Random(31)
    data = []
    for _ in range(400):
        t = rnd.randint(0, 5 * 60) * M + rnd.randint(0, M - 1)
        data.append((rnd.choice(["red", "blue", "hot"]), rnd.randint(0, 20), t, t + rnd.choice([0, 2 * M, 30 * M])))
    df = spark.createDataFrame(data, "team string, score int, timestamp_ms long, arrival_ms long")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        got = sorted((r.team, r.ws, r.timing, r.total_score) for r in
                     replay_panes(df, window_minutes=60, lateness_minutes=120, early_minutes=5,
                                  late_minutes=10).collect())
    finally:
        spark.conf.set(key, old)
    assert got == brute_replay(data, 60 * M, 120 * M, 5, 10)


def test_replay_does_not_depend_on_arrow_batches(spark):
    """Groups cut by batch ends, one batch inside a group, and many groups in one batch."""
    rows = [(u, s, (m * 60 + s) * 1000, (m * 60 + s) * 1000) for u in ("a", "b", "c") for m in range(0, 90, 3) for s in (1, 2)]
    events = spark.createDataFrame(rows, "user string, score long, timestamp_ms long, arrival_ms long").coalesce(1)
    whole = sorted(tuple(r) for r in user_panes(events).collect())
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    try:
        for size in (1, 7, 31):
            spark.conf.set(name, str(size))
            assert sorted(tuple(r) for r in user_panes(events).collect()) == whole
    finally:
        spark.conf.set(name, old)
    assert len(whole) > 15

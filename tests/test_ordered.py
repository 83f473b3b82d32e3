import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from rillet.operators import levels, ordered, sessions

M = 60_000


def _events(spark, data):
    df = spark.createDataFrame(data, "user string, timestamp_ms long")
    return df.withColumn("event_time", F.timestamp_millis("timestamp_ms"))


def _brute_sessions(data, gap):
    out = []
    by = {}
    for u, t in data:
        by.setdefault(u, []).append(t)
    for u, ts in by.items():
        ts.sort()
        start, last, n = ts[0], ts[0], 1
        for t in ts[1:]:
            if t - last >= gap:
                out.append((u, start, last + gap, n))
                start, n = t, 0
            last, n = t, n + 1
        out.append((u, start, last + gap, n))
    return sorted(out)


def test_touching_intervals_stay_apart(spark):
    s = sessions.sessions(_events(spark, [("u", 0), ("u", 5 * M), ("u", 9 * M)]), 5)
    assert rows(s, "start_ms", "end_ms", "minutes", "n_events") == [(0, 5 * M, 5, 1), (5 * M, 14 * M, 9, 2)]


@pytest.mark.parametrize("chunk_ms", [M, 7 * M, 10 * M])
def test_chunked_sessions_match_brute_force(spark, chunk_ms):
    rnd = random.Random(7)
    data = []
    for u in ("hot", "a", "b"):
        t = 0
        for _ in range(300 if u == "hot" else 40):
            t += rnd.choice([0, 1_000, 30_000, 4 * M, 5 * M, 5 * M - 1, 6 * M, 40 * M])
            data.append((u, t))
    got = rows(sessions.sessions(_events(spark, data), 5, chunk_ms=chunk_ms), "user", "start_ms", "end_ms", "n_events")
    assert got == _brute_sessions(data, 5 * M)


def test_session_mean_uses_end_minus_one_ms(spark):
    # session [0, 30 min) ends exactly on the boundary: it belongs to the first window
    ev = _events(spark, [("u", 0), ("u", 2 * M), ("u", 4 * M), ("u", 20 * M), ("u", 25 * M),
                         ("v", 31 * M), ("v", 33 * M)])
    got = rows(sessions.session_mean(ev, 5, 30), "window_start", "mean_duration")
    assert got == [("1969-12-31 16:00:00.000", 19 / 3), ("1969-12-31 16:30:00.000", 7.0)]


def _lv(spark, data):
    df = spark.createDataFrame([(tm, i, t, s) for i, (tm, s, t) in enumerate(data)],
                               "team string, event_id long, timestamp_ms long, score int")
    return df.withColumn("event_time", F.timestamp_millis("timestamp_ms"))


def test_level_crossings_one_team(spark):
    ev = _lv(spark, [("red", 99, 1), ("red", 1, 2), ("red", 0, 3), ("red", 100, 4), ("red", 201, 5)])
    assert rows(levels.level_crossings(ev, 100), "team", "total_score") == [("red", 100), ("red", 200), ("red", 401)]


def test_level_crossings_two_teams(spark):
    ev = _lv(spark, [("red", 50, 1), ("blue", 70, 2), ("red", 50, 3), ("blue", 80, 4), ("blue", 50, 5)])
    assert rows(levels.level_crossings(ev, 100), "team", "total_score") == [
        ("blue", 150), ("blue", 200), ("red", 100)]


def test_level_crossings_per_window(spark):
    ev = _lv(spark, [("red", 50, 1 * M), ("red", 50, 2 * M), ("red", 50, 3 * M), ("red", 60, 6 * M),
                     ("red", 60, 7 * M)])
    out = levels.windowed_level_crossings(ev, 5, 100)
    assert rows(out, "window_start", "total_score") == [
        ("1969-12-31 16:00:00.000", 100), ("1969-12-31 16:05:00.000", 120)]


@pytest.mark.parametrize("chunk_ms", [1_000, 13_000])
def test_chunked_running_sum_matches_brute_force(spark, chunk_ms):
    rnd = random.Random(3)
    data = [("hot" if rnd.random() < 0.6 else "cold", rnd.randint(0, 40), rnd.randint(0, 60_000))
            for _ in range(600)]
    ev = _lv(spark, data)
    got = rows(ordered.running_sum(ev, ["team"], ["timestamp_ms", "event_id"], "score", "timestamp_ms",
                                   "total", chunk_ms), "event_id", "total")
    want, acc = [], {}
    for i, (tm, s, t) in sorted(enumerate(data), key=lambda x: (x[1][2], x[0])):
        acc[tm] = acc.get(tm, 0) + s
        want.append((i, acc[tm]))
    assert got == sorted(want)


@pytest.mark.parametrize("target", [3, 17])
def test_heavy_cells_are_split_and_stay_exact(spark, target):
    rnd = random.Random(target)
    data = []
    for u in ("hot", "a"):
        t = 0
        for _ in range(400 if u == "hot" else 30):
            t += rnd.choice([0, 1, 1_000, 20_000, 5 * M, 6 * M])
            data.append((u, t))
    ev = _events(spark, data)
    tagged = ordered.session_starts(ev.select("user", "timestamp_ms"), ["user"], "timestamp_ms", 5 * M,
                                    chunk_ms=60 * M, target_rows=target)
    got = rows(tagged.groupBy("user", "session_start").agg(
        F.max("timestamp_ms").alias("last"), F.count(F.lit(1)).alias("n")), "user", "session_start", "last", "n")
    want = [(u, s, e - 5 * M, n) for u, s, e, n in _brute_sessions(data, 5 * M)]
    assert got == want
    # and the running sum, on the same kind of hot data
    lv = _lv(spark, [("hot" if i % 5 else "cold", i % 7, t) for i, (_, t) in enumerate(data)])
    got_sum = rows(ordered.running_sum(lv, ["team"], ["timestamp_ms", "event_id"], "score", "timestamp_ms",
                                       "total", 60 * M, target), "event_id", "total")
    acc, want_sum = {}, []
    for i, (_, t) in sorted(enumerate(data), key=lambda x: (x[1][1], x[0])):
        tm = "hot" if i % 5 else "cold"
        acc[tm] = acc.get(tm, 0) + i % 7
        want_sum.append((i, acc[tm]))
    assert got_sum == sorted(want_sum)


def test_heavy_cell_chunk_ids_grow_with_time(spark):
    ev = _events(spark, [("hot", t * 1000) for t in range(100)])
    x = ordered._with_chunks(ev, ["user"], "timestamp_ms", 60 * M, 10)
    ids = [r._chunk for r in x.orderBy("timestamp_ms").collect()]
    assert ids == sorted(ids) and len(set(ids)) == 10


def test_hot_key_inside_one_hour_is_spread_over_balanced_chunks(spark):
    # one user holds 30,000 of 30,300 rows, all within ten minutes of one hour cell
    rnd = random.Random(9)
    data = [("hot", rnd.randint(0, 10 * M)) for _ in range(30_000)] + [("cold", rnd.randint(0, 60 * M)) for _ in range(300)]
    ev = _events(spark, data)
    x = ordered._with_chunks(ev, ["user"], "timestamp_ms", 60 * M, 1_000)
    sizes = [r["count"] for r in x.where("user = 'hot'").groupBy("_chunk").count().collect()]
    assert len(sizes) >= 25 and max(sizes) <= 2_000
    cold = x.where("user = 'cold'").select("_chunk").distinct().count()
    assert cold == 1                                     # light cells are not cut


def test_running_sum_cuts_a_same_instant_burst_by_id(spark):
    # 3,000 events of one team at one millisecond: cut by event id, still exact
    data = [("hot", (i * 7) % 13, 5_000) for i in range(3_000)] + [("hot", 1, 5_001), ("cold", 2, 5_000)]
    lv = _lv(spark, data)
    x = ordered._with_chunks(lv, ["team"], "timestamp_ms", 60 * M, 200, "event_id")
    sizes = [r["count"] for r in x.where("team = 'hot'").groupBy("_chunk").count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 210
    got = rows(ordered.running_sum(lv, ["team"], ["timestamp_ms", "event_id"], "score", "timestamp_ms",
                                   "total", 60 * M, 200), "event_id", "total")
    acc, want = {}, []
    for i, (tm, s, t) in sorted(enumerate(data), key=lambda x: (x[1][2], x[0])):
        acc[tm] = acc.get(tm, 0) + s
        want.append((i, acc[tm]))
    assert got == sorted(want)


def test_a_burst_among_spread_rows_is_cut_evenly(spark):
    # one instant holds 90 % of a cell's rows, the others are spread over the hour
    rnd = random.Random(12)
    data = [("hot", rnd.randint(-5, 9), 20 * M) for _ in range(9_000)] \
        + [("hot", 1, rnd.randrange(60 * M)) for _ in range(1_000)] + [("cold", 3, t) for t in (5, 70 * M)]
    rnd.shuffle(data)
    lv = _lv(spark, data)
    x = ordered._with_chunks(lv, ["team"], "timestamp_ms", 60 * M, 500, "event_id")
    sizes = [r["count"] for r in x.where("team = 'hot'").groupBy("_chunk").count().collect()]
    assert len(sizes) == 20 and max(sizes) <= 600
    assert x.where("team = 'cold'").groupBy("_chunk").count().count() == 2
    last = x.orderBy("team", "timestamp_ms", "event_id").select("team", "_chunk").collect()
    assert all(a._chunk <= b._chunk for a, b in zip(last, last[1:]) if a.team == b.team)
    got = rows(ordered.running_sum(lv, ["team"], ["timestamp_ms", "event_id"], "score", "timestamp_ms",
                                   "total", 60 * M, 500), "event_id", "total")
    acc, want = {}, []
    for i, (tm, s, t) in sorted(enumerate(data), key=lambda x: (x[1][2], x[0])):
        acc[tm] = acc.get(tm, 0) + s
        want.append((i, acc[tm]))
    assert got == sorted(want)

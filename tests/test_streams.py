from pyspark.sql import functions as F

from rillet.operators.scores import parse_game_events
from rillet.session import scratch_path
from rillet.sinks.table import stream_append
from rillet.streaming import leaderboard, levels
from rillet.streaming.runner import run_available_now

M = 60_000


def _add(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def _stream(spark, path):
    return parse_game_events(spark.readStream.schema("value string").text(path))


def _run_batches(spark, batches, build, mode="update"):
    src, out, ck = (scratch_path(spark, k) for k in ("in", "out", "ck"))
    for lines in batches:
        _add(spark, src, lines)
        run_available_now(stream_append(build(_stream(spark, src)), None, out, ck, mode))
    return spark.read.parquet(out)


def test_user_totals_accumulate_across_batches(spark):
    b1 = ["navy,blue,12,0,x", "scarlet,red,3,0,x"]
    b2 = ["scarlet,red,4,1,x", "sky,blue,3,1,x", "navy,blue,3,46800000,x"]
    b3 = ["scarlet,red,3,0,x"]   # very late: still counts, the global window has no lateness
    log = _run_batches(spark, [b1, b2, b3], leaderboard.user_totals)
    last = dict((r.user, r.total_score) for r in leaderboard.latest_updates(log, ["user"]).collect())
    assert last == {"navy": 15, "scarlet": 10, "sky": 3}
    assert log.where("user = 'scarlet'").count() == 3          # one update per batch that touched it


def test_team_totals_drop_rows_beyond_lateness(spark):
    b1 = ["a,red,5,18000000,x"]                 # 5 h: watermark becomes 3 h
    b2 = ["b,red,7,1800000,x", "c,red,2,14400000,x"]   # 0.5 h (window ended 1 h < 3 h) dropped; 4 h kept
    log = _run_batches(spark, [b1, b2], lambda ev: leaderboard.team_totals(ev, 60, 120).select(
        F.unix_millis(F.col("window.start")).alias("ws"), "team", "total_score"))
    last = {(r.ws, r.team): r.total_score for r in leaderboard.latest_updates(log, ["ws", "team"]).collect()}
    assert last == {(5 * 60 * M, "red"): 5, (4 * 60 * M, "red"): 2}


def test_level_crossings_stream(spark):
    def with_ids(lines, first):
        return [f"{x},{first + i}" for i, x in enumerate(lines)]

    b1 = with_ids(["r,red,99,1,x", "r,red,1,2,x"], 0)
    b2 = with_ids(["r,red,0,3,x", "r,red,100,4,x", "r,red,201,5,x"], 2)

    def build(ev):
        return levels.level_crossings(ev, 100)

    src, out, ck = (scratch_path(spark, k) for k in ("in", "out", "ck"))
    for lines in (b1, b2):
        _add(spark, src, lines)
        raw = spark.readStream.schema("value string").text(src)
        raw = raw.withColumn("event_id", F.element_at(F.split("value", ","), -1).cast("bigint"))
        ev = parse_game_events(raw, keep=("event_id",))
        run_available_now(stream_append(build(ev), None, out, ck, "append"))
    got = sorted((r.event_id, r.total_score) for r in spark.read.parquet(out).collect())
    assert got == [(1, 100), (3, 200), (4, 401)]


def _poll(spark, out, want, seconds=90):
    import time

    deadline, got = time.time() + seconds, set()
    while time.time() < deadline:
        try:
            got = {(r.team, r.ws, r.timing, r.total_score) for r in spark.read.parquet(out).collect()}
        except Exception:  # noqa: BLE001 - nothing written yet
            got = set()
        if want(got):
            break
        time.sleep(0.5)
    return got


def test_panes_stream_fires_on_time_after_watermark(spark):
    # Processing-time timeouts keep a stateful query scheduling batches, so the
    # live form runs on a processing-time trigger (never availableNow) and the
    # test polls its sink.
    src, out, ck = (scratch_path(spark, k) for k in ("in", "out", "ck"))
    _add(spark, src, ["p,red,3,60000,x", "p,red,4,120000,x", "q,blue,5,4200000,x"])
    panes = leaderboard.team_panes(_stream(spark, src), 60, 120, 5, 10, poll_ms=1)
    q = stream_append(panes, None, out, ck, "append").trigger(processingTime="200 milliseconds").start()
    try:
        got = _poll(spark, out, lambda g: ("red", 0, "ON_TIME", 7) in g)
    finally:
        q.stop()
    assert ("red", 0, "ON_TIME", 7) in got
    assert not any(t == "blue" and timing == "ON_TIME" for t, _, timing, _ in got)


def test_topic_source_needs_the_kafka_connector(spark):
    import pytest

    from rillet.sources.text import stream_topic

    with pytest.raises(Exception, match="(?i)kafka"):
        stream_topic(spark, "localhost:1", "games")


def test_panes_stream_fires_early_then_on_time(spark):
    # early/late delays of 30 ms of processing time, so the live clock can be observed
    src, out, ck = (scratch_path(spark, k) for k in ("in", "out", "ck"))
    _add(spark, src, ["p,red,3,60000,x"])
    panes = leaderboard.team_panes(_stream(spark, src), 60, 120, 0.0005, 0.0005, poll_ms=1)
    q = stream_append(panes, None, out, ck, "append").trigger(processingTime="200 milliseconds").start()
    try:
        got = _poll(spark, out, lambda g: ("red", 0, "EARLY", 3) in g)
        _add(spark, src, ["q,blue,5,4200000,x"])            # moves the watermark past red's window
        got = _poll(spark, out, lambda g: ("red", 0, "ON_TIME", 3) in g)
    finally:
        q.stop()
    assert ("red", 0, "EARLY", 3) in got and ("red", 0, "ON_TIME", 3) in got


def test_replayed_batch_is_written_once(spark):
    # Simulate a crash after the batch's output was written but before Spark
    # recorded the batch as committed: on restart the batch is replayed.
    import glob
    import os

    src, out, ck = (scratch_path(spark, k) for k in ("in", "out", "ck"))
    _add(spark, src, ["a,red,5,1000,x", "b,red,7,2000,x"])

    def run():
        run_available_now(stream_append(_stream(spark, src).select("user", "score"), None, out, ck, "append"))

    run()
    assert spark.read.parquet(out).count() == 2
    commits = sorted(glob.glob(ck.replace("file:", "") + "/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(commits[-1])
    crc = os.path.join(os.path.dirname(commits[-1]), "." + os.path.basename(commits[-1]) + ".crc")
    if os.path.exists(crc):
        os.remove(crc)
    run()
    assert spark.read.parquet(out).count() == 2

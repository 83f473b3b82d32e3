import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from rillet.operators.checks import assert_same_multiset
from rillet.session import scratch_path
from rillet.sinks import append_table, write_per_window, write_text, write_windowed_text
from rillet.sinks.table import SchemaClash


def test_write_text_and_read_back(spark):
    path = scratch_path(spark, "test-text")
    df = spark.createDataFrame([("a: 1",), ("b: 2",)], "line string")
    write_text(df, path, num_shards=2)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["a: 1", "b: 2"]
    assert len(glob.glob(path.replace("file:", "") + "/part-*")) == 2


def test_per_window_files_with_shards(spark):
    path = scratch_path(spark, "test-windows").replace("file:", "")
    df = (spark.range(40).select((F.col("id") * 600_000).alias("ms"), F.col("id").cast("string").alias("line"))
          .withColumn("window", F.window(F.timestamp_millis("ms"), "60 minutes")))
    write_windowed_text(df, path)
    dirs = sorted(glob.glob(path + "/window_start=*/window_end=*"))
    assert len(dirs) == 7 and os.path.basename(os.path.dirname(dirs[0])) == "window_start=1970-01-01T00-00-00"
    shards = [glob.glob(d + "/shard=*") for d in dirs]
    assert all(1 <= len(s) <= 3 for s in shards) and max(len(s) for s in shards) == 3
    assert all(len(glob.glob(sd + "/part-*")) == 1 for s in shards for sd in s)
    assert spark.read.text(path).count() == 40


def test_per_window_requires_window(spark):
    with pytest.raises(ValueError):
        write_per_window(spark.createDataFrame([("x",)], "line string"), scratch_path(spark, "x"))


def test_append_table_twice(spark):
    path = scratch_path(spark, "test-table")
    df = spark.createDataFrame([("u", 3)], "user string, total_score long")
    fields = {"user": "user", "total_score": F.col("total_score"), "doubled": F.col("total_score") * 2}
    append_table(df, fields, path=path)
    append_table(df, fields, path=path)
    back = spark.read.parquet(path)
    assert back.columns == ["user", "total_score", "doubled"] and back.count() == 2


def test_multiset_check(spark):
    a = spark.createDataFrame([("x", 1), ("x", 1)], "w string, c long")
    assert_same_multiset(a, a)
    with pytest.raises(AssertionError):
        assert_same_multiset(a, a.limit(1))


# -- appended tables -----------------------------------------------------------------

def _files(path):
    return sorted(p for p in os.listdir(path) if p.endswith(".parquet"))


def test_append_creates_then_adds(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string")
    append_table(df, path=path)
    append_table(df.select("y", "x"), path=path)                         # the order of columns does not matter
    append_table(df.limit(0), path=path)
    assert rows(spark.read.parquet(path), "x", "y") == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]
    assert not os.listdir(f"{path}/_commits") and not os.listdir(f"{path}/_staged")


@pytest.mark.parametrize("ddl, said", [
    ("x int", "missing column y string"), ("x int, y string, z int", "unknown column z int"),
    ("x bigint, y string", "column x is bigint, in the table int"), ("z int", "missing column x int; missing column y string; unknown column z int")])
def test_a_clashing_schema_is_refused_before_any_task(spark, tmp_path, ddl, said):
    path = str(tmp_path / "t")
    append_table(spark.createDataFrame([(1, "a")], "x int, y string"), path=path)
    before = _files(path)
    ran = spark.sparkContext.accumulator(0)

    def count(frames):
        for f in frames:
            ran.add(1)
            yield f
    other = spark.createDataFrame([], ddl).mapInPandas(count, ddl)
    with pytest.raises(SchemaClash, match=said):
        append_table(other, path=path)
    spark.sql("drop table if exists clash_table")
    append_table(spark.createDataFrame([(1, "a")], "x int, y string"), table="clash_table")
    with pytest.raises(SchemaClash, match=said):
        append_table(other, table="clash_table")
    append_table(spark.createDataFrame([("b", 2)], "y string, x int"), table="clash_table")
    assert rows(spark.table("clash_table"), "x", "y") == [(1, "a"), (2, "b")]
    spark.sql("drop table clash_table")
    assert ran.value == 0 and _files(path) == before


def test_a_failed_append_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    good = spark.createDataFrame([(1,)], "x int")
    append_table(good, path=path)

    def broken(frames):
        yield from frames
        raise RuntimeError("task lost")
    with pytest.raises(Exception, match="task lost"):
        append_table(spark.range(1000).selectExpr("cast(id as int) x").mapInPandas(broken, "x int"), path=path)
    assert rows(spark.read.parquet(path)) == [(1,)] and not os.listdir(f"{path}/_staged")


def test_a_killed_commit_is_finished_by_the_next_append(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    from rillet.sinks import table as sink

    with monkeypatch.context() as m:
        calls = []
        real = sink._finish

        def killed(files, root):
            calls.append(1)
            if len(calls) > 1:
                raise KeyboardInterrupt
            real(files, root)
        m.setattr(sink, "_finish", killed)
        with pytest.raises(KeyboardInterrupt):
            append_table(spark.range(8).repartition(4), path=path)
    assert _files(path) == [] and len(os.listdir(f"{path}/_commits")) == 1
    append_table(spark.range(8, 10), path=path)
    assert rows(spark.read.parquet(path)) == [(i,) for i in range(10)]


# -- per-window files of a stream ----------------------------------------------------

def _windows(path):
    """Lines per (window start, shard) of what is published."""
    out = {}
    for p in sorted(glob.glob(f"{path}/window_start=*/window_end=*/shard=*/*.txt")):
        start, _, shard, _ = p[len(path) + 1:].split("/")
        assert (start[13:], int(shard[6:])) not in out
        out[start[13:], int(shard[6:])] = open(p).read().splitlines()
    return out


def _word_windows(spark, tmp_path, messages, then=lambda: None, **kw):
    import json

    from rillet.model import WindowedWordCountOptions
    from rillet.plans import jobs

    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    opts = WindowedWordCountOptions(src, out, timestamp_attribute="ts", num_shards=4)
    for part in messages:
        spark.createDataFrame([(json.dumps({"value": v, "attributes": {"ts": str(t)}}),) for v, t in part], "value string") \
            .coalesce(1).write.mode("append").text(src)
        q = jobs.windowed_word_count_stream(spark, opts, trigger="100 milliseconds")
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        then()
    return out, opts


M10 = 10 * 60_000
SAID = [[("one two two", 5), ("three", M10 - 1)], [("four four", M10 + 1), ("one", 7)], [("end", 5 * M10)], [("end", 9 * M10)]]
WANT = {"1970-01-01T00-00-00": ["one: 2", "three: 1", "two: 2"], "1970-01-01T00-10-00": ["four: 2"],
        "1970-01-01T00-50-00": ["end: 1"]}


def test_an_unbounded_word_count_writes_its_shards_once(spark, tmp_path):
    out, _ = _word_windows(spark, tmp_path, SAID)
    got = _windows(out)
    assert sorted(got) == [(w, k) for w in sorted(WANT) for k in range(4)]            # exactly n shards a window
    assert {w: sorted(x for k in range(4) for x in got[w, k]) for w in WANT} == WANT
    assert rows(spark.read.text(out), "value") == sorted((x,) for v in WANT.values() for x in v)
    assert not os.listdir(f"{out}/_staged")


@pytest.mark.parametrize("phase", ["before the note", "after the note", "between moves", "before the query's commit"])
def test_windows_survive_a_kill_between_the_phases(spark, tmp_path, phase):
    from rillet.sinks.windows import _Shards, _Writer

    path = str(tmp_path / "out")
    os.makedirs(path)

    def attempt():
        import pyarrow as pa
        w, done = _Writer(path, 3), []
        for shard in (0, 2):
            rows_ = [("s", "e", shard, f"line {shard}"), ("s", "e", shard, None), ("s2", "e2", shard, "é")]
            cols = list(zip(*rows_))
            done.append(w.write(iter([pa.RecordBatch.from_arrays(
                [pa.array(cols[0]), pa.array(cols[1]), pa.array(cols[2], pa.int32()), pa.array(cols[3])],
                names=["window_start", "window_end", "shard", "value"])])))
        return w, [*done, _Shards(), None]
    w, done = attempt()
    if phase == "before the note":
        w.abort(done, 7)
        assert os.listdir(f"{path}/_staged") == []
    elif phase == "before the query's commit":
        w.commit(done, 7)
    else:
        def killed(files, root, staged):
            if phase == "between moves":
                start, end, shard, name = staged[0]
                os.makedirs(f"{root}/window_start={start}/window_end={end}/shard={shard}")
                os.rename(f"{root}/_staged/{name}", f"{root}/window_start={start}/window_end={end}/shard={shard}/part.txt")
            raise KeyboardInterrupt
        w._finish = killed
        with pytest.raises(KeyboardInterrupt):
            w.commit(done, 7)
    w, done = attempt()                                      # the micro-batch runs again
    w.commit(done, 7)
    want = {(s, k): ["", f"line {k}"] if s == "s" else ["é"] for s in ("s", "s2") for k in (0, 2)}
    got = _windows(path)
    assert {k: sorted(v) for k, v in got.items()} == want | {("s", 1): [], ("s2", 1): []}
    assert os.listdir(f"{path}/_staged") == []

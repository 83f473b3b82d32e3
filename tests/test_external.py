import pytest

from conftest import rows
from rillet.operators import external


def test_two_programs_in_a_row_are_identity(spark):
    df = spark.createDataFrame([(str(i), str(i)) for i in range(100)], "key string, value string").repartition(3)
    out = external.pipe_values(external.pipe_values(df, ("cat",)), ("cat",))
    assert rows(out) == rows(df)


def test_values_arrive_unaltered_and_null_stays(spark):
    data = [("a", "back\\slash"), ("b", None), ("c", "u2028\u2028x\x85y\x0bz"), ("d", ""), ("e", None)]
    df = spark.createDataFrame(data, "key string, value string").coalesce(1)
    assert [tuple(r) for r in external.pipe_values(df, ("cat",)).collect()] == data
    length = external.pipe_values(df, ("awk", "{ print length($0) }"))
    assert dict(map(tuple, length.collect()))["a"] == "10"
    assert rows(external.run_per_row(df.limit(1), ("printf", "%s\\n"))) == [("a", "back\\slash")]


def test_values_with_newlines_survive(spark):
    df = spark.createDataFrame([("a", "x\ny"), ("b", "back\\slash")], "key string, value string")
    assert rows(external.pipe_values(df, ("cat",))) == [("a", "x\ny"), ("b", "back\\slash")]


def test_value_that_cannot_be_one_line_is_refused(spark):
    df = spark.createDataFrame([("a", "x\ny\x1ez")], "key string, value string")
    with pytest.raises(Exception, match="holds a newline"):
        external.pipe_values(df, ("cat",)).collect()


def test_one_program_run_per_partition(spark):
    df = spark.range(50_000).selectExpr("cast(id as string) key", "cast(id as string) value").coalesce(1)
    out = external.pipe_values(df, ("awk", "{ print NR }"))       # a buffering program that counts its lines
    assert out.selectExpr("max(cast(value as int))").first()[0] == 50_000


def test_transforming_program(spark):
    df = spark.createDataFrame([("k", "hello")], "key string, value string")
    assert external.pipe_values(df, ("tr", "a-z", "A-Z")).first().value == "HELLO"


def test_per_row_mode_emits_each_output_line(spark):
    df = spark.createDataFrame([("k1", "a b"), ("k2", "c")], "key string, value string")
    out = external.run_per_row(df, ("sh", "-c", 'for w in $0; do echo "$w"; done'))
    assert rows(out) == [("k1", "a"), ("k1", "b"), ("k2", "c")]


def test_failing_program_fails_the_job(spark):
    df = spark.createDataFrame([("k", "v")], "key string, value string")
    with pytest.raises(Exception, match="exited"):
        external.pipe_values(df, ("sh", "-c", "exit 3")).collect()


def test_line_count_mismatch_fails(spark):
    df = spark.createDataFrame([("k", "v"), ("j", "w")], "key string, value string").coalesce(1)
    with pytest.raises(Exception, match="returned"):
        external.pipe_values(df, ("head", "-n", "1")).collect()


def test_timeout_fails_the_row_task(spark):
    df = spark.createDataFrame([("k", "v")], "key string, value string")
    with pytest.raises(Exception, match="(?i)timeout|timed out"):
        external.pipe_values(df, ("sh", "-c", "sleep 5; cat"), timeout_sec=0.5).collect()


# a program of the framed kind: answers a value's words, upper-cased
FRAMES = """
import sys
i, o = sys.stdin.buffer, sys.stdout.buffer
while line := i.readline():
    value = i.read(int(line)).decode()
    %s
    words = [w.upper().encode() for w in value.split(" ") if w]
    o.write(b"%%d\\n" %% len(words) + b"".join(b"%%d\\n" %% len(w) + w for w in words))
    o.flush()
"""


def framed(extra="pass"):
    import sys
    return (sys.executable, "-c", FRAMES % extra)


def test_frames_answer_any_number_of_values(spark):
    data = [("a", "one"), ("b", ""), ("c", "x y\nz  w"), ("d", None), ("e", "é\x1e \u2028\x00"), ("f", "w " * 50_000)]
    df = spark.createDataFrame(data, "key string, value string").coalesce(1)
    got = [tuple(r) for r in external.exchange_frames(df, framed()).collect()]
    want = [(k, None) if v is None else (k, w.upper()) for k, v in data for w in ([None] if v is None else v.split(" ")) if w != ""]
    assert got == want
    assert external.exchange_frames(df.limit(0), framed()).count() == 0


def test_frames_run_the_program_once_per_partition_with_few_rows_under_way(spark):
    df = spark.range(20_000).selectExpr("cast(id as string) key", "concat('v', id) value").repartition(2)
    counter = "global_n = globals().get('global_n', 0) + 1; globals().update(global_n=global_n); value = str(global_n)"
    out = external.exchange_frames(df, framed(counter), window=3)
    assert out.selectExpr("max(cast(value as int))").first()[0] > 9_000 and out.count() == 20_000


@pytest.mark.parametrize("extra, said", [
    ("import time; value == 'bad' and time.sleep(60)", "key 'k7'.*no answer in 2"),
    ("value == 'bad' and sys.exit(3)", "key 'k7'.*it ended"),
    ("value == 'bad' and o.write(b'many\\n')", "key 'k7'.*no number"),
    ("value == 'bad' and o.write(b'1\\n5\\nabc') and o.flush() is None and sys.exit(0)", "key 'k7'.*within a value"),
])
def test_frames_name_the_row_that_fails(spark, extra, said):
    df = spark.createDataFrame([(f"k{i}", "bad" if i == 7 else "v") for i in range(20)], "key string, value string").coalesce(1)
    with pytest.raises(Exception, match=said):
        external.exchange_frames(df, framed(extra), timeout_sec=2.0).collect()


def test_frames_of_a_program_that_fails_at_its_end(spark):
    df = spark.createDataFrame([("k", "v")], "key string, value string")
    with pytest.raises(Exception, match="exited 5|key 'k'"):
        external.exchange_frames(df, (*framed()[:2], framed()[2] + "\nsys.exit(5)")).collect()

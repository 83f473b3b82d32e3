from conftest import lines_df, rows

from rillet.model import ASCII_TOKENIZER_PATTERN
from rillet.operators import words


def test_tokenize_drops_blanks_and_spaces(spark):
    df = lines_df(spark, [" some  input  words ", " ", " cool ", " foo", " bar"])
    got = [r.word for r in words.tokenize(df).collect()]
    assert sorted(got) == sorted(["some", "input", "words", "cool", "foo", "bar"])


def test_word_count_and_format(spark):
    df = lines_df(spark, ["hi there", "hi", "hi sue bob", "hi sue", "", "bob hi"])
    out = words.format_counts(words.count_words(words.tokenize(df)))
    assert sorted(r.line for r in out.collect()) == sorted(["hi: 5", "there: 1", "sue: 2", "bob: 2"])


def test_tokenizer_keeps_accents_and_case(spark):
    df = lines_df(spark, ["Héllo wörld, it's Ωmega"])
    assert [r.word for r in words.tokenize(df).collect()] == ["Héllo", "wörld", "it", "s", "Ωmega"]
    ascii_ = [r.word for r in words.tokenize(df, pattern=ASCII_TOKENIZER_PATTERN).collect()]
    assert ascii_ == ["H", "llo", "w", "rld", "it's", "mega"]


def test_filtered_word_count_full_match(spark):
    df = lines_df(spark, ["stomach secret Flourish message Flourish here Flourish"])
    counts = words.count_words(words.tokenize(df))
    kept = words.filter_full_match(counts, "Flourish|stomach")
    assert rows(kept, "word", "cnt") == [("Flourish", 3), ("stomach", 1)]
    stats = words.match_stats(counts, "Flourish|stomach").first()
    assert (stats.n_matched, stats.n_unmatched) == (2, 3)


def test_full_match_is_anchored_around_alternation(spark):
    df = lines_df(spark, ["it itx PGM xPGM"])
    kept = words.filter_full_match(words.count_words(words.tokenize(df)), "it|PGM")
    assert rows(kept, "word") == [("PGM",), ("it",)]


def test_line_stats(spark):
    df = lines_df(spark, ["ab", "", "  \t", "abcd"])
    s = words.line_stats(df).first()
    assert (s.n_blank, s.min_len, s.max_len, s.sum_len, s.n_lines) == (2, 0, 4, 9, 4)


def test_observed_line_stats(spark):
    df = lines_df(spark, ["a b", ""])
    observed, obs = words.observe_line_stats(df)
    assert words.count_words(words.tokenize(observed)).count() == 2
    assert obs.get["n_blank"] == 1 and obs.get["n_lines"] == 2


def test_windowed_counts(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("a b", 0), ("a", 599_999), ("a", 600_000)], "value string, ms long")
    df = df.withColumn("event_time", F.timestamp_millis("ms"))
    out = words.windowed_counts(words.tokenize(df, keep=["event_time"]), 10)
    assert rows(out, "window_start", "word", "cnt") == [
        ("1969-12-31 16:00:00.000", "a", 2), ("1969-12-31 16:00:00.000", "b", 1),
        ("1969-12-31 16:10:00.000", "a", 1)]


def test_random_event_time_in_range(spark):
    from pyspark.sql import functions as F
    df = words.with_random_event_time(spark.range(200), 1000, 61000, seed=3)
    r = df.agg(F.min(F.unix_millis("event_time")).alias("lo"), F.max(F.unix_millis("event_time")).alias("hi")).first()
    assert 1000 <= r.lo and r.hi < 61000

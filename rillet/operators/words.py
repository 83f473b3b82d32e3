"""Word counting: tokenise, count, filter by full match, line metrics, windows.

Counting is one ``groupBy(word)``: a partial aggregate in every task, then one
exchange on ``word``.  A word that makes up a third of the corpus is reduced
to one row per task before the shuffle, so it never lands whole on a reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.functions.strings import full_match, java_trim
from rillet.functions.times import display_time, window_start_ms
from rillet.model import DEBUG_FILTER_PATTERN, TOKENIZER_PATTERN, WORD_WINDOW_MINUTES


def tokenize(lines: DataFrame, value_col: str = "value", pattern: str = TOKENIZER_PATTERN,
             keep: Sequence[str] = ()) -> DataFrame:
    """``*keep, word``: split on ``pattern`` (trailing empties kept), drop empty tokens, case kept."""
    words = lines.select(*keep, F.explode(F.split(F.col(value_col), pattern, -1)).alias("word"))
    return words.where(F.col("word") != "")


def count_words(words: DataFrame, extra_keys: Sequence[str | Column] = ()) -> DataFrame:
    """``*extra_keys, word, cnt`` (BIGINT)."""
    return words.groupBy(*extra_keys, "word").agg(F.count(F.lit(1)).alias("cnt"))


def format_counts(counts: DataFrame) -> DataFrame:
    """``line``: ``word: count``."""
    return counts.select(F.concat(F.col("word"), F.lit(": "), F.col("cnt").cast("string")).alias("line"))


def line_stats(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """One row: blank-line counter and the line-length distribution (min, max, sum, count)."""
    v = F.col(value_col)
    n = F.length(v).cast("bigint")
    return lines.agg(
        F.count_if(java_trim(v) == "").alias("n_blank"),
        F.min(n).alias("min_len"),
        F.max(n).alias("max_len"),
        F.sum(n).cast("bigint").alias("sum_len"),
        F.count(F.lit(1)).alias("n_lines"),
    )


def observe_line_stats(lines: DataFrame, value_col: str = "value"):
    """Counter form: ``(lines, observation)``; metrics are ready after the first action."""
    from pyspark.sql import Observation

    obs = Observation("line_stats")
    v = F.col(value_col)
    observed = lines.observe(
        obs,
        F.count_if(java_trim(v) == "").alias("n_blank"),
        F.min(F.length(v).cast("bigint")).alias("min_len"),
        F.max(F.length(v).cast("bigint")).alias("max_len"),
        F.sum(F.length(v)).cast("bigint").alias("sum_len"),
        F.count(F.lit(1)).alias("n_lines"),
    )
    return observed, obs


def filter_full_match(counts: DataFrame, pattern: str = DEBUG_FILTER_PATTERN) -> DataFrame:
    """Keep rows whose ``word`` matches ``pattern`` entirely (``it`` yes, ``itx`` no)."""
    return counts.where(full_match(F.col("word"), pattern))


def match_stats(counts: DataFrame, pattern: str = DEBUG_FILTER_PATTERN) -> DataFrame:
    """One row ``n_matched, n_unmatched`` over the (distinct) counted words."""
    m = full_match(F.col("word"), pattern)
    return counts.agg(F.count_if(m).alias("n_matched"), F.count_if(~m).alias("n_unmatched"))


def with_random_event_time(df: DataFrame, min_ms: int, max_ms: int, seed: int = 0,
                           name: str = "event_time") -> DataFrame:
    """Set an event time uniformly in ``[min_ms, max_ms)`` (a seeded ``rand`` expression)."""
    span = max_ms - min_ms
    ms = (F.lit(min_ms) + F.floor(F.rand(seed) * F.lit(span))).cast("bigint")
    return df.withColumn(name, F.timestamp_millis(ms))


def windowed_counts(words: DataFrame, minutes: int = WORD_WINDOW_MINUTES,
                    time_col: str = "event_time") -> DataFrame:
    """``window_start, word, cnt`` per fixed event-time window."""
    counts = count_words(words, [F.window(time_col, f"{minutes} minutes").alias("window")])
    return counts.select(display_time(window_start_ms()).alias("window_start"), "word", "cnt")

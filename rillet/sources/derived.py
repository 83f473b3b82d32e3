"""Inputs with the reference's row formats, derived by Spark from the driver's tables.

Each derivation is a narrow projection (no shuffle); the same rules are
written in SQL in ``rillet.plans.oracle`` so DuckDB can rebuild them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.functions.times import epoch_millis
from rillet.sources.tables import read_table

# Fixed values of the derivation rules (FIXTURES section 2).
GAME_USERS = 40
GAME_TEAMS = 15
CORRUPT_EVERY = 97
BAD_SCORE_EVERY = 101
CORRUPT_PREFIX = "THIS LINE REPRESENTS CORRUPT DATA AND WILL CAUSE A PARSE ERROR"
SLIGHTLY_LATE_EVERY = 50          # arrives 10 minutes after its event time
VERY_LATE_EVERY = 211             # arrives 3 hours after (beyond the lateness)
WORD_TIME_BASE_MS = 1704067200000  # 2024-01-01 00:00:00 UTC
WORD_TIME_MULTIPLIER = 7919
WORD_TIME_SPAN_SEC = 3600


def game_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, value, arrival_ms``: one game line per event, some corrupted.

    ``value`` is ``user,team,score,ms,readable``.
    """
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value"])
    ms = epoch_millis(ev, "ts")
    user = F.concat(F.lit("user"), (F.col("user_id") % GAME_USERS).cast("string"))
    team = F.concat(F.lit("team"), (F.col("user_id") % GAME_TEAMS).cast("string"))
    score = F.floor(F.col("value")).cast("int").cast("string")
    tail = F.concat_ws(",", ms.cast("string"), F.col("ts").cast("string"))   # readable field: ts as text
    line = (F.when(F.col("event_id") % CORRUPT_EVERY == 0, F.concat_ws(",", F.lit(CORRUPT_PREFIX), tail))
            .when(F.col("event_id") % BAD_SCORE_EVERY == 0, F.concat_ws(",", user, team, F.lit("xxx"), tail))
            .otherwise(F.concat_ws(",", user, team, score, tail)))
    delay_ms = (F.when(F.col("event_id") % SLIGHTLY_LATE_EVERY == 0, F.lit(10 * 60_000)).otherwise(0)
                + F.when(F.col("event_id") % VERY_LATE_EVERY == 0, F.lit(3 * 3_600_000)).otherwise(0))
    return ev.select("event_id", line.alias("value"), (ms + delay_ms).alias("arrival_ms"))


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, text`` of every document, whole."""
    return read_table(spark, sf_dir, "documents", ["doc_id", "text"])


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, value``: one row per line of every document (trailing empties kept)."""
    docs = document_texts(spark, sf_dir)
    return docs.select("doc_id", F.explode(F.split("text", "\n", -1)).alias("value"))


def doc_event_ms(doc_id_col: str = "doc_id"):
    """Deterministic event time of a document: base + (doc_id * 7919 % 3600) s."""
    return (F.lit(WORD_TIME_BASE_MS)
            + (F.col(doc_id_col) * WORD_TIME_MULTIPLIER % WORD_TIME_SPAN_SEC) * 1000)


def person_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``c_custkey, value``: a person line per customer, some deliberately invalid."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    k = F.col("c_custkey")
    name = F.when(k % 23 == 0, F.col("c_name")).otherwise(F.regexp_replace("c_name", "#", " "))
    sex = F.when(k % 19 == 0, "Male").when(k % 2 == 0, "M").otherwise("F")
    age = F.when(k % 17 == 0, F.lit("")).otherwise((k % 90).cast("string"))
    weight = F.when(k % 13 == 0, F.lit("-60")).otherwise((50 + k % 60).cast("string"))
    height = F.when(k % 29 == 0, F.lit("5000")).otherwise((140 + k % 60).cast("string"))
    return c.select("c_custkey", F.concat_ws(",  ", name, sex, age, weight, height).alias("value"))


def echo_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``key, value`` pairs for the external-program job."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey"])
    s = F.col("c_custkey").cast("string")
    return c.select(s.alias("key"), s.alias("value"))

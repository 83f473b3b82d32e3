"""Keyed queries: ``name -> f(spark, sf_dir) -> DataFrame`` over the driver's tables.

Each reads whole tables (or inputs Spark derives from them) and returns the
job's result; oracles with the same column names live in ``oracle_sql``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from rillet.model import ASCII_TOKENIZER_PATTERN, DEBUG_FILTER_PATTERN
from rillet.operators import abuse, external, levels, panes, people, scores, sessions, words
from rillet.sources.derived import doc_event_ms, document_texts, echo_rows, game_lines, person_lines, text_lines

Query = Callable[[SparkSession, str], DataFrame]

RANGE_START = "2024-01-05-00-00"
RANGE_STOP = "2024-01-20-12-30"


def _events(spark: SparkSession, sf_dir: str, keep=("event_id",)) -> DataFrame:
    return scores.parse_game_events(game_lines(spark, sf_dir), keep=keep)


def parse_game_events(spark, sf_dir):
    return _events(spark, sf_dir).drop("event_time")


def parse_error_count(spark, sf_dir):
    return scores.parse_error_count(game_lines(spark, sf_dir))


def user_score(spark, sf_dir):
    return scores.sum_scores(_events(spark, sf_dir, keep=()), "user")


def team_score(spark, sf_dir):
    return scores.sum_scores(_events(spark, sf_dir, keep=()), "team")


def user_score_text(spark, sf_dir):
    return scores.user_score_text(user_score(spark, sf_dir))


def hourly_team_score(spark, sf_dir):
    return scores.windowed_team_score(_events(spark, sf_dir, keep=()), 60)


def hourly_team_score_range(spark, sf_dir):
    ev = scores.in_time_range(_events(spark, sf_dir, keep=()), RANGE_START, RANGE_STOP)
    return scores.windowed_team_score(ev, 60)


# -- word count ------------------------------------------------------------
# Tokenising a whole document equals tokenising its lines (a newline is a
# separator for both patterns), so counts skip the line split.

def tokenize(spark, sf_dir):
    return words.tokenize(document_texts(spark, sf_dir), "text", keep=["doc_id"])


def tokenize_ascii(spark, sf_dir):
    return words.tokenize(document_texts(spark, sf_dir), "text", ASCII_TOKENIZER_PATTERN, keep=["doc_id"])


def word_count(spark, sf_dir):
    return words.count_words(words.tokenize(document_texts(spark, sf_dir), "text"))


def word_count_text(spark, sf_dir):
    return words.format_counts(word_count(spark, sf_dir))


def line_stats(spark, sf_dir):
    return words.line_stats(text_lines(spark, sf_dir))


def debugging_word_count(spark, sf_dir):
    return words.filter_full_match(word_count(spark, sf_dir), DEBUG_FILTER_PATTERN)


def match_stats(spark, sf_dir):
    return words.match_stats(word_count(spark, sf_dir), DEBUG_FILTER_PATTERN)


def windowed_word_count(spark, sf_dir):
    docs = document_texts(spark, sf_dir).withColumn("event_time", F.timestamp_millis(doc_event_ms()))
    return words.windowed_counts(words.tokenize(docs, "text", keep=["event_time"]), 10)


# -- game statistics ---------------------------------------------------------

def spammy_users(spark, sf_dir):
    return abuse.spammy_users(_events(spark, sf_dir, keep=()), 60, 2.5)


def team_score_no_spam(spark, sf_dir):
    return abuse.team_score_without_spammers(_events(spark, sf_dir, keep=()), 60, 2.5)


def user_sessions(spark, sf_dir):
    return sessions.user_sessions(_events(spark, sf_dir, keep=()), 5)


def user_sessions_gap60(spark, sf_dir):
    return sessions.user_sessions(_events(spark, sf_dir, keep=()), 60)


def session_mean(spark, sf_dir):
    return sessions.session_mean(_events(spark, sf_dir, keep=()), 5, 30)


def session_mean_gap60(spark, sf_dir):
    return sessions.session_mean(_events(spark, sf_dir, keep=()), 60, 30)


def team_level_crossings(spark, sf_dir):
    return levels.level_crossings(_events(spark, sf_dir), 5000)


def team_level_crossings_windowed(spark, sf_dir):
    return levels.windowed_level_crossings(_events(spark, sf_dir), 60, 100)


# -- person records ------------------------------------------------------------

def bio_validate(spark, sf_dir):
    return people.validate(person_lines(spark, sf_dir), keep=["c_custkey"])


def bio_split(spark, sf_dir):
    return people.tag_lines(person_lines(spark, sf_dir))


def bio_people(spark, sf_dir):
    return people.valid_people(person_lines(spark, sf_dir))


def bio_people_text(spark, sf_dir):
    return people.people_text(bio_people(spark, sf_dir))


# -- external program ------------------------------------------------------------

def external_echo(spark, sf_dir):
    # each pass changes the value, so a skipped one shows
    once = external.pipe_values(echo_rows(spark, sf_dir), ("sed", "s/$/-1/"))
    return external.pipe_values(once, ("sed", "s/$/-2/"))


# -- leader board ------------------------------------------------------------------

def _arrivals(spark, sf_dir) -> DataFrame:
    return scores.parse_game_events(game_lines(spark, sf_dir), keep=("arrival_ms",))


def leaderboard_team_panes(spark, sf_dir):
    return panes.team_panes(_arrivals(spark, sf_dir), window_minutes=60, lateness_minutes=120,
                            early_minutes=5, late_minutes=10)


def leaderboard_team_final(spark, sf_dir):
    return panes.final_panes(_arrivals(spark, sf_dir), window_minutes=60, lateness_minutes=120,
                             early_minutes=5, late_minutes=10)


def leaderboard_user_panes(spark, sf_dir):
    return panes.user_panes(_arrivals(spark, sf_dir), 10)


def leaderboard_user_final(spark, sf_dir):
    return panes.user_final_panes(_arrivals(spark, sf_dir), 10)


def queries() -> dict[str, Query]:
    from rillet.plans.streams import STREAM_QUERIES

    return {
        **STREAM_QUERIES,
        "leaderboard_team_panes": leaderboard_team_panes,
        "leaderboard_team_final": leaderboard_team_final,
        "leaderboard_user_panes": leaderboard_user_panes,
        "leaderboard_user_final": leaderboard_user_final,
        "bio_validate": bio_validate,
        "bio_split": bio_split,
        "bio_people": bio_people,
        "bio_people_text": bio_people_text,
        "external_echo": external_echo,
        "spammy_users": spammy_users,
        "team_score_no_spam": team_score_no_spam,
        "user_sessions": user_sessions,
        "user_sessions_gap60": user_sessions_gap60,
        "session_mean": session_mean,
        "session_mean_gap60": session_mean_gap60,
        "team_level_crossings": team_level_crossings,
        "team_level_crossings_windowed": team_level_crossings_windowed,
        "tokenize": tokenize,
        "tokenize_ascii": tokenize_ascii,
        "word_count": word_count,
        "word_count_text": word_count_text,
        "line_stats": line_stats,
        "debugging_word_count": debugging_word_count,
        "match_stats": match_stats,
        "windowed_word_count": windowed_word_count,
        "parse_game_events": parse_game_events,
        "parse_error_count": parse_error_count,
        "user_score": user_score,
        "team_score": team_score,
        "user_score_text": user_score_text,
        "hourly_team_score": hourly_team_score,
        "hourly_team_score_range": hourly_team_score_range,
    }

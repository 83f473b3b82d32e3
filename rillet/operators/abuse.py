"""Spam detection: users whose window total exceeds ``weight x`` the window's mean
user total, and team sums with those users' events removed.

Plan shape (all shuffles keyed, no cross products):
  events -> partial/final sum by (window, user, team)   [exchange 1]
         -> sum by (window, user)                       [exchange 2, pre-aggregated rows]
         -> mean by window, joined back                 [tiny side; AQE broadcasts it by measured size]
  anti join of the (window, user, team) sums with the spammers on (window, user),
  then sum by (window, team).
Pre-aggregating before the anti join means raw events never cross the join.
The pre-aggregate feeds three branches (user sums, the mean, the anti join),
so it is written once to the shared checkpoint folder and read back: the
events are scanned and parsed once, not once per branch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.functions.times import display_time, floor_ms
from rillet.model import SCORE_WEIGHT, TEAM_WINDOW_MINUTES
from rillet.session import materialize


def user_team_sums(events: DataFrame, minutes: int = TEAM_WINDOW_MINUTES) -> DataFrame:
    """``ws, user, team, score_sum``: the pre-aggregate both outputs start from."""
    return (events.withColumn("ws", floor_ms(F.col("timestamp_ms"), minutes * 60_000))
            .groupBy("ws", "user", "team").agg(F.sum("score").alias("score_sum")))


def spammers_from_sums(uts: DataFrame, weight: float = SCORE_WEIGHT) -> DataFrame:
    """``ws, user, total_score`` of users above ``weight`` x the window mean."""
    return spammers_from_totals(uts.groupBy("ws", "user").agg(F.sum("score_sum").alias("total_score")), weight)


def spammers_from_totals(per_user: DataFrame, weight: float = SCORE_WEIGHT) -> DataFrame:
    """The same from ``ws, user, total_score`` (read twice: hand in a stored table)."""
    mean = per_user.groupBy("ws").agg((F.sum("total_score") / F.count("*")).alias("mean_score"))
    joined = per_user.join(mean, "ws")
    return (joined.where(F.col("total_score") > F.lit(weight) * F.col("mean_score"))
            .select("ws", "user", "total_score"))


def spammy_users(events: DataFrame, minutes: int = TEAM_WINDOW_MINUTES,
                 weight: float = SCORE_WEIGHT) -> DataFrame:
    """``window_start, user, total_score``."""
    totals = (events.withColumn("ws", floor_ms(F.col("timestamp_ms"), minutes * 60_000))
              .groupBy("ws", "user").agg(F.sum("score").alias("total_score")))
    sp = spammers_from_totals(materialize(totals, "window-user-sums"), weight)
    return sp.select(display_time(F.col("ws")).alias("window_start"), "user", "total_score")


def team_score_without_spammers(events: DataFrame, minutes: int = TEAM_WINDOW_MINUTES,
                                weight: float = SCORE_WEIGHT) -> DataFrame:
    """``window_start, team, total_score`` after dropping spammers of the same window."""
    uts = materialize(user_team_sums(events, minutes), "window-user-team-sums")
    spammers = spammers_from_sums(uts, weight).select("ws", "user")
    clean = uts.join(spammers, ["ws", "user"], "left_anti")
    sums = clean.groupBy("ws", "team").agg(F.sum("score_sum").alias("total_score"))
    return sums.select(display_time(F.col("ws")).alias("window_start"), "team", "total_score")


def observe_spammers(spammers: DataFrame, name: str = "spammers"):
    """Counter form: ``(spammers, observation)``; ``observation.get['n_spammers']`` after an action."""
    from pyspark.sql import Observation

    obs = Observation(name)
    return spammers.observe(obs, F.count(F.lit(1)).alias("n_spammers")), obs

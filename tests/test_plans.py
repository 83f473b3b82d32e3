"""Plan-shape regression tests: the scale properties of the keyed queries.

Each query is executed, then its final (adaptive) physical plan is inspected.
"""

import re

import pytest

import __spark_entry__ as entry
from rillet.plans import queries as base_queries

SF = "/root/testdata/sf0.001"
_PLANS = {}


def final_plan(spark, key):
    if key not in _PLANS:
        df = entry.queries()[key](spark, SF)
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString()
        # AdaptiveSparkPlan prints the final plan first, then the initial one
        _PLANS[key] = text.split("+- == Initial Plan ==")[0]
    return _PLANS[key]


@pytest.mark.parametrize("key", sorted(base_queries.queries()))
def test_no_cartesian_or_nested_loop_joins(spark, key):
    plan = final_plan(spark, key)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("key", ["user_score", "team_score", "word_count", "hourly_team_score",
                                 "windowed_word_count", "spammy_users"])
def test_aggregations_combine_before_the_shuffle(spark, key):
    plan = final_plan(spark, key)
    assert "partial_sum" in plan or "partial_count" in plan


def test_scans_are_pruned(spark):
    plan = final_plan(spark, "user_score")
    scans = re.findall(r"ReadSchema: (struct<[^>]*>)", plan) or re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert scans and all("props" not in s and "event_type" not in s for s in scans)
    wc = final_plan(spark, "word_count")
    assert all("lang" not in s and "source" not in s for s in re.findall(r"FileScan parquet \[([^\]]*)\]", wc))


@pytest.mark.parametrize("key", ["user_sessions", "team_level_crossings", "team_level_crossings_windowed"])
def test_ordered_scans_share_one_shuffle_of_the_rows(spark, key):
    assert "ReusedExchange" in final_plan(spark, key)


@pytest.mark.parametrize("key", ["team_score_no_spam", "spammy_users", "leaderboard_team_panes"])
def test_multi_consumer_preaggregates_do_not_rescan_the_events(spark, key):
    plan = final_plan(spark, key)
    assert "events.parquet" not in plan        # branches read the materialized pre-aggregate


def test_game_parse_is_a_flat_map_not_a_pushed_filter(spark):
    plan = final_plan(spark, "parse_game_events")
    assert "Generate inline" in plan

import pytest
from conftest import lines_df, rows

from rillet.operators import scores

GOOD = [
    "user0_MagentaKangaroo,MagentaKangaroo,3,1447955630000,2015-11-19 09:53:53.444",
    "user13_ApricotQuokka,ApricotQuokka,15,1447955630000,2015-11-19 09:53:53.444",
    "user6_AmberNumbat,AmberNumbat,11,1447955630000,2015-11-19 09:53:53.444",
    "user7_AlmondWallaby,AlmondWallaby,15,1447955630000,2015-11-19 09:53:53.444",
    "user7_AndroidGreenKookaburra,AndroidGreenKookaburra,12,1447955630000,2015-11-19 09:53:53.444",
    "user7_AndroidGreenKookaburra,AndroidGreenKookaburra,11,1447955630000,2015-11-19 09:53:53.444",
    "user19_BisqueBilby,BisqueBilby,6,1447955630000,2015-11-19 09:53:53.444",
    "user19_BisqueBilby,BisqueBilby,8,1447955630000,2015-11-19 09:53:53.444",
]
BAD = [
    "user6_AliceBlueDingo,AliceBlueDingo,4,xxxxxxx,2015-11-19 09:53:53.444",
    "THIS IS A PARSE ERROR,2015-11-19 09:53:53.444",
]
LATER = [
    "user0_AndroidGreenEchidna,AndroidGreenEchidna,0,1447965690000,2015-11-19 12:41:31.053",
    "user0_MagentaKangaroo,MagentaKangaroo,4,1447965690000,2015-11-19 12:41:31.053",
    "user2_AmberCockatoo,AmberCockatoo,13,1447965690000,2015-11-19 12:41:31.053",
    "user18_BananaEmu,BananaEmu,7,1447965690000,2015-11-19 12:41:31.053",
    "user3_BananaEmu,BananaEmu,17,1447965690000,2015-11-19 12:41:31.053",
    "user18_BananaEmu,BananaEmu,1,1447965690000,2015-11-19 12:41:31.053",
    "user18_ApricotCaneToad,ApricotCaneToad,14,1447965690000,2015-11-19 12:41:31.053",
]


def test_parse_keeps_good_lines(spark):
    ev = scores.parse_game_events(lines_df(spark, GOOD + BAD))
    assert ev.count() == 8
    assert rows(ev, "user", "score")[0] == ("user0_MagentaKangaroo", 3)
    assert scores.parse_error_count(lines_df(spark, GOOD + BAD)).first().n_errors == 2


def test_user_and_team_sums(spark):
    ev = scores.parse_game_events(lines_df(spark, GOOD + BAD))
    users = dict(rows(scores.sum_scores(ev, "user"), "user", "total_score"))
    assert users == {"user0_MagentaKangaroo": 3, "user13_ApricotQuokka": 15, "user6_AmberNumbat": 11,
                     "user7_AlmondWallaby": 15, "user7_AndroidGreenKookaburra": 23, "user19_BisqueBilby": 14}
    teams = dict(rows(scores.sum_scores(ev, "team"), "team", "total_score"))
    assert teams == {"MagentaKangaroo": 3, "ApricotQuokka": 15, "AmberNumbat": 11, "AlmondWallaby": 15,
                     "AndroidGreenKookaburra": 23, "BisqueBilby": 14}


def test_all_bad_input_is_empty(spark):
    bad = BAD + ["user13_BisqueBilby,BisqueBilby,xxx,1447955630000,2015-11-19 09:53:53.444"]
    assert scores.sum_scores(scores.parse_game_events(lines_df(spark, bad)), "user").count() == 0


@pytest.mark.parametrize("line,ok", [
    ("u,t,5,1", True), ("u,t, +5 ,\t1\t", True), ("u,t,5.7,1", False), ("u,t,5,1.0", False),
    ("u,t,99999999999,1", False), ("u,t,5", False), (",,5,1", True), ("u,t,5,1,extra,more", True),
    ("u,t,,1", False), ("u,t,-3,1", True),
])
def test_parse_guards(spark, line, ok):
    assert scores.parse_game_events(lines_df(spark, [line])).count() == (1 if ok else 0)


def test_time_filter_and_hourly_windows(spark):
    ev = scores.parse_game_events(lines_df(spark, GOOD + LATER))
    from pyspark.sql import functions as F
    kept = ev.where(F.col("timestamp_ms") > 1447965680000)
    assert sorted((r.user, r.score) for r in kept.collect()) == sorted([
        ("user0_AndroidGreenEchidna", 0), ("user0_MagentaKangaroo", 4), ("user2_AmberCockatoo", 13),
        ("user18_BananaEmu", 7), ("user3_BananaEmu", 17), ("user18_BananaEmu", 1),
        ("user18_ApricotCaneToad", 14)])
    # LA wall clock options: 2015-11-19 12:00 LA = 20:00 UTC lies between the two groups
    ranged = scores.in_time_range(ev, "2015-11-19-10-00", "2100-01-01-00-00")
    assert ranged.count() == 7
    hourly = scores.windowed_team_score(ev, 60)
    got = {(r.team, r.window_start): r.total_score for r in hourly.collect()}
    assert got[("BananaEmu", "2015-11-19 12:00:00.000")] == 25
    assert got[("MagentaKangaroo", "2015-11-19 09:00:00.000")] == 3


def test_range_bounds_are_strict(spark):
    # 2015-11-16-16-10 LA = 2015-11-17 00:10 UTC = 1447719000000
    at = "u,t,1,1447719000000,x"
    assert scores.in_time_range(scores.parse_game_events(lines_df(spark, [at])), "2015-11-16-16-10").count() == 0
    assert scores.in_time_range(scores.parse_game_events(lines_df(spark, [at])), "2015-11-16-16-09").count() == 1


def test_text_renderings(spark):
    ev = scores.parse_game_events(lines_df(spark, GOOD[:1]))
    assert scores.user_score_text(scores.sum_scores(ev, "user")).first().line == \
        "total_score: 3, user: user0_MagentaKangaroo"
    hourly = scores.windowed_team_score(ev, 60)
    assert scores.hourly_team_text(hourly).first().line == \
        "window_start: 2015-11-19 09:00:00.000, total_score: 3, team: MagentaKangaroo"


def test_zone_helpers_across_daylight_saving(spark):
    from pyspark.sql import functions as F

    from rillet.functions.times import display_time, local_option_to_ms

    # 2015-03-08 10:30 UTC is 03:30 PDT (clocks jumped at 02:00 PST); 09:30 UTC is 01:30 PST
    df = spark.createDataFrame([(1425810600000,), (1425807000000,)], "ms long")
    got = [r.t for r in df.select(display_time(F.col("ms")).alias("t")).orderBy("t").collect()]
    assert got == ["2015-03-08 01:30:00.000", "2015-03-08 03:30:00.000"]
    r = spark.range(1).select(local_option_to_ms("2015-07-01-12-00", "yyyy-MM-dd-HH-mm").alias("a"),
                              local_option_to_ms("2015-12-01-12-00", "yyyy-MM-dd-HH-mm").alias("b")).first()
    assert (r.a, r.b) == (1435777200000, 1449000000000)   # 19:00 UTC (PDT) and 20:00 UTC (PST)

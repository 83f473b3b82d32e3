from pyspark.sql import functions as F

from conftest import rows
from rillet.operators import abuse

PAIRS = [("Robot-2", 66), ("Robot-1", 116), ("user7_AndroidGreenKookaburra", 23),
         ("user7_AndroidGreenKookaburra", 1), ("user19_BisqueBilby", 14), ("user13_ApricotQuokka", 15),
         ("user18_BananaEmu", 25), ("user6_AmberEchidna", 8), ("user2_AmberQuokka", 6),
         ("user0_MagentaKangaroo", 4), ("user0_MagentaKangaroo", 3), ("user2_AmberCockatoo", 13),
         ("user7_AlmondWallaby", 15), ("user6_AmberNumbat", 11), ("user6_AmberQuokka", 4)]


def _events(spark, pairs, ms=0):
    df = spark.createDataFrame([(u, "t", s, ms) for u, s in pairs],
                               "user string, team string, score int, timestamp_ms long")
    return df.withColumn("event_time", F.timestamp_millis("timestamp_ms"))


def test_spammers(spark):
    sp = abuse.spammy_users(_events(spark, PAIRS), 60, 2.5)
    assert rows(sp, "user", "total_score") == [("Robot-1", 116), ("Robot-2", 66)]


def test_spam_free_team_sums_per_window(spark):
    ev = _events(spark, PAIRS).unionByName(_events(spark, [("Robot-1", 5), ("a", 4)], ms=3_600_000))
    out = abuse.team_score_without_spammers(ev, 60, 2.5)
    got = dict(rows(out, "window_start", "total_score"))
    total_first = sum(s for _, s in PAIRS) - 116 - 66
    # second window: mean of (5, 4) = 4.5, 2.5x = 11.25, nobody is a spammer there
    assert got == {"1969-12-31 16:00:00.000": total_first, "1969-12-31 17:00:00.000": 9}

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from rillet.session import build_session

    s = build_session("local[4]", shuffle_partitions=8, app_name="rillet-tests")
    yield s
    s.stop()


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())

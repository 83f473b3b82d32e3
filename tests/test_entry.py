"""The driver contract, and every keyed query against its DuckDB oracle at sf0.001."""

import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def n(v):
        return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(n(r[i]) for i in order) for r in rows), key=lambda t: tuple(str(x) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["user", "total_score"] and df.count() > 0


def test_every_key_has_an_oracle():
    missing = {k for k in set(entry.queries()) - set(entry.oracle_sql()) if not re.match(r"op\d+_|pipeline$", k)}
    assert not missing


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    got = _norm([tuple(r) for r in df.collect()], df.columns)
    res = con.execute(entry.oracle_sql()[key])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    type_map = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    duck = {d[0]: str(d[1]) for d in res.description}
    assert {f.name: type_map.get(f.dataType.simpleString()) for f in df.schema.fields} == duck
    assert got == _norm(res.fetchall(), cols)


def test_panes_final_agrees_with_pane_log(spark):
    panes = entry.queries()["leaderboard_team_panes"](spark, SF)
    final = entry.queries()["leaderboard_team_final"](spark, SF)
    last = panes.groupBy("window_start", "team").agg({"pane_index": "max"}).count()
    assert last == final.count() > 0
    assert panes.where("timing NOT IN ('EARLY', 'ON_TIME', 'LATE')").count() == 0

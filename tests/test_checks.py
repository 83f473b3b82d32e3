"""The multiset check: equal data passes without a shuffle of rows, differing rows are told."""

import re

import pytest

from rillet.operators.checks import assert_same_multiset

NAN = float("nan")
ROWS = [(1, "a", 1.5), (1, "a", 1.5), (None, None, None), (2, None, NAN), (2, "", -0.0), (None, "x", NAN), (3, "a", 1e300)]
DDL = "n int, s string, `d.x` double"


def frame(spark, rows, ddl=DDL):
    return spark.createDataFrame(rows, ddl).repartition(3)


def test_equal_whatever_the_order_the_columns_and_the_width(spark):
    a, b = frame(spark, ROWS), frame(spark, ROWS[::-1])
    assert_same_multiset(a, b)
    assert_same_multiset(a.select("`d.x`", "s", "n"), b)
    assert_same_multiset(a.selectExpr("cast(n as bigint) n", "s", "`d.x`"), b)
    assert_same_multiset(frame(spark, [(2, "", 0.0)]), frame(spark, [(2, "", -0.0)]))
    assert_same_multiset(a.limit(0), b.limit(0))
    assert_same_multiset(a.withColumn("more", a.n), b)                  # columns that nobody expects don't count


@pytest.mark.parametrize("change, missing, unexpected", [
    (lambda r: r[1:], "n=1, s='a'", None),                                              # one copy less
    (lambda r: r + r[:1], None, "n=1, s='a'"),
    (lambda r: r[:-1] + [(3, "b", 1e300)], "n=3, s='a'", "n=3, s='b'"),
    (lambda r: [("x", None) and (None, "x", None), *r[:5], r[6]], "n=None, s='x', d.x=nan", "n=None, s='x', d.x=None"),
    (lambda r: [x if x != (2, None, NAN) and x[1] is not None or x[0] is None else (None, "2", NAN) for x in r], "n=2, s=None", "n=None, s='2'"),
])
def test_differing_rows_are_told(spark, change, missing, unexpected):
    with pytest.raises(AssertionError) as e:
        assert_same_multiset(frame(spark, change(list(ROWS))), frame(spark, ROWS))
    told = re.search(r"missing (.*), unexpected (.*)", str(e.value)).groups()
    for want, got in zip((missing, unexpected), told):
        assert (want in got) if want else got == "[]", (want, got)


def test_nulls_are_told_by_their_column(spark):
    with pytest.raises(AssertionError, match="differ"):
        assert_same_multiset(frame(spark, [(None, "1", None)], "n int, s string, t string"),
                             frame(spark, [(None, None, "1")], "n int, s string, t string"))


def test_missing_columns_are_named(spark):
    with pytest.raises(AssertionError, match="missing columns .'s'"):
        assert_same_multiset(frame(spark, ROWS).select("n", "`d.x`"), frame(spark, ROWS))


def test_one_row_among_many(spark):
    a = spark.range(200_000)
    assert_same_multiset(a, spark.range(200_000).selectExpr("199999 - id id"))
    with pytest.raises(AssertionError, match="missing .Row.id=77777.., unexpected .Row.id=-1."):
        assert_same_multiset(a.selectExpr("if(id = 77777, -1, id) id"), a)

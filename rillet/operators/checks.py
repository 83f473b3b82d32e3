"""Dataset assertions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHOWN = 5                   # differing rows told per side
BUCKETS = 4096


def _hash(columns: list[str], seed: int) -> Column:
    """A 64-bit row hash that tells nulls by their column."""
    return F.xxhash64(F.lit(seed), *columns, *[F.col(c).isNull() for c in columns])


def _prints() -> list[Column]:
    """Order-free fingerprint of rows that hold ``_h1`` and ``_h2``: their number and the sums of both hashes."""
    return [F.count(F.lit(1)).alias("n"), F.sum(F.col("_h1").cast("decimal(38,0)")).alias("s1"),
            F.sum(F.col("_h2").cast("decimal(38,0)")).alias("s2")]


def assert_same_multiset(actual: DataFrame, expected: DataFrame) -> None:
    """Fail unless both frames hold the same rows with the same multiplicities.

    Columns are matched by name and compared in their common type; nulls are equal, as are NaNs.  Each side
    is one partial aggregation to its fingerprint (two 64-bit hashes summed, and the count).  Only where they
    differ the sides are compared bucket by bucket (fingerprints of hash buckets), and the rows of the
    buckets that differ one by one: equal data is never shuffled.
    """
    names = expected.columns
    lacking = [c for c in names if c not in actual.columns]
    if lacking:
        raise AssertionError(f"datasets differ; missing columns {lacking}")
    quoted = [f"`{c}`" for c in names]
    common = actual.select(*quoted).limit(0).union(expected.limit(0)).schema
    sides = []
    for side in (actual, expected):
        typed = side.select(*[F.col(q).cast(f.dataType).alias(f.name) for q, f in zip(quoted, common)])
        sides.append(typed.withColumns({"_h1": _hash(quoted, 17), "_h2": _hash(quoted, 29)}))
    whole = [side.agg(*_prints()).first() for side in sides]
    if whole[0] == whole[1]:
        return
    bucket = F.pmod("_h1", F.lit(BUCKETS)).alias("bucket")
    parts = [{r["bucket"]: r[1:] for r in side.groupBy(bucket).agg(*_prints()).collect()} for side in sides]
    differ = [b for b in parts[0].keys() | parts[1].keys() if parts[0].get(b) != parts[1].get(b)]
    a, e = (side.where(F.pmod("_h1", F.lit(BUCKETS)).isin(differ)).select(*quoted) for side in sides)
    missing, extra = e.exceptAll(a).limit(SHOWN).collect(), a.exceptAll(e).limit(SHOWN).collect()
    raise AssertionError(f"datasets differ ({whole[0]['n']} rows, expected {whole[1]['n']}); "
                         f"missing {missing}, unexpected {extra}")

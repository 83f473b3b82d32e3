"""Helpers shared by the operators: text bytes and hashes, joins by measured size, components.

Texts are handled as UTF-8 bytes straight from Arrow buffers.  A word is a
maximal run of bytes outside ``\\x20 \\x09-\\x0D``; as those are ASCII, cutting
bytes cuts code points the same way.  Hashes are 64-bit polynomials over a
random byte table, finished with a mixer: two different words or shingles
agree with probability about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillet.session import materialize

SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
BROADCAST_CELLS = 3_000_000     # a side is broadcast only if counted below this (some dozen MB)
TEXT_ROWS = 1_000               # rows of an Arrow batch that holds whole texts

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BYTE_CODE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[list(SPACE_BYTES)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers = np.ones(1, dtype=np.uint64)


# -- bytes, words, hashes ------------------------------------------------------

def byte_rows(col) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each row of an Arrow string array (empty for null), without copies."""
    if len(col) == 0:
        return
    wide = str(col.type).startswith("large")
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    null = col.is_null().to_numpy(zero_copy_only=False)
    for i in range(len(col)):
        yield raw[0:0] if null[i] else raw[at[i]:at[i + 1]]


def spans(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    if mask.size == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    if mask[0]:
        edge = np.concatenate(([0], edge))
    if mask[-1]:
        edge = np.concatenate((edge, [mask.size]))
    return edge[0::2], edge[1::2]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finisher: every input bit reaches every output bit."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _power(n: int) -> np.ndarray:
    global _powers
    if n > len(_powers):
        _powers = np.cumprod(np.concatenate(([_U(1)], np.full(2 * n, _BASE, dtype=np.uint64))))
    return _powers


def segment_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each non-empty ``raw[start:end]``; segments ascend and don't overlap."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    length = ends - starts
    first = np.cumsum(length) - length
    k = np.arange(int(length.sum())) - np.repeat(first, length)
    value = _BYTE_CODE[raw[k + np.repeat(starts, length)]] * _power(int(length.max()))[k]
    return mix(np.add.reduceat(value, first) ^ (length.astype(np.uint64) * _U(0xD6E8FEB86659FD93)))


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """An order-sensitive hash of each run of ``size`` neighbouring hashes (none if fewer)."""
    n = len(h) - size + 1
    if n <= 0 or size <= 0:
        return np.zeros(0, np.uint64)
    acc = np.full(n, size, dtype=np.uint64)
    for j in range(size):
        acc = mix(acc * _BASE + h[j:j + n])
    return acc


def shingles(raw: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of a text's word ``size``-grams after lower-casing A-Z.

    With fewer words the whole sequence is the one shingle; without words the set is empty.
    """
    raw = LOWER[raw]
    words = segment_hashes(raw, *spans(IS_WORD[raw]))
    return np.unique(window_hashes(words, min(size, len(words))))


# -- frames ---------------------------------------------------------------------

def join_by_size(big: DataFrame, small: DataFrame, on, how: str, cells: Column | None = None) -> DataFrame:
    """Join, broadcasting ``small`` only if its counted cells are within the bound; else Spark chooses.

    Keeps the wide rows of ``big`` (whole texts) out of a shuffle whenever the other side is small.
    ``cells`` is a row's size in values (its columns, if not given); ``small`` is counted, so hand in
    a stored table.
    """
    cells = F.lit(len(small.columns)) if cells is None else cells
    if (small.agg(F.sum(cells)).first()[0] or 0) <= BROADCAST_CELLS:
        small = F.broadcast(small)
    return big.join(small, on, how)


def components(edges: DataFrame, kind: str) -> DataFrame:
    """``id, component``: the smallest id reachable from each end of ``edges`` (``a``, ``b`` long).

    Each round takes the smallest label among a node's neighbours and then the label's own label
    (pointer jumping), so the number of rounds is about the logarithm of the longest path.  A round
    is joins and map-side combined minimums only, and is stored in the shared folder, which cuts the
    lineage.  Null ends and loops are ignored; no edges give an empty frame.
    """
    ends = edges.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).where("u < v").distinct()
    ends = materialize(ends, kind)
    both = ends.union(ends.select(F.col("v").alias("u"), F.col("u").alias("v")))
    state = both.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("m")) \
        .select("id", F.least("id", "m").alias("component"))
    state = materialize(state, kind)
    while True:
        near = both.join(state.select(F.col("id").alias("v"), F.col("component").alias("c")), "v") \
            .groupBy(F.col("u").alias("id")).agg(F.min("c").alias("m"))
        hooked = materialize(state.join(near, "id").select(
            "id", F.least("component", "m").alias("c"), F.col("component").alias("was")), kind)
        jump = hooked.select(F.col("id").alias("c"), F.col("c").alias("component"))
        after = materialize(hooked.join(jump, "c").select("id", "component", "was"), kind)
        state = after.select("id", "component")
        if after.where("component <> was").limit(1).count() == 0:
            return state


def held(df: DataFrame, *columns) -> DataFrame:
    """``columns`` next to all others but ``text``, which go into one struct ``row``: no name can clash."""
    rest = [df[f"`{c}`"] for c in df.columns if c != "text"]
    return df.select(F.struct(*rest).alias("row"), *columns)


def map_texts(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` over rows that hold whole texts, in batches of at most ``TEXT_ROWS`` rows.

    Spark sizes Arrow batches by rows; its default of 10,000 is made for narrow ones.  A lower
    setting of the session stays.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= TEXT_ROWS:
        conf.set(name, str(TEXT_ROWS))
    return df.mapInArrow(function, schema)


def runs(frames, keys: list[str]):
    """The runs of equal ``keys`` in a partition's pandas frames, sorted by them, as dicts of arrays.

    Runs may reach across frames; at most one run and one frame are held.
    """
    rest = None
    for f in frames:
        if not len(f):
            continue
        cols = {c: f[c].to_numpy() for c in f.columns}
        if rest is not None:
            cols = {c: np.concatenate((rest[c], v)) for c, v in cols.items()}
        n = len(cols[keys[0]])
        new = np.zeros(n, bool)
        for k in keys:
            new[1:] |= cols[k][1:] != cols[k][:-1]
        cuts = [0, *np.flatnonzero(new).tolist()]
        for a, b in zip(cuts, cuts[1:]):
            yield {c: v[a:b] for c, v in cols.items()}
        rest = {c: v[cuts[-1]:] for c, v in cols.items()}
    if rest is not None:
        yield rest


# -- small models -----------------------------------------------------------------

def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights (bias last) of a ridge logistic regression on few dense features, by Newton steps."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    penalty = np.full(a.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(a @ w)
        gradient = a.T @ (p - y) + penalty * w
        hessian = (a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


# -- running sums over a whole table ----------------------------------------------

def prefix_sums(df: DataFrame, order: list[str], amounts: dict[str, str], kind: str, by: str | None = None) -> DataFrame:
    """``df`` (stored) with, per ``{new: amount}``, the sum of ``amount`` over the rows before each.

    The order is by the columns ``order``, together unique or their ties alike; ``by`` (a non-null
    column) starts the sums anew per value.  The rows are range-partitioned by ``by`` and ``order``,
    summed within each range, and the ranges' totals (one row per range and value of ``by``) carry
    over, so a value that holds most rows is spread over many tasks.
    """
    group = [by] if by else []
    part = "_range"
    ranged = materialize(df.repartitionByRange(*group, *order).withColumn(part, F.spark_partition_id()), kind)
    inner = Window.partitionBy(part, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(part, *group).agg(*[F.sum(a).alias(n) for n, a in amounts.items()])
    carry = totals.select(part, *group, *[F.coalesce(F.sum(n).over(outer), F.lit(0)).alias(f"_carry_{n}") for n in amounts])
    out = ranged.withColumns({n: F.coalesce(F.sum(a).over(inner), F.lit(0)) for n, a in amounts.items()})
    out = out.join(carry, [part, *group])
    return out.select(*df.columns, *[(F.col(n) + F.col(f"_carry_{n}")).alias(n) for n in amounts])

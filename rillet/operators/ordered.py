"""Order-dependent scans per key (sessions, running totals) that survive a hot key.

A plain ``Window.partitionBy(key).orderBy(t)`` sends every row of a key to one
task; if one user or team holds a third of all rows, that task holds a third
of the data.  Here each key's rows are cut into time chunks (one-hour cells,
heavy cells sliced further, see ``_with_chunks``): the row-level window runs
per ``(key, chunk)`` (many balanced tasks), and the only cross-chunk state
is carried through a per-chunk summary whose size is bounded by the number
of chunks, not by the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillet.session import materialize

# Cell length: the summary holds one row per (key, cell with rows), and a
# cell with more than DEFAULT_TARGET_ROWS rows is sliced, so no task holds
# much more than that many rows of one key whatever the data volume.
DEFAULT_CHUNK_MS = 60 * 60_000
DEFAULT_TARGET_ROWS = 4_000_000   # rows per chunk above which a cell is split
_SPLIT_BASE = 1 << 20             # sub-chunks per cell at most; chunk id = cell * base + sub


def _chunk(ts_col: str, chunk_ms: int):
    return F.expr(f"(`{ts_col}` - pmod(`{ts_col}`, {chunk_ms}L)) div {chunk_ms}L")


def _with_chunks(rows: DataFrame, keys: list[str], ts_col: str, chunk_ms: int,
                 target_rows: int | None, tiebreak: str | None = None) -> DataFrame:
    """Add ``_chunk``: time cells of ``chunk_ms``, and heavy cells cut into sub-chunks.

    A cell (key, time cell) with n > ``target_rows`` rows is cut into about n / target slices,
    so a key that is hot inside one cell is spread too.  Chunk ids grow with time within a
    key.  The heavy cells are found by a partial-aggregated count; there are
    at most total rows / target of them, so that table stays small.

    Without ``tiebreak`` the slices are equal parts of the cell's observed time span.  With it
    they hold equal numbers of rows, see ``_even_slices``; nothing of that is planned where the
    count, which runs now, finds no heavy cell.
    """
    cell = _chunk(ts_col, chunk_ms)
    x = rows.withColumn("_cell", cell)
    if not target_rows:
        return x.withColumn("_chunk", F.col("_cell") * F.lit(_SPLIT_BASE)).drop("_cell")
    counts = x.groupBy(*keys, "_cell")
    if tiebreak:
        heavy = materialize(counts.agg(F.count(F.lit(1)).alias("_n_cell"))
                            .where(F.col("_n_cell") > target_rows).select(*keys, "_cell"), "heavy-cells")
        if not heavy.limit(1).count():
            return x.withColumn("_chunk", F.col("_cell") * F.lit(_SPLIT_BASE)).drop("_cell")
        light = x.join(heavy, [*keys, "_cell"], "left_anti").withColumn("_sub", F.lit(0).cast("bigint"))
        dense = x.join(heavy, [*keys, "_cell"], "left_semi")
        x = light.unionByName(_even_slices(dense, keys, ts_col, target_rows, tiebreak))
        return x.withColumn("_chunk", F.col("_cell") * F.lit(_SPLIT_BASE) + F.col("_sub")).drop("_cell", "_sub")
    heavy = counts.agg(F.count(F.lit(1)).alias("_n_cell"), F.min(ts_col).alias("_lo"), F.max(ts_col).alias("_hi")) \
        .where(F.col("_n_cell") > target_rows).select(
            *keys, "_cell", "_lo", (F.col("_hi") - F.col("_lo") + 1).alias("_span"),
            F.least(F.ceil(F.col("_n_cell") / F.lit(target_rows)), F.lit(_SPLIT_BASE)).cast("bigint").alias("_k"))
    x = x.join(heavy, [*keys, "_cell"], "left")
    pos = (F.col(ts_col) - F.col("_lo")).cast("double")
    sub = F.when(F.col("_k").isNull(), F.lit(0)).otherwise(
        F.least(F.floor(pos * F.col("_k") / F.col("_span")), F.col("_k") - 1).cast("bigint"))
    return (x.withColumn("_chunk", F.col("_cell") * F.lit(_SPLIT_BASE) + sub)
            .drop("_cell", "_k", "_lo", "_span"))


def _even_slices(rows: DataFrame, keys: list[str], ts_col: str, target_rows: int, tiebreak: str) -> DataFrame:
    """Add ``_sub`` to the rows of heavy cells: slices of ``target_rows`` rows in (time, tiebreak) order.

    The rows are counted by instant (map-side combined; a cell has as many instants as milliseconds at
    most) and the counts summed up along the cell.  A row's slice follows from the rows before its instant
    and its own place in it, which is taken from where the tiebreak stands between the instant's least and
    greatest: an instant that holds most of a cell is cut as evenly as its tiebreaks are spread.
    """
    instant = [*keys, "_cell", ts_col]
    counts = rows.groupBy(*instant).agg(F.count(F.lit(1)).alias("_n"), F.min(tiebreak).alias("_tlo"),
                                        F.max(tiebreak).alias("_thi"))
    earlier = Window.partitionBy(*keys, "_cell").orderBy(ts_col).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    x = rows.join(counts, instant)
    place = (F.col(tiebreak) - F.col("_tlo")).cast("double") / (F.col("_thi") - F.col("_tlo") + 1).cast("double")
    rank = F.col("_before") + F.floor(F.coalesce(place, F.lit(0.0)) * F.col("_n"))
    sub = F.least(F.floor(rank / F.lit(target_rows)), F.lit(_SPLIT_BASE - 1)).cast("bigint")
    return x.withColumn("_sub", sub).drop("_n", "_tlo", "_thi", "_before")


def session_starts(rows: DataFrame, keys: Sequence[str], ts_col: str, gap_ms: int,
                   chunk_ms: int = DEFAULT_CHUNK_MS, extra_order: Sequence[str] = (),
                   target_rows: int | None = DEFAULT_TARGET_ROWS) -> DataFrame:
    """Add ``session_start`` (same unit as ``ts_col``, epoch ms) to every row.

    A row opens a session when the previous row of its key is ``gap_ms`` or
    more earlier (half-open ``[t, t + gap)`` activity intervals that merely
    touch do not merge).  Rows with a NULL key or time are dropped.
    """
    keys = list(keys)
    ts = F.col(ts_col)
    # Rows without a time cannot be placed in a session; keys are never NULL
    # after parsing.  Stating both up front gives the two consumers of the
    # row-level pass identical plans, so Spark reuses its shuffle.
    not_null = ts.isNotNull()
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    x = _with_chunks(rows.where(not_null), keys, ts_col, chunk_ms, target_rows)
    x = x.where(F.col("_chunk").isNotNull())
    # extra_order: columns that do not change the order (times are unique per
    # key) but that both consumers then read, keeping their plans identical
    w_in = Window.partitionBy(*keys, "_chunk").orderBy(ts_col, *extra_order)
    prev = F.lag(ts).over(w_in)
    x = x.withColumn("_inner_start", F.when(prev.isNotNull() & (ts - prev >= gap_ms), ts))
    x = x.withColumn("_local_start", F.max("_inner_start").over(
        w_in.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    summary = x.groupBy(*keys, "_chunk").agg(
        F.min(ts).alias("_cmin"), F.max(ts).alias("_cmax"), F.max("_inner_start").alias("_last_inner"))
    w_c = Window.partitionBy(*keys).orderBy("_chunk")
    prev_max = F.lag("_cmax").over(w_c)
    summary = summary.withColumn(
        "_first_is_start", prev_max.isNull() | (F.col("_cmin") - prev_max >= gap_ms))
    summary = summary.withColumn(
        "_cand", F.coalesce("_last_inner", F.when(F.col("_first_is_start"), F.col("_cmin"))))
    carried = F.max("_cand").over(w_c.rowsBetween(Window.unboundedPreceding, -1))
    summary = summary.select(
        *keys, "_chunk",
        F.when(F.col("_first_is_start"), F.col("_cmin")).otherwise(carried).alias("_entry_start"))

    out = x.join(summary, [*keys, "_chunk"])
    return (out.withColumn("session_start", F.coalesce("_local_start", "_entry_start"))
            .drop("_chunk", "_inner_start", "_local_start", "_entry_start"))


def running_sum(rows: DataFrame, keys: Sequence[str], order_cols: Sequence[str], value_col: str,
                ts_col: str, out_col: str = "running_total",
                chunk_ms: int = DEFAULT_CHUNK_MS, target_rows: int | None = DEFAULT_TARGET_ROWS) -> DataFrame:
    """Add the inclusive running sum of ``value_col`` per key in ``order_cols`` order.

    ``order_cols`` must start with ``ts_col`` (the chunking column) so that
    chunk order agrees with row order.  Rows with a NULL key or time are
    dropped.
    """
    keys = list(keys)
    not_null = F.col(ts_col).isNotNull()
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    tiebreak = order_cols[1] if len(order_cols) == 2 else None
    x = _with_chunks(rows.where(not_null), keys, ts_col, chunk_ms, target_rows, tiebreak)
    x = x.where(F.col("_chunk").isNotNull())
    w_in = (Window.partitionBy(*keys, "_chunk").orderBy(*order_cols)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    x = x.withColumn("_local", F.sum(value_col).over(w_in))
    # A chunk's total is the running value at its last row: taken from the
    # same row-level pass, so both consumers share one shuffle of the rows.
    last = F.struct(*[F.col(c) for c in order_cols])
    totals = x.groupBy(*keys, "_chunk").agg(F.max_by("_local", last).alias("_ctotal"))
    w_c = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_chunk", F.coalesce(F.sum("_ctotal").over(w_c), F.lit(0)).alias("_off"))
    out = x.join(offsets, [*keys, "_chunk"])
    return (out.withColumn(out_col, (F.col("_off") + F.col("_local")).cast("bigint"))
            .drop("_chunk", "_local", "_off"))

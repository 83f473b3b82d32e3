"""Level crossings on a stream: each team's running total, kept from micro-batch to micro-batch.

Within a micro-batch a team's rows are applied in (event time, event id)
order; across batches in arrival order, as a stream must.

* ``crossings_sink``: the totals are a small table per micro-batch, and a micro-batch is a
  batch scan (``ordered.running_sum``), so a hot team's rows are spread over many tasks.
* ``level_crossings``: the same with keyed state, as a plain stream; a team's rows of one
  micro-batch are held together to be ordered, so bound the batch at the source.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rillet.model import LEVEL_THRESHOLD
from rillet.operators.levels import crossed
from rillet.operators.ordered import DEFAULT_CHUNK_MS, DEFAULT_TARGET_ROWS, running_sum
from rillet.sinks.table import batch_path

LEVEL_STATE = T.StructType([T.StructField("total", T.LongType())])


def _tdiv(a: np.ndarray, t: int) -> np.ndarray:
    """Integer division truncating toward zero (Java semantics)."""
    return np.sign(a) * (np.abs(a) // t)


def level_crossings(events: DataFrame, threshold: int = LEVEL_THRESHOLD,
                    keys: Sequence[str] = ("team",)) -> DataFrame:
    """``*keys, event_id, total_score`` whenever ``old div t < new div t``."""
    keys = list(keys)
    out_schema = T.StructType(
        [events.schema[k] for k in keys]
        + [T.StructField("event_id", T.LongType()), T.StructField("total_score", T.LongType())])
    t = int(threshold)

    def step(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        total = int(state.get[0]) if state.exists else 0
        batch = pd.concat(list(pdfs), ignore_index=True).sort_values(["timestamp_ms", "event_id"])
        after = total + np.cumsum(batch["score"].to_numpy(np.int64))
        before = after - batch["score"].to_numpy(np.int64)
        state.update((int(after[-1]),))
        hit = _tdiv(before, t) < _tdiv(after, t)
        if hit.any():
            cols = {k: [v] * int(hit.sum()) for k, v in zip(keys, key)}
            cols.update({"event_id": batch["event_id"].to_numpy()[hit], "total_score": after[hit]})
            yield pd.DataFrame(cols)

    return (events.select(*keys, "event_id", "timestamp_ms", "score").groupBy(*keys)
            .applyInPandasWithState(step, out_schema, LEVEL_STATE, "append", GroupStateTimeout.NoTimeout))


def crossings_sink(events: DataFrame, path: str, totals_path: str, checkpoint: str, threshold: int = LEVEL_THRESHOLD,
                   keys: Sequence[str] = ("team",), shown: Sequence[Column] = (), chunk_ms: int = DEFAULT_CHUNK_MS,
                   target_rows: int | None = DEFAULT_TARGET_ROWS):
    """A writer of ``*keys, event_id, total_score, *shown`` to a folder per micro-batch (start it yourself).

    A micro-batch reads the totals that the one before it left (one row per key), adds its own running
    sums and leaves the new totals.  Both folders are its own, so one that runs again replaces them.
    """
    keys = list(keys)
    totals_type = T.StructType([events.schema[k] for k in keys] + [T.StructField("total", T.LongType())])

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            before = spark.read.schema(totals_type).parquet(batch_path(totals_path, batch_id - 1)) if batch_id else \
                spark.createDataFrame([], totals_type)
            base = before.withColumnRenamed("total", "_base")
            runs = running_sum(batch, keys, ["timestamp_ms", "event_id"], "score", "timestamp_ms", "_run", chunk_ms,
                               target_rows)
            total = (F.coalesce("_base", F.lit(0)) + F.col("_run")).cast("bigint")
            runs = runs.join(base, keys, "left").withColumn("total_score", total)
            runs.where(crossed("total_score", "score", threshold)).select(*keys, "event_id", "total_score", *shown) \
                .write.mode("overwrite").parquet(batch_path(path, batch_id))
            added = batch.select(*keys, F.col("score").cast("bigint").alias("total"))
            before.unionByName(added).groupBy(*keys).agg(F.sum("total").alias("total")) \
                .write.mode("overwrite").parquet(batch_path(totals_path, batch_id))
        finally:
            batch.unpersist()

    return (events.select(*keys, "event_id", "timestamp_ms", "score").writeStream.outputMode("append")
            .option("checkpointLocation", checkpoint).foreachBatch(per_batch))

"""Game statistics on a stream.

One stateful step: an append-mode sum per (window, user, team) with a
watermark.  A window's groups all leave state in the micro-batch where the
watermark passes its end, so ``foreachBatch`` can compute the mean, the
spammers, the anti join and the team sums for those windows as plain batch
operations (no stream-stream join).  Session means chain a session-window
aggregate into a fixed-window mean, both in append mode.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.functions.times import display_time
from rillet.model import SCORE_WEIGHT, SESSION_GAP_MINUTES, SESSION_MEAN_WINDOW_MINUTES, TEAM_WINDOW_MINUTES
from rillet.operators.abuse import observe_spammers, spammers_from_sums
from rillet.sinks.table import batch_path
from rillet.streaming.counters import record


def window_user_team_sums(events: DataFrame, window_minutes: int = TEAM_WINDOW_MINUTES,
                          delay: str = "0 seconds") -> DataFrame:
    return (events.withWatermark("event_time", delay)
            .groupBy(F.window("event_time", f"{window_minutes} minutes").alias("window"), "user", "team")
            .agg(F.sum("score").alias("score_sum"))
            .select(F.unix_millis(F.col("window.start")).alias("ws"), "user", "team", "score_sum"))


def spam_outputs(spam_path: str, team_path: str, checkpoint: str, stream: DataFrame,
                 weight: float = SCORE_WEIGHT, without_user: str | None = None, counters: str | None = None):
    """Write spammers and spam-free team sums for every closed window, with its start and the processing time.

    The spammers are found once a micro-batch and read back for the sums.  ``counters`` is a counter
    folder for their number.
    """
    shown = [display_time(F.col("ws")).alias("window_start"),
             display_time(F.unix_millis(F.current_timestamp())).alias("processing_time")]

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        if without_user is not None:
            batch = batch.where(F.col("user") != without_user)
        batch.persist()
        try:
            found, seen = observe_spammers(spammers_from_sums(batch, weight), f"spammers-{uuid.uuid4().hex}")
            found = found.select("*", *shown)
            found.write.mode("overwrite").parquet(batch_path(spam_path, batch_id))
            if counters:
                record(counters, "spammers", batch_id, seen.get)
            spam = batch.sparkSession.read.schema(found.schema).parquet(batch_path(spam_path, batch_id))
            clean = batch.join(spam.select("ws", "user"), ["ws", "user"], "left_anti")
            (clean.groupBy("ws", "team").agg(F.sum("score_sum").alias("total_score")).select("*", *shown)
             .write.mode("overwrite").parquet(batch_path(team_path, batch_id)))
        finally:
            batch.unpersist()

    return stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(per_batch)


def session_mean_stream(events: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES,
                        window_minutes: int = SESSION_MEAN_WINDOW_MINUTES, delay: str = "0 seconds",
                        without_user: str | None = None) -> DataFrame:
    """``ws, mean_duration`` in append mode.

    Spark's session window merges events exactly one gap apart; the gap is
    shortened by 1 microsecond (event times are whole ms) so touching
    activity intervals stay apart, as in the batch form, and the end is
    rounded back up to the whole millisecond.  ``without_user`` moves the
    watermark but its sessions don't count (a bounded input's end mark).
    """
    gap_ms = gap_minutes * 60_000
    sess = (events.withWatermark("event_time", delay)
            .groupBy("user", F.session_window("event_time", f"{gap_ms * 1000 - 1} microseconds").alias("s"))
            .agg(F.max(F.col("user") == F.lit(without_user)).alias("mark"))
            .select("mark", F.col("s.start").alias("start"),
                    (F.unix_millis(F.col("s.end")) + 1).alias("end_ms"),
                    F.window_time("s").alias("at")))
    if without_user is not None:
        # on an aggregate: a filter on the key itself would be pushed below the watermark
        sess = sess.where(~F.col("mark"))
    dur = sess.select(F.floor((F.col("end_ms") - F.unix_millis("start")) / 60_000).alias("minutes"), "at")
    return (dur.groupBy(F.window("at", f"{window_minutes} minutes").alias("w"))
            .agg(F.avg("minutes").alias("mean_duration"))
            .select(F.unix_millis(F.col("w.start")).alias("ws"), "mean_duration"))

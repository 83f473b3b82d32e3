"""Text sinks.

Per-window output uses ``partitionBy`` on full window timestamps (so days
never collide, unlike HH:mm-only names) and, for a fixed shard count, a
``repartition`` on (window, shard) so each window gets exactly ``n`` files
written in parallel by different tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.functions.times import display_time

_WINDOW_FMT = "yyyy-MM-dd'T'HH-mm-ss"


def write_text(df: DataFrame, path: str, line_col: str = "line", num_shards: int | None = None,
               mode: str = "overwrite") -> None:
    """One line per row; ``num_shards`` fixes the file count (else one per task)."""
    out = df.select(F.col(line_col).alias("value"))
    if num_shards:
        out = out.repartition(num_shards)
    out.write.mode(mode).text(path)


def write_per_window(df: DataFrame, path: str, window_col: str = "window", line_col: str = "line",
                     num_shards: int | None = None, mode: str = "overwrite", zone: str = "UTC") -> None:
    """Files under ``window_start=<start>/window_end=<end>/[shard=<k>/]``, named in ``zone``'s wall clock.

    With ``num_shards`` each window has up to that many shard folders of one file each.
    Without, rows are rebalanced by window: small windows end up in one file, and
    adaptive execution splits a large one over several tasks and files.
    """
    if window_col not in df.columns:
        raise ValueError(f"per-window output needs an interval window column {window_col!r}")
    w = F.col(window_col)
    out = df.select(
        display_time(F.unix_millis(w.start), zone, _WINDOW_FMT).alias("window_start"),
        display_time(F.unix_millis(w.end), zone, _WINDOW_FMT).alias("window_end"),
        F.col(line_col).alias("value"))
    if num_shards:
        # shard k of a window is the folder .../shard=k, written by one task
        # (the repartition puts each (window, shard) in one task): one file
        # per shard, at most num_shards per window, shards written in parallel.
        shard = F.pmod(F.xxhash64("value"), F.lit(num_shards)).cast("int")
        out = (out.withColumn("shard", shard)
               .repartition("window_start", "window_end", "shard"))
        out.write.mode(mode).partitionBy("window_start", "window_end", "shard").text(path)
        return
    out = out.hint("rebalance", "window_start", "window_end")
    out.write.mode(mode).partitionBy("window_start", "window_end").text(path)


def write_windowed_text(df: DataFrame, path: str, window_col: str = "window", line_col: str = "line",
                        mode: str = "overwrite", zone: str = "UTC") -> None:
    """The game form: three shards per window (the job names them in its local zone)."""
    write_per_window(df, path, window_col, line_col, 3, mode, zone)


def window_label(window_col: str = "window"):
    """Display form of a window's start and end, for file names or rows."""
    w = F.col(window_col)
    return F.concat_ws("-", display_time(F.unix_millis(w.start)), display_time(F.unix_millis(w.end)))


def publish_topic(stream: DataFrame, bootstrap_servers: str, topic: str, checkpoint: str,
                  value_col: str = "value"):
    """Streaming writer publishing ``value_col`` strings to a Kafka topic (start it yourself)."""
    return (stream.select(F.col(value_col).cast("string").alias("value")).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic)
            .option("checkpointLocation", checkpoint))

"""Person records on a stream: valid people (rendered, with the minor flag) and
invalid raw lines to two topics, or valid people appended to a table (invalid
lines discarded)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.operators.people import INVALID, VALID, people, people_text, table_rows, tag_lines
from rillet.sinks.table import batch_path
from rillet.sources import topics


def split_to_topics(lines: DataFrame, valid_path: str, invalid_path: str, checkpoint: str):
    """One query, two text "topics": each micro-batch is tagged once and written twice."""
    tagged = tag_lines(lines)

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            # one folder per batch, overwritten if the batch is replayed: exactly once
            people_text(people(batch.where(F.col("tag") == VALID))).write.mode("overwrite").text(
                batch_path(valid_path, batch_id))
            batch.where(F.col("tag") == INVALID).select("value").write.mode("overwrite").text(
                batch_path(invalid_path, batch_id))
        finally:
            batch.unpersist()

    return tagged.writeStream.option("checkpointLocation", checkpoint).foreachBatch(publish)


def split_to_message_topics(lines: DataFrame, valid_topic: str, invalid_topic: str, checkpoint: str):
    """One query, two topics of messages: a micro-batch is tagged once and published once to each."""
    producer = topics.producer_of(lines.sparkSession, checkpoint)
    tagged = tag_lines(lines)

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            valid = people_text(people(batch.where(F.col("tag") == VALID))).select(F.col("line").alias("value"))
            topics.send(valid, valid_topic, producer, batch_id)
            topics.send(batch.where(F.col("tag") == INVALID).select("value"), invalid_topic, producer, batch_id)
        finally:
            batch.unpersist()

    return tagged.writeStream.option("checkpointLocation", checkpoint).foreachBatch(publish)


def to_table(lines: DataFrame, path: str, checkpoint: str):
    """Valid people's five columns appended to a Parquet table."""
    valid = tag_lines(lines).where(F.col("tag") == VALID).select("value")
    rows = table_rows(people(valid))
    return (rows.writeStream.outputMode("append").format("parquet")
            .option("path", path).option("checkpointLocation", checkpoint))

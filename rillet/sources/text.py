"""Text sources: files (batch), staged line folders and file streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rillet.model import LINE_SCHEMA


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line (``value``) of every file matching ``path`` (path or glob)."""
    return spark.read.text(path)


def stage_lines(df: DataFrame, path: str, order_col: str | None = None,
                num_files: int | None = None) -> str:
    """Write the ``value`` column (plus nothing else) as text files under ``path``.

    Used to stand in for a message topic: a file stream then reads the folder.
    With ``order_col`` the files hold disjoint, ordered ranges of that column.
    """
    out = df
    if order_col is not None:
        out = out.repartitionByRange(num_files or df.sparkSession.sparkContext.defaultParallelism, order_col)
        out = out.sortWithinPartitions(order_col)
    elif num_files is not None:
        out = out.repartition(num_files)
    out.select("value").write.mode("overwrite").text(path)
    return path


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Unbounded ``value`` rows from text files arriving in ``path``."""
    reader = spark.readStream.schema(LINE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.text(path)


def stream_messages(spark: SparkSession, path: str, attribute: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Unbounded ``value`` and ``attribute_ms`` (BIGINT) from JSON-line files of messages arriving in ``path``.

    A message is ``{"value": "...", "attributes": {"<attribute>": "<ms>"}}``; ``attribute_ms`` is null
    where the attribute is missing or no number.
    """
    from pyspark.sql import functions as F

    lines = stream_lines(spark, path, max_files_per_trigger)
    message = F.from_json("value", "value string, attributes map<string, string>").alias("m")
    return lines.select(message).select("m.value", F.col("m.attributes")[attribute].try_cast("bigint").alias("attribute_ms"))


def stream_topic(spark: SparkSession, bootstrap_servers: str, topic: str,
                 starting_offsets: str = "latest", attribute: str | None = "timestamp_ms",
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Unbounded ``value`` strings from a Kafka topic (needs the spark-sql-kafka
    connector on the classpath; Spark reports a missing data source otherwise).

    With ``attribute`` the message header of that name is exposed as
    ``attribute_ms`` (BIGINT), for jobs that take event time from a message
    attribute instead of the payload.
    """
    from pyspark.sql import functions as F

    df = (spark.readStream.format("kafka")
          .option("kafka.bootstrap.servers", bootstrap_servers)
          .option("subscribe", topic)
          .option("startingOffsets", starting_offsets)
          .option("includeHeaders", "true"))
    if max_offsets_per_trigger:
        df = df.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    df = df.load()
    cols = [F.col("value").cast("string").alias("value")]
    if attribute:
        header = F.filter(F.col("headers"), lambda h: h["key"] == F.lit(attribute))
        cols.append(F.get(header, 0)["value"].cast("string").try_cast("bigint").alias("attribute_ms"))
    return df.select(*cols)

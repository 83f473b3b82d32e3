"""Topics of messages in a shared folder, as a Spark data source.

A message has a key, a value and attributes.  Producers (streaming queries, or single batch writes) own a
subfolder each and publish by commits:

    <topic>/<producer>/data/<unique>.parquet      messages, written by tasks
    <topic>/<producer>/commit-000000000007.json   the files that commit 7 makes visible

Tasks stage files; the commit names them in one step, so a failed or repeated attempt shows nothing, and
a commit that is there already stays (a replayed micro-batch publishes once).  A reader's offset is the
number of commits read of each producer, kept in the query's checkpoint; each file is one input partition.

It is a connector only: nothing runs between jobs.  Messages of one commit have no order among themselves.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader,
    InputPartition, WriterCommitMessage,
)

from rillet.functions.files import is_file, open_folder, put, read_bytes, remove

FORMAT = "message_folder"
MESSAGE_SCHEMA = "key string, value string, attributes map<string, string>"
#: Fixed value: the attribute that holds a message's event time.
TIMESTAMP_ATTRIBUTE = "timestamp_ms"


class _Folder:
    """The files of one topic."""

    def __init__(self, path: str):
        from pyarrow import fs

        self._files = fs
        self.fs, self.root = open_folder(path)

    def _commit(self, producer: str, number: int) -> str:
        return f"{self.root}/{producer}/commit-{number:012d}.json"

    def _exists(self, path: str) -> bool:
        return is_file(self.fs, path)

    def offsets(self, known: dict) -> dict:
        """Commits of each producer; one known before is only looked at from there on."""
        listed = self.fs.get_file_info(self._files.FileSelector(self.root, allow_not_found=True))
        out = {}
        for producer in sorted(x.base_name for x in listed if x.type == self._files.FileType.Directory):
            n = known.get(producer)
            if n is None:
                inside = self.fs.get_file_info(self._files.FileSelector(f"{self.root}/{producer}"))
                names = {x.base_name for x in inside}
                n = 0
                while f"commit-{n:012d}.json" in names:
                    n += 1
            while self._exists(self._commit(producer, n)):
                n += 1
            out[producer] = n
        return out

    def files(self, start: dict, end: dict) -> list[_File]:
        out = []
        for producer, last in sorted(end.items()):
            for number in range(start.get(producer, 0), last):
                named = json.loads(read_bytes(self.fs, self._commit(producer, number)))["files"]
                out += [_File(f"{self.root}/{x}") for x in named]
        return out

    def stage(self, producer: str, batches) -> _Staged:
        """Write a task's messages to a file that no commit names yet."""
        import pyarrow as pa
        import pyarrow.parquet as pq

        schema = pa.schema([("key", pa.string()), ("value", pa.string()),
                            ("attributes", pa.map_(pa.string(), pa.string()))])
        name, writer, sink, rows = f"{producer}/data/{uuid.uuid4().hex}.parquet", None, None, 0
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if writer is None:
                    self.fs.create_dir(f"{self.root}/{producer}/data", recursive=True)
                    sink = self.fs.open_output_stream(f"{self.root}/{name}")
                    writer = pq.ParquetWriter(sink, schema, compression="zstd")
                columns = [batch.column(f.name).cast(f.type) if f.name in batch.schema.names
                           else pa.nulls(batch.num_rows, f.type) for f in schema]
                writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=schema))
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
                sink.close()
        return _Staged(name if rows else "", rows)

    def publish(self, producer: str, number: int, staged: list) -> bool:
        """Make the staged files visible as commit ``number``; False (and the files go) if it is there already."""
        target = self._commit(producer, number)
        if self._exists(target):
            self.discard(staged)
            return False
        put(self.fs, target, json.dumps({"files": [x.name for x in staged if x and x.name],
                                         "rows": sum(x.rows for x in staged if x)}).encode())
        return True

    def discard(self, staged: list) -> None:
        for x in staged:
            if x and x.name:
                remove(self.fs, f"{self.root}/{x.name}")

    def read(self, path: str):
        import pyarrow.parquet as pq

        with self.fs.open_input_file(path) as f:
            yield from pq.ParquetFile(f).iter_batches()


@dataclass
class _File(InputPartition):
    path: str


@dataclass
class _Staged(WriterCommitMessage):
    name: str
    rows: int


class _StreamReader(DataSourceStreamReader):
    def __init__(self, path: str, latest: bool):
        self._path, self._latest, self._known = path, latest, {}

    def initialOffset(self) -> dict:
        return _Folder(self._path).offsets({}) if self._latest else {}

    def latestOffset(self) -> dict:
        self._known = _Folder(self._path).offsets(self._known)
        return self._known

    def partitions(self, start: dict, end: dict):
        return _Folder(self._path).files(start, end)

    def read(self, partition):
        yield from _Folder(self._path).read(partition.path)


class _BatchReader(DataSourceReader):
    def __init__(self, path: str):
        self._path = path

    def partitions(self):
        folder = _Folder(self._path)
        return folder.files({}, folder.offsets({})) or [_File("")]

    def read(self, partition):
        if partition.path:
            yield from _Folder(self._path).read(partition.path)


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, producer: str):
        self._path, self._producer = path, producer

    def write(self, iterator):
        return _Folder(self._path).stage(self._producer, iterator)

    def commit(self, messages, batchId: int) -> None:
        _Folder(self._path).publish(self._producer, batchId, messages)

    def abort(self, messages, batchId: int) -> None:
        _Folder(self._path).discard(messages)


class _BatchWriter(DataSourceArrowWriter):
    def __init__(self, path: str, producer: str, number: int):
        self._path, self._producer, self._number = path, producer, number

    def write(self, iterator):
        return _Folder(self._path).stage(self._producer, iterator)

    def commit(self, messages) -> None:
        _Folder(self._path).publish(self._producer, self._number, messages)

    def abort(self, messages) -> None:
        _Folder(self._path).discard(messages)


class MessageFolder(DataSource):
    """Options: ``path``; reading ``startingOffsets`` (earliest or latest); writing ``producer`` and ``commit``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return MESSAGE_SCHEMA

    def _path(self) -> str:
        path = self.options.get("path")
        if not path:
            raise ValueError(f"{FORMAT} needs a path")
        return path

    def _wants_value(self, schema) -> None:
        if "value" not in schema.names or set(schema.names) - {"key", "value", "attributes"}:
            raise ValueError(f"messages have the columns {MESSAGE_SCHEMA}, not {schema.simpleString()}")

    def reader(self, schema):
        return _BatchReader(self._path())

    def streamReader(self, schema):
        start = self.options.get("startingOffsets", "earliest")
        if start not in ("earliest", "latest"):
            raise ValueError(f"startingOffsets is earliest or latest, not {start!r}")
        return _StreamReader(self._path(), start == "latest")

    def writer(self, schema, overwrite: bool):
        self._wants_value(schema)
        return _BatchWriter(self._path(), self.options.get("producer") or uuid.uuid4().hex,
                            int(self.options.get("commit", "0")))

    def streamWriter(self, schema, overwrite: bool):
        self._wants_value(schema)
        if not self.options.get("producer"):
            raise ValueError("a stream needs a producer that is the checkpoint's own (see publish)")
        return _StreamWriter(self._path(), self.options["producer"])


def _registered(spark: SparkSession) -> SparkSession:
    try:
        spark.dataSource.register(MessageFolder)
    except AnalysisException as e:                         # also said in sessions cloned for a stream, which hold it
        if e.getCondition() != "DATA_SOURCE_ALREADY_EXISTS":
            raise
    return spark


def producer_of(spark: SparkSession, checkpoint: str) -> str:
    """The producer that belongs to a checkpoint folder: drawn once, kept in it.

    A query that starts over with a new checkpoint counts its micro-batches from 0 again, under a new name.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/producer")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        out = files.create(path, False)
        out.write(bytearray(uuid.uuid4().hex.encode()))
        out.close()
    return spark.read.text(path.toString()).first()[0]


def read_messages(spark: SparkSession, topic: str) -> DataFrame:
    """All messages published so far."""
    return _registered(spark).read.format(FORMAT).load(topic)


def stream_messages(spark: SparkSession, topic: str, attribute: str = TIMESTAMP_ATTRIBUTE,
                    starting: str = "earliest") -> DataFrame:
    """Unbounded ``value`` and ``attribute_ms`` (BIGINT; null where the attribute is missing or no number)."""
    messages = _registered(spark).readStream.format(FORMAT).option("startingOffsets", starting).load(topic)
    return messages.select("value", F.col("attributes")[attribute].try_cast("bigint").alias("attribute_ms"))


def send(messages: DataFrame, topic: str, producer: str | None = None, commit: int = 0) -> None:
    """Publish a batch of messages in one commit; one that ``producer`` has published already is left as it is."""
    writer = messages.write.format(FORMAT).mode("append").option("commit", str(commit))
    _registered(messages.sparkSession)
    (writer.option("producer", producer) if producer else writer).save(topic)


def publish(messages: DataFrame, topic: str, checkpoint: str):
    """A stream writer that publishes every micro-batch of ``messages`` once (start it yourself)."""
    spark = _registered(messages.sparkSession)
    return (messages.writeStream.format(FORMAT).option("path", topic).option("checkpointLocation", checkpoint)
            .option("producer", producer_of(spark, checkpoint)))

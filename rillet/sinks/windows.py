"""Text files per window from an unbounded input, each window's shards published once.

A stream in append mode emits the rows of a window when the watermark has passed it, all in one
micro-batch.  Tasks write each (window, shard) they hold to a staged file; the commit on the driver first
notes, in one step, which staged file becomes which shard, then moves them:

    <path>/window_start=<start>/window_end=<end>/shard=<k>/part.txt     exactly `shards` of them a window
    <path>/_staged/<unique>.txt                                         not yet, or never, published
    <path>/_commits/<micro-batch>.json                                  the notes

Killed before the note, nothing of the micro-batch shows and it runs again; killed after it, the next
attempt finishes the noted moves and drops its own files.  Shards without rows are empty files.

A task puts the rows of its part of a micro-batch in order in memory, so bound micro-batches at the
source.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

from rillet.functions.files import is_file, open_folder, put, read_bytes, remove
from rillet.functions.times import display_time
from rillet.sinks.text import _WINDOW_FMT

FORMAT = "window_files"
_COLUMNS = ["window_start", "window_end", "shard", "value"]


@dataclass
class _Shards(WriterCommitMessage):
    files: list = field(default_factory=list)        # (window start, window end, shard, staged name)


class _Writer(DataSourceStreamArrowWriter):
    def __init__(self, path: str, shards: int):
        self._path, self._shards = path, shards

    def write(self, iterator) -> _Shards:
        import pyarrow as pa
        import pyarrow.compute as pc

        batches = [b for b in iterator if b.num_rows]
        out = _Shards()
        if not batches:
            return out
        files, root = open_folder(self._path)
        files.create_dir(f"{root}/_staged", recursive=True)
        rows = pa.Table.from_batches(batches).select(_COLUMNS).sort_by([(c, "ascending") for c in _COLUMNS])
        key = pc.binary_join_element_wise(rows["window_start"], rows["window_end"],
                                          pc.cast(rows["shard"], pa.string()), "|")
        runs, at = pc.run_end_encode(key.combine_chunks()), 0
        for end in runs.run_ends.to_pylist():
            part = rows.slice(at, end - at)
            name = f"{uuid.uuid4().hex}.txt"
            with files.open_output_stream(f"{root}/_staged/{name}") as f:
                for chunk in part["value"].chunks:
                    f.write("".join(f"{'' if v is None else v}\n" for v in chunk.to_pylist()).encode())
            out.files.append((*[part[c][0].as_py() for c in _COLUMNS[:3]], name))
            at = end
        return out

    def commit(self, messages, batchId: int) -> None:
        files, root = open_folder(self._path)
        note = f"{root}/_commits/{batchId:012d}.json"
        staged = [x for m in messages if m for x in m.files]
        if is_file(files, note):
            self._drop(files, root, staged)
        else:
            put(files, note, json.dumps(staged).encode())
        self._finish(files, root, json.loads(read_bytes(files, note)))

    def _finish(self, files, root: str, staged: list) -> None:
        """Move what the note says; what is moved already stays."""
        windows = {(start, end) for start, end, _, _ in staged}
        noted = {(start, end, shard): name for start, end, shard, name in staged}
        for start, end in sorted(windows):
            for shard in range(self._shards):
                target = f"{root}/window_start={start}/window_end={end}/shard={shard}/part.txt"
                name = noted.get((start, end, shard))
                if is_file(files, target):
                    continue
                if name is None:
                    put(files, target, b"")
                else:
                    files.create_dir(target.rsplit("/", 1)[0], recursive=True)
                    files.move(f"{root}/_staged/{name}", target)

    def _drop(self, files, root: str, staged: list) -> None:
        for *_, name in staged:
            remove(files, f"{root}/_staged/{name}")

    def abort(self, messages, batchId: int) -> None:
        files, root = open_folder(self._path)
        self._drop(files, root, [x for m in messages if m for x in m.files])


class WindowFiles(DataSource):
    """Options: ``path`` and ``shards``; rows are ``window_start, window_end, shard, value``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema, overwrite: bool):
        if schema.names != _COLUMNS:
            raise ValueError(f"{FORMAT} takes the columns {_COLUMNS}, not {schema.names}")
        return _Writer(self.options["path"], int(self.options["shards"]))


def stream_per_window(lines: DataFrame, path: str, checkpoint: str, num_shards: int = 3, window_col: str = "window",
                      line_col: str = "line", zone: str = "UTC"):
    """A writer (append mode; start it yourself) of ``lines``, whose rows leave a watermarked window.

    A row's shard is by its line's hash, so a hot window is written by ``num_shards`` tasks.
    """
    try:
        lines.sparkSession.dataSource.register(WindowFiles)
    except AnalysisException as e:
        if e.getCondition() != "DATA_SOURCE_ALREADY_EXISTS":
            raise
    w = F.col(window_col)
    rows = lines.select(
        display_time(F.unix_millis(w.start), zone, _WINDOW_FMT).alias("window_start"),
        display_time(F.unix_millis(w.end), zone, _WINDOW_FMT).alias("window_end"),
        F.pmod(F.xxhash64(line_col), F.lit(num_shards)).cast("int").alias("shard"), F.col(line_col).alias("value"))
    return (rows.repartition("window_start", "window_end", "shard").writeStream.outputMode("append").format(FORMAT)
            .option("path", path).option("shards", str(num_shards)).option("checkpointLocation", checkpoint))

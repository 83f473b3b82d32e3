"""Table sinks built from a name -> column map (create if missing, append)."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillet.functions.files import is_file, open_folder, put, read_bytes, remove_folder


def select_fields(df: DataFrame, fields: Mapping[str, Column | str]) -> DataFrame:
    """Project ``fields`` (output name -> column or expression), in map order."""
    cols = [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items()]
    return df.select(*cols)


class SchemaClash(ValueError):
    """The rows to append don't have the table's columns."""


def check_schema(rows: StructType, table: StructType, name: str) -> None:
    """Refuse rows that lack columns of the table, have others, or other types; all of them are named."""
    mine, there = ({f.name.lower(): f for f in x} for x in (rows, table))
    wrong = [f"missing column {f.name} {f.dataType.simpleString()}" for k, f in there.items() if k not in mine]
    wrong += [f"unknown column {f.name} {f.dataType.simpleString()}" for k, f in mine.items() if k not in there]
    wrong += [f"column {f.name} is {f.dataType.simpleString()}, in the table {there[k].dataType.simpleString()}"
              for k, f in mine.items() if k in there and f.dataType != there[k].dataType]
    if wrong:
        raise SchemaClash(f"{name}: {'; '.join(wrong)}")


def _stored_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema of the Parquet files directly in ``path``, or None without any."""
    from pyarrow.fs import FileSelector, FileType

    files, root = open_folder(path)
    found = files.get_file_info(FileSelector(root, allow_not_found=True))
    first = next((f.path for f in found if f.type == FileType.File and _shown(f.base_name)), None)
    return None if first is None else spark.read.parquet(f"{path.rstrip('/')}/{first.rsplit('/', 1)[1]}").schema


def _shown(name: str) -> bool:
    return name.endswith(".parquet") and not name.startswith(("_", "."))


def _finish(files, root: str) -> None:
    """Make the noted files visible, those of an append that was killed while at it too, then drop the notes."""
    from pyarrow.fs import FileSelector

    for note in files.get_file_info(FileSelector(f"{root}/_commits", allow_not_found=True)):
        if not note.path.endswith(".json"):
            continue
        for staged, name in json.loads(read_bytes(files, note.path)):
            if is_file(files, f"{root}/_staged/{staged}"):
                files.move(f"{root}/_staged/{staged}", f"{root}/{name}")
        files.delete_file(note.path)


def append_table(df: DataFrame, fields: Mapping[str, Column | str] | None = None, *, path: str | None = None,
                 table: str | None = None) -> None:
    """Append rows to a table (by name, in the catalog) or to a Parquet folder; it is made if missing.

    The columns must be the table's (in any order); otherwise ``SchemaClash`` names those that are not,
    before any task runs.  Rows of a folder are written below ``_staged``, which readers skip; when all tasks
    are done one note names the new files and they move to the folder.  A failed append shows nothing, and
    one that is killed while its files move is finished by the next.  One job at a time may append to a folder.
    """
    out = select_fields(df, fields) if fields else df
    spark = df.sparkSession
    if table:
        if spark.catalog.tableExists(table):
            there = spark.table(table)
            check_schema(out.schema, there.schema, table)
            out = out.select(*[f"`{c}`" for c in there.columns])
        out.write.mode("append").format("parquet").saveAsTable(table)
        return
    if not path:
        raise ValueError("append_table needs a path or a table name")
    from pyarrow.fs import FileSelector

    path = path.rstrip("/")
    files, root = open_folder(path)
    _finish(files, root)
    stored = _stored_schema(spark, path)
    if stored is not None:
        check_schema(out.schema, stored, path)
    attempt = uuid.uuid4().hex
    staged = f"{root}/_staged/{attempt}"
    try:
        out.write.parquet(f"{path}/_staged/{attempt}")
    except Exception:
        remove_folder(files, staged)
        raise
    new = [f.base_name for f in files.get_file_info(FileSelector(staged)) if _shown(f.base_name)]
    put(files, f"{root}/_commits/{attempt}.json",
        json.dumps([(f"{attempt}/{name}", f"{attempt}-{name}") for name in new]).encode())
    _finish(files, root)
    remove_folder(files, staged)


def batch_path(path: str, batch_id: int) -> str:
    """Folder of one micro-batch: rewriting it is idempotent, so a batch that
    is replayed after a failure replaces its own output instead of adding to it."""
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def stream_append(stream: DataFrame, fields: Mapping[str, Column | str] | None, path: str,
                  checkpoint: str, output_mode: str = "append"):
    """Streaming form: each micro-batch is written to ``<path>/batch_id=<n>``
    (exactly once: a replayed batch overwrites its folder).  Read back with
    ``spark.read.parquet(path)``; ``batch_id`` is then a column.

    Returns the ``DataStreamWriter`` (the caller picks the trigger and starts it).
    """
    out = select_fields(stream, fields) if fields else stream

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_path(path, batch_id))

    return (out.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
            .foreachBatch(write_batch))

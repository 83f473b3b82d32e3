"""Counters of live jobs: metrics observed in streaming plans, added up over micro-batches and restarts.

A plan counts with ``observe``; Spark reports the counts with each micro-batch's progress, and ``Counters``,
a streaming listener, adds them to a small file per query in the job's counter folder.  The file holds the
last micro-batch's number and the totals before and after it, so a micro-batch that runs again replaces its
own counts.  Counts that ``foreachBatch`` makes go the same way, by ``record``.

A listener hears of a micro-batch after its commit: of one whose driver dies in between, its observed
counts are missing.
"""

from __future__ import annotations

import json
import uuid
from pathlib import PurePosixPath

from pyspark.sql import SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from rillet.functions.files import is_file, open_folder, put, read_bytes


class _Store:
    def __init__(self, path: str):
        self.fs, self.root = open_folder(path)

    def load(self, name: str) -> dict:
        path = f"{self.root}/{name}.json"
        if not is_file(self.fs, path):
            return {"batch": -1, "before": {}, "total": {}}
        return json.loads(read_bytes(self.fs, path))

    def save(self, name: str, state: dict) -> None:
        put(self.fs, f"{self.root}/{name}.json", json.dumps(state).encode())

    def names(self) -> list[str]:
        from pyarrow.fs import FileSelector

        found = self.fs.get_file_info(FileSelector(self.root, allow_not_found=True))
        return [PurePosixPath(x.path).stem for x in found if x.path.endswith(".json")]


def record(path: str, name: str, batch_id: int, counts: dict) -> None:
    """Add a micro-batch's counts to the totals ``name`` below ``path``; one that runs again replaces its own."""
    store = _Store(path)
    state = store.load(name)
    if batch_id != state["batch"]:
        state = {"batch": batch_id, "before": state["total"]}
    before = state["before"]
    state["total"] = before | {k: before.get(k, 0) + int(v or 0) for k, v in counts.items()}
    store.save(name, state)


def totals(path: str) -> dict:
    """All counters below ``path``, summed by name over the queries that report them."""
    store, out = _Store(path), {}
    for name in store.names():
        for k, v in store.load(name)["total"].items():
            out[k] = out.get(k, 0) + v
    return out


def metric(path: str, name: str) -> str:
    """What a plan's ``observe`` is called, so that the listener of ``path`` alone takes it."""
    return f"{name}@{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"


class Counters(StreamingQueryListener):
    """Keeps the totals of the metrics observed for the counter folder ``path``."""

    def __init__(self, path: str):
        self._path, self._suffix = path, metric(path, "")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for name, row in progress.observedMetrics.items():
            if name.endswith(self._suffix):
                record(self._path, f"{progress.id}-{name[:-len(self._suffix)]}", progress.batchId, row.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


_listening: dict[str, Counters] = {}


def listen(spark: SparkSession, path: str) -> str:
    """Have the counters observed for ``path`` added up there, once per application; ``path``."""
    key = f"{spark.sparkContext.applicationId} {path}"
    if key not in _listening:
        _listening[key] = Counters(path)
        spark.streams.addListener(_listening[key])
    return path

"""Run a streaming query to completion over what is available, then read its sink.

The keyed stream queries stage their input (derived by Spark from the
tables) as text files in a folder under the shared checkpoint dir, run the
stream with ``availableNow`` (exactly-once, restartable from its checkpoint
if an executor or the driver dies), and return the sink read back as a
batch DataFrame.
"""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter


def run_available_now(writer: DataStreamWriter, timeout_sec: float | None = None) -> None:
    """Start with ``availableNow`` and block until every staged file is processed."""
    q = writer.trigger(availableNow=True).start()
    try:
        q.awaitTermination(timeout_sec) if timeout_sec else q.awaitTermination()
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise q.exception()

"""Summarize a Spark event log: per stage, task count and median / max task time.

Usage: python tools/stage_times.py <event-log file or folder>
A max far above the median flags a skewed (straggler) task.
"""

from __future__ import annotations

import json
import os
import statistics
import sys


def _lines(f: str):
    """Lines of an event-log file, plain or zstd-compressed (Spark 4's default)."""
    if f.endswith(".zstd") or f.endswith(".zst"):
        import io

        import zstandard

        with open(f, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(f) as fh:
            yield from fh


def main(argv):
    path = argv[1]
    files = [os.path.join(path, f) for f in sorted(os.listdir(path))] if os.path.isdir(path) else [path]
    tasks: dict[tuple, list] = {}
    names: dict[tuple, str] = {}
    for f in files:
        if os.path.isdir(f):
            files += [os.path.join(f, g) for g in sorted(os.listdir(f))]
            continue
        base = os.path.basename(f)
        if base.startswith(".") or base.startswith("appstatus"):
            continue
        for line in _lines(f):
            if line.strip():
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerTaskEnd":
                    info = ev["Task Info"]
                    key = (ev["Stage ID"], ev["Stage Attempt ID"])
                    dur = info["Finish Time"] - info["Launch Time"]
                    metrics = ev.get("Task Metrics") or {}
                    rows = (metrics.get("Input Metrics") or {}).get("Records Read", 0) + \
                        (metrics.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    tasks.setdefault(key, []).append((dur, rows))
                elif kind == "SparkListenerStageCompleted":
                    si = ev["Stage Info"]
                    names[(si["Stage ID"], si["Stage Attempt ID"])] = si["Stage Name"][:60]
    print(f"{'stage':>7} {'tasks':>5} {'med ms':>7} {'max ms':>7} {'max rows':>9}  name")
    for key in sorted(tasks):
        durs = [d for d, _ in tasks[key]]
        rows = [r for _, r in tasks[key]]
        print(f"{key[0]:>7} {len(durs):>5} {int(statistics.median(durs)):>7} {max(durs):>7} {max(rows):>9}  "
              f"{names.get(key, '')}")


if __name__ == "__main__":
    main(sys.argv)

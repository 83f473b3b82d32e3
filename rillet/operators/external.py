"""Map rows through an external program.

Stream mode (default): each partition has one run of the program, fed the
values on stdin, one a line, as they are; the program must write one line per
input line, so keys stay aligned.  A null value is not sent and stays null.
Only what must be escaped is: newlines inside a value are sent as U+001E and
come back as newlines; a value that holds both can't be sent and fails the
task.  A non-zero exit, a line-count mismatch or a timeout fails the task too
(Spark retries it elsewhere).  A feeding thread keeps the program from
blocking on a full pipe, whatever it buffers.

Per-row mode: the program runs once per row with the value as its last
argument; each stdout line becomes a ``(key, line)`` row (0..n per input).

Framed mode: one run of the program per partition that answers each value with
0..n others.  A request is the value's length in bytes in ASCII digits, a
newline, and the value; a response is a count and a newline, then as many
values, framed alike.  The program answers in order; at most ``window`` rows are under way, and
each answer is due within a time of its own.  Values may hold anything.
"""

from __future__ import annotations

import queue
import subprocess
import threading
from collections import deque
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame

from rillet.model import KV_SCHEMA

OUTPUT_ROWS = 10_000
LINE_MARK = "\x1e"


def _run(cmd: Sequence[str], timeout: float) -> str:
    res = subprocess.run(list(cmd), capture_output=True, timeout=timeout)
    if res.returncode != 0:
        raise RuntimeError(f"external program {cmd[0]!r} exited {res.returncode}: {res.stderr.decode()[:500]}")
    return res.stdout.decode()


class _Feeder(threading.Thread):
    """Writes the values of ``batches`` to the program, keeping the keys whose line is still due."""

    def __init__(self, batches: Iterator[pd.DataFrame], program: subprocess.Popen):
        super().__init__(daemon=True)
        self._batches, self._program = batches, program
        self.due: deque = deque()            # (key, sent, newlines escaped)
        self.sent, self.error = 0, None

    def run(self) -> None:
        try:
            with self._program.stdin as pipe:
                for pdf in self._batches:
                    for key, value in zip(pdf["key"].tolist(), pdf["value"].tolist()):
                        if value is None:
                            self.due.append((key, False, False))
                            continue
                        inside = "\n" in value
                        if inside and LINE_MARK in value:
                            raise ValueError(f"the value of key {key!r} holds a newline and U+001E")
                        self.due.append((key, True, inside))
                        self.sent += 1
                        pipe.write(value.replace("\n", LINE_MARK).encode() + b"\n")
        except BrokenPipeError:
            pass                             # the program ended: its exit code or line count tells
        except Exception as e:  # noqa: BLE001 - raised by the reading side
            self.error = e
            self._program.kill()


def pipe_values(df: DataFrame, command: Sequence[str] = ("cat",), timeout_sec: float = 3600.0) -> DataFrame:
    """``key, value`` -> ``key, value`` where value is the program's output line."""
    cmd = tuple(command)

    def run_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        program = subprocess.Popen(cmd, stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.DEVNULL)
        timed_out = threading.Event()
        timer = threading.Timer(timeout_sec, lambda: (timed_out.set(), program.kill()))
        timer.daemon = True
        timer.start()
        feeder = _Feeder(batches, program)
        feeder.start()
        keys, values, lines = [], [], 0
        try:
            for line in program.stdout:      # cut at newlines only
                lines += 1
                while feeder.due and not feeder.due[0][1]:
                    keys.append(feeder.due.popleft()[0])
                    values.append(None)
                if not feeder.due:
                    break                    # more lines than rows
                key, _, inside = feeder.due.popleft()
                text = line.removesuffix(b"\n").decode()
                keys.append(key)
                values.append(text.replace(LINE_MARK, "\n") if inside else text)
                if len(keys) >= OUTPUT_ROWS:
                    yield pd.DataFrame({"key": keys, "value": values}, dtype=object)
                    keys, values = [], []
            else:
                feeder.join()
                code = program.wait()
                if timed_out.is_set():
                    raise TimeoutError(f"external program {cmd[0]!r} timed out after {timeout_sec} s")
                if feeder.error is not None:
                    raise feeder.error
                if code:
                    raise RuntimeError(f"external program {cmd[0]!r} exited {code}")
            if lines != feeder.sent or any(sent for _, sent, _ in feeder.due):
                raise RuntimeError(f"external program returned {lines} lines for {feeder.sent} rows")
            for key, _, _ in feeder.due:
                keys.append(key)
                values.append(None)
            if keys:
                yield pd.DataFrame({"key": keys, "value": values}, dtype=object)
        finally:
            timer.cancel()
            program.kill()
            program.wait()

    return df.select("key", "value").mapInPandas(run_partition, KV_SCHEMA)


def run_per_row(df: DataFrame, command: Sequence[str], timeout_sec: float = 3600.0) -> DataFrame:
    """``key, value`` -> one ``key, line`` row per output line of ``command value``."""
    cmd = tuple(command)

    def run_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys, lines = [], []
            for k, v in zip(pdf["key"], pdf["value"]):
                out = _run((*cmd, "" if v is None else str(v)), timeout_sec).split("\n")
                for line in out[:-1] if out[-1] == "" else out:
                    keys.append(k)
                    lines.append(line.removesuffix("\r"))
            yield pd.DataFrame({"key": keys, "value": lines}, dtype=object)

    return df.select("key", "value").mapInPandas(run_rows, KV_SCHEMA)


class _Frames(threading.Thread):
    """Sends framed values, ``window`` ahead of the answers at most."""

    def __init__(self, batches: Iterator[pd.DataFrame], program: subprocess.Popen, window: int):
        super().__init__(daemon=True)
        self._batches, self._program = batches, program
        self.room = threading.Semaphore(window)
        self.due: queue.SimpleQueue = queue.SimpleQueue()       # (key, value was null), then None
        self.error, self.stopped = None, False

    def run(self) -> None:
        try:
            with self._program.stdin as pipe:
                for pdf in self._batches:
                    for key, value in zip(pdf["key"].tolist(), pdf["value"].tolist()):
                        if value is not None:
                            self.room.acquire()
                            if self.stopped:
                                return
                            body = value.encode()
                            pipe.write(b"%d\n" % len(body) + body)
                            pipe.flush()
                        self.due.put((key, value is None))
        except BrokenPipeError:
            pass                             # the reading side sees the program's end
        except Exception as e:  # noqa: BLE001 - raised by the reading side
            self.error = e
            self._program.kill()
        finally:
            self.due.put(None)


class _Answers:
    """Reads framed answers, each within ``timeout`` seconds."""

    def __init__(self, program: subprocess.Popen, timeout: float):
        self._program, self._timeout, self._late = program, timeout, threading.Event()

    def _number(self) -> int:
        line = self._program.stdout.readline(32)
        if not line.endswith(b"\n") or not line[:-1].isdigit():
            raise EOFError(f"no number but {line!r}" if line else "it ended")
        return int(line)

    def _value(self) -> str:
        size = self._number()
        body = self._program.stdout.read(size)
        if len(body) < size:
            raise EOFError("it ended within a value")
        return body.decode()

    def next(self) -> list[str]:
        timer = threading.Timer(self._timeout, lambda: (self._late.set(), self._program.kill()))
        timer.daemon = True
        timer.start()
        try:
            return [self._value() for _ in range(self._number())]
        except EOFError as e:
            if self._late.is_set():
                raise TimeoutError(f"no answer in {self._timeout} s") from e
            raise
        finally:
            timer.cancel()


def exchange_frames(df: DataFrame, command: Sequence[str], timeout_sec: float = 60.0, window: int = 64) -> DataFrame:
    """``key, value`` -> one ``key, value`` row per value that the program answers with (framed mode, see above).

    A null value is not sent and gives one null.  A row without a right answer in ``timeout_sec``, a program that ends early, and
    a non-zero exit fail the task, and the message names the row's key.
    """
    cmd = tuple(command)

    def run_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        program = subprocess.Popen(cmd, stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.DEVNULL)
        sender = _Frames(batches, program, window)
        sender.start()
        answers = _Answers(program, timeout_sec)
        keys, values = [], []
        try:
            while (row := sender.due.get()) is not None:
                key, null = row
                if null:
                    told = [None]
                else:
                    try:
                        told = answers.next()
                    except (EOFError, TimeoutError, UnicodeDecodeError) as e:
                        if sender.error is not None:
                            raise sender.error from e
                        raise RuntimeError(f"external program {cmd[0]!r} failed on the row of key {key!r}: {e}") from e
                    sender.room.release()
                keys += [key] * len(told)
                values += told
                if len(keys) >= OUTPUT_ROWS:
                    yield pd.DataFrame({"key": keys, "value": values}, dtype=object)
                    keys, values = [], []
            if sender.error is not None:
                raise sender.error
            if program.stdout.read(1):
                raise RuntimeError(f"external program {cmd[0]!r} answered more rows than it was sent")
            if code := program.wait(timeout_sec):
                raise RuntimeError(f"external program {cmd[0]!r} exited {code}")
            if keys:
                yield pd.DataFrame({"key": keys, "value": values}, dtype=object)
        finally:
            sender.stopped = True
            sender.room.release()
            program.kill()
            program.wait()

    return df.select("key", "value").mapInPandas(run_partition, KV_SCHEMA)

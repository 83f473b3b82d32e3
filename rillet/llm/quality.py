"""Quality rules: word counts, and a hashed n-gram classifier (operator 6).

Base measures are counted on the bytes of the whole text.  The classifier is a logistic regression on
hashed word unigrams and bigrams and character 4-grams (each family as relative frequencies, so long
and short texts compare), trained on labelled quality rows, then calibrated by a second logistic
regression on rows held out from the training.  Texts are scored in Arrow batches against a fixed
threshold on the calibrated probability.

The training sample is bounded by about ``train_rows``; it is drawn by a hash of the id, a rare class
in greater part.  Every fourth row of each class calibrates.

Defined cases: a null text is empty; a text without words fails the base rules; without labelled
rows of both classes the classifier keeps everything; the only row of a class both trains and
calibrates; labels given twice count as good if any is.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import (IS_WORD, byte_rows, fit_logistic, join_by_size, map_texts, mix, segment_hashes,
                               sigmoid, spans, window_hashes)
from rillet.session import materialize


@dataclass(frozen=True)
class QualityOptions:
    min_words: int = 10
    repeat_window: int = 5
    repeat_percent: int = 20
    bits: int = 15                  # log2 of the slots of each of the three n-gram families
    train_rows: int = 4_000         # bound on the labelled rows the classifier is fitted on
    threshold: float = 0.5          # keep at or above this calibrated probability


_U = np.uint64
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_FAMILIES = 3


def measures(raw: np.ndarray, window: int = 5) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    word = IS_WORD[raw]
    starts, ends = spans(word)
    chars = int((word & ((raw & 0xC0) != 0x80)).sum())
    symbols = int(_SYMBOL[raw].sum())
    lines = 0
    if len(starts):
        first, last = spans(raw != 0x0A)
        inside = np.searchsorted(starts, last) > np.searchsorted(starts, first)      # lines with a word
        hashes = segment_hashes(raw, first[inside], last[inside])
        lines = len(hashes) - len(np.unique(hashes))
    repeated = 0
    runs = window_hashes(segment_hashes(raw, starts, ends), window)
    if len(runs):
        _, back, n = np.unique(runs, return_inverse=True, return_counts=True)
        mark = np.zeros(len(starts) + 1, np.int64)
        again = np.flatnonzero(n[back] > 1)
        np.add.at(mark, again, 1)
        np.add.at(mark, again + window, -1)
        repeated = int((np.cumsum(mark) > 0).sum())
    return len(starts), chars, symbols, lines, repeated


def ngrams(raw: np.ndarray, bits: int) -> list[np.ndarray]:
    """Slots of the text's words, word pairs and character 4-grams, one array per family."""
    shift = _U(64 - bits)
    words = segment_hashes(raw, *spans(IS_WORD[raw]))
    pairs = window_hashes(words, 2)
    b = raw.astype(np.uint64)
    fours = (b[:-3] | (b[1:-2] << _U(8)) | (b[2:-1] << _U(16)) | (b[3:] << _U(24))) if len(b) > 3 else b[:0]
    return [(h >> shift).astype(np.int64) for h in (words, pairs, mix(fours))]


def text_score(raw: np.ndarray, weights: np.ndarray, bits: int) -> float:
    """The classifier's log-odds: each family's mean weight, plus the bias."""
    size = 1 << bits
    total = weights[-1]
    for k, slots in enumerate(ngrams(raw, bits)):
        if len(slots):
            total += weights[k * size:(k + 1) * size][slots].mean()
    return float(total)


def _fit_sparse(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, width: int, rounds: int = 120,
                rate: float = 0.5, decay: float = 1e-5) -> np.ndarray:
    """Logistic regression weights (bias last) on sparse rows (slots, values), by Adam on all rows."""
    at = np.concatenate([r[0] for r in rows])
    value = np.concatenate([r[1] for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    sample = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))   # both classes weigh the same
    w, m, v = (np.zeros(width + 1) for _ in range(3))
    for step in range(1, rounds + 1):
        z = np.bincount(row, value * w[at], minlength=len(rows)) + w[-1]
        d = (sigmoid(z) - y) * sample
        g = np.append(np.bincount(at, value * d[row], minlength=width) + decay * w[:-1], d.sum())
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w


def _relative(bits: int):
    size = 1 << bits

    def run(batches):
        for batch in batches:
            slots, values = [], []
            for raw in byte_rows(batch.column("text")):
                s, f = [], []
                for k, x in enumerate(ngrams(raw, bits)):
                    u, n = np.unique(x, return_counts=True)
                    s.append(u + k * size)
                    f.append(n / max(len(x), 1))
                slots.append(np.concatenate(s).astype(np.int32).tobytes())
                values.append(np.concatenate(f).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("good"), batch.column("part"), pa.array(slots, pa.binary()),
                 pa.array(values, pa.binary())], names=["good", "part", "slots", "weights"])
    return run


@dataclass
class QualityModel:
    weights: np.ndarray | None      # three families of 2^bits slots and the bias
    scale: float                    # calibration: probability = sigmoid(scale * log-odds + shift)
    shift: float
    options: QualityOptions


def train(docs: DataFrame, labels: DataFrame, options: QualityOptions = QualityOptions()) -> QualityModel:
    """Fit on at most ``train_rows`` labelled rows; every fourth one calibrates instead."""
    marks = materialize(labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
                        .agg(F.max((F.col("quality") != 0).cast("int")).alias("good")), "quality")
    sizes = {r["good"]: r["count"] for r in marks.groupBy("good").count().collect()}       # two rows
    total = sum(sizes.values())
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    marks = marks.withColumn("part", F.pmod(draw, F.lit(4)).cast("int"))
    if total > options.train_rows:
        limit = F.lit(0)
        for good, n in sizes.items():
            share = max(options.train_rows / total, options.train_rows / 8 / n)
            limit = F.when(F.col("good") == good, F.lit(int((1 << 30) * min(1.0, share)))).otherwise(limit)
        marks = materialize(marks.where(draw < limit), "quality")
    rows = join_by_size(docs.select("doc_id", "text"), marks, "doc_id", "inner").select("text", "good", "part")
    got = map_texts(rows, _relative(options.bits), "good int, part int, slots binary, weights binary").toArrow()
    y = got.column("good").to_numpy().astype(float)
    part = got.column("part").to_numpy()
    if not {0.0, 1.0} <= set(y.tolist()):
        return QualityModel(None, 1.0, 0.0, options)
    trains, checks = part != 0, part == 0
    for c in (0, 1):                                     # both sides hold both classes
        mine = np.flatnonzero(y == c)
        if trains[mine].all() or checks[mine].all():
            some = np.arange(len(mine)) % 4 == 0
            checks[mine], trains[mine] = some, ~some
            if len(mine) == 1:
                trains[mine] = True
    rows = [(np.frombuffer(s, np.int32), np.frombuffer(v, np.float32))
            for s, v in zip(got.column("slots").to_pylist(), got.column("weights").to_pylist())]
    fit = [r for r, t in zip(rows, trains) if t]
    w = _fit_sparse(fit, y[trains], _FAMILIES << options.bits)
    z = np.array([float((w[s] * v).sum() + w[-1]) for (s, v), c in zip(rows, checks) if c])
    scale, shift = fit_logistic(z[:, None], y[checks], ridge=1e-3)
    return QualityModel(w.astype(np.float32), float(scale), float(shift), options)


def judge(docs: DataFrame, model: QualityModel) -> DataFrame:
    """Measures, base verdict, calibrated probability and verdict of every row of ``docs`` (doc_id, text)."""
    options = model.options
    shared = None if model.weights is None else docs.sparkSession.sparkContext.broadcast(model.weights)
    scale, shift = model.scale, model.shift

    def run(batches):
        for batch in batches:
            rows, p = [], []
            for raw in byte_rows(batch.column("text")):
                rows.append(measures(raw, options.repeat_window))
                p.append(1.0 if shared is None else float(
                    sigmoid(np.float64(scale * text_score(raw, shared.value, options.bits) + shift))))
            n = np.array(rows, np.int64).reshape(-1, 5)
            failed = (n[:, 0] < options.min_words) | (100 * n[:, 4] > options.repeat_percent * n[:, 0])
            p = np.array(p)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(n[:, k]) for k in range(5)], pa.array(failed),
                 pa.array(~failed & (p >= options.threshold)), pa.array(p, pa.float64())],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "kept", "quality"])
    return map_texts(
        docs.select("doc_id", "text"), run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
             "n_repeat_words long, base_failed boolean, kept boolean, quality double")

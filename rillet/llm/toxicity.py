"""Toxicity by class-conditional Kneser-Ney models (operator 10).

Two models of the bytes inside a word (contexts start at the word's start and
hold up to ``order - 1`` bytes), one for toxic and one for ordinary text.  Each
interpolates its own absolutely discounted counts with one shared backoff,
the continuation counts of both classes together:

    p_c(b | h) = max(n_c(hb) - D, 0) / n_c(h) + D * N1+_c(h .) / n_c(h) * p_shared(b | h')

so an expression that neither class has seen often gets the same shared
probability in both and tells nothing.  A word's evidence is the sum of its
bytes' log-likelihood ratios; a text's features are length-normalised: the
mean over all its words, the mean over its strongest 1, 3 and 8 words, and the
logarithm of its length.  A logistic regression, fitted on a fold whose counts
were left out of the models, turns them into a probability.

Counts cover every training row and are Spark aggregations.  The finished
ratios are a stored table that grows with the corpus: an entry for every context
whose classes back off differently and for every gram that adds to its context's
ratio (all others add exactly nothing).  Scoring adds entries up, so it can take
the table in slices: one broadcast where it has at most ``slice_rows`` entries,
otherwise one pass over the texts per slice, with the evidence so far carried
along.  No entry is left out, and the slices give the scores of the whole.

Rows of crc32 remainder 1 calibrate; a class with none or only such rows has its row of the
smallest hash on the other side, and its only row on both.

Defined cases: a null or empty text scores by its (empty) features; without
training rows of both classes the score is the share of toxic training rows
(0 without any) and nothing is learned; a null ``doc_id`` is never held out
and never trains; labels given twice count as toxic if any is; label rows
that name no document do nothing; null labels are no labels.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructType

from rillet.llm.common import byte_rows, fit_logistic, join_by_size, map_texts, mix, sigmoid
from rillet.session import materialize


@dataclass(frozen=True)
class ToxicityOptions:
    order: int = 6                   # bytes in a gram, 6 at most
    discount: float = 2.0            # D
    slice_rows: int = 8_000_000      # table entries broadcast at once, about (some 160 MB)
    calibration_rows: int = 50_000   # bound on the sample the logistic regression is fitted on
    threshold: float = 0.5


_U = np.uint64
_TAG = 57                            # a gram is its bytes, with its length from this bit on
_LOW = _U((1 << _TAG) - 1)
_CONTEXT = _U(1 << 61)               # marks the code of a context
_FOLD_BYTE = np.full(256, 32, np.uint8)
_FOLD_BYTE[48:58] = np.arange(48, 58)
_FOLD_BYTE[97:123] = np.arange(97, 123)
_FOLD_BYTE[65:91] = np.arange(97, 123)
_FOLD_BYTE[128:] = np.arange(128, 256)
N_FEATURES = 5


def text_grams(raw: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Gram code of every byte of every word (with the space that ends it), and the word's number.

    Letters, digits and non-ASCII bytes make words, A-Z lower-cased; all else separates.
    """
    b = np.concatenate(([32], _FOLD_BYTE[raw], [32])).astype(np.uint8)
    b = b[~((b == 32) & (np.concatenate(([0], b[:-1])) == 32))]
    n = len(b)
    if n < 2:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.arange(n)
    start = np.maximum.accumulate(np.where(b == 32, at, 0))
    start = np.concatenate(([0], start[:-1]))
    size = np.minimum(order, at - start + 1)
    code = np.zeros(n, np.uint64)
    for k in range(order - 1, -1, -1):
        code <<= _U(8)
        code[k:] |= b[:max(n - k, 0)]
    keep = np.array([(1 << (8 * k)) - 1 for k in range(order + 1)], np.uint64)
    gram = (code & keep[size]) | (size.astype(np.uint64) << _U(_TAG))
    return gram[1:], (np.cumsum(b == 32) - (b == 32))[1:] - 1


def context_of(gram: np.ndarray) -> np.ndarray:
    """The gram without its last byte (tagged with the gram's own length)."""
    return ((gram & _LOW) >> _U(8)) | (gram & ~_LOW)


def _gram_counts(order: int):
    def run(batches):
        for batch in batches:
            codes, which = [], []
            for raw, label in zip(byte_rows(batch.column("text")), batch.column("cell").to_pylist()):
                g, _ = text_grams(raw, order)
                codes.append(g)
                which.append(np.full(len(g), label, np.uint64))
            if not codes:
                continue
            # length tags need 3 bits, so the top four bits hold the cell
            key, n = np.unique(np.concatenate(codes) | (np.concatenate(which) << _U(60)), return_counts=True)
            gram = (key & _U((1 << 60) - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram), pa.array((key >> _U(60)).astype(np.int32)), pa.array(n.astype(np.int64))],
                names=["gram", "cell", "n"])
    return run


def _ratio_rows(grams: DataFrame, options: ToxicityOptions) -> DataFrame:
    """``code, value`` from ``gram, n0, n1``: a context's log-ratio, and what a gram adds to it.

    A gram's log-ratio is the sum of both.  Contexts are coded as by ``context_of``.
    """
    d = float(options.discount)
    tag = F.shiftleft(F.shiftright("gram", _TAG), _TAG)
    size = F.shiftright("gram", _TAG)
    code = F.col("gram").bitwiseAND(F.lit(int(_LOW)))
    wide = F.expr("shiftleft(1L, cast(8 * (shiftright(gram, %d) - 1) as int)) - 1" % _TAG)
    g = grams.select("gram", "n0", "n1", F.shiftright(code, 8).bitwiseOR(tag).alias("ctx"),
                     code.bitwiseAND(wide).bitwiseOR(F.shiftleft(size - 1, _TAG)).alias("suffix"))
    g = g.withColumn("sctx", F.shiftright(F.col("suffix").bitwiseAND(F.lit(int(_LOW))), 8)
                     .bitwiseOR(F.shiftleft(F.shiftright("suffix", _TAG), _TAG)))
    ctx = g.groupBy("ctx").agg(*[F.sum(f"n{c}").alias(f"t{c}") for c in (0, 1)],
                               *[F.sum((F.col(f"n{c}") > 0).cast("long")).alias(f"k{c}") for c in (0, 1)])
    back = g.groupBy("suffix", "sctx").agg(F.count("*").alias("cont"))
    sctx = back.groupBy("sctx").agg(F.sum("cont").alias("total"), F.count("*").alias("kinds"))
    less = min(d, 0.75)                      # the shared model's own discount, backing off to uniform bytes
    back = back.join(sctx, "sctx").select("suffix", (
        (F.greatest(F.col("cont") - less, F.lit(0.0)) + less * F.col("kinds") / 256)
        / F.col("total")).alias("shared"))
    left = [F.when(F.col(f"t{c}") > 0, F.least(F.lit(1.0), d * F.col(f"k{c}") / F.col(f"t{c}"))).otherwise(1.0)
            for c in (0, 1)]
    ctx = ctx.select("ctx", "t0", "t1", left[0].alias("l0"), left[1].alias("l1"))
    shared = F.greatest(F.col("shared"), F.lit(1e-6))
    p = [F.greatest(F.col(f"n{c}") - d, F.lit(0.0)) / F.greatest(F.col(f"t{c}"), F.lit(1)) + F.col(f"l{c}") * shared
         for c in (0, 1)]
    left_ratio = F.log("l1") - F.log("l0")
    own = g.where((F.col("n0") > d) | (F.col("n1") > d)).join(ctx, "ctx").join(back, "suffix").select(
        F.col("gram").alias("code"), (F.log(p[1]) - F.log(p[0]) - left_ratio).alias("value"))
    return own.unionByName(ctx.where("l0 <> l1").select(
        F.col("ctx").bitwiseOR(F.lit(int(_CONTEXT))).alias("code"), left_ratio.alias("value")))


def ratio_table(code: np.ndarray, value: np.ndarray) -> tuple:
    """A table for ``find``: 64-bit codes sorted by their mixed value (a bijection), indexed by its top bits."""
    key = mix(code.astype(np.uint64))
    order = np.argsort(key)
    key, bits = key[order], max(1, len(key).bit_length())
    shift = _U(64 - bits)
    first = np.searchsorted(key >> shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)
    return key, value[order].astype(np.float32), first, shift


def find(table: tuple, code: np.ndarray) -> np.ndarray:
    """The values of ``code``, 0 where there is none; the look-up is exact."""
    keys, values, first, shift = table
    out = np.zeros(len(code), np.float32)
    key = mix(code)
    top = (key >> shift).astype(np.int64)
    at, end = first[top], first[top + 1]
    ask = np.flatnonzero(at < end)
    at, end, key = at[ask], end[ask], key[ask]
    while len(ask):                                      # a bucket holds one entry or less on average
        hit = keys[at] == key
        out[ask[hit]] = values[at[hit]]
        on = ~hit & (at + 1 < end)
        ask, at, end, key = ask[on], at[on] + 1, end[on], key[on]
    return out


@dataclass
class Ratios:
    """The stored table ``code, value`` and the number of slices it is broadcast in."""
    rows: DataFrame
    slices: int

    def broadcast(self, k: int):
        """Slice ``k`` as a Spark broadcast; its rows, about ``slice_rows``, pass through the driver."""
        mine = self.rows if self.slices == 1 else \
            self.rows.where(F.pmod(F.xxhash64("code"), F.lit(self.slices)) == k)
        got = mine.toArrow()
        table = ratio_table(got.column("code").to_numpy(), got.column("value").to_numpy())
        return self.rows.sparkSession.sparkContext.broadcast(table)


def _stored(grams: DataFrame, options: ToxicityOptions) -> Ratios:
    rows = materialize(_ratio_rows(grams, options).withColumn("value", F.col("value").cast("float")), "toxicity")
    return Ratios(rows, max(1, -(-rows.count() // options.slice_rows)))


def text_evidence(raw: np.ndarray, table: tuple, order: int) -> np.ndarray:
    """What the table's entries add to the evidence of each word of one text."""
    gram, word = text_grams(raw, order)
    return np.bincount(word, find(table, gram) + find(table, context_of(gram) | _CONTEXT))


def text_features(evidence: np.ndarray) -> np.ndarray:
    """Length-normalised evidence of one text (see the module's head)."""
    if len(evidence) == 0:
        return np.zeros(N_FEATURES)
    top = np.sort(evidence)[::-1][:8]
    return np.array([evidence.mean(), top[0], top[:3].sum() / 3, top.sum() / 8, np.log1p(len(evidence))])


def fold(doc_id="doc_id"):
    """crc32 of the id as text, mod 5: 0 is held out, 1 calibrates, all but 0 train."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5))


def _draw():
    return F.xxhash64("doc_id").alias("draw")


@dataclass
class ToxicityModel:
    """The ratio table (with its broadcast, if it is one slice) and the calibration; or the constant share."""
    ratios: Ratios | None
    table: object
    weights: np.ndarray | None
    share: float
    options: ToxicityOptions


def train(docs: DataFrame, labels: DataFrame, options: ToxicityOptions = ToxicityOptions()) -> ToxicityModel:
    """Learn from the rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) marks, held-out ones excepted."""
    spark = docs.sparkSession
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id") \
        .agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic")).where(fold() != 0)
    marks = materialize(marks, "toxicity")
    rows = join_by_size(docs.select("doc_id", "text"), marks, "doc_id", "inner") \
        .select("text", "toxic", fold().alias("fold"), _draw())
    known = join_by_size(docs.select("doc_id"), marks, "doc_id", "inner").select("toxic", _draw(), (fold() == 1).alias("c"))
    sides = known.groupBy("toxic").agg(                                               # two rows
        F.count("*").alias("n"), F.sum(F.col("c").cast("long")).alias("checks"), F.min("draw").alias("least"),
        F.max("draw").alias("most")).collect()
    total = sum(r["n"] for r in sides)
    share = sum(r["n"] for r in sides if r["toxic"]) / total if total else 0.0
    if len(sides) < 2:
        return ToxicityModel(None, None, None, share, options)
    checks, counted = F.col("fold") == 1, F.lit(True)                  # counted: in the model that is calibrated
    for r in sides:
        if r["checks"] in (0, r["n"]):
            checks = F.when(F.col("toxic") == r["toxic"], F.col("draw") == r["least"]).otherwise(checks)
    for r in sides:
        only = r["least"] == r["most"]
        counted = F.when(F.col("toxic") == r["toxic"], F.lit(True) if only else ~checks).otherwise(counted)
    rows = rows.withColumn("checks", checks).withColumn("counted", counted)
    cells = rows.select("text", (F.col("toxic") + F.when(F.col("counted"), 0).otherwise(2)).cast("int").alias("cell"))
    counts = map_texts(cells, _gram_counts(options.order), "gram long, cell int, n long").groupBy("gram").agg(
        *[F.sum(F.when(F.col("cell") == c, F.col("n")).otherwise(0)).alias(f"c{c}") for c in range(4)])
    counts = materialize(counts, "toxicity")
    first = _stored(counts.selectExpr("gram", "c0 n0", "c1 n1").where("n0 + n1 > 0"), options)
    held_back = sum(r["checks"] or 1 for r in sides)
    if held_back > options.calibration_rows:
        limit = F.lit(0)                                 # a rare class in greater part
        for r in sides:
            part = options.calibration_rows * max(1 / held_back, 1 / 8 / (r["checks"] or 1))
            limit = F.when(F.col("toxic") == r["toxic"], F.lit(int((1 << 20) * min(1.0, part)))).otherwise(limit)
        rows = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < limit)
    got = _map_evidence(rows.where("checks").select("text", "toxic"), first, None, options,
                        lambda f: [pa.array(f[:, i]) for i in range(N_FEATURES)], _FEATURES) \
        .select(*_FEATURES, "toxic").toArrow()
    x = np.column_stack([got.column(name).to_numpy() for name in _FEATURES])
    weights = fit_logistic(x, got.column("toxic").to_numpy().astype(float))
    full = _stored(counts.selectExpr("gram", "c0 + c2 n0", "c1 + c3 n1"), options)
    return ToxicityModel(full, full.broadcast(0) if full.slices == 1 else None, weights, share, options)


_FEATURES = [f"f{i}" for i in range(N_FEATURES)]


def _map_evidence(docs: DataFrame, ratios: Ratios, table, options: ToxicityOptions, finish, names: list[str]) -> DataFrame:
    """``docs`` with the double columns ``names`` that ``finish`` makes of the texts' features.

    ``table`` is the broadcast of a table of one slice, if there already is one.
    """
    carried = "evidence"
    while carried in map(str.lower, docs.columns):
        carried += "_"
    order, fields = options.order, docs.schema.fields

    def add(shared, begun: bool, ends: bool):
        def run(batches):
            for batch in batches:
                done = [np.frombuffer(b) for b in batch.column(carried).to_pylist()] if begun else itertools.repeat(0.0)
                sums = [e + text_evidence(raw, shared.value, order)
                        for e, raw in zip(done, byte_rows(batch.column("text")))]
                if ends:
                    new, called = finish(np.array([text_features(e) for e in sums]).reshape(-1, N_FEATURES)), names
                else:
                    new, called = [pa.array([e.tobytes() for e in sums], pa.binary())], [carried]
                kept = batch.columns[:-1] if begun else batch.columns
                yield pa.RecordBatch.from_arrays(kept + new, names=batch.schema.names[:len(kept)] + called)
        return run

    for k in range(ratios.slices - 1):
        shared = ratios.broadcast(k)
        docs = materialize(map_texts(docs, add(shared, k > 0, False), StructType(fields[:]).add(carried, BinaryType())),
                           "toxicity")
        shared.destroy()
    schema = StructType(fields[:])
    for name in names:
        schema = schema.add(name, DoubleType())
    last = ratios.slices - 1
    return map_texts(docs, add(table or ratios.broadcast(last), last > 0, True), schema)


def score(docs: DataFrame, model: ToxicityModel, out: str = "score") -> DataFrame:
    """``docs`` with the column ``out``: the probability that a reader would mark the text toxic.

    ``docs`` has a ``text`` column; all others pass through (they must not be named as ``out``).
    """
    if model.weights is None:
        return docs.withColumn(out, F.lit(float(model.share)))
    weights = model.weights
    return _map_evidence(docs, model.ratios, model.table, model.options,
                         lambda f: [pa.array(sigmoid(f @ weights[:-1] + weights[-1]))], [out])

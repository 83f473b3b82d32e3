"""Best-fit packing by exact-complement hashing (operator 8).

Texts become token ids plus an end id; longer ones are cut into pieces of ``capacity`` tokens.  Only
the histogram of piece lengths (at most ``capacity`` rows) is planned:

* going down the lengths, a length's gap is looked up among the single lengths, then the pair sums,
  then the triple sums of what is still available, and every combination that fills the gap exactly
  is consumed as often as the counts allow;
* what is left is packed best fit, longest first, into the smallest gap that holds it.

The plan is a list of patterns (lengths, how often).  Every piece gets its rank among the pieces of
its length: a count per (length, bucket) turned into running offsets, plus its place in the bucket,
the buckets being hashes of the pieces, so no length meets in one task.  Length and rank name the
piece's pattern, copy and slot, hence its sequence and offset, without moving any text or ids.

Defined cases: a null or empty text is its end id alone; rows that share a ``doc_id`` are packed
each; a null ``doc_id`` stays null; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillet.llm.common import map_texts
from rillet.session import materialize


@dataclass(frozen=True)
class PackingOptions:
    tokenizer: str                  # path of a tokenizers JSON file, readable on every executor
    capacity: int = 2048
    end_id: int = 0
    bucket_rows: int = 4096         # pieces of one length and bucket, about
    cached_words: int = 350_000     # per Python worker


_SIMPLE = re.compile("[\x00-\u012f\u0131-\u017f]*")       # Latin letters, each with one lower case form

_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"                   # without the apostrophe, which joins


# -- tokens ---------------------------------------------------------------------

def _byte_letters() -> dict[int, str]:
    """Characters up to U+017F as the letters byte-level vocabularies write their UTF-8 bytes with."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0x180)}


class WordTokenizer(dict):
    """Token ids of texts, word by word: a cache from words to ids that learns what it misses.

    The tokenizer drops white space, lower-cases and never merges across white space or between
    letters and punctuation, so the ids of a text are those of its parts, one after the other (the
    tests compare them).  An unknown word is looked up without case and without the ASCII marks that
    end it; if it is then all plain Latin letters, normalising would leave it as it is, and it goes
    straight to the tokenizer's merge model.  All else goes through the whole tokenizer, as do texts
    that hold the text of an added token anywhere (the tokenizer looks for those first).
    """

    def __init__(self, path: str, cached_words: int):
        super().__init__({"": b""})
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._tokenizer = Tokenizer.from_file(path)
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._merge = self._tokenizer.model.tokenize
        self._letters = _byte_letters()
        self._most = cached_words

    def __missing__(self, word: str) -> bytes:
        core = word.lower() if word.isascii() or _SIMPLE.fullmatch(word) else ""
        mark = ""
        if not core.isalpha():
            core = core.rstrip(_MARKS)
            mark = word[len(core):]
        if core.isalpha():
            ids = self.get(core)
            if ids is None:
                tokens = self._merge(core if core.isascii() else core.translate(self._letters))
                ids = self[core] = array("I", [t.id for t in tokens]).tobytes()
            if mark:
                ids += self[mark]
        else:
            ids = array("I", self._tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        self[word] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        if len(self) > self._most:
            self.clear()
            self[""] = b""
        text = text or ""
        if any(t in text for t in self._added):
            return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def _pieces(options: PackingOptions):
    cut = 4 * options.capacity
    end = np.array([options.end_id], "<u4").tobytes()

    def run(batches):
        tokenizer = WordTokenizer(options.tokenizer, options.cached_words)
        for batch in batches:
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                body = tokenizer.encode(text) + end
                for k, at in enumerate(range(0, len(body), cut)):
                    part = body[at:at + cut]
                    out.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                 *[pa.array(c, pa.int64()) for c in cols[2:]]],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, options: PackingOptions) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` for every piece of every row of ``docs``."""
    return map_texts(
        docs.select("doc_id", "text"), _pieces(options), "doc_id long, piece int, start long, length long, ids_crc32 long")


# -- plan -------------------------------------------------------------------------

def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns ``(lengths, copies)`` that use every length exactly as often as ``counts`` says."""
    left = {n: c for n, c in counts.items() if c > 0}
    out = []

    def use(lengths: tuple[int, ...]) -> None:
        need = {n: lengths.count(n) for n in set(lengths)}
        copies = min(left.get(n, 0) // k for n, k in need.items())
        if copies:
            out.append((lengths, copies))
            for n, k in need.items():
                left[n] -= k * copies
                if not left[n]:
                    del left[n]

    for n in sorted(left, reverse=True):
        if n == capacity:
            use((n,))
        if n in left and capacity - n in left:
            use((n, capacity - n))
    for n in sorted(left, reverse=True):           # n + a + b, a pair sum
        for a in sorted(left, reverse=True):
            if n not in left:
                break
            if a <= n and a in left and capacity - n - a in left and capacity - n - a <= a:
                use((n, a, capacity - n - a))
    _triples(left, capacity, use)
    _best_fit(left, capacity, out)
    return out


def _triples(left: dict[int, int], capacity: int, use) -> None:
    """Fill gaps by triples: for each length, its gap less one length is looked up in the pair sums."""
    for n in sorted(left, reverse=True):
        lengths = sorted(left, reverse=True)
        small = [a for a in lengths if a <= capacity - n]
        have = np.zeros(capacity + 1, bool)
        have[small] = True
        values = np.array(small[::-1])
        for a in small:
            if n not in left:
                break
            gap = capacity - n - a
            b = values[(values <= a) & (values * 2 >= gap) & (values < gap)]
            for x in b[have[gap - b]].tolist():
                if n not in left or a not in left:
                    break
                if x in left and gap - x in left:
                    use((n, a, x, gap - x))


def _best_fit(left: dict[int, int], capacity: int, out: list) -> None:
    """Longest first; each goes to the smallest gap that holds it.  Equal open sequences move together."""
    open_: dict[int, list[list]] = {}              # gap -> [lengths, copies]
    gaps: list[int] = []
    for n in sorted(left, reverse=True):
        count = left[n]
        while count:
            i = bisect_left(gaps, n)
            if i == len(gaps):                     # no gap holds it: open sequences of it alone
                fit = capacity // n
                whole, rest = divmod(count, fit)
                if whole:
                    _add(open_, gaps, capacity - n * fit, ((n,) * fit, whole))
                if rest:
                    _add(open_, gaps, capacity - n * rest, ((n,) * rest, 1))
                break
            gap = gaps[i]
            lengths, copies = open_[gap].pop()
            if not open_[gap]:
                del open_[gap]
                gaps.pop(i)
            fit = gap // n
            whole = min(copies, count // fit)
            if whole:
                _add(open_, gaps, gap - n * fit, (lengths + (n,) * fit, whole))
                count -= whole * fit
            if whole < copies:                     # fewer than fit are left: they share one sequence
                if count:
                    _add(open_, gaps, gap - n * count, (lengths + (n,) * count, 1))
                    whole += 1
                    count = 0
                if whole < copies:
                    _add(open_, gaps, gap, (lengths, copies - whole))
    for group in open_.values():
        out += [(tuple(lengths), copies) for lengths, copies in group]
    left.clear()


def _add(open_: dict, gaps: list[int], gap: int, group: tuple) -> None:
    if gap not in open_:
        open_[gap] = []
        insort(gaps, gap)
    open_[gap].append(group)


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """Per (length, pattern slot), sorted: key ``length << 48 | first rank``, first sequence, offset."""
    taken: dict[int, int] = {}
    rows = []
    first = 0
    for lengths, copies in patterns:
        at = 0
        for n in lengths:
            rank = taken.get(n, 0)
            rows.append(((n << 48) | rank, first, at))
            taken[n] = rank + copies
            at += n
        first += copies
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 3


# -- placing ------------------------------------------------------------------------

def pack(docs: DataFrame, options: PackingOptions) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: every piece and its place."""
    cut = materialize(pieces(docs, options), "packing")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}   # capacity rows at most
    key, first, offset = slots(plan(counts, options.capacity))
    buckets = max(1, sum(counts.values()) // options.bucket_rows)
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    before = dealt.groupBy("length", "bucket").count().withColumn(
        "before", F.sum("count").over(Window.partitionBy("length").orderBy("bucket")) - F.col("count"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = dealt.withColumn("inside", inside).join(before.drop("count"), ["length", "bucket"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("inside")).alias("rank"))

    def place(batches):
        for batch in batches:
            code = (batch.column("length").to_numpy() << 48) | batch.column("rank").to_numpy()
            at = np.searchsorted(key, code, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                batch.columns[:5] + [pa.array(first[at] + (code - key[at])), pa.array(offset[at])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                    "sequence_id long, offset long")

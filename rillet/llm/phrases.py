"""Phrase collocations from FM-indexes over word ids (operator 12).

Texts, A-Z lower-cased, are split into pieces at ``. , ; : ! ? \\x0A-\\x0D`` and those into words at ``\\x20
\\x09``.  A task gathers about ``shard_words`` words into a shard: word ids of its own and the ids of its
texts in a row, with a break between pieces.  A phrase of ``least`` occurrences has words and parts of as
many, so the shards work in three rounds, each keeping only what the round before found often enough
over all shards:

1. words are counted; all others become breaks;
2. an FM-index of each shard gives its word pairs with counts; all rare pairs become breaks;
3. a bidirectional FM-index (the BWT of the ids and of their reversal, intervals kept in step) extends
   the pairs to the right and those to the left, up to four words, each with its count.

Counts are summed across shards.  What is frequent goes back to the shards by joins on words and a window
over pairs (one row a shard and pair), so neither the lexicon nor the phrases need to fit in one place.  Suffixes are sorted by their first
four ids only: deeper order changes no interval of four words or fewer.

Scores are integers (products in decimals of 38 digits).  Words are told apart within a shard by 64-bit
hashes of language and bytes, across shards by their text.

Defined cases: a null text has no words; a null language is ``und``; copies count each time; an empty
table gives no rows; documents longer than a shard make a shard of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillet.llm.common import LOWER, byte_rows, join_by_size, map_texts, mix, prefix_sums, segment_hashes, spans
from rillet.session import materialize, scratch_path

NO_LANG = "und"


@dataclass(frozen=True)
class PhraseOptions:
    least: int = 30                  # occurrences of a candidate
    top: int = 2_000                 # phrases returned per language
    scale: int = 2_000_000           # scores are floor(scale * a / (l + r))
    cover_percent: int = 80          # a longer candidate with this share of the occurrences drops the shorter
    shard_words: int = 2_000_000


_U = np.uint64
_KIND = np.zeros(256, np.uint8)      # 0 in words, 1 between words, 2 between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2


# -- the index ------------------------------------------------------------------------

def stable_order(key: np.ndarray, top: int) -> np.ndarray:
    """The stable sorted order of integers in 0..top, 16 bits at a time."""
    order = np.argsort(key.astype(np.uint16), kind="stable").astype(np.int32)
    for at in range(16, max(int(top).bit_length(), 1), 16):
        digit = (key >> at).astype(np.uint16)
        order = order[np.argsort(digit[order], kind="stable")]
    return order


class _Bwt:
    """The BWT of a ring of ids whose rotations are sorted by their first ``depth`` ids."""

    def __init__(self, ids: np.ndarray, sigma: int, depth: int):
        rank, top, width = ids.astype(np.int64), sigma - 1, 1
        order = stable_order(rank, top)
        while width < depth:
            key = rank * (top + 1) + np.roll(rank, -width)
            order = stable_order(key, (top + 1) ** 2 - 1)
            step = np.concatenate(([False], key[order[1:]] != key[order[:-1]]))
            rank = np.empty_like(rank)
            rank[order] = np.cumsum(step)
            top, width = int(rank[order[-1]]), 2 * width
        self.symbols = ids[order - 1]
        to = stable_order(self.symbols, sigma - 1)
        self.lf = np.empty(len(ids), np.int32)         # row of the rotation that starts one id earlier
        self.lf[to] = np.arange(len(ids), dtype=np.int32)


class FMIndex:
    """Both directions of a shard; ids are 1..sigma-1, 0 is a break and stands first.

    An interval set is a tuple ``words, low, size, rlow``: the phrases' word columns, the first row and
    the number of rows of each in the index, and its first row in the index of the reversal.
    """

    def __init__(self, ids: np.ndarray, sigma: int, depth: int = 4, both: bool = True):
        self.sigma = sigma
        self.forward = _Bwt(ids, sigma, depth)
        self.reverse = _Bwt(ids[::-1], sigma, depth) if both else None
        self.counts = np.bincount(ids, minlength=sigma)
        self.starts = np.cumsum(self.counts) - self.counts

    def words(self):
        """The intervals of the single words."""
        found = np.flatnonzero(self.counts[1:]) + 1
        return [found], self.starts[found], self.counts[found], self.starts[found]

    def _extend(self, bwt: _Bwt, low, size, other):
        base = np.cumsum(size) - size
        rows = np.arange(int(size.sum()), dtype=np.int32) - np.repeat((base - low).astype(np.int32), size)
        key = np.repeat(np.arange(len(size)) * self.sigma, size) + bwt.symbols[rows]
        order = stable_order(key, max(len(size), 1) * self.sigma)
        key = key[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        count = np.diff(np.append(first, len(key)))
        owner, symbol = key[first] // self.sigma, key[first] % self.sigma
        kept = symbol > 0
        owner, symbol, first, count = owner[kept], symbol[kept], first[kept], count[kept]
        # rows ascend within a group, so its first row's LF is where the extended interval begins;
        # in the other index it begins after the smaller ids that extend the same phrase
        return owner, symbol, bwt.lf[rows[order[first]]], count, other[owner] + first - base[owner]

    def left(self, intervals):
        """All phrases of ``intervals`` with one more word before them."""
        words, low, size, rlow = intervals
        owner, symbol, low, count, rlow = self._extend(self.forward, low, size, rlow)
        return [symbol, *[w[owner] for w in words]], low, count, rlow

    def right(self, intervals):
        """All phrases of ``intervals`` with one more word after them."""
        words, low, size, rlow = intervals
        owner, symbol, rlow, count, low = self._extend(self.reverse, rlow, size, low)
        return [*[w[owner] for w in words], symbol], low, count, rlow


def with_breaks(ids: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """``ids`` without zeros, with one 0 in front, at the end, and before each id where ``cut`` or a zero stood."""
    zero = ids == 0
    cut = cut | np.concatenate(([True], zero[:-1]))[:len(ids)]
    kept = ~zero
    # a cut before a dropped id counts for the next one kept
    at = np.cumsum(cut)[kept]
    ids = ids[kept]
    new = np.concatenate(([True], at[1:] != at[:-1]))[:len(ids)]
    out = np.zeros(len(ids) + int(new.sum()) + 1, np.int32)
    out[np.arange(len(ids)) + np.cumsum(new)] = ids
    return out


# -- shards ---------------------------------------------------------------------------

class _Gather:
    """Words of a task's texts until a shard is full."""

    def __init__(self):
        self.raws, self.hashes, self.cuts, self.starts, self.ends, self.langs = [], [], [], [], [], []
        self.names: dict[str, int] = {}
        self.bytes = self.words = 0

    def add(self, texts: list[np.ndarray], langs: list[str | None]) -> None:
        size = np.array([len(t) + 1 for t in texts], np.int64)
        if not size.sum():
            return
        raw = np.full(int(size.sum()), 0x0A, np.uint8)
        begin = np.cumsum(size) - size
        for t, b in zip(texts, begin):
            raw[b:b + len(t)] = t
        raw = LOWER[raw]
        kind = _KIND[raw]
        starts, ends = spans(kind == 0)
        if not len(starts):
            return
        codes = np.array([self.names.setdefault(NO_LANG if x is None else x, len(self.names)) for x in langs], np.int32)
        lang = codes[np.searchsorted(begin, starts, "right") - 1]
        piece = np.searchsorted(np.flatnonzero(kind == 2), starts)
        self.cuts.append(np.concatenate(([True], piece[1:] != piece[:-1])))
        self.hashes.append(mix(segment_hashes(raw, starts, ends) + lang.astype(np.uint64) * _U(0x9E3779B97F4A7C15)))
        self.langs.append(lang)
        self.raws.append(raw)
        self.starts.append(starts + self.bytes)
        self.ends.append(ends + self.bytes)
        self.bytes += len(raw)
        self.words += len(starts)

    def shard(self, number: int) -> pa.RecordBatch:
        """One row: the shard's ids, and its words with language and count (id 1 first)."""
        _, first, ids, counts = np.unique(np.concatenate(self.hashes), return_index=True, return_inverse=True,
                                          return_counts=True)
        common = np.argsort(-counts, kind="stable")       # frequent words get small ids
        rank = np.empty_like(common)
        rank[common] = np.arange(1, len(common) + 1)
        body = _squeeze(with_breaks(rank[ids], np.concatenate(self.cuts)))
        first, counts = first[common], counts[common]
        start, end = np.concatenate(self.starts)[first], np.concatenate(self.ends)[first]
        length = end - start
        offsets = np.concatenate(([0], np.cumsum(length)))
        at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], length)
        data = np.concatenate(self.raws)[at]
        words = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))
        names = pa.array(list(self.names), pa.string())
        langs = names.take(pa.array(np.concatenate(self.langs)[first]))
        whole = pa.array([0, len(first)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([body], pa.binary()),
             pa.ListArray.from_arrays(whole, words), pa.ListArray.from_arrays(whole, langs),
             pa.ListArray.from_arrays(whole, pa.array(counts.astype(np.int64)))],
            names=["shard", "body", "words", "langs", "counts"])


def _shards(options: PhraseOptions):
    def run(batches):
        number, held = TaskContext.get().partitionId() << 24, _Gather()
        for batch in batches:
            held.add(list(byte_rows(batch.column("text"))), batch.column("lang").to_pylist())
            if held.words >= options.shard_words:
                yield held.shard(number)
                number, held = number + 1, _Gather()
        if held.words:
            yield held.shard(number)
    return run


def _squeeze(ids: np.ndarray) -> bytes:
    """Ids as bytes: their number, then 32 bits each, compressed."""
    return np.array([len(ids)], "<i8").tobytes() + pa.compress(ids.astype("<i4").tobytes(), codec="zstd", asbytes=True)


def _ids(body: bytes) -> np.ndarray:
    size = int(np.frombuffer(body, "<i8", 1)[0])
    return np.frombuffer(pa.decompress(memoryview(body)[8:], 4 * size, codec="zstd", asbytes=True), "<i4")


_BITS = 32                           # of a word id in a pair
_PAIRS = pa.schema([("shard", pa.int64()), ("pair", pa.int64()), ("n", pa.int64())])
_LONGER = pa.schema([("pair", pa.int64()), ("rest", pa.int64()), ("n", pa.int64())])


def _frequent(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A shard's ids of frequent words only (from 1, others are breaks), their word ids, and its frequent pairs.

    ``right`` holds a row ``lid, id`` per frequent word, and a row -1 and the pair per frequent pair.
    """
    ids = _ids(left.column("body")[0].as_py())
    lid, wid = right.column("lid").to_numpy(), right.column("id").to_numpy()
    pairs = wid[lid < 0]
    lid, wid = lid[lid >= 0], wid[lid >= 0]
    order = np.argsort(wid)
    lid, wid = lid[order], wid[order]
    small = np.zeros(int(max(ids.max(initial=0), lid.max(initial=0))) + 1, np.int32)
    small[lid] = np.arange(1, len(lid) + 1)
    return with_breaks(small[ids], np.zeros(len(ids), bool)), wid, pairs


def _pairs(left: pa.Table, right: pa.Table) -> pa.Table:
    """Round 2 for one shard: its frequent words' pairs with counts."""
    if not len(left) or not len(right):
        return _PAIRS.empty_table()
    ids, wid, _ = _frequent(left, right)
    index = FMIndex(ids, len(wid) + 1, depth=1, both=False)
    (a, b), _, n, _ = index.left(index.words())
    return pa.table([pa.array(np.full(len(a), left.column("shard")[0].as_py())),
                     pa.array(wid[a - 1] << _BITS | wid[b - 1]), pa.array(n)], schema=_PAIRS)


def _longer(left: pa.Table, right: pa.Table) -> pa.Table:
    """Round 3 for one shard: its phrases of three and four words whose pairs are frequent."""
    if not len(left) or not len(right):
        return _LONGER.empty_table()
    ids, wid, pairs = _frequent(left, right)
    if not len(pairs):
        return _LONGER.empty_table()
    sigma = len(wid) + 1
    place = np.searchsorted(wid, np.concatenate((pairs >> _BITS, pairs & ((1 << _BITS) - 1)))) + 1
    good = np.sort(place[:len(pairs)] * sigma + place[len(pairs):])
    pair = ids[:-1].astype(np.int64) * sigma + ids[1:]
    at = np.minimum(np.searchsorted(good, pair), len(good) - 1)
    cut = np.concatenate(([True], good[at] != pair))
    # words next to no frequent pair are breaks
    alone = cut & np.append(cut[1:], True)
    ids = with_breaks(np.where(alone, 0, ids), cut)
    index = FMIndex(ids, sigma)
    three = index.right(index.left(index.words()))
    four = index.left(three)
    (a, b, c), (e, f, g, h) = three[0], four[0]
    return pa.table([pa.array(np.concatenate((wid[a - 1] << _BITS | wid[b - 1], wid[e - 1] << _BITS | wid[f - 1]))),
                     pa.array(np.concatenate((wid[c - 1] << _BITS, wid[g - 1] << _BITS | wid[h - 1]))),
                     pa.array(np.concatenate((three[2], four[2])))], schema=_LONGER)


def _stored(df: DataFrame, kind: str) -> DataFrame:
    path = scratch_path(df.sparkSession, kind)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


@dataclass
class Counts:
    """Stored counts over all texts: words per language, frequent words, and frequent phrases of 2 to 4 words."""
    sizes: DataFrame        # lang, n
    lexicon: DataFrame      # wid, lang, word, a
    phrases: DataFrame      # w1, w2, w3, w4 (0: none), a


def count_phrases(docs: DataFrame, options: PhraseOptions = PhraseOptions()) -> Counts:
    """Counts of ``docs`` (lang, text)."""
    shards = _stored(map_texts(docs.select("lang", "text"), _shards(options),
                               "shard long, body binary, words array<string>, langs array<string>, counts array<long>"),
                     "phrases")
    vocabulary = shards.select("shard", F.posexplode(F.arrays_zip("words", "langs", "counts")).alias("i", "x")).select(
        "shard", (F.col("i") + 1).cast("long").alias("lid"), F.col("x.words").alias("word"),
        F.col("x.langs").alias("lang"), F.col("x.counts").alias("n"))
    sizes = materialize(vocabulary.groupBy("lang").agg(F.sum("n").alias("n")), "phrases")
    words = vocabulary.groupBy("lang", "word").agg(F.sum("n").alias("a")).where(F.col("a") >= options.least)
    lexicon = prefix_sums(words.withColumn("one", F.lit(1).cast("long")), ["lang", "word"], {"wid": "one"}, "phrases")
    lexicon = materialize(lexicon.select((F.col("wid") + 1).alias("wid"), "lang", "word", "a"), "phrases")
    if lexicon.count() >= 1 << (_BITS - 1):
        raise ValueError(f"more than {(1 << (_BITS - 1)) - 1} different words occur {options.least} times")
    known = join_by_size(vocabulary.select("shard", "lid", "lang", "word"), lexicon.select("wid", "lang", "word"),
                         ["lang", "word"], "inner").select(F.col("shard").alias("of"), "lid", F.col("wid").alias("id"))
    bodies = shards.select("shard", "body")
    pairs = bodies.groupBy("shard").cogroup(known.groupBy("of")).applyInArrow(_pairs, "shard long, pair long, n long")
    # one row a shard and pair: the total goes to each, so one exchange serves the counting and the way back
    each = Window.partitionBy("pair")
    pairs = materialize(pairs.select("shard", "pair", F.sum("n").over(each).alias("a"))
                        .where(F.col("a") >= options.least), "phrases")
    told = known.unionByName(pairs.select(F.col("shard").alias("of"), F.lit(-1).cast("long").alias("lid"),
                                          F.col("pair").alias("id")))
    longer = bodies.groupBy("shard").cogroup(told.groupBy("of")).applyInArrow(_longer, "pair long, rest long, n long")
    longer = longer.groupBy("pair", "rest").agg(F.sum("n").alias("a")).where(F.col("a") >= options.least)
    two = pairs.groupBy("pair").agg(F.max("a").alias("a")).select("pair", F.lit(0).cast("long").alias("rest"), "a")

    def word(column, high):
        return F.shiftright(column, _BITS) if high else F.col(column).bitwiseAND(F.lit((1 << _BITS) - 1))
    phrases = materialize(longer.unionByName(two).select(
        word("pair", True).alias("w1"), word("pair", False).alias("w2"), word("rest", True).alias("w3"),
        word("rest", False).alias("w4"), "a"), "phrases")
    return Counts(sizes, lexicon, phrases)


# -- scores ---------------------------------------------------------------------------

_W = ["w1", "w2", "w3", "w4"]


def _part(first: int, last: int, name: str):
    """Words ``first`` to ``last`` (from 1) as columns ``name``1 to 4, filled up with 0."""
    return [(F.col(f"w{first + k}") if first + k <= last else F.lit(0).cast("long")).alias(f"{name}{k + 1}")
            for k in range(4)]


def scored(counts: Counts, options: PhraseOptions = PhraseOptions()) -> DataFrame:
    """``w1..w4, size, a, l, r, score`` of every candidate that no longer one drops."""
    size = F.when(F.col("w4") > 0, 4).when(F.col("w3") > 0, 3).otherwise(2)
    rows = counts.phrases.withColumn("size", size)
    zero = F.lit(0).cast("long")
    every = materialize(counts.phrases.unionByName(counts.lexicon.select(
        F.col("wid").alias("w1"), zero.alias("w2"), zero.alias("w3"), zero.alias("w4"), "a")), "phrases")
    cuts = [F.when(F.col("size") == s, F.struct(F.lit(k).alias("k"), *_part(1, k, "p"), *_part(k + 1, s, "q")))
            for s in (2, 3, 4) for k in range(1, s)]
    cut = rows.select(*_W, "a", "size", F.explode(F.array_compact(F.array(*cuts))).alias("c")) \
        .select(*_W, "a", "size", "c.*")
    for name, count in (("p", "l"), ("q", "r")):
        side = every.select(*[F.col(w).alias(f"{name}{k + 1}") for k, w in enumerate(_W)], F.col("a").alias(count))
        cut = cut.join(side, [f"{name}{k}" for k in range(1, 5)]).drop(*[f"{name}{k}" for k in range(1, 5)])
    wide = "decimal(20,0)"
    cut = cut.withColumn("score", F.expr(
        f"cast(cast(a as {wide}) * {options.scale} div (cast(l as {wide}) + cast(r as {wide})) as long)"))
    best = cut.groupBy(*_W, "a", "size").agg(F.min(F.struct("score", "k", "l", "r")).alias("best")) \
        .select(*_W, "a", "size", "best.l", "best.r", "best.score")
    inner = [F.when(F.col("size") == s, F.struct(*_part(i, i + n - 1, "w")))
             for s in (3, 4) for n in range(2, s) for i in range(1, s - n + 2)]
    cover = rows.where("size > 2").select("a", F.explode(F.array_compact(F.array(*inner))).alias("c")) \
        .select("a", "c.*").groupBy(*_W).agg(F.max("a").alias("cover"))
    covered = F.coalesce(100 * F.col("cover") >= options.cover_percent * F.col("a"), F.lit(False))
    return best.join(cover, _W, "left").where(~covered).drop("cover")


def collocations(docs: DataFrame, options: PhraseOptions = PhraseOptions()) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases of ``docs`` (lang, text)."""
    counts = count_phrases(docs, options)
    kept = materialize(scored(counts, options), "phrases")
    word = kept.select(*_W, F.posexplode(F.array(*_W)).alias("i", "wid")).where("wid > 0")
    told = join_by_size(word, counts.lexicon.select("wid", "lang", "word"), "wid", "inner").groupBy(*_W).agg(
        F.min("lang").alias("lang"),
        F.concat_ws(" ", F.transform(F.sort_array(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]))
        .alias("phrase"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.join(told, _W).select("lang", "phrase", "a", "l", "r", "score", F.row_number().over(best).cast("long")
                                        .alias("rank")).where(F.col("rank") <= options.top)
    return ranked.join(counts.sizes, "lang") \
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle(options: PhraseOptions = PhraseOptions()) -> str:
    """DuckDB SQL for the registered query."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang, row_number() OVER () AS piece, part
  FROM (SELECT lang, unnest(string_split_regex(translate(text, '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) AS part
        FROM documents WHERE text IS NOT NULL)
), words AS (
  SELECT lang, regexp_extract_all(part, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, s
  FROM (SELECT lang, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM words, range(1, 5) t(s) WHERE len(w) >= s)
), counts AS (
  SELECT lang, phrase, s, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= {options.least}
), sizes AS (SELECT lang, count(*) AS n FROM grams WHERE s = 1 GROUP BY lang), candidates AS (
  SELECT lang, phrase, s, a, string_split(phrase, ' ') AS w FROM counts WHERE s > 1
), cuts AS (
  SELECT c.lang, c.phrase, c.s, c.a, k, l.a AS l, r.a AS r,
         ({options.scale}::HUGEINT * c.a // (l.a + r.a))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, s)) AS k FROM candidates) c
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_parts AS (
  SELECT lang, a, array_to_string(w[i:i + t - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, s - t + 2)) AS i FROM (SELECT *, unnest(range(2, s)) AS t FROM candidates WHERE s > 2))
), cover AS (SELECT lang, phrase, max(a) AS most FROM inner_parts GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS rank,
       b.phrase, b.a, b.l, b.r, z.n, b.score
FROM best b JOIN sizes z ON z.lang = b.lang LEFT JOIN cover c ON c.lang = b.lang AND c.phrase = b.phrase
WHERE c.most IS NULL OR 100 * c.most < {options.cover_percent} * b.a
QUALIFY rank <= {options.top}
"""

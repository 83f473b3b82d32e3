"""Hard negatives from Hilbert-ordered blocks with zone maps (operator 13).

Every component x of a vector is ``floor(256 * x)``; scores are integer inner products.  The vectors are
range-sorted by label and by their place on a Hilbert curve (``curve_dims`` dimensions of greatest
variance, ``curve_bits`` bits each, cells of equal width over 99% of a sample of ``sample_rows`` rows or so)
and stored in Parquet, one row per block of ``block_rows`` neighbours, with the least and greatest value of
each dimension and of the label.  Every vector is in a block; the sample only shapes the curve.

Anchors are packed into tiles.  A tile reads the zone maps of all blocks, in pages; interval arithmetic
bounds the score of every anchor with every row of a block:

    sum over i of min(q_i * low_i, q_i * high_i)  <=  q . x  <=  sum over i of max(q_i * low_i, q_i * high_i)

Positives: the anchor's own block gives a fifth-best score to begin with, and a block of the anchor's
label is read if its upper bound reaches that.  Negatives: each positive opens a window of scores, and a
block is read if it holds another label and its bounds meet a window of one of the tile's anchors.  What
is read is scored exactly, so the result is that of comparing every anchor with every row.

A task holds one block and one tile at a time (and a batch of such rows); a unit emits at most
``positives`` rows an anchor and ``negatives`` rows a window, which Spark's partial top-k reduces.

Defined cases: rows with a null id, label or vector or a null or non-finite component take no part; rows
that share an id count once (the smallest label and vector); vectors of different lengths are compared
over their common length; scores beyond 64 bits are compared exactly and given as the end of the range;
an anchor without positives, or a window without rows, gives no rows; an empty table gives none.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillet.llm.common import join_by_size
from rillet.session import materialize


@dataclass(frozen=True)
class NegativeOptions:
    anchor_every: int = 50
    positives: int = 5
    negatives: int = 3
    low_percent: int = 50            # of the positive's score
    high_percent: int = 95
    relabel_every: int = 7           # ids divisible by this get the next of `labels` labels first
    labels: int = 10
    block_rows: int = 1_024
    tile_rows: int = 256
    page_blocks: int = 256           # zone maps in a page
    curve_dims: int = 16
    curve_bits: int = 4              # curve_dims * curve_bits is 64 at most
    sample_rows: int = 20_000


_EXACT = float(1 << 53)              # up to here sums of doubles are exact
_LONG = (1 << 63) - 1


# -- the curve ------------------------------------------------------------------------

def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of the rows of ``cells`` (n, dims), values below 2^bits, as signed 64-bit keys.

    Gray-code transform by bit planes, all rows at once; dims * bits must be 64 at most.
    """
    x = cells.astype(np.uint64).T.copy()
    dims = len(x)
    one = np.uint64(1)
    q = 1 << (bits - 1)
    while q > 1:
        p, flag = np.uint64(q - 1), np.uint64(q)
        for i in range(dims):
            up = (x[i] & flag) != 0
            swap = np.where(up, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] ^= np.where(up, p, np.uint64(0)) ^ swap
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[dims - 1] & np.uint64(q)) != 0, np.uint64(q - 1), np.uint64(0))
        q >>= 1
    x ^= turn
    key = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << one) | ((x[i] >> np.uint64(b)) & one)
    return (key ^ np.uint64(1 << 63)).view(np.int64)


def fit_curve(sample: list, options: NegativeOptions) -> tuple[np.ndarray, np.ndarray]:
    """The dimensions of greatest variance and each one's inner cell borders, from a bounded sample."""
    width = max(map(len, sample), default=0)
    if width == 0:
        return np.zeros(0, np.int64), np.zeros((0, 0))
    x = np.zeros((len(sample), width))
    for row, v in zip(x, sample):
        row[:len(v)] = v
    dims = np.sort(np.argsort(-x.var(axis=0), kind="stable")[:options.curve_dims])
    cells = 1 << options.curve_bits
    low, high = np.quantile(x[:, dims], [0.005, 0.995], axis=0)
    return dims, low[:, None] + (high - low)[:, None] * np.arange(1, cells) / cells


def _matrix(column) -> np.ndarray:
    """The rows of an Arrow list<long> array as a matrix, shorter ones filled up with 0."""
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(size.max()) if len(size) else 0
    if len(size) and (size == width).all():
        return flat.reshape(len(size), width).astype(np.int64, copy=False)
    out = np.zeros((len(size), width), np.int64)
    out[np.arange(width) < size[:, None]] = flat
    return out


def _keyed(shape):
    def run(batches):
        dims, borders = shape.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("q"))
            cells = np.zeros((len(x), len(dims)), np.int64)
            for k, d in enumerate(dims):
                if d < x.shape[1]:
                    cells[:, k] = np.searchsorted(borders[k], x[:, d], "right")
            bits = max(1, int(len(borders[0]) + 1).bit_length() - 1) if len(borders) else 1
            place = hilbert(cells, bits) if len(dims) else np.zeros(len(x), np.int64)
            yield batch.append_column("place", pa.array(place))
    return run


# -- blocks ---------------------------------------------------------------------------

def usable(vectors: DataFrame, options: NegativeOptions = NegativeOptions()) -> DataFrame:
    """``vec_id, label, q`` of the rows that take part, relabelled and in whole numbers."""
    v = F.transform("embedding", lambda e: e.cast("double"))
    sound = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % options.relabel_every == 0, (label + 1) % options.labels).otherwise(label)
    rows = vectors.where("vec_id is not null and label is not null and embedding is not null") \
        .select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), v.alias("v")).where(sound) \
        .select("vec_id", "label", F.transform("v", lambda e: F.floor(e * 256).cast("long")).alias("q"))
    rows = materialize(rows, "negatives")
    twice = materialize(rows.groupBy("vec_id").count().where("count > 1").select("vec_id"), "negatives")
    if twice.limit(1).count():
        once = join_by_size(rows, twice, "vec_id", "left_semi").groupBy("vec_id") \
            .agg(F.min(F.struct("label", "q")).alias("m")).select("vec_id", "m.*")
        rows = materialize(join_by_size(rows, twice, "vec_id", "left_anti").unionByName(once), "negatives")
    return rows


_PACK = pa.schema([("pack", pa.int64()), ("size", pa.int64()), ("ids", pa.binary()), ("labels", pa.binary()),
                   ("rows", pa.binary())])
_BLOCK = pa.schema([*_PACK, ("least", pa.list_(pa.int64())), ("most", pa.list_(pa.int64())), ("label_least", pa.int64()),
                    ("label_most", pa.int64())])
_BLOCK_DDL = "pack long, size long, ids binary, labels binary, rows binary, least array<long>, most array<long>, " \
             "label_least long, label_most long"


def _packed(number: int, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
    def rows(low):
        return pa.array([low.tolist()], pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), pa.array([len(ids)]), pa.array([ids.astype("<i8").tobytes()], pa.binary()),
         pa.array([labels.astype("<i8").tobytes()], pa.binary()), pa.array([x.astype("<i8").tobytes()], pa.binary()),
         rows(x.min(axis=0)), rows(x.max(axis=0)), pa.array([int(labels.min())]), pa.array([int(labels.max())])],
        schema=_BLOCK)


def _pack(rows: int, sort_label: bool = True):
    """Rows in order into one row per ``rows`` neighbours of a partition."""
    def run(batches):
        number, held, count = TaskContext.get().partitionId() << 32, [], 0

        def flush():
            width = max(x.shape[1] for _, _, x in held)
            parts = [np.pad(x, ((0, 0), (0, width - x.shape[1]))) for _, _, x in held]
            return _packed(number, np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]),
                           np.concatenate(parts))
        for batch in batches:
            ids, labels = (batch.column(c).to_numpy() for c in ("vec_id", "label"))
            x, at = _matrix(batch.column("q")), 0
            while at < len(ids):
                end = min(len(ids), at + rows - count)
                held.append((ids[at:end], labels[at:end], x[at:end]))
                count += end - at
                at = end
                if count == rows:
                    yield flush()
                    number, held, count = number + 1, [], 0
        if count:
            yield flush()
    return run


class _Rows:
    """A stored pack's rows."""

    def __init__(self, ids, labels, rows):
        self.ids, self.labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
        self.x = np.frombuffer(rows, "<i8").reshape(len(self.ids), -1)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices over their common width: int64, or Python integers."""
    width = min(a.shape[1], b.shape[1])
    if width == 0:
        return np.zeros((len(a), len(b)), np.int64)
    a, b = a[:, :width], b[:, :width]
    most = float(np.abs(a.astype(float)).max()) * float(np.abs(b.astype(float)).max()) * width if len(a) and len(b) else 0
    if most < _EXACT:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a.astype(object) @ b.astype(object).T


def bounds(q: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the products of ``q``'s rows with anything between ``least`` and ``most`` (a row a block).

    Doubles, widened where they might not be exact.
    """
    width = min(q.shape[1], least.shape[1])
    up, down = np.maximum(q[:, :width], 0).astype(float), np.minimum(q[:, :width], 0).astype(float)
    least, most = least[:, :width].astype(float), most[:, :width].astype(float)
    low, high = up @ least.T + down @ most.T, up @ most.T + down @ least.T
    slack = (up - down) @ np.maximum(np.abs(least), np.abs(most)).T
    slack = np.where(slack < _EXACT, 0.0, slack * 1e-12)
    return low - slack, high + slack


def _clip(x) -> np.ndarray:
    if getattr(x, "dtype", None) == np.int64:
        return x
    return np.array([max(-_LONG - 1, min(_LONG, int(v))) for v in x], np.int64)


def _first(keys: list[np.ndarray], count: int) -> np.ndarray:
    """The first ``count`` places by score descending (first key), then id."""
    score, ids = keys
    if len(ids) > 8 * count and score.dtype == np.int64:
        edge = np.partition(score, len(score) - count)[len(score) - count]
        near = np.flatnonzero(score >= edge)
        return near[np.lexsort((ids[near], -score[near]))[:count]]
    if score.dtype == np.int64:
        return np.lexsort((ids, -score))[:count]
    return np.array(sorted(range(len(ids)), key=lambda k: (-score[k], ids[k]))[:count], np.int64)


def _best_positives(anchors: _Rows, block: _Rows, count: int):
    """Per anchor, the places of the best rows of its label in the block, with all scores."""
    of = scores(anchors.x, block.x)
    for i, (vec, label) in enumerate(zip(anchors.ids, anchors.labels)):
        mine = np.flatnonzero((block.labels == label) & (block.ids != vec))
        if len(mine):
            at = mine[_first([of[i][mine], block.ids[mine]], count)]
            yield i, at, of[i][at]


# -- positives ------------------------------------------------------------------------

_TILE_DDL = "pack long, size long, ids binary, labels binary, rows binary, floors array<double>"


def _tiles(options: NegativeOptions):
    """The blocks' anchors in tiles, each with a score that its ``positives``-th best reaches (-inf: unknown)."""
    schema = pa.schema([*_PACK, ("floors", pa.list_(pa.float64()))])

    def run(batches):
        number, held, count = TaskContext.get().partitionId() << 32, [], 0

        def flush():
            width = max(x.shape[1] for _, _, x, _ in held)
            x = np.concatenate([np.pad(h[2], ((0, 0), (0, width - h[2].shape[1]))) for h in held])
            ids, labels = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([len(ids)]), *[pa.array([v.tobytes()], pa.binary()) for v in (ids, labels, x)],
                 pa.array([np.concatenate([h[3] for h in held]).tolist()], pa.list_(pa.float64()))], schema=schema)
        for batch in batches:
            for block in map(_Rows, *[batch.column(c).to_pylist() for c in ("ids", "labels", "rows")]):
                own = np.flatnonzero(block.ids % options.anchor_every == 0)
                if not len(own):
                    continue
                anchors = _Rows.__new__(_Rows)
                anchors.ids, anchors.labels, anchors.x = block.ids[own], block.labels[own], block.x[own]
                floors = np.full(len(own), -np.inf)
                for i, _, best in _best_positives(anchors, block, options.positives):
                    if len(best) == options.positives:
                        floors[i] = np.nextafter(float(best[-1]), -np.inf) if abs(float(best[-1])) >= _EXACT else best[-1]
                held.append((anchors.ids, anchors.labels, anchors.x, floors))
                count += len(own)
                if count >= options.tile_rows:
                    yield flush()
                    number, held, count = number + 1, [], 0
        if count:
            yield flush()
    return run


def _zones(batch, row: int):
    zones = batch.column("zones")[row].as_py()
    width = max((len(z["least"]) for z in zones), default=0)
    # a shorter block's rows count as filled up with 0
    least, most = ([z[c] + [0] * (width - len(z[c])) for z in zones] for c in ("least", "most"))
    return (np.array([z["pack"] for z in zones], np.int64), np.array(least, np.int64).reshape(len(zones), width),
            np.array(most, np.int64).reshape(len(zones), width), np.array([z["label_least"] for z in zones], np.int64),
            np.array([z["label_most"] for z in zones], np.int64), np.array([z["size"] for z in zones], np.int64))


def _chosen(needs):
    """Pairs (tile, block) where ``needs(batch, row, anchors, low, high, label_least, label_most, size)`` holds for an anchor."""
    def run(batches):
        for batch in batches:
            tiles, found = [], []
            for row in range(batch.num_rows):
                anchors = _Rows(*[batch.column(c)[row].as_py() for c in ("ids", "labels", "rows")])
                packs, least, most, *labels_and_size = _zones(batch, row)
                low, high = bounds(anchors.x, least, most)
                read = packs[needs(batch, row, anchors, low, high, *labels_and_size).any(axis=0)]
                tiles.append(np.full(len(read), batch.column("pack")[row].as_py(), np.int64))
                found.append(read)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tiles)), pa.array(np.concatenate(found))],
                                                 names=["tile", "block"])
    return run


def _of_page(tiles: DataFrame, blocks: DataFrame, pages: int):
    """``tiles`` times the pages of zone maps, each page holding ``page_blocks`` blocks or so."""
    zones = blocks.select(F.pmod(F.xxhash64("pack"), F.lit(pages)).alias("page"), F.struct(
        "pack", "least", "most", "label_least", "label_most", "size").alias("z")).groupBy("page") \
        .agg(F.collect_list("z").alias("zones"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pages - 1).cast("long")))
    return tiles.withColumn("page", every).join(zones, "page")


def _read(pairs: DataFrame, tiles: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each chosen pair with its tile's columns and the block's rows."""
    side = blocks.select(F.col("pack").alias("block"), F.col("ids").alias("b_ids"), F.col("labels").alias("b_labels"),
                         F.col("rows").alias("b_rows"))
    return pairs.join(tiles.withColumnRenamed("pack", "tile"), "tile").join(side, "block")


def _units(batch):
    for row in range(batch.num_rows):
        yield (row, _Rows(*[batch.column(c)[row].as_py() for c in ("ids", "labels", "rows")]),
               _Rows(*[batch.column(c)[row].as_py() for c in ("b_ids", "b_labels", "b_rows")]))


def _reaches(options: NegativeOptions):
    """Blocks that may hold one of an anchor's positives."""
    def needs(batch, row, anchors, low, high, first, last, size):
        own = anchors.labels[:, None]
        floors = np.array(batch.column("floors")[row].as_py())
        # all rows of a block of the anchor's label score its lower bound at least
        sure = (first[None, :] == own) & (last[None, :] == own) & (size > options.positives)[None, :]
        floors = np.maximum(floors, np.where(sure, low, -np.inf).max(axis=1, initial=-np.inf))
        return (first[None, :] <= own) & (own <= last[None, :]) & (high >= floors[:, None])
    return needs


def _positive_rows(options: NegativeOptions):
    def run(batches):
        for batch in batches:
            out = []
            for row, anchors, block in _units(batch):
                floors = batch.column("floors")[row].as_py()
                tile = batch.column("tile")[row].as_py()
                for i, at, best in _best_positives(anchors, block, options.positives):
                    out += [(tile, i, int(anchors.ids[i]), int(block.ids[k]), str(int(s)))
                            for k, s in zip(at, best) if s >= floors[i]]
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()))],
                names=["tile", "nth", "anchor_id", "positive_id", "score"])
    return run


# -- negatives ------------------------------------------------------------------------

def window(score: int, options: NegativeOptions) -> tuple[int, int]:
    """The least and the greatest score a negative may have beside a positive of ``score`` (empty if they cross)."""
    return -(-options.low_percent * score // 100), options.high_percent * score // 100


def _windows(options: NegativeOptions):
    """Tiles with their anchors' positives (a list of ``nth, positive_id, score``)."""
    def needs(batch, row, anchors, low, high, first, last, size):
        own = anchors.labels[:, None]
        other = (first[None, :] != own) | (last[None, :] != own)
        out = np.zeros(low.shape, bool)
        for p in batch.column("positives")[row].as_py():
            a, b = window(int(p["score"]), options)
            if a <= b:
                out[p["nth"]] |= (high[p["nth"]] >= a) & (low[p["nth"]] <= b)
        return out & other
    return needs


def _negative_rows(options: NegativeOptions):
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string())

    def run(batches):
        for batch in batches:
            out = []
            for row, anchors, block in _units(batch):
                of = scores(anchors.x, block.x)
                for p in batch.column("positives")[row].as_py():
                    i, (a, b) = p["nth"], window(int(p["score"]), options)
                    if a > b:
                        continue
                    mine = np.flatnonzero((of[i] >= a) & (of[i] <= b) & (block.labels != anchors.labels[i]))
                    if len(mine):
                        at = mine[_first([of[i][mine], block.ids[mine]], options.negatives)]
                        out += [(int(anchors.ids[i]), p["positive_id"], p["score"], int(block.ids[k]), str(int(of[i][k])))
                                for k in at]
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             names=["anchor_id", "positive_id", "positive_score", "negative_id", "score"])
    return run


def _wide(score) -> F.col:
    return F.col(score).cast("decimal(38,0)")


def _long(score):
    return F.least(F.greatest(_wide(score), F.lit(-_LONG - 1).cast("decimal(38,0)")),
                   F.lit(_LONG).cast("decimal(38,0)")).cast("long")


def _ranked(rows: DataFrame, keys: list[str], other: str, count: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(_wide("score")), other)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def store_blocks(points: DataFrame, options: NegativeOptions = NegativeOptions()) -> DataFrame:
    """The stored blocks of ``points`` (vec_id, label, q): rows in curve order, with zone maps."""
    spark = points.sparkSession
    total = points.count()
    draw = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30))
    sample = points if total <= options.sample_rows else \
        points.where(draw < int((1 << 30) * options.sample_rows / total))
    sample = [r[0] for r in sample.select("q").limit(2 * options.sample_rows).collect()]
    shape = spark.sparkContext.broadcast(fit_curve(sample, options))
    ddl = "vec_id long, label long, q array<long>, place long"
    keyed = materialize(points.mapInArrow(_keyed(shape), ddl), "negatives")
    parts = max(1, -(-total // (8 * options.block_rows)))
    ordered = keyed.repartitionByRange(parts, "label", "place", "vec_id").sortWithinPartitions("label", "place", "vec_id")
    return materialize(ordered.select("vec_id", "label", "q").mapInArrow(_pack(options.block_rows), _BLOCK_DDL), "negatives")


def hard_negatives(vectors: DataFrame, options: NegativeOptions = NegativeOptions()) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for ``vec_id, label, embedding``."""
    blocks = store_blocks(usable(vectors, options), options)
    tiles = materialize(blocks.select("ids", "labels", "rows").mapInArrow(_tiles(options), _TILE_DDL), "negatives")
    pages = max(1, -(-blocks.count() // options.page_blocks))
    pairs = materialize(_of_page(tiles, blocks, pages).mapInArrow(_chosen(_reaches(options)), "tile long, block long"),
                        "negatives")
    found = _read(pairs, tiles, blocks).mapInArrow(
        _positive_rows(options), "tile long, nth int, anchor_id long, positive_id long, score string")
    best = materialize(_ranked(found, ["anchor_id"], "positive_id", options.positives), "negatives")
    held = best.groupBy("tile").agg(F.collect_list(F.struct("nth", "positive_id", "score")).alias("positives"))
    asking = materialize(tiles.drop("floors").join(held.withColumnRenamed("tile", "pack"), "pack"), "negatives")
    pairs = materialize(_of_page(asking, blocks, pages).mapInArrow(_chosen(_windows(options)), "tile long, block long"),
                        "negatives")
    found = _read(pairs, asking, blocks).mapInArrow(
        _negative_rows(options),
        "anchor_id long, positive_id long, positive_score string, negative_id long, score string")
    top = _ranked(found, ["anchor_id", "positive_id"], "negative_id", options.negatives)
    return top.select("anchor_id", "positive_id", "rank", "negative_id", _long("positive_score").alias("positive_score"),
                      _long("score").alias("negative_score"))


def oracle(options: NegativeOptions = NegativeOptions()) -> str:
    """DuckDB SQL for the registered query."""
    o = options
    return f"""
WITH sound AS (
  SELECT vec_id, label, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), points AS (
  SELECT vec_id, CASE WHEN vec_id % {o.relabel_every} = 0 THEN (label + 1) % {o.labels} ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM sound
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM points a JOIN points b ON a.vec_id % {o.anchor_every} = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {o.positives}
)
SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
         ORDER BY s.score DESC, s.other_id)::INT AS rank, s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND {o.low_percent} * p.positive_score <= 100 * s.score AND 100 * s.score <= {o.high_percent} * p.positive_score
QUALIFY rank <= {o.negatives}
"""

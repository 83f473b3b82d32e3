"""Near-duplicates by one-permutation MinHash with optimal densification (operator 2).

1. Every text's shingle set is hashed once: one permutation (the shingle hash itself) deals the
   shingles to ``bands * rows`` bins, each bin keeps its minimum, and an empty bin copies the first
   non-empty bin along its own fixed random order of bins (optimal densification).  Eight bits of
   each bin are stored.  Documents with equal sets form one class and go on as one representative.
2. ``rows`` neighbouring bins are a band; equal bands are a bucket.  Candidate edges are stars: in
   each bucket every member points at the bucket's smallest member, and of its hubs a member keeps
   the one it shares most bands with, so there are at most as many edges as representatives.
3. Edges are confirmed on the full sets of 64-bit shingle hashes; confirmed ones are joined into
   components.
4. A star proves only links to its hub.  Buckets that still hold several components are therefore
   read again in blocks: members of different components are compared by their sketches (each pair in
   the first band it shares), and members with a pair that could reach the threshold come back with
   their full sets and are compared exactly.  Buckets are cut into blocks of bounded size, block pairs
   being the unit of work, so no bucket meets in one task, and a unit gives out the links that join
   something, not pairs.

With 6 rows and 50 bands a pair of similarity 0.75 shares no band with probability 6e-5 (0.8: 3e-7),
and a pair at the threshold passes the sketch comparison but for 1 case in 10^7.

Defined cases: null or empty texts have the empty set, no link and their own id as component; a null
``doc_id`` takes its class's component, null if the class has no id, and is never kept; rows that
share one ``doc_id`` are one node, each row keeping its own ``n_shingles``; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import byte_rows, components, join_by_size, map_texts, mix, runs, shingles
from rillet.session import materialize


@dataclass(frozen=True)
class MinHashOptions:
    percent: int = 75          # link when 100 * intersection >= percent * union
    shingle_words: int = 5
    bands: int = 50
    rows: int = 6
    block: int = 256           # members of a bucket compared at once
    seed: int = 11


_U = np.uint64


def fill_order(bins: int, seed: int) -> np.ndarray:
    """For each bin, a random order of all bins: the order in which an empty bin looks for a value."""
    rng = np.random.default_rng(seed)
    return np.argsort(rng.random((bins, bins)), axis=1)


def sketch(hashes: np.ndarray, bins: int, order: np.ndarray) -> np.ndarray:
    """The 8-bit one-permutation sketch of a non-empty set of 64-bit hashes."""
    bucket = ((hashes >> _U(32)) * _U(bins)) >> _U(32)
    low = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(low, bucket.astype(np.int64), hashes)
    full = np.zeros(bins, bool)
    full[bucket.astype(np.int64)] = True
    empty = np.flatnonzero(~full)
    if len(empty):
        source = order[empty, np.argmax(full[order[empty]], axis=1)]
        low[empty] = low[source]
    return (mix(low) >> _U(56)).astype(np.uint8)


def _sketches(options: MinHashOptions):
    bins = options.bands * options.rows

    def run(batches):
        order = fill_order(bins, options.seed)
        for batch in batches:
            n, one, two, marks = [], [], [], []
            for raw in byte_rows(batch.column("text")):
                h = shingles(raw, options.shingle_words)
                n.append(len(h))
                one.append(int(mix(h).sum().astype(np.int64)) if len(h) else 0)
                two.append(int(mix(h ^ _U(0x5851F42D4C957F2D)).sum().astype(np.int64)) if len(h) else 0)
                marks.append(sketch(h, bins, order).tobytes() if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(one, pa.int64()),
                 pa.array(two, pa.int64()), pa.array(marks, pa.binary())],
                names=["doc_id", "n_shingles", "set1", "set2", "sketch"])
    return run


def _sets(size: int):
    def run(batches):
        for batch in batches:
            rows = [shingles(raw, size).tobytes() for raw in byte_rows(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(rows, pa.binary())],
                                             names=["node", "hashes"])
    return run


def full_sets(docs: DataFrame, nodes: DataFrame, options: MinHashOptions) -> DataFrame:
    """``node, hashes``: the full shingle sets of the documents in the stored table ``nodes``."""
    texts = join_by_size(docs.select(F.col("doc_id").alias("node"), "text"), nodes, "node", "left_semi")
    return materialize(map_texts(texts, _sets(options.shingle_words), "node long, hashes binary"), "minhash")


def common_count(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct values."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = common_count(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirm(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                keep.append(_linked(a, b, percent))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)],
                                             names=["a", "b"])
    return run


def _near_pairs(unit: dict, options: MinHashOptions):
    """Rows (left, right) of a unit that could be linked and share no earlier band."""
    bins = options.bands * options.rows
    share = options.percent / 100
    least = bins * (share - 5 * (share * (1 - share) / bins) ** 0.5)
    marks = np.frombuffer(b"".join(unit["sketch"]), np.uint8).reshape(-1, bins)
    comp, size = unit["component"], unit["n_shingles"]
    side = unit["left"].astype(bool)
    left, right = np.flatnonzero(side), np.flatnonzero(~side)
    for x in left:
        y = right[(comp[right] != comp[x]) & (100 * np.minimum(size[right], size[x]) >=
                                              options.percent * np.maximum(size[right], size[x]))]
        if len(y):
            same = marks[y] == marks[x]
            y, same = y[(near := same.sum(axis=1) >= least)], same[near]
            if len(y):
                first = same.reshape(len(y), options.bands, options.rows).all(axis=2).argmax(axis=1)
                y = y[first == unit["band"][0]]
                if len(y):
                    yield x, y


_UNIT = ["bucket", "i", "j"]


def _near_members(options: MinHashOptions):
    """The members of each unit that have a pair to be compared exactly."""
    def run(frames):
        for unit in runs(frames, _UNIT):
            keep = set()
            for x, y in _near_pairs(unit, options):
                keep.add(int(x))
                keep.update(y.tolist())
            if keep:
                at = np.array(sorted(keep))
                yield pd.DataFrame({c: v[at] for c, v in unit.items()})
    return run


def _exact_links(options: MinHashOptions):
    """Links of a unit by full sets, as a forest: only those that join two of its groups."""
    def run(frames):
        for unit in runs(frames, _UNIT):
            node = unit["node"]
            sets = [np.frombuffer(h, np.uint64) for h in unit["hashes"]]
            up = {int(c): int(c) for c in unit["component"]}

            def root(c):
                while up[c] != c:
                    up[c] = c = up[up[c]]
                return c

            out = []
            for x, ys in _near_pairs(unit, options):
                for y in ys:
                    a, b = root(int(unit["component"][x])), root(int(unit["component"][y]))
                    if a != b and _linked(sets[x], sets[y], options.percent):
                        up[a] = b
                        out.append((node[x], node[y]))
            if out:
                yield pd.DataFrame(out, columns=["a", "b"])
    return run


def confirm(edges: DataFrame, docs: DataFrame, options: MinHashOptions) -> DataFrame:
    """The edges (a, b) whose documents' full shingle sets reach the threshold."""
    edges = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .where("a < b").distinct(), "minhash")
    ends = materialize(edges.selectExpr("a node").union(edges.selectExpr("b node")).distinct(), "minhash")
    sets = full_sets(docs, ends, options)
    wide = edges.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a") \
        .join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b")
    return materialize(wide.select("a", "b", "x", "y").mapInArrow(_confirm(options.percent), "a long, b long"),
                       "minhash")


def near_duplicates(docs: DataFrame, options: MinHashOptions = MinHashOptions()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (doc_id long, text)."""
    docs = docs.select("doc_id", "text")
    rows = materialize(map_texts(
        docs, _sketches(options), "doc_id long, n_shingles long, set1 long, set2 long, sketch binary"), "minhash")
    # equal sets: one representative, whatever the number of copies
    classes = materialize(rows.where("n_shingles > 0").groupBy("set1", "set2", "n_shingles").agg(
        F.min("doc_id").alias("node"), F.first("sketch").alias("sketch")).where("node is not null"), "minhash")
    bands = classes.select("node", F.explode(F.expr(
        f"transform(sequence(0, {options.bands - 1}), i -> struct(i as band, "
        f"xxhash64(i, substring(sketch, i * {options.rows} + 1, {options.rows})) as bucket))")).alias("k")) \
        .select("node", "k.band", "k.bucket")
    buckets = bands.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("members")) \
        .where("members > 1").select("bucket", "hub")
    members = materialize(bands.join(buckets, "bucket"), "minhash")
    stars = members.where("node <> hub").groupBy("node", "hub").count() \
        .groupBy(F.col("node").alias("a")).agg(F.max_by("hub", F.struct("count", -F.col("hub"))).alias("b"))
    links = confirm(stars, docs, options)
    found = components(links, "minhash")
    more = _unresolved(members, classes, found, docs, options)
    if more is not None:
        found = components(links.union(more), "minhash")
    of_class = classes.join(found.withColumnRenamed("id", "node"), "node", "left").select(
        "set1", "set2", "n_shingles", F.coalesce("component", "node").alias("component"))
    ids = rows.select("doc_id", "n_shingles", "set1", "set2").join(
        of_class, ["set1", "set2", "n_shingles"], "left")
    # rows of one doc_id with different texts are one node: each row follows its id where that was linked
    component = F.coalesce("component", "doc_id")
    return ids.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def _unresolved(members: DataFrame, classes: DataFrame, found: DataFrame, docs: DataFrame,
                options: MinHashOptions) -> DataFrame | None:
    """Links between different components that share a bucket, as far as they join any; None if there are none.

    In a bucket, members outside its largest component are compared with all others: blocks of the
    former times blocks of all, so the largest component's members are dealt once per block of the rest.
    """
    held = materialize(members.select("node", "band", "bucket").join(found.withColumnRenamed("id", "node"), "node", "left")
                       .select("node", "band", "bucket", F.coalesce("component", "node").alias("component")), "minhash")
    open_ = held.groupBy("bucket", "component").count().groupBy("bucket").agg(
        F.count("*").alias("components"), F.sum("count").alias("members"), F.max("count").alias("most"),
        F.max_by("component", "count").alias("largest")).where("components > 1")
    open_ = materialize(open_.select(
        "bucket", "largest", F.ceil(F.col("members") / options.block).alias("rights"),
        F.ceil((F.col("members") - F.col("most")) / options.block).alias("lefts")), "minhash")
    if open_.limit(1).count() == 0:
        return None
    dealt = held.join(open_, "bucket").join(classes.select("node", "n_shingles", "sketch"), "node")
    mine = F.xxhash64("node", "bucket")
    own = ["node", "n_shingles", "sketch", "component", "band", "bucket"]

    def blocks(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    def by_unit(df):
        return df.repartition(*_UNIT).sortWithinPartitions(*_UNIT)

    right = dealt.select(*own, F.lit(False).alias("left"), F.pmod(mine, F.col("rights")).alias("j"),
                         blocks("lefts").alias("i"))
    left = dealt.where("component <> largest").select(
        *own, F.lit(True).alias("left"), blocks("rights").alias("j"), F.pmod(mine, F.col("lefts")).alias("i"))
    units = left.unionByName(right)
    near = materialize(by_unit(units).mapInPandas(_near_members(options), units.schema), "minhash")
    nodes = materialize(near.select("node").distinct(), "minhash")
    if nodes.limit(1).count() == 0:
        return None
    wide = near.join(full_sets(docs, nodes, options), "node")
    links = materialize(by_unit(wide).mapInPandas(_exact_links(options), "a long, b long"), "minhash")
    return links if links.limit(1).count() else None

"""Embedding near-duplicates by a robust-pruned flat graph (operator 1).

1. Usable vectors are normalised in double precision; equal ones form a class and go on as one
   representative (the smallest id) with the class's size.
2. Per label, centroids are fitted on a bounded sample (spherical k-means, farthest-first seeds).  A
   vector belongs to the shards of its ``overlap`` nearest centroids.  A shard larger than ``block`` is
   cut into blocks; a vector is indexed in one block of each of its shards and searches all blocks of
   them, block by block of queries, so no shard meets in one task.
3. In every block a flat graph is built: each vector's nearest members and some random ones, robust-
   pruned (a candidate goes if a kept one is ``alpha`` times nearer to it), with reverse edges pruned
   likewise.  The adjacency lists that a vector gets in its shards are united, and a block's search
   uses what of the united lists lies in the block.
4. Every vector searches greedily from the block's medoids; once its beam settles, the search expands
   through all members in range until no neighbour of a member in range is left, which finds a whole
   group of near-copies.  Only links with cosine >= ``threshold``, computed in double, are kept.
5. A block joins all its links (union-find) and emits per vector its number of links and the smallest
   vector that links of the block lead to, not pairs.  A link that two shards could find is counted in the first shard both ends share.
   Components are joined over those edges.
6. Audit: ids divisible by 50 are compared with all rows of their label in blocks; ``audit_links``
   holds their exact number of links, so the result carries its own recall.

Defined cases: null vectors, zero vectors, vectors with null or non-finite components, null labels:
no links, their own component; vectors of another length than most of their shard never meet it
(length is part of the label key); a null ``vec_id`` has component null and is not kept; rows that
share a ``vec_id`` are separate vectors but one node.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import components
from rillet.session import materialize


@dataclass(frozen=True)
class GraphOptions:
    threshold: float = 0.98
    shard_rows: int = 1024         # vectors per centroid, about
    overlap: int = 2
    block: int = 2048              # vectors in one graph; queries searched in it at once
    sample_rows: int = 20_000      # bound on the sample the centroids are fitted on
    degree: int = 24
    near: int = 48                 # nearest candidates per vector
    far: int = 16                  # random candidates per vector
    alpha: float = 1.2
    beam: int = 48
    audit_every: int = 50
    seed: int = 5


# -- graph ------------------------------------------------------------------------

def robust_prune(x: np.ndarray, node: int, candidates: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """Keep the nearest candidate, drop those ``alpha`` times nearer to it than to ``node``, repeat."""
    gap = np.sqrt(np.maximum(2 - 2 * (x[candidates] @ x[node]), 0))
    rank = np.argsort(gap, kind="stable")
    candidates, gap = candidates[rank], gap[rank]
    between = np.sqrt(np.maximum(2 - 2 * (x[candidates] @ x[candidates].T), 0))
    alive = candidates != node
    kept = []
    for i in range(len(candidates)):
        if alive[i]:
            kept.append(candidates[i])
            if len(kept) == degree:
                break
            alive &= alpha * between[i] > gap
            alive[:i + 1] = False
    return np.array(kept, np.int64)


def build_graph(x: np.ndarray, options: GraphOptions) -> list[np.ndarray]:
    """Adjacency lists of the rows of ``x`` (unit vectors)."""
    n = len(x)
    rng = np.random.default_rng(options.seed)
    near = min(options.near, n - 1)
    out = []
    for lo in range(0, n, 512):
        cos = x[lo:lo + 512] @ x.T
        best = np.argpartition(-cos, near, axis=1)[:, :near + 1] if near else np.zeros((len(cos), 0), np.int64)
        for k, row in enumerate(best):
            far = rng.integers(0, n, options.far)
            # near and far ones are pruned apart, so that a group of near-copies keeps ways out
            a = robust_prune(x, lo + k, np.unique(row), options.alpha, options.degree)
            b = robust_prune(x, lo + k, np.unique(far), options.alpha, options.degree // 3)
            out.append(np.union1d(a, b))
    back: list[list[int]] = [[] for _ in range(n)]
    for i, row in enumerate(out):
        for j in row:
            back[j].append(i)
    for i in range(n):
        both = np.union1d(out[i], np.array(back[i], np.int64))
        out[i] = both if len(both) <= 2 * options.degree else \
            robust_prune(x, i, both, options.alpha, 2 * options.degree)
    return out


def medoids(x: np.ndarray, count: int) -> np.ndarray:
    """Entry points: the member nearest to the mean, then farthest-first members."""
    mean = x.mean(axis=0)
    out = [int(np.argmax(x @ mean))]
    best = x @ x[out[0]]
    while len(out) < min(count, len(x)):
        out.append(int(np.argmin(best)))
        best = np.maximum(best, x @ x[out[-1]])
    return np.array(out, np.int64)


def range_search(x: np.ndarray, lists: list[np.ndarray], queries: np.ndarray, options: GraphOptions):
    """(query rows, member rows) with cosine at or above the threshold, found from the medoids."""
    n, width = len(x), max((len(r) for r in lists), default=0)
    links = np.full((n, max(width, 1)), -1, np.int64)
    for i, row in enumerate(lists):
        links[i, :len(row)] = row
    entry = medoids(x, max(1, int(np.sqrt(n))))
    found_q, found_m = [], []
    for lo in range(0, len(queries), 256):
        q = queries[lo:lo + 256]
        rows = np.arange(len(q))[:, None]
        seen = np.zeros((len(q), n), bool)
        seen[:, entry] = True
        beam = np.broadcast_to(entry, (len(q), len(entry))).copy()
        cos = q @ x[entry].T
        done = np.zeros(beam.shape, bool)
        in_q, in_m = [np.nonzero(cos >= options.threshold)[0]], [entry[np.nonzero(cos >= options.threshold)[1]]]
        while True:                                        # greedy: expand each query's best open member
            order = np.argsort(-cos, axis=1)[:, :options.beam]
            beam, cos, done = beam[rows, order], cos[rows, order], done[rows, order]
            open_ = np.where(done | (cos == -np.inf), -np.inf, cos)
            pick = np.argmax(open_, axis=1)
            live = open_[rows[:, 0], pick] > -np.inf
            if not live.any():
                break
            done[rows[:, 0], pick] = True
            step = np.where(live[:, None], links[beam[rows[:, 0], pick]], -1)
            fresh = (step >= 0) & ~seen[rows, np.maximum(step, 0)]
            r, c = np.nonzero(fresh)
            seen[r, step[r, c]] = True
            near = np.full(step.shape, -np.inf)
            near[r, c] = np.einsum("ij,ij->i", q[r], x[step[r, c]])
            r, c = np.nonzero(near >= options.threshold)   # in range, whether or not the beam keeps it
            in_q.append(r)
            in_m.append(step[r, c])
            beam = np.hstack([beam, np.maximum(step, 0)])
            cos = np.hstack([cos, near])
            done = np.hstack([done, np.zeros(step.shape, bool)])
        r, m = np.concatenate(in_q), np.concatenate(in_m)
        while len(r):                                      # range: expand every member in range
            found_q.append(r + lo)
            found_m.append(m)
            nr, nm = [], []
            for a in range(0, len(r), 4096):
                step = links[m[a:a + 4096]]
                owner = np.repeat(r[a:a + 4096], step.shape[1])
                step = step.ravel()
                fresh = np.flatnonzero(step >= 0)
                owner, step = owner[fresh], step[fresh]
                fresh = ~seen[owner, step]
                owner, step = owner[fresh], step[fresh]
                if len(owner):
                    key = np.unique(owner * n + step)
                    owner, step = key // n, key % n
                    seen[owner, step] = True
                    hit = np.einsum("ij,ij->i", q[owner], x[step]) >= options.threshold
                    nr.append(owner[hit])
                    nm.append(step[hit])
            r = np.concatenate(nr) if nr else np.zeros(0, np.int64)
            m = np.concatenate(nm) if nm else np.zeros(0, np.int64)
    if not found_q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_q), np.concatenate(found_m)


# -- frames -------------------------------------------------------------------------

def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, unit`` of the vectors that can link (unit: normalised doubles)."""
    v = F.transform("embedding", lambda e: e.cast("double"))
    sound = F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall(
        "v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    # scaled by a power of two first (exactly), so that no square leaves the range of doubles
    peak = F.array_max(F.transform("v", lambda e: F.abs(e)))
    scale = F.pow(F.lit(2.0), F.floor(F.log2(F.col("peak"))))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, e: a + e * e))
    return vectors.where("vec_id is not null").select("vec_id", "label", v.alias("v")).where(sound) \
        .withColumn("peak", peak).where("peak > 0") \
        .withColumn("scale", scale).withColumn("v", F.transform("v", lambda e: e / F.col("scale"))) \
        .withColumn("norm", norm).select("vec_id", F.struct(F.col("label").cast("string"), F.size("v")).cast("string").alias("label"),
                F.transform("v", lambda e: e / F.col("norm")).alias("unit"))


def _matrix(column) -> np.ndarray:
    return np.vstack(column.to_numpy()) if len(column) else np.zeros((0, 1))


def fit_centroids(points: DataFrame, options: GraphOptions) -> dict[str, np.ndarray]:
    """Per label about one centroid per ``shard_rows`` vectors, from a sample bounded by ``sample_rows``."""
    total = points.count()
    draw = F.pmod(F.xxhash64("vec_id", F.lit(options.seed)), F.lit(1 << 30))
    share = min(1.0, options.sample_rows / max(total, 1))
    sample = points.where(draw <= int((1 << 30) * share)).select("label", "unit").toPandas()
    out = {}
    for label, part in sample.groupby("label"):
        x = _matrix(part.unit)
        k = max(1, min(len(x), round(len(x) / share / options.shard_rows)))
        c = x[medoids(x, k)]
        for _ in range(8):
            own = np.argmax(x @ c.T, axis=1)
            sums = np.zeros_like(c)
            np.add.at(sums, own, x)
            size = np.linalg.norm(sums, axis=1, keepdims=True)
            c = np.where(size > 0, sums / np.maximum(size, 1e-300), c)
        out[label] = c
    return out


def _assign(centroids, overlap: int):
    def run(frames):
        for f in frames:
            shards = []
            for label, part in f.groupby("label", sort=False):
                c = centroids.value.get(label)
                x = _matrix(part.unit)
                order = np.argsort(-(x @ c.T), axis=1)[:, :overlap] if c is not None else np.zeros((len(x), 1), int)
                shards.append(pd.Series([np.sort(o).astype(np.int32) for o in order], index=part.index))
            yield f.assign(shards=pd.concat(shards).reindex(f.index) if shards else pd.Series([], dtype=object))
    return run


def _build(options: GraphOptions):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = pdf.vec_id.to_numpy()
        lists = build_graph(_matrix(pdf.unit), options) if len(ids) > 1 else [np.zeros(0, np.int64)] * len(ids)
        return pd.DataFrame({"vec_id": ids, "links": [ids[r] for r in lists]})
    return run


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids in the pairs (``a``, ``b``), and of each the smallest id that pairs lead to."""
    ids, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = at[:len(a)], at[len(a):]
    up = np.arange(len(ids))
    while len(u):
        low, high = np.minimum(up[u], up[v]), np.maximum(up[u], up[v])
        np.minimum.at(up, high, low)                       # a root joins the smallest root next to it
        while (up[up] != up).any():
            up = up[up]
        open_ = up[u] != up[v]
        u, v = u[open_], v[open_]
    return ids, ids[up]


def _here(members: pd.DataFrame) -> list[np.ndarray]:
    """The members' links as rows of ``members``, without those to vectors elsewhere."""
    ids = members.vec_id.to_numpy()
    order = np.argsort(ids, kind="stable")
    rows = [np.zeros(0, np.int64) if r is None else np.asarray(r, np.int64) for r in members.links]
    flat = np.concatenate([*rows, np.zeros(0, np.int64)])
    at = np.minimum(np.searchsorted(ids[order], flat), max(len(ids) - 1, 0))
    known = ids[order][at] == flat if len(ids) else np.zeros(0, bool)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])[known]
    return np.split(order[at[known]], np.cumsum(np.bincount(owner, minlength=len(rows)))[:-1])


def _shard_matrix(shards, none: int) -> np.ndarray:
    """A row of shard numbers per vector, filled up with ``none``."""
    rows = [np.asarray(s) for s in shards]
    out = np.full((len(rows), max(map(len, rows), default=0)), none, np.int64)
    for r, s in zip(out, rows):
        r[:len(s)] = s
    return out


def _search(options: GraphOptions):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        members = pdf[pdf.member].reset_index(drop=True)
        asking = pdf[~pdf.member].reset_index(drop=True)
        x = _matrix(members.unit)
        lists = _here(members)
        q, m = range_search(x, lists, _matrix(asking.unit), options) if len(members) and len(asking) else ([], [])
        q, m = np.asarray(q, np.int64), np.asarray(m, np.int64)
        mine, theirs = asking.vec_id.to_numpy(), members.vec_id.to_numpy()
        other = mine[q] != theirs[m]
        q, m = q[other], m[other]
        shard = key[1]
        first = np.full(len(q), True)                      # of the shards both belong to, this is the first
        if len(q):
            a, b = _shard_matrix(asking.shards, -1)[q], _shard_matrix(members.shards, -2)[m]
            least = np.full(len(q), np.iinfo(np.int64).max)
            for x in a.T:
                both = (x[:, None] == b).any(axis=1)
                least[both] = np.minimum(least[both], x[both])
            first = least == shard
        count = np.bincount(q[first], members.copies.to_numpy()[m[first]], minlength=len(mine)).astype(np.int64)
        linked = np.flatnonzero(count)
        ids, root = spanning(mine[q], theirs[m])           # both ends of every link, whichever of them asks
        return pd.DataFrame({"vec_id": np.concatenate((mine[linked], ids)),
                             "n": np.concatenate((count[linked], np.zeros(len(ids), np.int64))),
                             "least": np.concatenate((mine[linked], root))})
    return run


def _blocks(n, salt: str):
    return F.pmod(F.xxhash64("vec_id", F.lit(salt)), n)


def near_duplicates(vectors: DataFrame, options: GraphOptions = GraphOptions(), audit: bool = True) -> DataFrame:
    """``vec_id, n_links, component_id, kept, audit_links`` for every row of ``vectors``."""
    spark = vectors.sparkSession
    vectors = vectors.select("vec_id", "embedding", "label")
    points = materialize(usable(vectors), "vectors")
    classes = points.groupBy("label", "unit").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = materialize(classes.select(F.col("rep").alias("vec_id"), "label", "unit", "copies"), "vectors")
    centroids = spark.sparkContext.broadcast(fit_centroids(classes, options))
    dealt = classes.mapInPandas(_assign(centroids, options.overlap),
                                "vec_id long, label string, unit array<double>, copies long, shards array<int>")
    dealt = materialize(dealt, "vectors")
    members = dealt.withColumn("shard", F.explode("shards"))
    sizes = materialize(members.groupBy("label", "shard").agg(
        F.ceil(F.count("*") / options.block).alias("blocks")), "vectors")
    members = members.join(sizes, ["label", "shard"])
    own = _blocks(F.col("blocks"), "member")
    graph = members.select("vec_id", "label", "shard", "unit", own.alias("block")) \
        .groupBy("label", "shard", "block").applyInPandas(_build(options), "vec_id long, links array<long>")
    united = materialize(graph.groupBy("vec_id").agg(F.array_distinct(F.flatten(F.collect_list("links"))).alias("links")),
                         "vectors")
    side = ["vec_id", "label", "shard", "shards", "unit", "copies"]
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    index = members.join(united, "vec_id").select(*side, "links", F.lit(True).alias("member"), own.alias("block"),
                                                  every.alias("asked"))
    asking = members.select(*side, F.lit(None).cast("array<long>").alias("links"), F.lit(False).alias("member"),
                            every.alias("block"), _blocks(F.col("blocks"), "asks").alias("asked"))
    found = index.unionByName(asking).groupBy("label", "shard", "block", "asked").applyInPandas(
        _search(options), "vec_id long, n long, least long")
    found = materialize(found, "vectors")
    links = found.groupBy("vec_id").agg(F.sum("n").alias("n"))
    joined = components(found.select(F.col("vec_id").alias("a"), F.col("least").alias("b")), "vectors")
    of_class = classes.select("vec_id", "label", "unit", "copies") \
        .join(links, "vec_id", "left").join(joined.withColumnRenamed("id", "vec_id"), "vec_id", "left") \
        .select("label", "unit", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "vec_id").alias("component"))
    of_vector = points.join(of_class, ["label", "unit"]).select("vec_id", "n_links", "component")
    of_vector = of_vector.groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component").alias("component"))
    out = vectors.select("vec_id").join(of_vector, "vec_id", "left")
    if audit:
        out = out.join(exact_links(points, options), "vec_id", "left")
    else:
        out = out.withColumn("audit_links", F.lit(None).cast("long"))
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"), "audit_links")


def exact_links(points: DataFrame, options: GraphOptions) -> DataFrame:
    """``vec_id, audit_links``: the exact number of links of the ids divisible by ``audit_every``.

    Blocks of queries times blocks of rows of the same label; each unit counts, none emits pairs.
    """
    stated = F.col("vec_id") % options.audit_every == 0
    size = points.groupBy("label").agg(F.ceil(F.count("*") / (4 * options.block)).alias("rows"),
                                       F.ceil(F.sum(stated.cast("int")) / options.block).alias("asks")).where("asks > 0")
    dealt = points.join(size, "label")

    def every(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    rows = dealt.select("vec_id", "label", "unit", F.lit(True).alias("member"),
                        _blocks(F.col("rows"), "row").alias("i"), every("asks").alias("j"))
    asks = dealt.where(stated).select("vec_id", "label", "unit", F.lit(False).alias("member"),
                                      every("rows").alias("i"), _blocks(F.col("asks"), "ask").alias("j"))

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, asks = pdf[pdf.member], pdf[~pdf.member]
        n = np.zeros(len(asks), np.int64)
        if len(rows) and len(asks):
            near = _matrix(asks.unit) @ _matrix(rows.unit).T >= options.threshold
            near &= asks.vec_id.to_numpy()[:, None] != rows.vec_id.to_numpy()[None, :]
            n = near.sum(axis=1)
        return pd.DataFrame({"vec_id": asks.vec_id.to_numpy(), "n": n})

    return rows.unionByName(asks).groupBy("label", "i", "j").applyInPandas(count, "vec_id long, n long") \
        .groupBy("vec_id").agg(F.sum("n").alias("audit_links"))

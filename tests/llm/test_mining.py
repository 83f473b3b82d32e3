"""Mixing, collocations and hard negatives against brute force, on small frames with awkward rows."""

import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from rillet.llm import mixing, negatives, phrases
from rillet.llm import queries as Q
from rillet.llm.common import prefix_sums

SF = "/root/testdata/sf0.01"


def frame(spark, rows, ddl):
    """Rows with extra columns named as the operators' own."""
    extra = "row string, place string, rank string, w1 string, position string, shard string"
    return spark.createDataFrame([(*r, *"abcdef") for r in rows], f"{ddl}, {extra}")


def same_as_sql(spark, name):
    got = Q.queries()[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    columns = ", ".join(got.columns)
    want = con.execute(f"SELECT {columns} FROM ({Q.oracle_sql()[name]})").fetchall()
    assert len(want) > 0
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("name", ["op11_curriculum_mix", "op12_collocations", "op13_hard_negatives"])
def test_queries_equal_their_sql(spark, name):
    same_as_sql(spark, name)


# -- 11 ----------------------------------------------------------------------------

def test_prefix_sums_carry_over_ranges(spark):
    rng = np.random.default_rng(5)
    rows = [(int(g), int(k), int(a)) for k, (g, a) in enumerate(zip(rng.integers(0, 3, 500), rng.integers(0, 9, 500)))]
    rows = [(0 if k % 2 else g, k, a) for g, k, a in rows]          # one group holds most rows
    df = spark.createDataFrame(rows, "g long, k long, a long").repartition(7)
    want, sums = {}, defaultdict(int)
    for g, k, a in rows:
        want[k] = sums[g]
        sums[g] += a
    assert {r.k: r.s for r in prefix_sums(df, ["k"], {"s": "a"}, "test", by="g").collect()} == want
    total = 0
    for g, k, a in rows:
        want[k], total = total, total + a
    assert {r.k: r.s for r in prefix_sums(df, ["k"], {"s": "a"}, "test").collect()} == want


def brute_targets(sizes: dict, options=mixing.MixOptions()) -> dict:
    """Targets by resharing until none is above its limit, in fractions."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: options.weights[k % len(options.weights)] for k, s in enumerate(order)}
    full, left = {}, Fraction(sum(sizes.values()))
    while True:
        rest = [s for s in order if s not in full]
        if not rest:
            return full
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        above = [s for s in rest if share[s] > options.most * sizes[s]]
        if not above:
            return full | share
        for s in above:
            full[s] = Fraction(options.most * sizes[s])
            left -= full[s]


MIXED = [(i, "a" if i % 3 else "hot", "w " * (i % 7)) for i in range(60)] + [
    (100, "tiny", "one"), (101, "tiny", "two words"), (102, None, "no source here"), (103, None, None), (104, "empty", ""),
    (105, "empty", None), (106, "Ünï", "x " * 40), (107, "z\U0001f600", "y"), (108, "long", "word " * 30_000),
    (None, "a", "no id at all"), (None, "a", "no id at all"), (None, None, None), (100, "tiny", "one")]


def test_mix_meets_the_targets(spark):
    rows = mixing.mix(frame(spark, MIXED, "doc_id long, source string, text string")).collect()
    size = Counter()
    for _, s, t in MIXED:
        size[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = brute_targets(size)
    assert len(rows) == len(MIXED)
    taken = Counter()
    for r in rows:
        s = r.row["source"]
        assert r.source_size == size[s] and math.isclose(r.target, want[s], abs_tol=1e-6)
        assert 0 <= r.taken <= 3 * r.size and r.taken == sum(o.words for o in r.occurrences)
        assert [o.epoch for o in r.occurrences] == list(range(len(r.occurrences)))
        assert all(0 <= o.position <= 1 for o in r.occurrences)
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want) and any(want[s] == 3 * size[s] > 0 for s in want)
    again = mixing.mix(frame(spark, MIXED, "doc_id long, source string, text string").repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))


def test_positions_follow_the_schedules(spark):
    """Up to any time a source has given the share of its words that its schedule's integral says."""
    options = mixing.MixOptions()
    rows = [(i, f"s{i % 3}", "w " * 10) for i in range(900)]
    got = mixing.training_sequence(mixing.mix(frame(spark, rows, "doc_id long, source string, text string"), options)) \
        .select("row.source", "position", "words").collect()
    assert [r.position for r in got] == sorted(r.position for r in got)
    for k, knots in enumerate(options.schedules):
        mine = [r for r in got if r.source == f"s{k}"]
        total = sum(r.words for r in mine)
        t, w = zip(*knots)
        grid = np.linspace(0, 1, 20_001)
        area = np.concatenate(([0], np.cumsum((np.interp(grid[1:], t, w) + np.interp(grid[:-1], t, w)) / 2)))
        for at in (0.1, 0.35, 0.5, 0.75, 0.9):
            share = sum(r.words for r in mine if r.position < at) / total
            assert abs(share - np.interp(at, grid, area / area[-1])) < 0.02


def test_mix_without_rows_or_words(spark):
    ddl = "doc_id long, source string, text string"
    assert mixing.mix(frame(spark, [], ddl)).count() == 0
    rows = mixing.mix(frame(spark, [(1, "a", None), (2, None, " ")], ddl)).collect()
    assert [(r.target, r.taken, r.occurrences) for r in rows] == [(0.0, 0, [])] * 2


# -- 12 ----------------------------------------------------------------------------

def brute_collocations(rows, least, top, scale=2_000_000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for d in range(1, 5):
                for i in range(len(w) - d + 1):
                    f[lang][tuple(w[i:i + d])] += 1
    out = []
    for lang, c in f.items():
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        covered = set()
        for p, a in candidates.items():
            for d in range(2, len(p)):
                for i in range(len(p) - d + 1):
                    if 100 * a >= 80 * c[p[i:i + d]]:
                        covered.add(p[i:i + d])
        best = []
        for p, a in candidates.items():
            if p not in covered:
                score, k = min((scale * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s)
                for i, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1)]
    return sorted(out)


def test_index_counts_every_phrase():
    rng = np.random.default_rng(3)
    for size, sigma in ((1, 2), (300, 4), (2000, 40), (5000, 70_000)):
        ids = phrases.with_breaks(rng.integers(0, sigma, size), rng.random(size) < 0.1)
        index = phrases.FMIndex(ids, sigma)
        want = Counter(tuple(ids[i:i + d].tolist()) for d in (1, 2, 3, 4) for i in range(len(ids) - d + 1))
        one = index.words()
        for found in (one, index.left(one), index.right(one), index.right(index.left(one)), index.left(index.right(one)),
                      index.left(index.right(index.left(one))), index.right(index.right(index.left(one)))):
            words = list(zip(*[w.tolist() for w in found[0]]))
            d = len(found[0])
            assert dict(zip(words, found[2].tolist())) == {p: a for p, a in want.items() if len(p) == d and 0 not in p}
            for p, low, size_, rlow in list(zip(words, *found[1:]))[:50]:       # both intervals stand where they should
                flat = ids.tolist()
                ring = flat + flat
                n = len(flat)
                less = sum(tuple(ring[i:i + d]) < p for i in range(n))
                back = flat[::-1] * 2
                rless = sum(tuple(back[i:i + d]) < p[::-1] for i in range(n))
                if n < 2500:
                    assert (low, rlow) == (less, rless)


PROSE = [("en", "The cat sat. The cat sat on the mat, the cat ran"), ("en", "the CAT sat"), (None, "the cat sat the cat"),
         ("und", "the cat"), ("de", "é à é à\té à\n\n;;;é à"), ("en", None), ("en", ""), ("en", " \t "), ("fr", ".,;:!?"),
         ("", "a b a b a b a b a b"), ("x", "aa aa aa aa aa aa aa"), ("en", "\x00   \x00   \x00  "),
         ("de", "one two three four five six"), ("de", "one two three four five six"), ("de", "zero two three four")]


@pytest.mark.parametrize("shard_words", [1, 7, 2_000_000])
def test_collocations_match_brute_force(spark, shard_words):
    rng = np.random.default_rng(11)
    rows = PROSE + PROSE[:3] + [("long", " ".join(f"w{i}" for i in rng.integers(0, 9, 4000)))] \
        + [("en" if i % 2 else "de", " ".join(f"v{min(j, 30)}" for j in rng.zipf(1.4, 60))) for i in range(25)]
    df = frame(spark, rows, "lang string, text string").repartition(3)
    options = phrases.PhraseOptions(least=3, top=25, shard_words=shard_words)
    got = sorted(map(tuple, phrases.collocations(df, options).collect()))
    want = brute_collocations(rows, 3, 25)
    assert got == want and len(got) > 60


def test_collocations_without_rows(spark):
    for rows in ([], [("en", None), (None, "")], [("en", "too few words")]):
        assert phrases.collocations(frame(spark, rows, "lang string, text string")).count() == 0


def test_score_products_beyond_64_bits(spark):
    big = 4 * 10 ** 13
    lexicon = spark.createDataFrame([(1, "en", "a", big), (2, "en", "b", big)], "wid long, lang string, word string, a long")
    pairs = spark.createDataFrame([(1, 2, 0, 0, big - 1)], "w1 long, w2 long, w3 long, w4 long, a long")
    row = phrases.scored(phrases.Counts(None, lexicon, pairs)).first()
    assert row.score == 2_000_000 * (big - 1) // (2 * big)


# -- 13 ----------------------------------------------------------------------------

def brute_negatives(rows, o):
    points = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or not all(x is not None and math.isfinite(x) for x in v):
            continue
        if i % 7 == 0:
            label = (label + 1) % 10
        q = (label, [math.floor(256 * x) for x in v])
        points[i] = min(points[i], q) if i in points else q
    out = []
    for i, (label, q) in points.items():
        if i % o.anchor_every:
            continue
        score = {j: sum(a * b for a, b in zip(q, x)) for j, (_, x) in points.items() if j != i}
        order = sorted(score, key=lambda j: (-score[j], j))
        for p in [j for j in order if points[j][0] == label][:5]:
            good = [j for j in order if points[j][0] != label and 50 * score[p] <= 100 * score[j] <= 95 * score[p]]
            out += [(i, p, r, j, score[p], score[j]) for r, j in enumerate(good[:3], 1)]
    return sorted(out)


def spread(rng, n, dims, groups, noise):
    centre = rng.normal(size=(groups, dims))
    return centre[rng.integers(0, groups, n)] + noise * rng.normal(size=(n, dims))


SMALL = negatives.NegativeOptions(anchor_every=5, block_rows=8, tile_rows=6, page_blocks=3, sample_rows=50)


@pytest.mark.parametrize("groups,noise", [(3, 0.05), (40, 0.3), (1, 1.0)])
def test_negatives_match_brute_force(spark, groups, noise):
    rng = np.random.default_rng(groups)
    x = np.round(spread(rng, 150, 12, groups, noise), 2)
    rows = [(i, [float(v) for v in x[i]], 1 if i % 3 else int(i % 4)) for i in range(150)]         # a label with most rows
    rows += [(1000 + i, rows[0][1], int(i % 2)) for i in range(40)]                                # copies, so ties
    rows += [(2000, None, 1), (2005, [None] * 12, 1), (2010, [float("nan")] * 12, 1), (2015, [float("inf")] * 12, 1),
             (2020, [0.0] * 12, 1), (2025, rows[3][1], None), (None, rows[3][1], 1), (2030, [1.5, 2.5], 1),
             (2035, [1.5, 2.5, 3.5], 0), (2040, [], 1), (2045, [1.0] * 12, 77), (2050, [0.25] * 12, 2), (2050, [0.25] * 12, 2),
             (2055, [0.5] * 12, 3), (2055, [0.75] * 12, 2), (-10, [float(v) for v in -x[4]], 1)]
    df = frame(spark, rows, "vec_id long, embedding array<double>, label int").repartition(4)
    got = sorted(map(tuple, negatives.hard_negatives(df, SMALL).collect()))
    want = brute_negatives(rows, SMALL)
    assert got == want and len(got) > 100


def test_negatives_without_rows_and_alone(spark):
    ddl = "vec_id long, embedding array<float>, label int"
    for rows in ([], [(50, [1.0, 2.0], 1)], [(None, None, None)], [(50, [1.0], 1), (100, [1.0], 1)]):
        assert negatives.hard_negatives(frame(spark, rows, ddl)).count() == 0


def test_negatives_beyond_double_precision(spark):
    big = float(2 ** 40)
    rows = [(50, [big, 1.0], 0), (1, [big, 1.0], 0), (2, [big * 0.9, 3.0], 1), (3, [big * 0.9, 4.0], 1), (100, [1e300, 1.0], 2)]
    got = negatives.hard_negatives(frame(spark, rows[:4], "vec_id long, embedding array<double>, label int")).collect()
    want = brute_negatives(rows[:4], negatives.NegativeOptions())
    assert [(r.anchor_id, r.positive_id, r.rank, r.negative_id) for r in got] == [w[:4] for w in want] and len(got) == 2
    assert negatives.hard_negatives(frame(spark, rows, "vec_id long, embedding array<double>, label int")).count() >= 0


def test_curve_visits_every_cell_once_and_steps_to_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = negatives.hilbert(grid, bits)
        assert len(np.unique(key)) == len(grid)
        walk = grid[np.argsort(key)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_leave_blocks_unread(spark):
    rng = np.random.default_rng(2)
    q = rng.integers(-300, 300, (20, 10))
    x = rng.integers(-300, 300, (50, 10))
    low, high = negatives.bounds(q, x.min(axis=0)[None, :], x.max(axis=0)[None, :])
    of = negatives.scores(q, x)
    assert (low[:, 0] <= of.min(axis=1)).all() and (of.max(axis=1) <= high[:, 0]).all()
    # far apart groups: an anchor's windows reach few blocks
    x = np.kron(np.eye(10), np.ones((60, 1))) * 10 + rng.normal(size=(600, 10)) * 0.1
    vectors = frame(spark, [(i, [float(v) for v in x[i]], i % 2) for i in range(600)],
                    "vec_id long, embedding array<double>, label int")
    blocks = negatives.store_blocks(negatives.usable(vectors, SMALL), SMALL)
    tiles = blocks.select("ids", "labels", "rows").mapInArrow(negatives._tiles(SMALL), negatives._TILE_DDL)
    pairs = negatives._of_page(tiles, blocks, 4).mapInArrow(negatives._chosen(negatives._reaches(SMALL)),
                                                            "tile long, block long").count()
    assert 0 < pairs < 0.5 * tiles.count() * blocks.count()

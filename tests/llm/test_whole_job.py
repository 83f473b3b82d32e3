"""Cases in which an operator once did less than its whole job."""

import zlib
from bisect import bisect_right

import numpy as np
import pytest

from pyspark.sql import functions as F

from rillet.llm import lines, ordering, packing, pii, quality, sampling, toxicity, vectors
from rillet.llm import queries as Q
from rillet.llm.common import held
from test_ops import AWKWARD, DOC, SF, brute_lines, brute_links, docs


# -- 1 -----------------------------------------------------------------------------

def turned(ids, label):
    """Unit vectors in a plane, 8 degrees apart in the order of ``ids``: only neighbours link."""
    return [(i, [float(np.cos(a)), float(np.sin(a))], label) for i, a in zip(ids, np.radians(8) * np.arange(len(ids)))]


def star(centre, leaves, label):
    """Leaves that link to the centre only."""
    n = len(leaves)
    rows = [(centre, [1.0] + [0.0] * n, label)]
    return rows + [(i, [1.0] + [0.18 * (k == j) for j in range(n)], label) for k, i in enumerate(leaves)]


@pytest.mark.parametrize("block", [1024, 4])
def test_vectors_chains_and_stars(spark, block):
    rows = turned([1, 9, 5], 1) + turned([107, 103, 112, 101, 120, 102, 115, 104], 2) + star(250, [210, 230, 260, 290], 3) \
        + turned([*range(301, 340, 2), *range(302, 340, 2)], 4) + star(500, range(480, 520, 3), 5)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = vectors.near_duplicates(df, vectors.GraphOptions(block=block)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == sorted(brute_links(rows))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_spanning_joins_every_pair():
    rng = np.random.default_rng(1)
    for n, pairs in ((2, 1), (50, 30), (400, 390), (400, 5000)):
        a, b = rng.integers(0, n, (2, pairs)) * 3
        up = {x: x for x in [*a.tolist(), *b.tolist()]}
        for _ in range(n):
            for x, y in zip(a.tolist(), b.tolist()):
                up[x] = up[y] = min(up[x], up[y])
        ids, root = vectors.spanning(a, b)
        assert dict(zip(ids.tolist(), root.tolist())) == up
    assert len(vectors.spanning(np.zeros(0, np.int64), np.zeros(0, np.int64))[0]) == 0


# -- 4 -----------------------------------------------------------------------------

def test_training_order_writes_its_shards(spark, tmp_path):
    options = ordering.OrderOptions(Q.tokenizer_path(), seq_len=16, shard_rows=8)
    source = docs(spark, AWKWARD).coalesce(1)
    rows = ordering.training_order(source, options, str(tmp_path)).toPandas()
    assert rows.equals(ordering.materialise(source, options).toPandas())
    assert sorted(x.name for x in tmp_path.iterdir() if x.suffix != ".crc") == \
        [f"shard-{k:06d}.bin" for k in range(rows.shard.max() + 1)]
    for shard, part in rows.groupby("shard"):
        body = (tmp_path / f"shard-{shard:06d}.bin").read_bytes()
        assert len(body) == len(part) * options.stride
        for at, ids in zip(part.byte_offset, part.ids):
            assert body[at:at + options.stride] == ids + b"\xff" * (options.stride - len(ids))
    assert ordering.training_order(spark.createDataFrame([], DOC), options).count() == 0


def test_training_order_in_passes(spark, tmp_path):
    """However many parts the shuffle has, the rows and files are the same; the session's settings stay."""
    source, name = docs(spark, AWKWARD).coalesce(2), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, made = spark.conf.get(name, None), []
    for passes in (1, 2, 5):
        options = ordering.OrderOptions(Q.tokenizer_path(), seq_len=16, shard_rows=8, passes=passes)
        path = tmp_path / str(passes)
        rows = ordering.training_order(source, options, str(path)).toPandas()
        assert rows.slot.tolist() == list(range(len(rows)))
        made.append((rows, {x.name: x.read_bytes() for x in path.glob("*.bin")}))
    assert all(rows.equals(made[0][0]) and files == made[0][1] for rows, files in made)
    assert spark.conf.get(name, None) == was


def test_training_order_query_writes_shards(spark, monkeypatch):
    made = []
    monkeypatch.setattr(ordering, "scratch_path", lambda s, kind, real=ordering.scratch_path: made.append(real(s, kind)) or made[-1])
    rows = Q.op4_training_order(spark, SF).count()
    options = ordering.OrderOptions(Q.tokenizer_path())
    held = [ordering.read_slots(p, 0, rows, options) for p in made if "/shards/" in p]
    assert len(held) == 1 and held[0].shape == (rows, options.seq_len)


# -- 7 -----------------------------------------------------------------------------

@pytest.mark.parametrize("address", [
    "jоhn@example.com", "foo(dot)bar@example.com", "a@mail.exаmple.com", "john@mail.example(dot)com"])
def test_pii_disguise_beside_a_base_span(address):
    text = f"mail {address} now"
    base = pii.base_spans(text)
    spans = pii.all_spans(text)
    assert base and set(base) < set(spans) and (5, 0, 5 + len(address)) in spans
    assert pii.redact_text(text) == "mail <email> now"
    assert spans == sorted(set(spans))


# -- 9 -----------------------------------------------------------------------------

def test_segmentations_of_documents_and_turns(spark, tmp_path):
    rows = [(1, "Hello wörld ☃ and more"), (2, None), (3, ""), (None, "words without an id")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 0, "a turn")], "conv_id long, turn long, text string") \
        .write.parquet(str(tmp_path / "conversations.parquet"))
    got = Q.op9_sentencepiece_sampling(spark, str(tmp_path)).collect()
    sampler = sampling.Sampler(sampling.SamplingOptions(Q.tokenizer_path("piece_bpe_32k.model")))
    source = {("documents", i, None): t for i, t in rows} | {("conversations", 1, 0): "a turn"}
    own = {(r.source, r.id, r.turn): r.ids for r in got if r.sample == -1}
    assert own == {k: sampler.encode(t) for k, t in source.items()}
    for k, t in source.items():
        mine = [r for r in got if (r.source, r.id, r.turn) == k]
        assert {r.text for r in mine} == {sampler.decode(sampler.encode(t))}
        drawn = sampler.sample(t, sampling.row_seed(17, *k))
        assert [r.ids for r in sorted(mine, key=lambda r: r.sample) if r.sample >= 0] == [x[0] for x in drawn]


def test_segment_draws_piece_by_piece():
    """Batches of any size draw what a walk over each text's lattices draws; long texts and long words included."""
    random = np.random.default_rng(5)
    made = ["".join(random.choice(list("ab  \n▁éthe漢"), n)) for n in random.integers(1, 300, 120)]
    texts = [None, "", "  ", "x" * 400 + " end", "a long text " * 3000, *made]
    sampler = sampling.Sampler(sampling.SamplingOptions(Q.tokenizer_path("piece_bpe_32k.model"), cached_edges=4000))
    own, drawn = sampler.segment(texts, list(range(len(texts))))
    for r, text in enumerate(texts):
        units = [sampler.lattice(u) for u in sampler.units(text or "")]
        rng = np.random.Generator(np.random.PCG64(r))
        rng.standard_exponential()
        draws, want, log = iter(rng.random(sum(len(x.ends) for x in units) or 1)), [], 0.0
        for x in units:
            i = 0
            while i < len(x.ends):
                j = bisect_right(x.sums[i], next(draws))
                want, log, i = [*want, *x.ids[i][j]], log + x.logs[i][j], x.ends[i][j]
        assert drawn[r][0][0].tolist() == want and abs(drawn[r][0][1] - log) < 1e-6
        assert own[r].tolist() == sampler.encode(text)
        assert [x[0] for x in sampler.sample(text, r)] == [x[0].tolist() for x in drawn[r]]
        assert len({tuple(x[0].tolist()) for x in drawn[r]}) == len(drawn[r])
    parts = [ids for mine in zip(own, drawn) for ids in (mine[0], *(x[0] for x in mine[1]))]
    got = sampler.texts(np.concatenate(parts).astype(np.int32), np.cumsum([0, *map(len, parts)]))
    assert got.to_pylist() == [sampler.decode(x) for x in parts]


def test_rows_waiting_for_a_place_draw_alike(monkeypatch):
    """With few places, rows that start when others end draw the same; equal rests of words are one node."""
    model = sampling.SamplingOptions(Q.tokenizer_path("piece_bpe_32k.model"))
    random = np.random.default_rng(9)
    texts = [" ".join(random.choice(["then", "other", "ether", "wörld", "☃x"], n)) for n in random.integers(0, 90, 60)]
    want = [sampling.Sampler(model).sample(t, r) for r, t in enumerate(texts)]
    monkeypatch.setattr(sampling, "WIDTH", 9)
    monkeypatch.setattr(sampling, "FEW", 2)
    sampler = sampling.Sampler(model)
    _, drawn = sampler.segment(texts, list(range(len(texts))), own=False)
    assert [[(ids.tolist(), *scores) for ids, *scores in mine] for mine in drawn] == want
    words = {u for t in texts for u in sampler.units(t)}
    known = sampler._units
    assert len(known.keys) == len(known.beta.all) == len({u[i:] for u in words for i in range(len(u))})
    assert (np.diff(known.keys) > 0).all() and sorted(known.rests.tolist()) == list(range(len(known.keys)))


# -- results that once were wrong ---------------------------------------------------

def test_lines_of_unicode_separators_are_no_blanks(spark):
    for odd in ("\u2028", "\u0085", "\u2029", "x\u2028"):
        rows = [(1, "a\nb\nc"), (2, f"{odd}\nkeep1\na\nb\nc\nend"), (3, f"q\n{odd}\nr\na\nb\nc"), (4, f"{odd}\n{odd}\n{odd}")]
        got = lines.dedup_lines(held(docs(spark, rows), "doc_id", "text")).select("row.doc_id", "text", "n_removed").collect()
        assert {r.doc_id: (r.text, r.n_removed) for r in got} == {i: (t, n) for i, t, n in brute_lines(rows)}
        assert dict((r.doc_id, r.text) for r in got)[2] == f"{odd}\nkeep1\nend"


def test_packing_follows_the_tokenizer_on_added_tokens(spark):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(Q.tokenizer_path())
    text = "a <|endoftext|> b <|startoftext|>"
    row = packing.pack(docs(spark, [(1, text)]), packing.PackingOptions(Q.tokenizer_path())).first()
    ids = [*whole.encode(text, add_special_tokens=False).ids, 0]
    assert (row.length, row.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) and 49407 in ids


def test_vectors_of_any_finite_size_link(spark):
    rows = [(i, [x * 10.0 ** e, y * 10.0 ** e], e) for e in (-322, -200, 0, 200, 307)
            for i, x, y in ((1000 + 3 * e, 3.0, 4.0), (1001 + 3 * e, 3.0, 4.0), (1002 + 3 * e, 4.0, -3.0))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(df).collect()}
    assert got == {i: ((0, i) if i % 3 == (1002 % 3) else (1, i - (i % 3 + 3 - 1000 % 3) % 3)) for i, _, _ in rows}


def test_vectors_recall_on_planted_links(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3000, 24))
    near = np.concatenate((np.repeat(np.arange(0, 600, 50), 25), np.arange(600, 900)))
    x[2000:2000 + len(near)] = x[near] + rng.normal(size=(len(near), 24)) * 0.06
    ids = rng.permutation(3000)
    df = spark.createDataFrame([(int(i), [float(e) for e in v], int(k % 2)) for i, v, k in zip(ids, x, np.zeros(3000))],
                               "vec_id long, embedding array<double>, label int")
    options = vectors.GraphOptions(shard_rows=300, block=200, audit_every=5)
    out = vectors.near_duplicates(df, options).where("audit_links is not null").toPandas()
    exact = out.audit_links.sum()
    assert exact > 500 and 0.9 * exact <= out.n_links.sum() <= exact and (out.n_links <= out.audit_links).all()


def labelled(spark, n, remainders, name, rare=None):
    """Rows whose crc32 remainders are among ``remainders``, half of them labelled 1 (or ``rare`` rows only)."""
    ids = [i for i in range(20 * n) if zlib.crc32(str(i).encode()) % 5 in remainders][:n]
    marks = [(i, int(k < rare if rare is not None else k % 2)) for k, i in enumerate(ids)]
    words = ("calm harbour lists quiet letters for every reader", "zorgul blaxx snarf the vile wretched mob of trash")
    rows = [(i, " ".join(f"{words[m]} {w}{(i * 7 + w) % 90}" for w in range(6))) for i, m in marks]
    return rows, spark.createDataFrame(marks, f"doc_id long, {name} int")


@pytest.mark.parametrize("remainders,rare", [((2, 3, 4), None), ((1,), None), ((1, 2), 1), ((2,), 1), ((1,), 1)])
def test_toxicity_learns_whenever_both_classes_are_there(spark, remainders, rare):
    rows, labels = labelled(spark, 80, remainders, "toxic", rare)
    model = toxicity.train(docs(spark, rows).drop("score"), labels)
    assert model.weights is not None
    marks = {r.doc_id: r.toxic for r in labels.collect()}
    got = {r.doc_id: r.score for r in toxicity.score(docs(spark, rows).drop("score"), model).collect()}
    toxic, clean = ([got[i] for i in marks if marks[i] == c] for c in (1, 0))
    assert min(toxic) > max(clean)
    if rare is None:
        assert min(toxic) > 0.5 > max(clean)


def test_pipeline_keeps_documents_without_a_model(spark, tmp_path):
    import corpus_pipeline
    rows = docs(spark, [(i, f"text {i}") for i in range(20)])
    for toxic in ([], [(3, 1), (4, 1)], [(3, 0)]):
        path = str(tmp_path / str(len(toxic)))
        spark.createDataFrame(toxic, "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
        assert corpus_pipeline.drop_toxic(spark, rows, path).count() == 20


@pytest.mark.parametrize("remainder,rare", [(1, None), (0, None), (None, 1), (None, 3)])
def test_quality_learns_whenever_both_classes_are_there(spark, remainder, rare):
    rows, labels = labelled(spark, 120, range(5), "quality", rare)
    if remainder is not None:                            # all of one part of the hash split
        part = F.pmod(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)), F.lit(4))
        labels = labels.where((part == 0) == (remainder == 0))
    options = quality.QualityOptions()
    model = quality.train(docs(spark, rows), labels, options)
    assert model.weights is not None
    marks = {r.doc_id: r.quality for r in labels.collect()}
    got = {r.doc_id: r.quality for r in quality.judge(docs(spark, rows), model).collect()}
    good, bad = ([got[i] for i in marks if marks[i] == c] for c in (1, 0))
    assert min(good) > max(bad)


def test_quality_sample_keeps_a_rare_class(spark):
    rows, labels = labelled(spark, 400, range(5), "quality", 6)
    model = quality.train(docs(spark, rows), labels, quality.QualityOptions(train_rows=80))
    assert model.weights is not None


def test_training_order_holds_the_tokenizers_ids(spark):
    """Every document's sequences, put together, are what the tokenizer as loaded gives for the text, and the end id."""
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(Q.tokenizer_path())
    rows = [(i, t) for i, t in Q.documents(spark, SF).limit(60).collect()] + [(10 ** 6, "a <|endoftext|> b"), (10 ** 6 + 1, "x " * 40_000)]
    options = ordering.OrderOptions(Q.tokenizer_path(), seq_len=64)
    got = ordering.materialise(docs(spark, rows), options).orderBy("doc_id", "piece").toPandas()
    for i, text in rows:
        ids = np.frombuffer(b"".join(got.ids[got.doc_id == i]), "<u2").tolist()
        assert ids == [*whole.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_beyond_16_bits_are_refused(spark):
    options = ordering.OrderOptions(Q.tokenizer_path(), pad_id=300)
    with pytest.raises(Exception, match="16 bits"):
        ordering.materialise(docs(spark, [(1, "some words here")]), options).count()

"""The corpus pipeline: each stage against its own input, and all of them in a row."""

import zlib

import pytest

import corpus_pipeline as pipeline
from rillet.llm import packing, pii
from rillet.llm import queries as Q
from test_ops import AWKWARD, brute_groups, brute_lines

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def source(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", 0, 1, "k") for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, score int, key string")


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """The rows before the first and after each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return [x.toPandas() for x in out]


def test_columns(staged):
    assert all(list(x.columns) == COLUMNS for x in staged[:-1])
    assert all((x.n_chars == x.text.str.len()).all() for x in staged[2:-1])


def test_toxic_rows_go(spark, staged):
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    gone = set(staged[0].doc_id) - set(staged[1].doc_id)
    toxic, clean = set(labels[labels.toxic == 1].doc_id), set(labels[labels.toxic == 0].doc_id)
    assert len(gone & toxic) >= 0.8 * len(toxic) and len(gone & clean) <= 0.02 * len(clean)


def test_lines(staged):
    want = {(i, t) for i, t, _ in brute_lines(list(zip(staged[1].doc_id.tolist(), staged[1].text)))}
    assert {(i, t) for i, t in zip(staged[2].doc_id.tolist(), staged[2].text)} == want


def test_near_duplicates(staged):
    rows = list(zip(staged[2].doc_id.tolist(), staged[2].text))
    assert sorted(staged[3].doc_id) == sorted(i for i, _, c in brute_groups(rows) if i == c)


def test_personal_data(staged):
    assert sorted(zip(staged[4].doc_id, staged[4].text)) == sorted((i, pii.redact_text(t)) for i, t in zip(staged[3].doc_id, staged[3].text))
    assert not any(pii.base_spans(t) for t in staged[4].text)


def test_packing(staged):
    token = packing.WordTokenizer(Q.tokenizer_path(), 10 ** 6)
    want = []
    for i, t in zip(staged[4].doc_id.tolist(), staged[4].text):
        ids = token.encode(t) + bytes(4)
        want += [(i, k, zlib.crc32(ids[at:at + 8192])) for k, at in enumerate(range(0, len(ids), 8192))]
    assert sorted(zip(staged[5].doc_id, staged[5].piece, staged[5].ids_crc32)) == sorted(want)


def test_run_equals_the_stages(spark, staged):
    got = pipeline.run(spark, SF).toPandas()
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got[cols].values)) == sorted(map(tuple, staged[5][cols].values))


def test_awkward_rows_and_empty_table(spark):
    rows = AWKWARD + [(1, AWKWARD[0][1])]
    docs = source(spark, rows)
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        out.collect()
        assert stage(spark, docs.limit(0), SF).count() == 0
    kept = [tuple(r)[:2] for r in pipeline.drop_near_duplicates(spark, docs, SF).collect()]
    assert sorted(i for i, _ in kept if i is not None) == sorted({1, 4, 5, 6, 7, 9, 10, 11, 12})
    assert sum(1 for i, _ in kept if i is None) == 2

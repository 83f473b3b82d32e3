"""Corpus pipeline over ``documents``: toxicity, line dedup, near-dedup, personal data, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir), works on all rows its
predecessor kept and returns the columns of ``documents`` (the last one: the packed pieces).  ``run``
writes each stage as Parquet in the shared folder and hands the reread rows on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.llm import lines, minhash, packing, pii, toxicity
from rillet.llm.common import held, join_by_size
from rillet.llm.queries import tokenizer_path
from rillet.session import materialize
from rillet.sources.tables import read_table


def _columns(changed: DataFrame, like: DataFrame, new_text: bool = False) -> DataFrame:
    """``row`` and ``text`` back as the columns of ``like``, in their order; ``n_chars`` follows a new text."""
    def column(name):
        if name == "text":
            return F.col("text")
        if name == "n_chars" and new_text:
            return F.length("text").cast("long").alias(name)
        return F.col("row")[name].alias(name)
    return changed.select(*[column(c) for c in like.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, trained on this input's labelled rows, does not reject; without a model, all."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]))
    if model.weights is None:
        return docs
    scored = toxicity.score(held(docs, "text"), model)
    return _columns(scored.where(F.col("score") < model.options.threshold), docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines of three-line windows found earlier."""
    return _columns(lines.dedup_lines(held(docs, "doc_id", "text")), docs, new_text=True)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the smallest ``doc_id``; rows without an id stay.

    Of rows that repeat both id and text one stays.
    """
    found = materialize(minhash.near_duplicates(docs), "pipeline")
    out = materialize(found.where("not kept and doc_id is not null").select(F.col("doc_id").alias("key")).distinct(),
                      "pipeline")
    twice = materialize(found.where("doc_id is not null").groupBy(F.col("doc_id").alias("key")).count()
                        .where("count > 1").select("key"), "pipeline")
    rows = join_by_size(held(docs, F.col("doc_id").alias("key"), "text"), out, "key", "left_anti")
    if twice.limit(1).count():
        again = join_by_size(rows, twice, "key", "left_semi") \
            .withColumn("body", F.xxhash64("text")).dropDuplicates(["key", "body"])
        rows = join_by_size(rows, twice, "key", "left_anti").unionByName(again.drop("body"))
    return _columns(rows, docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return _columns(pii.redact(held(docs, "text")), docs, new_text=True)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and offset.

    The workers have served the other stages before, so their word caches stay smaller here.
    """
    return packing.pack(docs, packing.PackingOptions(tokenizer_path(), cached_words=150_000))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: Toxicity, near-dedup and packing can't be written as SQL; the tests check them by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``; the packed pieces."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

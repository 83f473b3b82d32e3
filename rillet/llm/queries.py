"""The registered ``opN_*`` queries: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.llm import (lines, minhash, mixing, negatives, ordering, packing, phrases, pii, quality, sampling,
                        toxicity, urls, vectors)
from rillet.llm.common import held
from rillet.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The public vocabulary file used by default."""
    import public_tokenizers
    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", ["doc_id", "text"])


def op1_embedding_near_dedup(spark, sf_dir):
    return vectors.near_duplicates(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"]))


def op2_minhash_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(documents(spark, sf_dir))


def op3_line_dedup(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return lines.dedup_lines(held(docs, "doc_id", "text")).select("row.doc_id", "text", "n_removed")


def op4_training_order(spark, sf_dir):
    return ordering.training_order(documents(spark, sf_dir), ordering.OrderOptions(tokenizer_path()))


def op5_url_filter(spark, sf_dir):
    return urls.judge_urls(read_table(spark, sf_dir, "pages", ["page_id", "url"]))


def op6_quality(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return quality.judge(docs, quality.train(docs, read_table(spark, sf_dir, "labels", ["doc_id", "quality"])))


def op7_pii(spark, sf_dir):
    return pii.find_pii(documents(spark, sf_dir))


def op8_best_fit_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir), packing.PackingOptions(tokenizer_path()))


def op9_sentencepiece_sampling(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "text"])
    texts = documents(spark, sf_dir).selectExpr("'documents' source", "doc_id id", "cast(null as long) turn", "text") \
        .union(turns.selectExpr("'conversations' source", "conv_id id", "turn", "text"))
    return sampling.segmentations(texts, ["source", "id", "turn"],
                                  sampling.SamplingOptions(tokenizer_path("piece_bpe_32k.model")))


def op10_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]))
    scored = toxicity.score(docs, model).drop("text")
    return scored.select("doc_id", F.coalesce(toxicity.fold() == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= model.options.threshold).cast("int").alias("predicted"))


def op11_curriculum_mix(spark, sf_dir):
    """Every document with its source's target and the words taken of it, in training order (untaken ones last)."""
    mixed = mixing.mix(read_table(spark, sf_dir, "documents", ["doc_id", "source", "text"]))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.size("occurrences").alias("n_copies"),
                        F.get("occurrences", F.lit(0))["position"].alias("first_position")) \
        .orderBy(F.asc_nulls_last("first_position"), "doc_id")


def op12_collocations(spark, sf_dir):
    """Each language's first 2,000 phrases of two to four words."""
    return phrases.collocations(read_table(spark, sf_dir, "documents", ["lang", "text"]))


def op13_hard_negatives(spark, sf_dir):
    """The hard negatives of every anchor (ids divisible by 50) and each of its positives."""
    return negatives.hard_negatives(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"]))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_embedding_near_dedup, op2_minhash_near_dedup, op3_line_dedup, op4_training_order, op5_url_filter,
        op6_quality, op7_pii, op8_best_fit_packing, op9_sentencepiece_sampling, op10_toxicity, op11_curriculum_mix,
        op12_collocations, op13_hard_negatives)}


# Blank lines take no part; a window is three neighbouring non-blank lines of a document.
OP3_SQL = r"""
WITH pieces AS (
  SELECT doc_id, i, string_split(text, chr(10))[i] AS line
  FROM documents, range(1, len(string_split(text, chr(10))) + 1) r(i)
), solid AS (
  SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos
  FROM pieces WHERE NOT regexp_full_match(line, '[ \t\n\x0B\f\r]*')
), windows AS (
  SELECT a.doc_id, a.pos, a.line || chr(10) || b.line || chr(10) || c.line AS body
  FROM solid a JOIN solid b ON b.doc_id = a.doc_id AND b.pos = a.pos + 1
  JOIN solid c ON c.doc_id = a.doc_id AND c.pos = a.pos + 2
), ranked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY body ORDER BY doc_id, pos) AS nth FROM windows
), gone AS (
  SELECT DISTINCT r.doc_id, s.i FROM ranked r JOIN solid s
  ON s.doc_id = r.doc_id AND s.pos BETWEEN r.pos AND r.pos + 2 WHERE r.nth > 1
), kept AS (
  SELECT p.doc_id, string_agg(p.line, chr(10) ORDER BY p.i) AS text
  FROM pieces p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.i = p.i WHERE g.i IS NULL GROUP BY p.doc_id
), lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text,
       coalesce(l.n, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN lost l ON l.doc_id = d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": OP3_SQL, "op5_url_filter": urls.oracle(), "op11_curriculum_mix": mixing.oracle(),
            "op12_collocations": phrases.oracle(),
            "op13_hard_negatives": negatives.oracle()}

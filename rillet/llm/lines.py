"""Line dedup over overlapping three-line windows (operator 3).

A text's lines are its ``\\n``-separated pieces; blank ones (nothing but ``\\x20 \\x09-\\x0D``) take no
part.  Every run of three neighbouring non-blank lines is a window, keyed by a 128-bit hash.  A window
found anywhere earlier, earlier being a smaller ``(doc_id, position)``, covers its three lines; covered
positions of a document are merged and those lines removed.  The first occurrence stays.

Window keys are grouped with map-side combination, and repeated ones are joined back by key, which
Spark splits where a window is very frequent; no group of windows meets in one task.

Defined cases: null texts stay null, texts with fewer than three non-blank lines stay as they are;
a text whose lines all go becomes empty; a null ``doc_id`` comes after all others (null-id rows are
one document as to order); rows sharing a ``doc_id`` are one document as to order, so a repeated row
keeps what its twin keeps.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import join_by_size, map_texts
from rillet.session import materialize

WINDOW = 3
LAST = (1 << 63) - 1         # order of a null doc_id
BLANK = "^[ \\t\\n\\x0B\\f\\r]*\\z"     # not $, which also matches before a last U+0085, U+2028 or U+2029
_BLANKS = " \t\n\x0b\x0c\r"


def _order():
    """A row's place in the order of documents, and its text's hash (rows may share a ``doc_id``)."""
    return F.coalesce("doc_id", F.lit(LAST)).alias("doc"), F.xxhash64("text").alias("body")


def windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc, body, pos, k1, k2``: each window's document, the number of its first line, and its key."""
    solid = F.filter(F.split("text", "\n"), lambda x: ~x.rlike(BLANK))
    lines = F.transform(solid, lambda x: F.struct(F.xxhash64(x).alias("p"), F.xxhash64(F.lit(7), x).alias("q")))
    hashed = docs.select(*_order(), lines.alias("h")).where(F.size("h") >= window)

    def key(i):
        parts = [F.element_at("h", i + j) for j in range(window)]
        return F.struct(i.alias("pos"), F.xxhash64(*[x["p"] for x in parts]).alias("k1"),
                        F.xxhash64(*[x["q"] for x in parts]).alias("k2"))

    starts = F.sequence(F.lit(1), F.size("h") - (window - 1))
    return hashed.select("doc", "body", F.explode(F.transform(starts, key)).alias("w")).select("doc", "body", "w.*")


def covered(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc, body, starts``: the sorted first lines (from 1) of each text's later windows."""
    found = materialize(windows(docs, window), "lines")
    first = found.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min(F.struct("doc", "pos")).alias("first"))
    later = found.join(first.where("n > 1"), ["k1", "k2"]).where("struct(doc, pos) > first")
    return later.groupBy("doc", "body").agg(F.sort_array(F.collect_set("pos")).alias("starts"))


def strip_lines(text: str, starts, window: int = WINDOW) -> tuple[str, int]:
    """``text`` without the lines that the windows starting at ``starts`` cover, and how many went."""
    pieces = text.split("\n")
    solid = [i for i, x in enumerate(pieces) if x.strip(_BLANKS)]
    gone, reach = set(), 0
    for s in starts:
        for k in range(max(s - 1, reach), s - 1 + window):
            gone.add(solid[k])
        reach = s - 1 + window
    return "\n".join(x for i, x in enumerate(pieces) if i not in gone), len(gone)


def _strip(window: int):
    def run(batches):
        for batch in batches:
            texts, counts = [], []
            for text, starts in zip(batch.column("text").to_pylist(), batch.column("starts").to_pylist()):
                t, n = (text, 0) if text is None or not starts else strip_lines(text, starts, window)
                texts.append(t)
                counts.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string()), pa.array(counts, pa.int64())],
                names=["row", "text", "n_removed"])
    return run


def dedup_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every row's ``row`` (a struct of its other columns), ``text`` after removal and ``n_removed``.

    ``docs`` holds ``row, doc_id, text`` (see ``common.held``); windows are taken from all of it.
    """
    later = materialize(covered(docs.select("doc_id", "text"), window), "lines")
    keyed = docs.select("row", "text", *_order())
    joined = join_by_size(keyed, later, ["doc", "body"], "left", F.size("starts") + 4).select("row", "text", "starts")
    row = docs.schema["row"].dataType
    from pyspark.sql.types import LongType, StringType, StructType
    schema = StructType().add("row", row).add("text", StringType()).add("n_removed", LongType())
    return map_texts(joined, _strip(window), schema)

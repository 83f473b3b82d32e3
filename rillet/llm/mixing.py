"""Mixing sources to target weights along a curriculum (operator 11).

Sources in code point order (null last) weigh ``weights``, repeating, and share as many words as all
documents hold.  A target stops at ``most`` times its source's size and what is above goes to the
others by weight until none is above: with the sources in ascending order of limit over weight the
limited ones are a prefix, found by exact comparisons of running sums.

Every source has a weight schedule over the training time 0 to 1 (knots, linear between them).  Its
integral, scaled to the source's target, is the cumulative demand for the source's words.  A source's
documents stand in the order of a seeded hash and are read again and again until the target is met,
so each occurrence of a document starts at a known count of the source's words; the time at which the
demand reaches that count is its training position.  ``training_sequence`` range-sorts the occurrences
by position.  The last document of a source is cut where the target ends: a source's taken words are
its target, rounded to a whole number.

Everything is DataFrame expressions.  Running sums are over ranges of a hash order within each source,
so a source that holds most rows is spread over many tasks; what the driver sees is four sums.

Defined cases: a null text has size 0 and a document of size 0 is taken 0 times; a null source is a
source of its own, after all others; null and repeated ids and repeated rows are documents of their
own; an empty table gives no rows; tables without words have targets of 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import held, join_by_size, prefix_sums
from rillet.session import materialize

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixOptions:
    weights: tuple[int, ...] = (1, 2, 3)
    most: int = 3                       # times a document is read at most
    #: per weight, repeating: knots (time, relative weight), the first at 0 and the last at 1
    schedules: tuple[tuple[tuple[float, float], ...], ...] = (
        ((0.0, 1.0), (1.0, 1.0)),                   # constant
        ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),       # mostly early
        ((0.0, 0.5), (0.75, 1.0), (1.0, 2.0)),      # mostly late
    )
    seed: int = 20240229


def word_size(text="text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def _scaled(a: Column, b: Column) -> Column:
    """``a * b`` of longs, exactly."""
    return a.cast("decimal(19,0)") * b.cast("decimal(19,0)")


def source_targets(sizes: DataFrame, options: MixOptions = MixOptions()) -> DataFrame:
    """``source, source_size, place, target, budget`` of the sources in ``sizes`` (source, size).

    ``place`` is the source's place in code point order, ``budget`` the words to take.
    """
    rows = materialize(sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
                       .withColumn("none", F.col("source").isNull().cast("int")), "mixing")
    ranked = prefix_sums(rows.withColumn("one", F.lit(1).cast("long")), ["none", "source"], {"place": "one"}, "mixing")
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in options.weights]),
                          (F.col("place") % len(options.weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("limit", options.most * F.col("source_size")) \
        .withColumn("ratio", F.col("limit").cast("double") / F.col("weight"))
    placed = materialize(prefix_sums(ranked, ["ratio", "place"], {"limits": "limit", "weights": "weight"}, "mixing"),
                         "mixing")
    total, weights = placed.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    total, weights = F.lit(total).cast("long"), F.lit(weights).cast("long")
    full = _scaled(total - F.col("limits"), F.col("weight")) > _scaled(F.col("limit"), weights - F.col("weights"))
    placed = placed.withColumn("full", full)
    gone = placed.where("full").agg(F.coalesce(F.sum("limit"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    share = ((total - gone[0]) * F.col("weight")).cast("double") / (weights - gone[1])
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(share)
    return placed.withColumn("target", target).select(
        "source", "source_size", "place", "target",
        F.least(F.floor(F.col("target") + 0.5), F.col("limit")).cast("long").alias("budget"))


def time_of(share: Column, place: Column, options: MixOptions = MixOptions()) -> Column:
    """The time at which a source's schedule has used up ``share`` of its integral."""
    out = F.lit(None).cast("double")
    for k, knots in enumerate(options.schedules):
        areas = [0.0]
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            areas.append(areas[-1] + (w0 + w1) / 2 * (t1 - t0))
        demand = share * F.lit(areas[-1])
        here = None
        for (t0, w0), (t1, w1), area in reversed(list(zip(knots, knots[1:], areas))):
            rest = demand - F.lit(area)
            slope = (w1 - w0) / (t1 - t0)
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * rest, F.lit(0.0)))
            time = F.lit(t0) + F.when(rest > 0, F.lit(2.0) * rest / (F.lit(w0) + root)).otherwise(0.0)
            here = time if here is None else F.when(demand < next_area, time).otherwise(here)
            next_area = F.lit(area)
        out = F.when(place % len(options.schedules) == k, here).otherwise(out)
    return out


def assign(docs: DataFrame, options: MixOptions = MixOptions()) -> DataFrame:
    """``row, doc_id, size, source_size, target, taken, occurrences`` of every row of ``docs``.

    ``docs`` holds ``row, doc_id, source, size``; ``occurrences`` are structs of ``epoch``, ``words`` and
    ``position``, in order.
    """
    key = F.md5(F.concat(F.lit(f"{options.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = docs.select("row", "doc_id", "source", "size", F.monotonically_increasing_id().alias("nth"),
                       F.conv(F.substring(key, 1, 15), 16, 10).cast("long").alias("draw"))
    rows = materialize(rows, "mixing")
    targets = materialize(source_targets(rows.select("source", "size"), options), "mixing")
    targets = targets.select(F.col("source").alias("of"), "source_size", "place", "target", "budget")
    rows = join_by_size(rows, targets, F.col("source").eqNullSafe(F.col("of")), "inner").drop("of", "source")
    rows = prefix_sums(rows, ["draw", "doc_id", "size", "nth"], {"start": "size"}, "mixing", by="place")

    def occurrence(epoch: int) -> Column:
        at = F.col("start") + F.lit(epoch) * F.col("source_size")
        words = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("budget") - at))
        position = time_of(at.cast("double") / F.nullif(F.col("budget").cast("double"), F.lit(0.0)), F.col("place"), options)
        return F.struct(F.lit(epoch).alias("epoch"), words.alias("words"),
                        F.when(words > 0, position).alias("position"))

    rows = rows.withColumn("occurrences", F.filter(F.array(*[occurrence(e) for e in range(options.most)]),
                                                   lambda x: x["words"] > 0))
    taken = F.aggregate("occurrences", F.lit(0).cast("long"), lambda a, x: a + x["words"])
    return rows.select("row", "doc_id", "size", "source_size", "target", taken.alias("taken"), "occurrences")


def training_sequence(assigned: DataFrame) -> DataFrame:
    """``row, doc_id, epoch, words, position`` of every occurrence, range-sorted by position."""
    return assigned.select("row", "doc_id", F.explode("occurrences").alias("o")).select("row", "doc_id", "o.*") \
        .orderBy("position", "epoch", "doc_id")


def mix(docs: DataFrame, options: MixOptions = MixOptions()) -> DataFrame:
    """``assign`` for ``docs`` with ``doc_id, source, text`` and any other columns (the text stays out of ``row``)."""
    return assign(held(docs, "doc_id", "source", word_size().alias("size")), options)


def oracle(options: MixOptions = MixOptions()) -> str:
    """DuckDB SQL for the registered query."""
    weight = " ".join(f"WHEN {k} THEN {w}" for k, w in enumerate(options.weights))
    times = []
    for k, knots in enumerate(options.schedules):
        areas = [0.0]
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            areas.append(areas[-1] + (w0 + w1) / 2 * (t1 - t0))
        cases = []
        for (t0, w0), (t1, w1), area, end in zip(knots, knots[1:], areas, areas[1:]):
            slope = (w1 - w0) / (t1 - t0)
            demand = f"(share * {areas[-1]!r}::DOUBLE)"
            rest = f"({demand} - {area!r}::DOUBLE)"
            root = f"sqrt(greatest({w0 * w0!r}::DOUBLE + {2 * slope!r}::DOUBLE * {rest}, 0::DOUBLE))"
            time = f"{t0!r}::DOUBLE + CASE WHEN {rest} > 0 THEN 2::DOUBLE * {rest} / ({w0!r}::DOUBLE + {root}) ELSE 0 END"
            cases.append((f"WHEN {demand} < {end!r}::DOUBLE THEN " if end != areas[-1] else "ELSE ") + time)
        times.append(f"WHEN {k} THEN " + (f"CASE {' '.join(cases)} END" if len(cases) > 1 else cases[0][5:]))
    return rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('{options.seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS draw
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source
), weighted AS (
  SELECT *, CASE place % {len(options.weights)} {weight} END::BIGINT AS weight,
         {options.most} * source_size AS most
  FROM sources
), ranked AS (
  SELECT *, coalesce(sum(most) OVER earlier, 0)::HUGEINT AS limits, coalesce(sum(weight) OVER earlier, 0)::HUGEINT AS weights,
         sum(source_size) OVER ()::HUGEINT AS total, sum(weight) OVER ()::HUGEINT AS whole
  FROM weighted
  WINDOW earlier AS (ORDER BY most::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), judged AS (
  SELECT *, (total - limits) * weight > most::HUGEINT * (whole - weights) AS is_full FROM ranked
), targets AS (
  SELECT source, source_size, place, most,
         CASE WHEN is_full THEN most::DOUBLE
              ELSE ((total - coalesce(sum(most) FILTER (is_full) OVER (), 0)) * weight)::DOUBLE
                   / (whole - coalesce(sum(weight) FILTER (is_full) OVER (), 0))::DOUBLE END AS target
  FROM judged
), budgets AS (SELECT *, least(floor(target + 0.5)::BIGINT, most) AS budget FROM targets), placed AS (
  SELECT s.doc_id, s.size, b.source_size, b.target, b.budget, b.place,
         coalesce(sum(s.size) OVER (PARTITION BY b.place ORDER BY s.draw, s.doc_id NULLS FIRST, s.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
), taken AS (
  SELECT *, start::DOUBLE / budget::DOUBLE AS share,
         {', '.join(f"greatest(0, least(size, budget - start - {e} * source_size)) AS words{e}" for e in range(options.most))}
  FROM placed
)
SELECT doc_id, size, source_size, target, ({' + '.join(f"words{e}" for e in range(options.most))})::BIGINT AS taken,
       ({' + '.join(f"(words{e} > 0)::INT" for e in range(options.most))})::INT AS n_copies,
       CASE WHEN words0 > 0 THEN CASE place % {len(options.schedules)} {' '.join(times)} END END AS first_position
FROM taken
"""

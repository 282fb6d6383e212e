"""Mixing sources to target weights with a time-varying curriculum.

Each source's share of the mix is its target; within the run its weight follows
a schedule ``w(t) = 1 + k(2t - 1)`` over training time ``t`` in 0..1. The
schedule's integral ``(1 - k)t + kt²`` is the part of the target demanded up to
``t``; inverting it at a document's cumulative token share gives the document's
training position, and documents are range-sorted by it.

Everything is DataFrame expressions. The running total inside a source, in the order
of a hash of the ids, comes from ``common.ranked``: its windows hold one range of
that order, so neither a source nor an id with a third of all rows is in one task.

Defined results: NULL and blank texts have size 0 and take no words; a NULL
source is a source of its own and sorts last; a source of size 0 has target 0;
NULL ids hash as the empty text; repeated rows are separate documents (equal
rows are interchangeable); texts of any length are counted whole; an empty table
gives no rows. Columns other than those named and those of ``keep`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lookup_join, ranked, word_count


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
                   cap: float = 2.0) -> DataFrame:
    """(source, source_size, target, _class) from (source, source_size).

    Sources in code-point order (NULL last) take ``weights`` in turn and share
    ``share`` times all words; a target stops at ``cap`` times its source's size
    and the excess goes to the others by weight. With sources in order of
    cap / weight the capped ones are a prefix, so one running sum finds the
    common level of the rest. The windows run over one row per source.
    """
    n = len(weights)
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(0))
    byte_order = (sizes
                  .withColumn("_class", ((F.row_number().over(order) - 1) % n).cast("int"))
                  .withColumn("_w", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("_class")))
                  .withColumn("_cap", F.col("source_size") * F.lit(cap))
                  .withColumn("_all", F.sum("source_size").over(every) * F.lit(share)))
    by_level = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(0, Window.unboundedFollowing)
    whole = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (byte_order
              .withColumn("_level", (F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                          / F.sum("_w").over(rest))
              .withColumn("_capped", F.col("_cap") <= F.col("_w") * F.col("_level")))
    common = F.first(F.when(~F.col("_capped"), F.col("_level")), ignorenulls=True).over(whole)
    return (levels.withColumn("_common", common)
            .select("source", "source_size", "_class",
                    F.when(F.col("_capped") | F.col("_common").isNull(), F.col("_cap"))
                    .otherwise(F.col("_w") * F.col("_common")).alias("target")))


def schedule_time(part: Column, drift: Column) -> Column:
    """Training time at which the schedule with ``drift`` k has demanded ``part`` of
    its target: the root of ``kt² + (1 - k)t = part`` in 0..1."""
    root = F.sqrt((F.lit(1.0) - drift) * (F.lit(1.0) - drift) + F.lit(4.0) * drift * part)
    below = (F.lit(1.0) - drift) + root
    return F.when(below > 0, F.lit(2.0) * part / below).otherwise(F.lit(0.0))


def _clamp(x: Column, most: Column) -> Column:
    return F.greatest(F.lit(0).cast("long"), F.least(x, most))


def curriculum_plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    source: str = "source", weights: tuple[int, ...] = (5, 2, 1),
                    drifts: tuple[float, ...] = (-0.5, 0.0, 0.5), share: float = 1.5,
                    cap: float = 2.0, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken,
    position, repeat_position and ``kept``, a struct of the columns ``keep``, if any.

    Documents of a source enter in the order of md5(doc_id); the first pass takes
    words up to the target, a second pass what is left of it (``cap`` of 2 needs
    no third), and the document at which the target is met gives part of its
    words. ``position`` and ``repeat_position`` are the training times at which
    the two copies start, NULL where a copy is not taken.
    """
    h = F.md5(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).cast("binary"))
    kept = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept")] if keep else []
    sizes = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
                        word_count(F.col(f"`{text}`")).alias("size"), h.alias("h"), *kept)
    placed = ranked(sizes, F.struct("source"), [F.col("h"), F.col("doc_id"), F.col("size")], "mix", F.col("size"))
    sources = placed.groupBy("grp").agg(F.max("total").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    targets = source_targets(sources.select(F.col("grp.source").alias("source"), "source_size"), weights, share, cap)
    targets = (targets.select(F.struct("source").alias("grp"), "source_size", "target", "_class")
               .join(sources.select("grp", "_rows"), "grp"))
    rows = (lookup_join(placed.select("row", "grp", F.col("place").alias("_before")), targets, ["grp"], "_rows")
            .select("row.*", "source_size", "target", "_class", "_before")
            .withColumn("_goal", F.floor("target").cast("long"))
            .withColumn("_first", _clamp(F.col("_goal") - F.col("_before"), F.col("size")))
            .withColumn("_again", _clamp(F.col("_goal") - F.col("source_size") - F.col("_before"),
                                         F.col("size"))))
    drift = F.get(F.array(*[F.lit(float(k)) for k in drifts]), F.col("_class") % F.lit(len(drifts)))

    def position(words_before: Column, taken: str) -> Column:
        return F.when(F.col(taken) > 0, schedule_time(
            F.least(F.lit(1.0), words_before.cast("double") / F.col("target")), drift))

    return rows.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("_first") + F.col("_again")).alias("taken"),
        position(F.col("_before"), "_first").alias("position"),
        position(F.col("source_size") + F.col("_before"), "_again").alias("repeat_position"),
        *(["kept"] if keep else []))


def training_order(plan: DataFrame) -> DataFrame:
    """``plan`` range-sorted by training position (documents not taken last)."""
    return plan.orderBy(F.col("position").asc_nulls_last(), F.md5(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), "doc_id")


def mix_query(docs: DataFrame) -> DataFrame:
    return training_order(curriculum_plan(docs)).select(
        "doc_id", "size", "source_size", "target", "taken", "position", "repeat_position")


ORACLE_SQL = r"""
WITH s AS (
  SELECT doc_id, source, md5(coalesce(cast(doc_id AS varchar), '')) AS h,
         coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint AS size
  FROM documents),
src AS (SELECT source, sum(size)::bigint AS source_size FROM s GROUP BY source),
cls AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::int AS class,
         (sum(source_size) OVER ())::double * 1.5::double AS total,
         source_size::double * 2.0::double AS cap
  FROM src),
wts AS (SELECT *, CASE class WHEN 0 THEN 5.0::double WHEN 1 THEN 2.0::double ELSE 1.0::double END AS w,
               CASE class WHEN 0 THEN -0.5::double WHEN 1 THEN 0.0::double ELSE 0.5::double END AS k
        FROM cls),
lev AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::double))
            / sum(w) OVER (ORDER BY cap / w, source NULLS LAST
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM wts),
com AS (
  SELECT *, cap <= w * level AS capped,
         first_value(CASE WHEN cap <= w * level THEN NULL ELSE level END IGNORE NULLS)
           OVER (ORDER BY cap / w, source NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS common
  FROM lev),
tgt AS (
  SELECT source, source_size, k,
         CASE WHEN capped OR common IS NULL THEN cap ELSE w * common END AS target FROM com),
cum AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.k, floor(t.target)::bigint AS goal,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h, s.doc_id, s.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS before
  FROM s JOIN tgt t ON s.source IS NOT DISTINCT FROM t.source),
tak AS (
  SELECT *, greatest(0, least(goal - before, size))::bigint AS first_taken,
         greatest(0, least(goal - source_size - before, size))::bigint AS again
  FROM cum),
par AS (
  SELECT *, least(1.0::double, before::double / target) AS u1,
         least(1.0::double, (source_size + before)::double / target) AS u2 FROM tak)
SELECT doc_id, size, source_size, target, first_taken + again AS taken,
       CASE WHEN first_taken > 0 THEN 2.0::double * u1
         / ((1.0::double - k) + sqrt((1.0::double - k) * (1.0::double - k) + 4.0::double * k * u1)) END AS position,
       CASE WHEN again > 0 THEN 2.0::double * u2
         / ((1.0::double - k) + sqrt((1.0::double - k) * (1.0::double - k) + 4.0::double * k * u2)) END AS repeat_position
FROM par
"""

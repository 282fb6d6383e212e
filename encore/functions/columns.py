"""Column-level helpers shared by the metric operators.

Everything here builds JVM-side expressions; nothing calls an action.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import MASK_SUFFIX


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def distinct_count_incl_null(df: DataFrame, c: str) -> DataFrame:
    """One-row frame ``n``: distinct values of ``c``, a NULL counting once.

    Two-level plan (distinct on ``c``, then a global count): the hot value of a
    skewed column collapses map-side before the shuffle.
    """
    return df.select(c).distinct().agg(F.count(F.lit(1)).alias("n"))


def scalar_distinct_count(df: DataFrame, c: str) -> Column:
    """Scalar subquery: distinct values of ``c`` (NULL counts once)."""
    return distinct_count_incl_null(df, c).scalar()


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double, 0.0 when ``den`` is 0 (ANSI mode raises)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def percent_of(num: Column, den: Column) -> Column:
    """``100.0 * num / den`` in the reference's operation order; den 0 → 1."""
    return F.lit(100.0) * num / F.greatest(den, F.lit(1))


def order_desc_then(measure: str | Column, ties: Iterable[str]) -> list[Column]:
    """Measure descending, then names ascending — deterministic ties."""
    return [col_of(measure).desc()] + [F.col(t).asc_nulls_first() for t in ties]


def first_by_playcount(value: Column, playcount: str, ties: Iterable[str]) -> Column:
    """Aggregate: ``value`` of the row ranked first by playcount desc, ties asc.

    ``min_by`` over an ordering struct combines map-side: a user holding a third of
    all rows sends one row per map task to the shuffle. Its buffer holds strings, so
    Spark plans it as a sort aggregate: each task sorts its own rows by user before
    the partial step. NULL playcounts sort last, as in a descending window order.
    """
    ordering = F.struct(
        F.col(playcount).isNull().alias("_pc_null"),
        (-F.col(playcount)).alias("_neg_pc"),
        *[F.col(t).alias(f"_t{i}") for i, t in enumerate(ties)],
    )
    return F.min_by(value, ordering)


def mask_id(c: Column, keep: int = 6) -> Column:
    """``abc123`` + ``MASK_SUFFIX`` when the id as text is longer than ``keep``."""
    s = c.cast("string")
    return F.when(F.length(s) > keep, F.concat(F.substring(s, 1, keep), F.lit(MASK_SUFFIX))).otherwise(s)


def distinct_count(column: str, once: bool) -> Column:
    """Distinct non-NULL values of a group. ``once``: each value stands in one row of its
    group at most (distinct rows), so a plain count tells the same, and map tasks send one
    row per group instead of every (group, value)."""
    return F.count(column) if once else F.countDistinct(column)

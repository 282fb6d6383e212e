"""Read-side operators V1–V10 over stored metric results.

These are the summaries a dashboard reads: ranked pages, renamed one-row
results, per-type summaries, masked samples and chart labels. Samples are
ordered before the limit so every read returns the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import mask_id
from ..schema import ARTIST, STAT_MEAN, STAT_MEDIAN, USER


def ranked_page(result: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """V1: ``ORDER BY … LIMIT n`` (planned as a single top-k)."""
    return result.orderBy(*order).limit(n)


def diversity_page(diversity: DataFrame, n: int = 20, item: str = ARTIST) -> DataFrame:
    """V2: the ``n`` artists with most users (then tracks), re-sorted by tracks."""
    page = ranked_page(diversity, [F.col("distinct_users").desc(), F.col("distinct_tracks").desc(),
                                   F.col(item).asc_nulls_first()], n)
    return page.orderBy(F.col("distinct_tracks").desc(), F.col("distinct_users").desc(),
                        F.col(item).asc_nulls_first())


def top1_artist_view(same_top1: DataFrame, item: str = ARTIST) -> DataFrame:
    """V3: the #1-artist row with its column renamed to ``top1_artist``."""
    return same_top1.select(F.col(item).alias("top1_artist"), "users_count",
                            "percentage").limit(1)


def items_per_user_summary(parts: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """V4: per item type, users counted plus mean and median from the stats rows.

    ``parts`` maps an item type to its (counts, stats) result pair.
    """
    rows = []
    for item_type, (counts, stats) in parts.items():
        total = counts.agg(F.count(F.lit(1))).scalar()
        rows.append(stats.agg(
            F.max(F.when(F.lower(F.trim("metric")) == STAT_MEAN, F.col("value"))).alias("mean"),
            F.max(F.when(F.lower(F.trim("metric")) == STAT_MEDIAN, F.col("value"))).alias("median"),
        ).select(F.lit(item_type).alias("item_type"), total.alias("total_users"), "mean", "median"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def concentrated_users(single: DataFrame, user: str = USER) -> DataFrame:
    """V5a: single-artist users ordered by (main_artist, user)."""
    return single.orderBy(F.col("main_artist").asc_nulls_first(), F.col(user).asc_nulls_first())


def concentrated_artists(single: DataFrame, n: int = 20) -> DataFrame:
    """V5b: users per main artist, the ``n`` largest."""
    return ranked_page(single.groupBy("main_artist").agg(F.count(F.lit(1)).alias("user_count")),
                       [F.col("user_count").desc(), F.col("main_artist").asc_nulls_first()], n)


def quality_total(quality: DataFrame) -> DataFrame:
    """V6: sum of affected users over all problems (0 when there are none)."""
    return quality.agg(F.coalesce(F.sum("affected_users"), F.lit(0)).cast("long").alias("total"))


def outlier_sample(outliers: DataFrame, n: int = 10, keep: int = 6, user: str = USER) -> DataFrame:
    """V7: ``n`` outliers by user id, ids masked, with the total population."""
    total = outliers.agg(F.count(F.lit(1))).scalar()
    return (ranked_page(outliers, [F.col(user).asc_nulls_first()], n)
            .select(mask_id(F.col(user), keep).alias(user), "items_count", "percentile",
                    total.alias("total_population")))


def low_coverage_sample(low: DataFrame, n: int = 10, item: str = ARTIST) -> DataFrame:
    """V8: ``n`` least-mentioned artists with the total population."""
    total = low.agg(F.count(F.lit(1))).scalar()
    return (ranked_page(low, [F.col("mentions").asc(), F.col(item).asc_nulls_first()], n)
            .select(item, "mentions", total.alias("total_population")))


def combo_labels(top_lists: DataFrame, shown: int = 3) -> DataFrame:
    """V9: ``a / b / c`` labels of the identical-list groups (NULL shown as null)."""
    parts = []
    for i in range(shown):
        if i:
            parts.append(F.lit(" / "))
        parts.append(F.coalesce(F.col(f"top{i + 1}"), F.lit("null")))
    return top_lists.select(F.concat(*parts).alias("combo"), "user_count")


def share_split(result: DataFrame, label: Column, value: str) -> DataFrame:
    """V10: a percentage and its remainder to 100, for share charts."""
    return result.select(label.alias("label"), F.col(value).cast("double").alias("share"),
                         (F.lit(100.0) - F.col(value)).alias("remainder"))

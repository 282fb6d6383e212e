"""Popularity metrics M1–M6.

Totals the reference fetched with driver ``count()`` calls are scalar
subqueries here, so each metric is one plan and one action.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import distinct_count, first_by_playcount, percent_of, scalar_distinct_count
from ..functions.histogram import summary
from ..schema import (ALBUM, ARTIST, PLAYCOUNT, STAT_MEAN, STAT_MEDIAN, STAT_STDDEV, TRACK,
                      USER)


def users_per_item(lists: DataFrame, item: str, user: str = USER, once: bool = False) -> DataFrame:
    """(item, users_count): distinct users of each item. ``once``: ``lists`` holds each (user,
    item) once."""
    return lists.groupBy(item).agg(distinct_count(user, once).alias("users_count"))


def top_items(lists: DataFrame, item: str, k: int = 20, user: str = USER, once: bool = False,
              per_item: DataFrame | None = None) -> DataFrame:
    """M1–M3: items listed by the most distinct users, with their share in %.

    ``countDistinct`` plans as distinct-on-(item, user) then count-per-item, so a
    hot item is spread over the first shuffle and arrives pre-counted. ``once``: ``lists``
    holds each (user, item) once. With ``per_item`` (``users_per_item``) at hand, ``lists`` may be
    any table of the same users.
    """
    total = scalar_distinct_count(lists, user)
    return ((users_per_item(lists, item, user, once) if per_item is None else per_item)
            .withColumn("percentage", percent_of(F.col("users_count"), total))
            .orderBy(F.col("users_count").desc(), F.col(item).asc_nulls_first())
            .limit(k))


def top_artists(artists: DataFrame, k: int = 20, once: bool = False, per_item: DataFrame | None = None) -> DataFrame:
    return top_items(artists, ARTIST, k, once=once, per_item=per_item)


def top_tracks(tracks: DataFrame, k: int = 20, once: bool = False, per_item: DataFrame | None = None) -> DataFrame:
    return top_items(tracks, TRACK, k, once=once, per_item=per_item)


def top_albums(albums: DataFrame, k: int = 20, once: bool = False, per_item: DataFrame | None = None) -> DataFrame:
    return top_items(albums, ALBUM, k, once=once, per_item=per_item)


def first_items(lists: DataFrame, item: str = ARTIST, user: str = USER,
                playcount: str = PLAYCOUNT, ties: tuple[str, ...] | None = None,
                alias: str | None = None) -> DataFrame:
    """Each user's #1 item (rank 1 of M25) as (user, item) — one row per user."""
    ties = tuple(ties) if ties is not None else (item,)
    return (lists.groupBy(user)
            .agg(first_by_playcount(F.col(item), playcount, ties).alias(alias or item)))


def same_top1_artist(artists: DataFrame, item: str = ARTIST, k: int = 1,
                     user: str = USER, firsts: DataFrame | None = None) -> DataFrame:
    """M4: the most common #1 artist, its users and their share of all users.

    ``first_items`` has one row per user, the NULL user included, so an artist's users
    are its non-NULL rows and the total is the sum of all rows: a window over the
    grouped result, from one scan of the list. ``firsts``: those rows, where at hand.
    """
    firsts = first_items(artists, item, user) if firsts is None else firsts
    per_artist = firsts.groupBy(item).agg(
        F.count(user).alias("users_count"), F.count(F.lit(1)).alias("_rows"))
    # Totalled map-side into one row, then joined by the scalar: the groups are reused.
    total = per_artist.agg(F.sum("_rows")).scalar()
    return (per_artist.drop("_rows")
            .orderBy(F.col("users_count").desc(), F.col(item).asc_nulls_first())
            .limit(k)
            .withColumn("percentage", percent_of(F.col("users_count"), total)))


def mention_counts(lists: DataFrame, item: str = ARTIST) -> DataFrame:
    """Rows per item ("mentions"); the NULL and '' items are groups of their own."""
    return lists.groupBy(item).agg(F.count(F.lit(1)).alias("mentions"))


def mention_stats(artists: DataFrame, item: str = ARTIST, mentions: DataFrame | None = None) -> DataFrame:
    """M5: mean, median and sample stddev of mentions per artist as (metric, value).
    ``mentions``: ``mention_counts``, where at hand."""
    mentions = mention_counts(artists, item) if mentions is None else mentions
    stats = summary(mentions, "mentions", {STAT_MEDIAN: 0.5},
                    mean=STAT_MEAN, stddev=STAT_STDDEV)
    return stats.unpivot([], [STAT_MEAN, STAT_MEDIAN, STAT_STDDEV], "metric", "value")


def long_tail(artists: DataFrame, share: float = 0.8, item: str = ARTIST,
              mentions: DataFrame | None = None) -> DataFrame:
    """M6: artists whose running mention total (most mentioned first) stays within
    ``share`` of all mentions.

    The running total uses the default RANGE frame, so tied artists share one
    cumulative value. It is computed over the histogram mentions → #artists, which
    has at most ~sqrt(2·rows) entries, so the unpartitioned window sees a tiny
    input instead of every artist. ``mentions``: ``mention_counts``, where at hand.
    """
    hist = ((mention_counts(artists, item) if mentions is None else mentions)
            .groupBy("mentions").agg(F.count(F.lit(1)).alias("n_artists"))
            .withColumn("weight", F.col("mentions") * F.col("n_artists")))
    running = Window.orderBy(F.col("mentions").desc()).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    hist = (hist.withColumn("cum", F.sum("weight").over(running))
                .withColumn("total", F.sum("weight").over(everything)))
    limit = F.lit(float(share)) * F.greatest(F.col("total"), F.lit(1))
    out = hist.agg(
        F.coalesce(F.sum("n_artists"), F.lit(0)).cast("long").alias("total_artists"),
        F.coalesce(F.sum(F.when(F.col("cum") <= limit, F.col("n_artists")).otherwise(0)),
                   F.lit(0)).cast("long").alias("artists_in_tail"),
    )
    return out.withColumn(
        "tail_percentage",
        F.when(F.col("total_artists") > 0,
               F.round(F.lit(100.0) * F.col("artists_in_tail") / F.col("total_artists"), 2))
        .otherwise(F.lit(0.0)))

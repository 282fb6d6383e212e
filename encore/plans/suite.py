"""Suite runners R1–R3: compute every metric result and write it to a store.

Each result is one plan and one write; its row count is observed during that
write (no second job). Inputs are the per-user lists as DataFrames, normally
column-pruned Parquet scans, so each metric reads only the columns it needs. Mentions
per artist, rows and distinct items per user, users per item, distinct (user, item) rows, each
user's #1 artist and first ten tracks are made once per run and read by all metrics that
build on them (``SHARED``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import compare as cmp
from ..operators import cooccur as co
from ..operators import counts as cnt
from ..operators import popularity as pop
from ..operators import quality as qa
from ..schema import ALBUM, ARTIST, RESULT_TABLES, TRACK, USER
from ..session import remove_folder, shared_dir

Lists = Mapping[str, DataFrame]  # keys: artists, tracks, albums
Result = Callable[["Shared"], DataFrame]

# Intermediate results that several metrics read, by name. Distinct (user, item) rows
# stand in for a list wherever a metric counts distinct users or items.
SHARED: dict[str, Callable[["Shared"], DataFrame]] = {
    "artist_users": lambda t: t["artists"].select(USER, ARTIST).distinct(),
    "track_users": lambda t: t["tracks"].select(USER, TRACK).distinct(),
    "album_users": lambda t: t["albums"].select(USER, ALBUM).distinct(),
    "artist_mentions": lambda t: pop.mention_counts(t["artists"]),
    "track_mentions": lambda t: pop.mention_counts(t["tracks"]),
    "artist_rows": lambda t: qa.row_counts(t["artists"]),
    "track_rows": lambda t: qa.row_counts(t["tracks"]),
    "first_artists": lambda t: pop.first_items(t["artists"]),
    "first_tracks": lambda t: cnt.first_rows(t["tracks"], 10),
    "users_per_artist": lambda t: pop.users_per_item(t["artist_users"], ARTIST, once=True),
    "users_per_track": lambda t: pop.users_per_item(t["track_users"], TRACK, once=True),
    "users_per_album": lambda t: pop.users_per_item(t["album_users"], ALBUM, once=True),
    "artists_per_user": lambda t: cnt.artists_per_user(t["artist_users"], once=True)[0],
    "tracks_per_user": lambda t: cnt.tracks_per_user(t["track_users"], once=True)[0],
    "albums_per_user": lambda t: cnt.albums_per_user(t["album_users"], once=True)[0],
}


class Shared:
    """The input lists and, by name, the intermediate results of one suite run. One that is
    asked for is written to the shared folder, once, and read from there."""

    def __init__(self, spark: SparkSession, lists: Lists):
        self.spark, self.lists, self.folders = spark, lists, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name in self.lists:
            return self.lists[name]
        if name not in self.folders:
            folder = shared_dir(self.spark, "suite", name)
            SHARED[name](self).write.parquet(folder)
            self.folders[name] = folder
        return self.spark.read.parquet(self.folders[name])

    def drop(self) -> None:
        for folder in self.folders.values():
            remove_folder(self.spark, folder)
        self.folders = {}


def _popularity() -> dict[str, Result]:
    return {
        "top_20_artists": lambda t: pop.top_artists(t["artists_per_user"], per_item=t["users_per_artist"]),
        "top_20_tracks": lambda t: pop.top_tracks(t["tracks_per_user"], per_item=t["users_per_track"]),
        "top_20_albums": lambda t: pop.top_albums(t["albums_per_user"], per_item=t["users_per_album"]),
        "same_top1_artist": lambda t: pop.same_top1_artist(t["artists"], firsts=t["first_artists"]),
        "artist_mention_stats": lambda t: pop.mention_stats(t["artists"], mentions=t["artist_mentions"]),
        "long_tail_80": lambda t: pop.long_tail(t["artists"], mentions=t["artist_mentions"]),
    }


def _quality() -> dict[str, Result]:
    return {
        "data_quality": lambda t: qa.missing_data_report(t["artist_users"], per_user=t["artist_rows"]),
        "outlier_users": lambda t: qa.outlier_users(t["artists"], per_user=t["artist_rows"]),
        "low_coverage_artists": lambda t: qa.low_coverage_items(t["artists"], mentions=t["artist_mentions"]),
    }


def _cooccurrence() -> dict[str, Result]:
    return {
        "top_50_artist_pairs": lambda t: co.artist_pairs(t["artist_users"], once=True),
        "top_50_artist_triplets": lambda t: co.artist_triplets(t["artists"]),
        "artist_track_overlap": lambda t: co.artist_track_overlap(
            t["artists"], t["tracks"], firsts=t["first_artists"], first_tracks=t["first_tracks"]),
        "artist_average_position": lambda t: co.average_position(t["artists"]),
        "top1_in_global_top5_frequency": lambda t: co.top1_in_global_top(
            t["artist_users"], firsts=t["first_artists"], once=True),
        "position_stability_users": lambda t: co.position_stability(t["artists"]),
    }


def _counts() -> dict[str, Result]:
    """R2: per-user counts and their stats, unique items, list shapes."""
    return {
        "user_artist_counts": lambda t: t["artists_per_user"],
        "user_artist_stats": lambda t: cnt.count_stats(t["artists_per_user"], "artist_count"),
        "user_track_counts": lambda t: t["tracks_per_user"],
        "user_track_stats": lambda t: cnt.count_stats(t["tracks_per_user"], "track_count"),
        "user_album_counts": lambda t: t["albums_per_user"],
        "user_album_stats": lambda t: cnt.count_stats(t["albums_per_user"], "album_count"),
        "unique_items": lambda t: cnt.unique_items(
            t["users_per_artist"], t["users_per_track"], t["users_per_album"]),
        "users_same_top3_from_top10": lambda t: cnt.identical_top_lists(t["tracks"], firsts=t["first_tracks"]),
        "users_top5_single_artist": lambda t: cnt.single_artist_top_k(t["tracks"], firsts=t["first_tracks"]),
    }


def _compare() -> dict[str, Result]:
    """R3: artist lists against track lists."""
    return {
        "top_artists_active_users": lambda t: cmp.active_user_artists(
            t["artist_users"], t["tracks"], per_user=t["track_rows"],
            per_artist_user=qa.row_counts(t["artist_users"])),
        "cross_popularity_artists": lambda t: cmp.cross_popularity(
            t["artists"], t["tracks"], in_artists=t["artist_mentions"], in_tracks=t["track_mentions"]),
        "artists_diversity": lambda t: cmp.artist_diversity(
            t["artist_users"], t["tracks"], users=t["users_per_artist"]),
    }


GROUPS: dict[str, Callable[[], dict[str, Result]]] = {
    "popularity": _popularity,
    "quality": _quality,
    "cooccurrence": _cooccurrence,
    "counts": _counts,
    "compare": _compare,
}


def suite_results(groups: Iterable[str] | None = None) -> dict[str, Result]:
    """Result name → builder, in the order of ``schema.RESULT_TABLES``."""
    out: dict[str, Result] = {}
    for g in groups or GROUPS:
        out.update(GROUPS[g]())
    return {name: out[name] for name in RESULT_TABLES if name in out}


def run_suite(spark: SparkSession, lists: Lists, store, groups: Iterable[str] | None = None,
              only: Iterable[str] | None = None) -> DataFrame:
    """R1: write every selected result to ``store``; return (result, rows).

    Stops at the first failing result and re-raises it; results already
    written stay in the store. What several results share (``SHARED``) is written once to
    the shared folder, and removed at the end.
    """
    results = suite_results(groups)
    if only is not None:
        wanted = set(only)
        results = {k: v for k, v in results.items() if k in wanted}
    written = []
    shared = Shared(spark, lists)
    try:
        for name, build in results.items():
            obs = Observation(f"rows_{name}")
            store.write(build(shared).observe(obs, F.count(F.lit(1)).alias("rows")), name)
            written.append((name, int(obs.get["rows"])))
    finally:
        shared.drop()
    schema = T.StructType([T.StructField("result", T.StringType()),
                           T.StructField("rows", T.LongType())])
    return spark.createDataFrame(written, schema)


def run_counts_suite(spark: SparkSession, lists: Lists, store) -> DataFrame:
    """R2."""
    return run_suite(spark, lists, store, groups=["counts"])


def run_compare_suite(spark: SparkSession, lists: Lists, store) -> DataFrame:
    """R3."""
    return run_suite(spark, lists, store, groups=["compare"])

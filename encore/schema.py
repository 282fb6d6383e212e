"""Logical schemas of the per-user preference lists.

Only the columns the metrics read are fixed; ``user_id`` may be any
orderable type (string in exported CSVs, long in the driver tables).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: these must equal the reference's -------------------------
# Input columns and the schemas of the CSV exports.
USER = "user_id"
ARTIST = "artist_name"
TRACK = "track_name"
ALBUM = "album_name"
PLAYCOUNT = "playcount"
RANK = "rank"

USER_TOP_ARTISTS = T.StructType([
    T.StructField(USER, T.StringType()),
    T.StructField(ARTIST, T.StringType()),
    T.StructField(PLAYCOUNT, T.LongType()),
    T.StructField(RANK, T.IntegerType()),
])

USER_TOP_TRACKS = T.StructType([
    T.StructField(USER, T.StringType()),
    T.StructField(TRACK, T.StringType()),
    T.StructField(ARTIST, T.StringType()),
    T.StructField(PLAYCOUNT, T.LongType()),
])

USER_TOP_ALBUMS = T.StructType([
    T.StructField(USER, T.StringType()),
    T.StructField(ALBUM, T.StringType()),
    T.StructField(PLAYCOUNT, T.LongType()),
])

USERS = T.StructType([
    T.StructField(USER, T.StringType()),
])

# Expected CSV exports (without ".csv"), in the reference's order.
EXPECTED_DATASETS = ("user_top_albums", "user_top_artists", "user_top_tracks", "users")
# Names of the result tables the suite writes, in the reference's run order.
RESULT_TABLES = (
    "top_20_artists", "top_20_tracks", "top_20_albums", "same_top1_artist",
    "artist_mention_stats", "long_tail_80", "data_quality", "outlier_users",
    "low_coverage_artists", "top_50_artist_pairs", "top_50_artist_triplets",
    "artist_track_overlap", "artist_average_position", "top1_in_global_top5_frequency",
    "position_stability_users", "user_artist_counts", "user_artist_stats",
    "user_track_counts", "user_track_stats", "user_album_counts", "user_album_stats",
    "unique_items", "users_same_top3_from_top10", "users_top5_single_artist",
    "top_artists_active_users", "cross_popularity_artists", "artists_diversity",
)
# Labels of the (metric, value) statistic rows.
STAT_MEAN, STAT_MEDIAN, STAT_STDDEV = "mean", "median", "stddev"
# Problem labels of the data-quality report; the second takes the row threshold.
PROBLEM_NULL_OR_EMPTY = "null_or_empty_field"
PROBLEM_SHORT_LIST = "less_than_{n}_items"
# Marker appended to masked ids on the read side.
MASK_SUFFIX = "…"
# ---------------------------------------------------------------------------

# Schema each expected CSV export is parsed with.
DATASETS = {
    "user_top_albums": USER_TOP_ALBUMS,
    "user_top_artists": USER_TOP_ARTISTS,
    "user_top_tracks": USER_TOP_TRACKS,
    "users": USERS,
}

# Columns that a row of a dataset must have; rows without them are dropped.
REQUIRED = {name: (USER,) for name in DATASETS if name != "users"}

from __future__ import annotations

from pyspark.sql import functions as F

from encore.operators import counts as cnt
from encore.operators import serve as sv
from tests.conftest import rows


def test_outlier_sample_masks_and_orders(spark):
    df = spark.createDataFrame([("abcdefgh", 9, 99.0), ("abc", 1, 1.0), ("zz", 1, 1.0)],
                               "user_id string, items_count long, percentile double")
    assert rows(sv.outlier_sample(df, n=2)) == [("abc", 1, 1.0, 3), ("abcdef…", 9, 99.0, 3)]


def test_quality_total_empty(spark):
    df = spark.createDataFrame([], "problem string, affected_users long")
    assert rows(sv.quality_total(df)) == [(0,)]


def test_combo_labels_null(spark):
    df = spark.createDataFrame([("a", None, "c", 2)],
                               "top1 string, top2 string, top3 string, user_count long")
    assert rows(sv.combo_labels(df)) == [("a / null / c", 2)]


def test_items_per_user_summary(artists, tracks, albums):
    parts = {"artists": cnt.artists_per_user(artists([("u1", "A", 1, 1), ("u2", "B", 1, 1),
                                                      ("u2", "C", 1, 2)])),
             "tracks": cnt.tracks_per_user(tracks([("u1", "t", "A", 1)])),
             "albums": cnt.albums_per_user(albums([]))}
    out = {r[0]: r[1:] for r in rows(sv.items_per_user_summary(parts))}
    assert out == {"artists": (2, 1.5, 1.0), "tracks": (1, 1.0, 1.0), "albums": (0, None, None)}


def test_diversity_page_resorted(spark):
    df = spark.createDataFrame([("a", 5, 1), ("b", 4, 9), ("c", 1, 100)],
                               "artist_name string, distinct_users long, distinct_tracks long")
    assert rows(sv.diversity_page(df, n=2), "artist_name") == [("b",), ("a",)]


def test_share_split(spark):
    df = spark.createDataFrame([("X", 30.0)], "artist_name string, percentage double")
    assert rows(sv.share_split(df, F.col("artist_name"), "percentage")) == [("X", 30.0, 70.0)]

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

ARTISTS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("artist_name", T.StringType()),
    T.StructField("playcount", T.LongType()),
    T.StructField("rank", T.IntegerType()),
])
TRACKS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("track_name", T.StringType()),
    T.StructField("artist_name", T.StringType()),
    T.StructField("playcount", T.LongType()),
])
ALBUMS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("album_name", T.StringType()),
    T.StructField("playcount", T.LongType()),
])


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def artists(spark):
    def make(rows):
        return spark.createDataFrame(rows, ARTISTS)
    return make


@pytest.fixture
def tracks(spark):
    def make(rows):
        return spark.createDataFrame(rows, TRACKS)
    return make


@pytest.fixture
def albums(spark):
    def make(rows):
        return spark.createDataFrame(rows, ALBUMS)
    return make


def rows(df, *cols):
    """Collected rows as tuples (in result order)."""
    cols = cols or tuple(df.columns)
    return [tuple(r[c] for c in cols) for r in df.collect()]

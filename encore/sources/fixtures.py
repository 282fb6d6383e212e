"""Per-user lists derived from the driver's TPC-H-like tables.

The mapping (users = customers, artists = suppliers, tracks = parts, albums =
brand + type) is fixed in FIXTURES.md; every list is derived by Spark from the
given tables, so its size grows with them. The same derivations are written
in SQL in ``plans/oracle.py``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rank import GROUP_LIMIT, large_groups, rank_within_user, user_window
from ..operators.skew import hot_keys, salted_join

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


class DriverTables:
    """Lazily read ``{sf_dir}/{name}.parquet`` tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]


def plays(t: DriverTables) -> DataFrame:
    """One row per line item: who (customer) played what (part by supplier)."""
    li = t["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                              "l_quantity", "l_returnflag")
    orders = t["orders"].select("o_orderkey", "o_custkey")
    part = t["part"].select("p_partkey", "p_brand", "p_type")
    supplier = t["supplier"].select("s_suppkey", "s_name", "s_nationkey")
    nation = t["nation"].select("n_nationkey", "n_regionkey")
    region = t["region"].select("r_regionkey", "r_name")
    # An order has at most seven line items, so the order join has no hot key.
    # A part or supplier may be hot (assume a third of all line items): those
    # joins are salted on the hot keys, counted over lineitem alone. Nation and
    # region are fixed-size (25 and 5 rows) and broadcast by size.
    line_id = ["l_orderkey", "l_linenumber"]
    joined = li.join(orders, li.l_orderkey == orders.o_orderkey)
    joined = salted_join(joined, part, "l_partkey", "p_partkey",
                         hot=hot_keys(li, "l_partkey"), salt_by=line_id)
    joined = salted_join(joined, supplier, "l_suppkey", "s_suppkey",
                         hot=hot_keys(li, "l_suppkey"), salt_by=line_id)
    joined = (joined.join(nation, joined.s_nationkey == nation.n_nationkey)
                    .join(region, nation.n_regionkey == region.r_regionkey))
    return joined.select(
        F.col("o_custkey").alias("user_id"),
        F.col("s_name").alias("artist_name"),
        F.concat(F.lit("Part#"), F.col("p_partkey").cast("string")).alias("track_name"),
        F.concat(F.col("p_brand"), F.lit(" "), F.col("p_type")).alias("album_name"),
        F.col("r_name").alias("region"),
        "p_type", "l_returnflag",
        F.col("l_quantity").alias("qty"),
        "l_orderkey", "l_linenumber",
    )


def _aggregate_list(p: DataFrame, keys: list[str], ties: list[str],
                    with_rank: bool) -> DataFrame:
    agg = p.groupBy("user_id", *keys).agg(F.sum("qty").cast("long").alias("playcount"))
    if with_rank:
        agg = rank_within_user(agg, ties, rank_col="rank").withColumn("rank", F.col("rank").cast("int"))
    return agg


def user_top_artists(t: DriverTables, p: DataFrame | None = None) -> DataFrame:
    p = p if p is not None else plays(t)
    return _aggregate_list(p, ["artist_name"], ["artist_name"], False)


def user_ranked_artists(t: DriverTables, p: DataFrame | None = None) -> DataFrame:
    """``user_top_artists`` with each row's ``rank``, for what reads it."""
    p = p if p is not None else plays(t)
    return _aggregate_list(p, ["artist_name"], ["artist_name"], True)


def user_top10_artists(t: DriverTables, p: DataFrame | None = None) -> DataFrame:
    """The rows of ``user_ranked_artists`` of the first ten ranks; the window's group limit
    keeps ten rows of a user in each task."""
    return rank_within_user(user_top_artists(t, p), ["artist_name"], 10, rank_col="rank")


def user_top_tracks(t: DriverTables, p: DataFrame | None = None) -> DataFrame:
    p = p if p is not None else plays(t)
    return _aggregate_list(p, ["track_name", "artist_name"], ["track_name", "artist_name"], False)


def user_top_albums(t: DriverTables, p: DataFrame | None = None) -> DataFrame:
    p = p if p is not None else plays(t)
    return _aggregate_list(p, ["album_name"], ["album_name"], False)


LISTS = {"artists": ["user_id", "artist_name", "playcount", "rank"],
         "tracks": ["user_id", "track_name", "artist_name", "playcount"],
         "albums": ["user_id", "album_name", "playcount"]}


def user_lists(p: DataFrame, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """The rows of ``user_ranked_artists``, ``user_top_tracks`` and ``user_top_albums`` in one table,
    column ``list`` telling which (``LISTS``: their columns), from one shuffle of the plays.

    The plays are dealt by user, so a user's rows of a list come from one task and are
    stored together. Users of more than ``group_limit`` plays are not: theirs go by the
    lists' own keys, and are ranked by range.
    """
    n = int(p.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    large = F.broadcast(large_groups(p, "user_id", group_limit))
    columns = ["artist_name", "track_name", "album_name", "qty"]
    keyed = p.select(F.struct("user_id").alias("_g"), *columns)
    few = keyed.join(large, "_g", "left_anti").repartition(n, "_g")
    many = keyed.join(large, "_g", "left_semi")
    # The hash of all columns keeps the shuffle of the plays alike for the lists, so that Spark
    # runs one.
    whole = F.max(F.xxhash64(*columns)).alias("_hash")

    def listed(part: DataFrame, *keys: str) -> DataFrame:
        made = part.groupBy("_g", *keys).agg(F.sum("qty").cast("long").alias("playcount"), whole)
        return made.where(F.col("_hash").isNotNull()).select(F.col("_g.user_id").alias("user_id"), "_g", *keys, "playcount")

    few_ranked = listed(few, "artist_name").withColumn("rank", F.row_number().over(user_window(["artist_name"], "_g")))
    many_ranked = rank_within_user(listed(many, "artist_name").drop("_g"), ["artist_name"], rank_col="rank",
                                   group_limit=group_limit)
    parts = {"artists": [few_ranked, many_ranked]}
    for name, keys in (("tracks", ["track_name", "artist_name"]), ("albums", ["album_name"])):
        parts[name] = [listed(few, *keys), listed(many, *keys)]
    kinds = {"user_id": p.schema["user_id"].dataType, "artist_name": "string", "track_name": "string",
             "album_name": "string", "playcount": "bigint", "rank": "int"}
    return reduce(DataFrame.unionAll, [
        df.select(F.lit(name).alias("list"), *[(F.col(c) if c in LISTS[name] else F.lit(None)).cast(kind).alias(c)
                                              for c, kind in kinds.items()])
        for name, dfs in parts.items() for df in dfs])


def user_top_types(t: DriverTables, p: DataFrame | None = None) -> DataFrame:
    """Part types as tracks: few values, so identical top lists exist."""
    p = p if p is not None else plays(t)
    return _aggregate_list(p.withColumn("track_name", F.col("p_type")),
                           ["track_name"], ["track_name"], False)


def user_tracks_by_region(t: DriverTables, p: DataFrame | None = None) -> DataFrame:
    """Tracks whose "artist" is the supplier's region: single-artist top 5s exist."""
    p = p if p is not None else plays(t)
    return _aggregate_list(p.drop("artist_name").withColumnRenamed("region", "artist_name"),
                           ["track_name", "artist_name"], ["track_name", "artist_name"], False)


def plays_by_region(t: DriverTables, p: DataFrame | None = None) -> DataFrame:
    """Unaggregated plays, region as artist, quantity as playcount (repeats exist)."""
    p = p if p is not None else plays(t)
    return p.select("user_id", F.col("region").alias("artist_name"), "track_name",
                    F.col("qty").cast("long").alias("playcount"),
                    "l_orderkey", "l_linenumber")


PLAYS_BY_REGION_TIES = ("track_name", "artist_name", "l_orderkey", "l_linenumber")


def user_artists_dirty(t: DriverTables, p: DataFrame | None = None) -> DataFrame:
    """Plays with missing artists: NULL when orderkey % 97 = 0, '' when % 89 = 0."""
    p = p if p is not None else plays(t)
    artist = (F.when(F.col("l_orderkey") % 97 == 0, F.lit(None).cast("string"))
               .when(F.col("l_orderkey") % 89 == 0, F.lit(""))
               .otherwise(F.col("artist_name")))
    return p.select("user_id", artist.alias("artist_name"),
                    F.col("qty").cast("long").alias("playcount"))


def user_fine_items(t: DriverTables, p: DataFrame | None = None) -> DataFrame:
    """Distinct (user, supplier/album) items as artists: a long tail of rare ones."""
    p = p if p is not None else plays(t)
    return (p.select("user_id", F.concat(F.col("artist_name"), F.lit("/"),
                                         F.col("album_name")).alias("artist_name"))
             .distinct())

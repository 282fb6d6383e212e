"""Registered queries: each one derives its input lists from the driver tables
at ``sf_dir`` and runs one operator (or one read-side view of its result).

The matching DuckDB SQL for each key lives in ``plans/oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import compare as cmp
from ..operators import cooccur as co
from ..operators import counts as cnt
from ..operators import popularity as pop
from ..operators import quality as qa
from ..operators import serve as sv
from ..session import shared_dir, stored
from ..sources import fixtures as fx
from ..sources import ingest
from ..sources.sinks import ParquetStore, query_results, write_csv
from . import suite

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


class Lists:
    """Fixture lists for one ``sf_dir``, sharing one ``plays`` derivation."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.tables = fx.DriverTables(spark, sf_dir)
        self._plays: DataFrame | None = None

    @property
    def plays(self) -> DataFrame:
        if self._plays is None:
            self._plays = fx.plays(self.tables)
        return self._plays

    def store_plays(self) -> None:
        """For queries that write several lists: what these read of ``plays`` is derived once."""
        self._plays = stored(self.plays.select("user_id", "artist_name", "track_name", "album_name", "qty"), "plays")

    def __getattr__(self, name: str) -> DataFrame:
        builder = getattr(fx, name, None)
        if builder is None or name.startswith("_"):
            raise AttributeError(name)
        return builder(self.tables, self.plays)


def query(name: str):
    def register(fn: Callable[[Lists], DataFrame]) -> Callable[[Lists], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(Lists(spark, sf_dir))
        return fn
    return register


# --- popularity (M1–M6) ----------------------------------------------------

@query("top_artists")
def _q_top_artists(t: Lists) -> DataFrame:
    return pop.top_artists(t.user_top_artists)


@query("top_tracks")
def _q_top_tracks(t: Lists) -> DataFrame:
    return pop.top_tracks(t.user_top_tracks)


@query("top_albums")
def _q_top_albums(t: Lists) -> DataFrame:
    return pop.top_albums(t.user_top_albums)


@query("same_top1_artist")
def _q_same_top1(t: Lists) -> DataFrame:
    return pop.same_top1_artist(t.user_top_artists)


@query("artist_mention_stats")
def _q_mention_stats(t: Lists) -> DataFrame:
    # Rounded for the comparison only: two engines add up in different orders.
    return pop.mention_stats(t.user_top_artists).withColumn("value", F.round("value", 6))


@query("long_tail_80")
def _q_long_tail(t: Lists) -> DataFrame:
    return pop.long_tail(t.user_top_artists)


# --- counts (M7–M12) --------------------------------------------------------

@query("user_artist_counts")
def _q_artist_counts(t: Lists) -> DataFrame:
    return cnt.artists_per_user(t.user_top_artists)[0]


@query("user_artist_stats")
def _q_artist_stats(t: Lists) -> DataFrame:
    return cnt.artists_per_user(t.user_top_artists)[1]


@query("user_track_counts")
def _q_track_counts(t: Lists) -> DataFrame:
    return cnt.tracks_per_user(t.user_top_tracks)[0]


@query("user_track_stats")
def _q_track_stats(t: Lists) -> DataFrame:
    return cnt.tracks_per_user(t.user_top_tracks)[1]


@query("user_album_counts")
def _q_album_counts(t: Lists) -> DataFrame:
    return cnt.albums_per_user(t.user_top_albums)[0]


@query("user_album_stats")
def _q_album_stats(t: Lists) -> DataFrame:
    return cnt.albums_per_user(t.user_top_albums)[1]


@query("unique_items")
def _q_unique_items(t: Lists) -> DataFrame:
    return cnt.unique_items(t.user_top_artists, t.user_top_tracks, t.user_top_albums)


@query("identical_top_lists")
def _q_identical(t: Lists) -> DataFrame:
    return cnt.identical_top_lists(t.user_top_types)


@query("single_artist_top5")
def _q_single_artist(t: Lists) -> DataFrame:
    return cnt.single_artist_top_k(t.user_tracks_by_region)


# --- co-occurrence and positions (M13–M18) ----------------------------------

@query("artist_pairs")
def _q_pairs(t: Lists) -> DataFrame:
    return co.artist_pairs(t.user_top_artists)


@query("artist_triplets")
def _q_triplets(t: Lists) -> DataFrame:
    return co.artist_triplets(t.user_top10_artists)


@query("artist_track_overlap")
def _q_overlap(t: Lists) -> DataFrame:
    return co.artist_track_overlap(t.user_top_artists, t.user_top_tracks)


@query("artist_average_position")
def _q_avg_position(t: Lists) -> DataFrame:
    return co.average_position(t.user_top_artists)


@query("top1_in_global_top5")
def _q_top1_in_top5(t: Lists) -> DataFrame:
    return co.top1_in_global_top(t.user_top_artists)


@query("position_stability")
def _q_stability(t: Lists) -> DataFrame:
    return co.position_stability(t.plays_by_region, ties=fx.PLAYS_BY_REGION_TIES)


# --- comparisons (M19–M21) --------------------------------------------------

@query("active_user_artists")
def _q_active(t: Lists) -> DataFrame:
    return cmp.active_user_artists(t.user_top_artists, t.user_top_tracks)


@query("cross_popularity")
def _q_cross(t: Lists) -> DataFrame:
    return cmp.cross_popularity(t.user_top_artists, t.user_top_tracks)


@query("artist_diversity")
def _q_diversity(t: Lists) -> DataFrame:
    return cmp.artist_diversity(t.user_top_artists, t.user_top_tracks)


# --- quality (M22–M24) ------------------------------------------------------

@query("data_quality")
def _q_quality(t: Lists) -> DataFrame:
    return qa.missing_data_report(t.user_artists_dirty)


@query("data_quality_clean")
def _q_quality_clean(t: Lists) -> DataFrame:
    return qa.missing_data_report(t.user_top_artists)


@query("outlier_users")
def _q_outliers(t: Lists) -> DataFrame:
    return qa.outlier_users(t.user_top_artists)


@query("low_coverage_artists")
def _q_low_coverage(t: Lists) -> DataFrame:
    return qa.low_coverage_items(t.user_fine_items)


# --- read side (V1–V10) -----------------------------------------------------

@query("serve_top1_artist")
def _v_top1(t: Lists) -> DataFrame:
    return sv.top1_artist_view(pop.same_top1_artist(t.user_top_artists))


@query("serve_active_page")
def _v_active_page(t: Lists) -> DataFrame:
    res = cmp.active_user_artists(t.user_top_artists, t.user_top_tracks)
    return sv.ranked_page(res, [F.col("active_users").desc(),
                                F.col("artist_name").asc_nulls_first()], 20)


@query("serve_cross_page")
def _v_cross_page(t: Lists) -> DataFrame:
    res = cmp.cross_popularity(t.user_top_artists, t.user_top_tracks)
    return sv.ranked_page(res, [F.col("difference").desc(),
                                F.col("artist_name").asc_nulls_first()], 20)


@query("serve_position_page")
def _v_position_page(t: Lists) -> DataFrame:
    res = co.average_position(t.user_top_artists)
    return sv.ranked_page(res, [F.col("avg_position").asc(),
                                F.col("artist_name").asc_nulls_first()], 200)


@query("serve_diversity_page")
def _v_diversity(t: Lists) -> DataFrame:
    return sv.diversity_page(cmp.artist_diversity(t.user_top_artists, t.user_top_tracks))


@query("serve_items_per_user")
def _v_items_per_user(t: Lists) -> DataFrame:
    return sv.items_per_user_summary({
        "artists": cnt.artists_per_user(t.user_top_artists),
        "tracks": cnt.tracks_per_user(t.user_top_tracks),
        "albums": cnt.albums_per_user(t.user_top_albums),
    })


@query("serve_concentrated_users")
def _v_conc_users(t: Lists) -> DataFrame:
    return sv.concentrated_users(cnt.single_artist_top_k(t.user_tracks_by_region))


@query("serve_concentrated_artists")
def _v_conc_artists(t: Lists) -> DataFrame:
    return sv.concentrated_artists(cnt.single_artist_top_k(t.user_tracks_by_region))


@query("serve_quality_total")
def _v_quality_total(t: Lists) -> DataFrame:
    return sv.quality_total(qa.missing_data_report(t.user_artists_dirty))


@query("serve_outlier_sample")
def _v_outliers(t: Lists) -> DataFrame:
    return sv.outlier_sample(qa.outlier_users(t.user_top_artists))


@query("serve_low_coverage_sample")
def _v_low_coverage(t: Lists) -> DataFrame:
    return sv.low_coverage_sample(qa.low_coverage_items(t.user_fine_items))


@query("serve_top3_labels")
def _v_labels(t: Lists) -> DataFrame:
    return sv.combo_labels(cnt.identical_top_lists(t.user_top_types))


@query("serve_top1_share")
def _v_top1_share(t: Lists) -> DataFrame:
    return sv.share_split(pop.same_top1_artist(t.user_top_artists), F.col("artist_name"),
                          "percentage")


@query("serve_long_tail_share")
def _v_tail_share(t: Lists) -> DataFrame:
    return sv.share_split(pop.long_tail(t.user_top_artists), F.lit("artists_in_tail"),
                          "tail_percentage")


@query("pairs_null_user")
def _q_pairs_null_user(t: Lists) -> DataFrame:
    """M13 with a NULL user (every 50th) whose list goes through the heavy-user split."""
    return co.top_combinations(_with_null_user(t.user_top_artists), 2, 50, max_set=100,
                               budget=50_000, count_col="pair_count")


@query("triplets_null_user")
def _q_triplets_null_user(t: Lists) -> DataFrame:
    """M14 over the ranked list with a NULL user, split above 20 items."""
    ranked = _with_null_user(t.user_top10_artists)
    return co.top_combinations(ranked, 3, 50, max_set=20, budget=50_000, count_col="triplet_count")


def _with_null_user(lists: DataFrame) -> DataFrame:
    return lists.withColumn("user_id", F.when(F.col("user_id") % 50 != 0, F.col("user_id")))


# --- ingest, result store and suite runners (S1–S10, R1–R3) ------------------

def _export_csvs(t: Lists, raw_dir: str) -> None:
    """The driver-derived lists as the CSV exports that the loader expects, with bad
    rows: repeated rows, rows without a user, an extra field, text for a number."""
    # Written once: the export reads it several times.
    t.store_plays()
    t.user_ranked_artists.write.parquet(f"{raw_dir}/_ranked")
    artists = t.tables.spark.read.parquet(f"{raw_dir}/_ranked")
    lines = artists.select(
        F.col("user_id").alias("u"),
        F.concat_ws(",", F.coalesce(F.col("user_id").cast("string"), F.lit("")), F.concat(
            F.lit('"'), "artist_name", F.lit('"')), F.col("playcount").cast("string"),
            F.col("rank").cast("string")).alias("value"))
    bad = lines.where("u % 10 = 0").select("value")                        # repeated
    bad = bad.unionByName(lines.where("u % 11 = 0").select(
        F.regexp_replace("value", "^[0-9]+", "").alias("value")))           # no user
    bad = bad.unionByName(lines.where("u % 12 = 0").select(
        F.concat("value", F.lit(",extra")).alias("value")))                 # too many fields
    bad = bad.unionByName(lines.where("u % 13 = 0").select(
        F.regexp_replace("value", ",[0-9]+$", ",many").alias("value")))     # text for a number
    # Written as one unquoted column whose name is the header line.
    (lines.select("value").unionByName(bad).withColumnRenamed("value", "user_id,artist_name,playcount,rank")
     .write.option("header", True).option("sep", "\u0001").option("quote", "").option("escapeQuotes", False)
     .option("compression", "gzip").csv(f"{raw_dir}/user_top_artists.csv"))
    write_csv(t.user_top_tracks, f"{raw_dir}/user_top_tracks.csv", "gzip")
    write_csv(t.user_top_albums, f"{raw_dir}/user_top_albums.csv", "gzip")
    write_csv(t.tables["customer"].select(F.col("c_custkey").alias("user_id"), "c_name", "c_nationkey"),
              f"{raw_dir}/users.csv", "gzip")


def _ingest(t: Lists, infer: bool = False) -> tuple[DataFrame, str]:
    base = shared_dir(t.tables.spark, "ingest")
    _export_csvs(t, f"{base}/raw")
    report = ingest.run_loader(t.tables.spark, f"{base}/raw", f"{base}/parquet", f"{base}/backup",
                               infer=infer)
    return report, base


@query("ingest_report")
def _i_report(t: Lists) -> DataFrame:
    return _ingest(t)[0].select("file", "original_rows", "malformed_rows", "cleaned_rows",
                                "final_rows", "success")


@query("ingest_clean")
def _i_clean(t: Lists) -> DataFrame:
    return t.tables.spark.read.parquet(f"{_ingest(t)[1]}/parquet/user_top_artists")


@query("ingest_backup")
def _i_backup(t: Lists) -> DataFrame:
    """The raw backup: well-formed rows before cleaning, as text columns."""
    return (t.tables.spark.read.option("header", True)
            .csv(f"{_ingest(t)[1]}/backup/user_top_artists_backup"))


@query("ingest_users_inferred")
def _i_users(t: Lists) -> DataFrame:
    """The users export with its further columns typed by inference."""
    return t.tables.spark.read.parquet(f"{_ingest(t, infer=True)[1]}/parquet/users")


def _suite_lists(t: Lists) -> dict[str, DataFrame]:
    """The suite's inputs, written once, by one job: every result reads them again."""
    base = shared_dir(t.tables.spark, "suite-lists")
    t.store_plays()
    made = fx.user_lists(t.plays)
    made.write.partitionBy("list").parquet(base)
    stored_lists = t.tables.spark.read.schema(made.schema).parquet(base)
    return {n: stored_lists.where(F.col("list") == n).select(*columns) for n, columns in fx.LISTS.items()}


def _store(t: Lists) -> ParquetStore:
    return ParquetStore(shared_dir(t.tables.spark, "results"))


def _with_content(t: Lists, groups: list[str] | None = None) -> DataFrame:
    """The suite's report with an order-independent hash of each stored result: the sum
    over its rows of 32 bits of md5 of the cells in order of their names (NULL as ``~``,
    doubles to four decimals)."""
    spark, store = t.tables.spark, _store(t)
    report = suite.run_suite(spark, _suite_lists(t), store, groups=groups)
    found = []
    for name in suite.suite_results(groups):
        table = store.read(spark, name)
        cells = [F.coalesce((F.round(F.col(c) * 10000).cast("long") if kind == "double" else F.col(c)).cast("string"),
                            F.lit("~")) for c, kind in sorted(table.dtypes)]
        h = F.conv(F.substring(F.md5(F.concat_ws("|", *cells).cast("binary")), 1, 8), 16, 10).cast("long")
        found.append(table.agg(F.coalesce(F.sum(h), F.lit(0)).alias("content")).select(F.lit(name).alias("result"), "content"))
    return report.join(reduce(DataFrame.unionByName, found), "result")


@query("suite_full")
def _r_full(t: Lists) -> DataFrame:
    return _with_content(t)


@query("suite_counts")
def _r_counts(t: Lists) -> DataFrame:
    return _with_content(t, ["counts"])


@query("suite_compare")
def _r_compare(t: Lists) -> DataFrame:
    return _with_content(t, ["compare"])


@query("store_sql")
def _s_store_sql(t: Lists) -> DataFrame:
    """SQL over two results read back from a Parquet store."""
    store = _store(t)
    suite.run_suite(t.tables.spark, _suite_lists(t), store, only=["top_20_artists", "artists_diversity"])
    return query_results(t.tables.spark, store, """
        SELECT a.artist_name, a.users_count, d.distinct_tracks
        FROM top_20_artists a JOIN artists_diversity d ON a.artist_name = d.artist_name""",
                         ["top_20_artists", "artists_diversity"])

from __future__ import annotations

import os
import tempfile
import uuid

import pytest

from encore.plans.suite import run_suite
from encore.sources import ingest
from encore.sources.sinks import JdbcStore, ParquetStore, query_results, read_back
from tests.conftest import rows

BAD_CSV = (
    "user_id,artist_name,playcount,rank\n"
    "u1,Alpha,10,1\n"
    "u1,Alpha,10,1\n"              # exact duplicate
    "u2,Beta,5,1,extra\n"          # too many fields
    'u3,"Gamma, The",7,1\n'        # quoted comma
    ",Delta,3,1\n"                 # NULL user
    "u4,Eps,notanumber,2\n"        # text in a numeric column
)


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as fh:
        fh.write(text)


def test_loader_report_and_clean_rows(spark):
    base = tempfile.mkdtemp(prefix="encore-test-")
    _write(f"{base}/raw", "user_top_artists.csv", BAD_CSV)
    _write(f"{base}/raw", "users.csv", "user_id,country\nu1,NZ\nu1,NZ\n,XX\n")
    report = {r["file"]: r.asDict() for r in
              ingest.run_loader(spark, f"{base}/raw", f"{base}/pq", f"{base}/bk").collect()}
    art = report["user_top_artists.csv"]
    assert (art["original_rows"], art["malformed_rows"], art["cleaned_rows"],
            art["final_rows"], art["success"]) == (4, 2, 2, 2, True)
    clean = spark.read.parquet(f"{base}/pq/user_top_artists")
    assert sorted(rows(clean)) == [("u1", "Alpha", 10, 1), ("u3", "Gamma, The", 7, 1)]
    # users: deduplicated, but the NULL-key filter applies only to "user…top…" lists
    users = report["users.csv"]
    assert (users["original_rows"], users["cleaned_rows"], users["success"]) == (3, 2, True)
    assert spark.read.parquet(f"{base}/pq/users").columns == ["user_id", "country"]
    # the raw backup holds the well-formed rows before cleaning
    assert spark.read.option("header", True).csv(f"{base}/bk/user_top_artists_backup").count() == 4


def test_loader_no_files_raises(spark):
    base = tempfile.mkdtemp(prefix="encore-test-")
    with pytest.raises(FileNotFoundError):
        ingest.run_loader(spark, f"{base}/raw", f"{base}/pq", f"{base}/bk")


def test_loader_failure_does_not_stop_others(spark):
    base = tempfile.mkdtemp(prefix="encore-test-")
    _write(f"{base}/raw", "user_top_albums.csv", "user_id,album_name\nu1,A\n")
    # the tracks "file" is a folder holding a corrupt gzip part: reading it fails
    os.makedirs(f"{base}/raw/user_top_tracks.csv")
    with open(f"{base}/raw/user_top_tracks.csv/part-0.csv.gz", "wb") as fh:
        fh.write(b"this is not gzip data")
    report = {r["file"]: r for r in
              ingest.run_loader(spark, f"{base}/raw", f"{base}/pq/", f"{base}/bk").collect()}
    assert report["user_top_albums.csv"]["success"] is True
    assert report["user_top_tracks.csv"]["success"] is False
    assert report["user_top_tracks.csv"]["error"]


def test_read_back_reports_missing_and_wrong_counts(spark):
    rows_, err = read_back(spark, f"/nonexistent/{uuid.uuid4().hex}", 1)
    assert rows_ is None and "PATH_NOT_FOUND" in err
    path = f"{tempfile.mkdtemp(prefix='encore-test-')}/t"
    spark.range(3).write.parquet(path)
    assert read_back(spark, path, 3) == (3, None)
    rows_, err = read_back(spark, path, 4)
    assert rows_ == 3 and "4 were written" in err


def test_staging_is_removed(spark):
    base = tempfile.mkdtemp(prefix="encore-test-")
    _write(f"{base}/raw", "user_top_albums.csv", "user_id,album_name\nu1,A\n")
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(shared)) if os.path.exists(shared) else set()
    ingest.run_loader(spark, f"{base}/raw", f"{base}/pq", f"{base}/bk").collect()
    left = set(os.listdir(shared)) - before if os.path.exists(shared) else set()
    assert not [f for f in left if f.startswith("ingest-staging")]


def test_part_files_must_agree_on_the_header(spark):
    base = tempfile.mkdtemp(prefix="encore-test-")
    _write(f"{base}/raw/user_top_albums.csv", "part-0.csv", "user_id,album_name\nu1,A\n")
    _write(f"{base}/raw/user_top_albums.csv", "part-1.csv", "album_name,user_id\nB,u2\n")
    report = ingest.run_loader(spark, f"{base}/raw", f"{base}/pq", f"{base}/bk").collect()[0]
    assert report["success"] is False and "header" in report["error"].lower()


def test_inferred_columns(spark):
    base = tempfile.mkdtemp(prefix="encore-test-")
    _write(f"{base}/raw", "users.csv", "user_id,age,country\n1,30,NZ\n2,41,DE\n")
    for infer, kinds in ((False, ["string", "string", "string"]), (True, ["string", "int", "string"])):
        ingest.run_loader(spark, f"{base}/raw", f"{base}/pq{infer}", f"{base}/bk", infer=infer)
        assert [t for _, t in spark.read.parquet(f"{base}/pq{infer}/users").dtypes] == kinds


def test_jdbc_round_trip_in_memory_derby(spark, artists, tracks, albums):
    store = JdbcStore(f"jdbc:derby:memory:encore{uuid.uuid4().hex[:8]};create=true",
                      2, {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    lists = {"artists": artists([("u1", "A", 2, 1), ("u1", "B", 1, 2), ("u2", "A", 1, 1)]),
             "tracks": tracks([("u1", "t1", "A", 1)]),
             "albums": albums([("u1", "b1", 1)])}
    written = dict(rows(run_suite(spark, lists, store, only=["top_20_artists", "long_tail_80"])))
    assert written == {"top_20_artists": 2, "long_tail_80": 1}
    top = query_results(spark, store, "SELECT ARTIST_NAME, USERS_COUNT FROM TOP_20_ARTISTS "
                        "ORDER BY USERS_COUNT DESC", ["TOP_20_ARTISTS"])
    assert rows(top) == [("A", 2), ("B", 1)]


def test_parquet_store_suite_all_results(spark, artists, tracks, albums):
    store = ParquetStore(tempfile.mkdtemp(prefix="encore-test-"))
    lists = {"artists": artists([("u1", "A", 2, 1), ("u1", "B", 1, 2), ("u2", "A", 1, 1),
                                 ("u2", "B", 1, 2)]),
             "tracks": tracks([("u1", "t1", "A", 1), ("u2", "t1", "A", 1)]),
             "albums": albums([("u1", "b1", 1)])}
    written = dict(rows(run_suite(spark, lists, store)))
    assert len(written) == 27
    assert written["top_50_artist_pairs"] == 1
    assert rows(store.read(spark, "top_50_artist_pairs")) == [("A", "B", 2)]


def test_suite_writes_exactly_the_fixed_result_tables():
    from encore.plans.suite import GROUPS, suite_results
    from encore.schema import RESULT_TABLES
    names = [n for g in GROUPS.values() for n in g()]
    assert sorted(names) == sorted(RESULT_TABLES)
    assert list(suite_results()) == list(RESULT_TABLES)


def test_raw_backup_is_compressed_and_reads_back_whole(spark):
    base = tempfile.mkdtemp(prefix="encore-test-")
    _write(f"{base}/raw", "user_top_artists.csv", BAD_CSV)
    ingest.run_loader(spark, f"{base}/raw", f"{base}/pq", f"{base}/bk")
    folder = f"{base}/bk/user_top_artists_backup"
    assert all(f.endswith(".csv.gz") for f in os.listdir(folder) if f.startswith("part-"))
    assert spark.read.option("header", True).csv(folder).count() == 4


def test_several_lists_derive_their_plays_once(spark):
    from encore.plans.catalog import Lists
    lists = Lists(spark, "/root/testdata/sf0.001")
    lists.store_plays()
    for made in (lists.user_top_artists, lists.user_top_tracks, lists.user_top_albums, lists.user_ranked_artists):
        assert "lineitem" not in "".join(made.inputFiles())

"""Physical-plan properties the scale design relies on."""

from __future__ import annotations

import re

from encore.operators import cooccur as co
from encore.operators import counts as cnt
from encore.operators import popularity as pop
from tests.conftest import rows


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _window_partitions(plan: str) -> list[str]:
    """The PARTITION BY lists of every Window operator in the plan."""
    return re.findall(r"Window \[.*?\], \[(.*?)\], \[", plan)


def test_rank_one_metrics_use_no_window(artists, tracks):
    a = artists([("u1", "A", 2, 1), ("u1", "B", 1, 2)])
    t = tracks([("u1", "t", "A", 1)])
    for df in (pop.same_top1_artist(a), co.artist_track_overlap(a, t),
               co.top1_in_global_top(a)):
        plan = _plan(df)
        assert "Window" not in plan
        assert "min_by" in plan


def test_top_k_metrics_limit_before_shuffle(tracks, artists):
    t = tracks([("u1", "t", "A", 1)])
    for df in (cnt.identical_top_lists(t), cnt.single_artist_top_k(t),
               co.position_stability(artists([("u1", "A", 1, 1)]))):
        assert "WindowGroupLimit" in _plan(df)


def test_average_position_has_no_window_over_large_users(artists):
    plan = _plan(co.average_position(artists([("u1", "A", 2, 1), ("u1", "B", 1, 2)]), group_limit=1))
    plan = plan[plan.index("Union") + 1:]
    plan = plan[plan.index("_b#") - 2000 if plan.index("_b#") > 2000 else 0:]
    parts = _window_partitions(plan)
    assert parts, plan
    # every window is partitioned by (group, range bucket) or runs over the
    # per-(group, bucket) totals (partitioned by group _kg, ordered by bucket)
    assert any("_b#" in p for p in parts) and any(p.startswith("_kg") for p in parts), parts


def test_active_users_join_on_user_and_salt(spark, artists, tracks):
    from encore.operators import compare as cmp
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(cmp.active_user_artists(artists([("u1", "A", 1, 1)]), tracks([("u1", "t", "A", 1)])))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [user_id" in plan and "_salt" in plan.split("SortMergeJoin", 1)[1][:80]


def test_percentiles_come_from_histograms(artists):
    from encore.operators import quality as qa
    a = artists([("u1", "A", 2, 1)])
    for df in (pop.mention_stats(a), cnt.artists_per_user(a)[1], qa.outlier_users(a)):
        assert "percentile" not in _plan(df).replace("percentile#", "")


def test_pairs_expand_on_explicit_repartition(artists):
    plan = _plan(co.artist_pairs(artists([("u1", "A", 1, 1), ("u1", "B", 1, 2)])))
    assert "REPARTITION_BY_NUM" in plan
    assert "Generate" in plan and "posexplode" in plan


def test_long_tail_window_runs_on_histogram(artists):
    plan = _plan(pop.long_tail(artists([("u1", "A", 1, 1)])))
    # the only windows order by the mention count, over the aggregated histogram
    for part in re.findall(r"Window \[(.*?)\]", plan):
        assert "mentions" in part or "weight" in part


def test_fixture_joins_are_salted_on_hot_keys(spark):
    from encore.sources import fixtures as fx
    plays = fx.plays(fx.DriverTables(spark, "/root/testdata/sf0.001"))
    plan = _plan(plays)
    # part and supplier joins: (key, salt) equi-joins, hot keys broadcast
    assert plan.count("sequence(0") == 2
    assert "_salt" in plan and "BroadcastExchange" in plan


def test_suite_makes_each_shared_result_once(spark, artists, tracks, albums, tmp_path):
    import os

    from encore.plans import suite
    from encore.sources.sinks import ParquetStore
    lists = {"artists": artists([("u1", "A", 2, 1), ("u2", "A", 1, 1)]), "tracks": tracks([("u1", "t", "A", 1)]),
             "albums": albums([("u1", "b", 1)])}
    made = []
    real = dict(suite.SHARED)
    for name, build in real.items():
        suite.SHARED[name] = lambda t, name=name, build=build: made.append(name) or build(t)
    try:
        suite.run_suite(spark, lists, ParquetStore(str(tmp_path)))
    finally:
        suite.SHARED.update(real)
    assert sorted(made) == sorted(real)
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    assert not [f for f in os.listdir(shared) if f.startswith("suite-artist")]


def test_suite_lists_come_from_one_shuffle_of_the_plays(spark):
    """The three lists as the fixtures make them one by one, users above the limit too."""
    from encore.sources import fixtures as fx

    plays = spark.createDataFrame(
        [(None if u == 3 else u, f"a{(u * k) % 5}", f"t{k % 7}", f"b{k % 3}", float(1 + k % 4))
         for u in range(6) for k in range(4 + 9 * (u == 2))],
        "user_id long, artist_name string, track_name string, album_name string, qty double")
    want = {"artists": fx.user_ranked_artists(None, plays), "tracks": fx.user_top_tracks(None, plays),
            "albums": fx.user_top_albums(None, plays)}
    for limit in (1 << 20, 5):
        made = fx.user_lists(plays, limit)
        for name, columns in fx.LISTS.items():
            got = made.where(made["list"] == name).select(*columns)
            assert got.dtypes == want[name].select(*columns).dtypes
            assert sorted(got.collect(), key=repr) == sorted(want[name].select(*columns).collect(), key=repr)
    made = fx.user_lists(plays)
    made.collect()
    plan = made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    lines = [x for x in plan.splitlines() if "hashpartitioning(_g" in x and "REPARTITION_BY_NUM" in x]
    assert sum("ReusedExchange" not in x for x in lines) == 1 and len(lines) >= 3


def test_shared_results_of_the_suite_stand_in_for_the_lists(artists, tracks):
    from encore.operators import compare, cooccur, counts, popularity, quality

    t = tracks([(u, n, a, p) for u in ("u1", "u2", "u3", None) for n, a, p in (
        ("s1", "X", 9), ("s2", "X", 8), ("s3", "Y" if u == "u3" else "X", 8), (None, "X", 2), ("s4", "X", None), ("s5", None, 1))]
        + [("u4", "s1", "X", 1), ("u5", None, None, 3)])
    a = artists([("u1", "X", 5, 1), ("u1", "Y", 4, 2), ("u2", "X", 1, 1), ("u3", None, 2, 1), ("u4", "Y", 2, 1), (None, "X", 2, 1)])
    firsts = counts.first_rows(t, 10)
    for k in (1, 3, 5):
        assert (sorted(rows(counts.single_artist_top_k(t, k, firsts=firsts)), key=repr)
                == sorted(rows(counts.single_artist_top_k(t, k)), key=repr))
        assert rows(counts.identical_top_lists(t, k, firsts=firsts)) == rows(counts.identical_top_lists(t, k))
    assert rows(cooccur.artist_track_overlap(a, t, first_tracks=firsts)) == rows(cooccur.artist_track_overlap(a, t))
    assert rows(cooccur.artist_pairs(a.select("user_id", "artist_name"), once=True)) == rows(cooccur.artist_pairs(a))
    per_item = popularity.users_per_item(a, "artist_name")
    per_user = counts.artists_per_user(a)[0]
    assert rows(popularity.top_artists(per_user, per_item=per_item)) == rows(popularity.top_artists(a))
    assert rows(compare.artist_diversity(a, t, users=per_item)) == rows(compare.artist_diversity(a, t))
    assert (rows(compare.active_user_artists(a, t, 3, per_artist_user=quality.row_counts(a)))
            == rows(compare.active_user_artists(a, t, 3)) != [])

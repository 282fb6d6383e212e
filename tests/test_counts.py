from __future__ import annotations

from encore.operators import counts as cnt
from encore.operators.rank import rank_within_user
from tests.conftest import rows


def test_items_per_user_and_stats(artists):
    df = artists([("u1", "A", 3, 1), ("u1", "A", 2, 2), ("u1", None, 1, 3), ("u2", "B", 1, 1),
                  ("u3", "A", 1, 1), ("u3", "B", 1, 2), ("u3", "C", 1, 3)])
    counts, stats = cnt.artists_per_user(df)
    assert sorted(rows(counts)) == [("u1", 1), ("u2", 1), ("u3", 3)]
    assert dict(rows(stats)) == {"mean": 5 / 3, "median": 1.0}


def test_unique_items_counts_null_once(artists, tracks, albums):
    a = artists([("u1", None, 1, 1), ("u2", None, 1, 1), ("u1", "", 1, 2), ("u1", "X", 1, 3)])
    t = tracks([("u1", "t1", "X", 1), ("u1", None, "X", 1)])
    b = albums([("u1", "b1", 1)])
    assert rows(cnt.unique_items(a, t, b)) == [(3, 2, 1)]


def test_identical_top_lists(tracks):
    same = [("t1", 9), ("t2", 8), ("t3", 7), ("t4", 6)]
    df = tracks([("a", "t1", "X", 5), ("a", "t2", "X", 4)]
                + [("b", t, "X", p) for t, p in same]
                + [("c", t, "X", p) for t, p in same])
    assert rows(cnt.identical_top_lists(df)) == [("t1", "t2", "t3", 2)]


def test_identical_top_lists_only_top_k_matters(tracks):
    # Same top 2, different third: equal under k=2, different under k=3.
    df = tracks([("a", "t1", "X", 9), ("a", "t2", "X", 8), ("a", "t3", "X", 1),
                 ("b", "t1", "X", 9), ("b", "t2", "X", 8), ("b", "t4", "X", 1)])
    assert rows(cnt.identical_top_lists(df, k=2)) == [("t1", "t2", None, 2)]
    assert cnt.identical_top_lists(df, k=3).count() == 0


def test_single_artist_top5(tracks):
    five = [(f"t{i}", "X", 10 - i) for i in range(5)]
    df = tracks([("a", t, ar, p) for t, ar, p in five]                       # all X
                + [("b", t, ar, p) for t, ar, p in five[:4]]                 # only 4 tracks
                + [("c", t, "X", p) for t, _, p in five] + [("c", "z", "Y", 100)])  # Y on top
    assert rows(cnt.single_artist_top_k(df)) == [("a", "X", 5)]


def test_rank_within_user_is_deterministic(artists):
    df = artists([("u1", "B", 10, 1), ("u1", "A", 10, 2), ("u1", "C", 11, 3)])
    out = rows(rank_within_user(df, ["artist_name"]).orderBy("rn"), "artist_name", "rn")
    assert out == [("C", 1), ("A", 2), ("B", 3)]


def test_rank_limit_uses_window_group_limit(artists):
    df = rank_within_user(artists([("u1", "A", 1, 1)]), ["artist_name"], k=3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_full_rank_matches_row_number_with_duplicates_and_nulls(artists):
    import random
    from pyspark.sql import functions as F
    from encore.operators.rank import user_window
    rnd = random.Random(5)
    data = [(rnd.choice(["u1", "u2", "u3", None]), rnd.choice([None, "", "a", "b", "c"]),
             rnd.choice([None, 1, 2, 3]), 1) for _ in range(120)]
    df = artists(data)
    split = rank_within_user(df, ["artist_name"], group_limit=100)
    plain = df.withColumn("rn", F.row_number().over(user_window(["artist_name"])))
    key = ("user_id", "playcount", "artist_name", "rn")
    assert sorted(rows(split, *key), key=repr) == sorted(rows(plain, *key), key=repr)
    assert "Window" in split._jdf.queryExecution().executedPlan().toString()


def test_running_total_splits_a_hot_user_over_buckets(spark, artists):
    """One user with most rows, nearly all at one playcount: the rows spread
    over several range buckets, and ranks still equal a plain row_number."""
    import random
    from pyspark.sql import functions as F
    from encore.operators.rank import user_window
    rnd = random.Random(7)
    data = [("hot", f"a{i:04d}", rnd.choice([1, 1, 1, 1, 2, 3]), 1) for i in range(600)]
    data += [(f"u{i}", f"a{rnd.randrange(50):04d}", rnd.randrange(5), 1) for i in range(60)]
    df = artists(data)
    buckets = (df.repartitionByRange(8, "user_id", F.col("playcount").desc(), "artist_name")
               .where(F.col("user_id") == "hot").select(F.spark_partition_id().alias("b"))
               .distinct().count())
    assert buckets > 2
    split = rank_within_user(df, ["artist_name"], group_limit=100)
    plain = df.withColumn("rn", F.row_number().over(user_window(["artist_name"])))
    key = ("user_id", "playcount", "artist_name", "rn")
    assert sorted(rows(split, *key), key=repr) == sorted(rows(plain, *key), key=repr)


def test_equal_signatures_are_settled_by_names(spark, tracks, monkeypatch):
    """All lists under one signature: still grouped by their names, NULLs included."""
    from pyspark.sql import functions as F
    from encore.operators import counts
    data = [(u, t, "A", 9 - k) for u, names in (("u1", "abc"), ("u2", "abc"), ("u3", "abd"), ("u4", "abd"), ("u5", "abd"),
                                                ("u6", "xyz"), (None, "abc")) for k, t in enumerate(names)]
    data += [(u, None, "A", 3) for u in ("u7", "u8")] + [("u7", "q", "A", 1), ("u8", "q", "A", 1)]
    plain = rows(counts.identical_top_lists(tracks(data)))
    monkeypatch.setattr(counts, "list_signature", lambda *c: F.struct(F.lit(1).alias("a"), F.lit(2).alias("b")))
    assert rows(counts.identical_top_lists(tracks(data))) == plain
    assert plain == [("a", "b", "d", 3), (None, "q", None, 2), ("a", "b", "c", 2)]


def test_rows_that_stand_once_are_counted_without_a_shuffle_of_pairs(spark):
    """Distinct (user, item) rows: the same results, with one exchange by the group alone."""
    from pyspark.sql import functions as F

    from encore.operators import compare, cooccur, counts, popularity

    pairs = spark.createDataFrame(list({(f"u{k % 7}" if k % 9 else None, f"a{k % 5}" if k % 11 else None)
                                        for k in range(60)}), "user_id string, artist_name string")
    tracks = pairs.withColumn("track_name", F.col("user_id"))
    firsts = pairs.groupBy("user_id").agg(F.min("artist_name").alias("artist_name"))
    made = [lambda **kw: popularity.top_artists(pairs, **kw), lambda **kw: counts.artists_per_user(pairs, **kw)[0],
            lambda **kw: counts.artists_per_user(pairs, **kw)[1],
            lambda **kw: compare.artist_diversity(pairs, tracks, **kw),
            lambda **kw: cooccur.top1_in_global_top(pairs, firsts=firsts, **kw)]
    for make in made:
        plain, once = make(), make(once=True)
        assert sorted(map(str, once.collect())) == sorted(map(str, plain.collect()))
        steps = [df._jdf.queryExecution().executedPlan().toString().count("Exchange") for df in (plain, once)]
        assert steps[1] < steps[0], steps

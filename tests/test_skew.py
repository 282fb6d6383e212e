"""Salted equi-join on a hot key."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.operators.skew import hot_keys, salted_join

from .conftest import rows


def test_salted_join_equals_plain_join_with_a_hot_key(spark):
    big = spark.createDataFrame(
        [(i, 7 if i % 10 < 7 else i % 13, f"r{i}") for i in range(400)],   # key 7: ~70 % of rows
        "id long, k long, v string")
    small = spark.createDataFrame([(k, f"name{k}") for k in range(13)], "sk long, name string")
    hot = hot_keys(big, "k", hot_share=4, partitions=8)
    assert rows(hot) == [(7, 6)]                       # ceil(0.7 · 8) salts
    got = salted_join(big, small, "k", "sk", hot=hot, salt_by=["id"])
    want = big.join(small, big.k == small.sk)
    cols = ("id", "k", "v", "sk", "name")
    assert sorted(rows(got, *cols)) == sorted(rows(want, *cols))
    salts = (big.join(F.broadcast(hot), "k").select(F.pmod(F.xxhash64("id"), F.col("_salts")))
             .distinct().count())
    assert salts > 1


def test_salted_join_without_hot_keys(spark):
    big = spark.createDataFrame([(i, i % 50) for i in range(200)], "id long, k long")
    small = spark.createDataFrame([(k, k * 2) for k in range(50)], "k long, w long")
    got = salted_join(big, small.withColumnRenamed("k", "sk"), "k", "sk", hot_share=4)
    assert got.count() == 200
    assert rows(hot_keys(big, "k", hot_share=4)) == []


def test_salted_left_join_same_key_name(spark):
    big = spark.createDataFrame([(i, "hot" if i % 4 else f"u{i}") for i in range(120)],
                                "id long, user_id string")
    small = spark.createDataFrame([("hot", 90)], "user_id string, _n long")
    got = salted_join(big, small, "user_id", how="left", hot_share=2, partitions=8)
    assert got.columns == ["id", "user_id", "_n"]
    assert rows(got.where("_n is not null")).__len__() == 90
    assert got.count() == 120


def test_salted_join_null_keys_behave_like_a_plain_join(spark):
    big = spark.createDataFrame([(i, None if i % 3 == 0 else i % 2) for i in range(60)],
                                "id long, k long")
    small = spark.createDataFrame([(0, "zero"), (1, "one"), (None, "null")], "sk long, name string")
    hot = hot_keys(big, "k", hot_share=4, partitions=8)
    for how in ("inner", "left"):
        got = salted_join(big, small, "k", "sk", hot=hot, salt_by=["id"], how=how)
        want = big.join(small, big.k == small.sk, how)
        cols = ("id", "k", "sk", "name")
        assert sorted(rows(got, *cols), key=repr) == sorted(rows(want, *cols), key=repr)

"""Equi-join on a key that may be hot.

``salted_join(big, small, key)`` joins a fact-like frame with a frame that
holds each key at most once (a dimension table). A key holding a large share
of ``big`` (assume up to a third of all rows) would put all its rows in one
shuffle task, so hot keys are salted:

* rows per key of ``big`` are counted (a map-side-combined aggregate over the
  key column only); keys holding ≥ 1/``hot_share`` of all rows are hot. There
  are at most ``hot_share`` of them (the counts sum to the total), so that
  table is broadcast with a proven size bound;
* a hot key with share ``f`` gets ``ceil(f · partitions)`` salts; each of its
  ``big`` rows takes one by a hash of the row (deterministic, so a retried task
  salts alike), and its ``small`` row is replicated once per salt;
* the join runs on (key, salt) with one shuffle of ``big``, as the plain join
  would, but a hot key's rows spread over about ``f · partitions`` tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hot_keys(big: DataFrame, key: str, hot_share: int = 1024,
             partitions: int | None = None) -> DataFrame:
    """(key, ``_salts``) for the keys holding ≥ 1/``hot_share`` of ``big``'s rows."""
    counts = big.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    return hot_from_counts(counts, key, "_rows", total, hot_share, partitions)


def hot_from_counts(counts: DataFrame, key: str, rows: str, total: Column,
                    hot_share: int = 1024, partitions: int | None = None) -> DataFrame:
    """``hot_keys`` from per-key row counts already at hand (``total`` = their sum)."""
    parts = partitions or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = F.greatest(F.lit(1), F.ceil(F.col(rows) * F.lit(parts) / total)).cast("int")
    return (counts.where(F.col(rows) * F.lit(hot_share) >= total)
            .select(key, salts.alias("_salts")))


def salted_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str | None = None,
                hot: DataFrame | None = None, salt_by: list[str] | None = None,
                hot_share: int = 1024, partitions: int | None = None,
                how: str = "inner") -> DataFrame:
    """``big ⋈ small`` on ``big_key = small_key`` (``small`` unique on its key),
    ``how`` = ``"inner"`` or ``"left"``. Both key columns are kept, as in a
    plain join; when the two names are equal, one key column is kept.

    ``hot`` is ``hot_keys`` of a frame with ``big``'s key distribution (by
    default ``big`` itself; pass one over the base table when ``big`` is an
    expensive derivation). ``salt_by`` names the columns hashed to salt a hot
    key's rows (default: every column of ``big``).
    """
    same_name = small_key is None or small_key == big_key
    if same_name:
        small = small.withColumnRenamed(big_key, "_sk")
        small_key = "_sk"
    hot = hot if hot is not None else hot_keys(big, big_key, hot_share, partitions)
    parts = partitions or int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot.select(F.col(hot.columns[0]).alias("_hk"), "_salts"))
    row_hash = F.xxhash64(*[F.col(c) for c in (salt_by or big.columns)])
    big_s = (big.join(hot, F.col(big_key) == F.col("_hk"), "left")
             # A NULL key matches nothing, so its rows may take any salt: all of them.
             .withColumn("_salt", F.when(F.col(big_key).isNull(), F.pmod(row_hash, F.lit(parts)))
                         .when(F.col("_salts").isNull(), F.lit(0))
                         .otherwise(F.pmod(row_hash, F.col("_salts"))).cast("int"))
             .drop("_hk", "_salts"))
    small_s = (small.join(hot, F.col(small_key) == F.col("_hk"), "left")
               .withColumn("_salt2", F.explode(F.sequence(
                   F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
               .drop("_hk", "_salts"))
    out = (big_s.join(small_s, (F.col(big_key) == F.col(small_key))
                      & (F.col("_salt") == F.col("_salt2")), how)
           .drop("_salt", "_salt2"))
    return out.drop("_sk") if same_name else out

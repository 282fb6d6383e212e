"""M25 — per-user ranker.

``row_number`` over ``playcount`` descending within each user, with name
columns appended ascending so ties are deterministic.

* With ``k`` (top-k per user) the filter sits directly on the rank, so
  Catalyst inserts a partial ``WindowGroupLimit`` before the shuffle: each map
  task forwards at most ``k`` rows per user, so a hot user never lands whole in
  one task.
* Without ``k`` (every row ranked) the rank is 1 + the user's rows before it
  in that order, an exclusive running count from ``running_total``, which
  splits users above ``GROUP_LIMIT`` rows into ordered range buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import order_desc_then
from ..schema import PLAYCOUNT, USER

# Rows of one group that one task may sort (about 100 MB).
GROUP_LIMIT = 1 << 20


def user_window(ties: Sequence[str], user: str = USER, playcount: str = PLAYCOUNT):
    return Window.partitionBy(user).orderBy(*order_desc_then(playcount, ties))


def large_groups(df: DataFrame, by: str, group_limit: int = GROUP_LIMIT, *more: Column) -> DataFrame:
    """(``_g``,): the groups of more than ``group_limit`` rows, as structs, which are never
    NULL. There are at most rows / ``group_limit`` of them, so the table may be broadcast."""
    held = df.groupBy(F.struct(by).alias("_g")).agg(F.count("*").alias("_rows"), *more)
    return held.where((F.col("_rows") > group_limit)).select("_g", *[F.col(f"_m{i}") for i in range(len(more))])


def running_total(df: DataFrame, by: str, order: Sequence[Column], value: str | None = None,
                  out: str = "_before", group_limit: int = GROUP_LIMIT,
                  prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Exclusive running total of ``value`` (a row count when omitted) within each
    ``by`` group, in ``order``; added as column ``out`` (long).

    Groups of at most ``group_limit`` rows take one window. The rows of larger ones, found
    by a count per group in the same plan, are cut by range into contiguous, ordered
    buckets. A row's total is that of its group's earlier buckets (a window over one row
    per bucket) and of the rows before it in its bucket. A group holding a third of all
    rows is spread over many buckets. Building the plan runs no job and writes nothing.

    The buckets are those of one range exchange, which both parts of the sum read. Since
    they are contiguous, the sum is right exactly if both saw as many rows in each bucket;
    the plan compares the two and fails otherwise (say, with exchange reuse turned off).

    ``order`` should be a total order within a group; rows tied on it are counted one
    after another, as ``row_number`` does.

    ``prepare`` makes the rows to add up (with ``by``, ``value`` and the columns of ``order``) from
    rows of ``df`` with ``_g``, the group as a struct; what it groups by ``_g`` needs no
    shuffle beside the one of the windows. ``df``'s own rows then decide which groups are large.
    """
    if prepare is None:
        # The hash of whole rows keeps an aggregate below the same here as in the windows, so
        # that Spark shuffles for it once.
        whole = F.max(F.xxhash64(*[F.col(c) for c in df.columns]))
        large = large_groups(df, by, group_limit, whole.alias("_m0")).where(F.col("_m0").isNotNull()).select("_g")
    else:
        large = large_groups(df, by, group_limit)
    v = F.col(value) if value else F.lit(1)
    keyed = df.withColumn("_g", F.struct(by))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # At most rows / group_limit groups are large, so the table is broadcast and their rows
    # never reach the other groups' shuffle. That has a fixed number of partitions: AQE would
    # cut it into as few as there are cores, each a sort that grows with the input.
    made = prepare or (lambda part: part)
    ordinary = made(keyed.join(F.broadcast(large), "_g", "left_anti").repartition(n, "_g"))
    small = _windowed(ordinary, ["_g"], order, v, out).drop("_g")
    ranged = made(keyed.join(F.broadcast(large), "_g", "left_semi"))
    columns = ranged.drop("_g").columns
    ranged = ranged.repartitionByRange(n, F.col("_g"), *order).withColumn("_b", F.spark_partition_id())
    bucket = Window.partitionBy("_g", "_b")
    inside = _windowed(ranged, ["_g", "_b"], order, v, "_in").withColumn("_held", F.count(F.lit(1)).over(bucket))
    earlier = Window.partitionBy("_kg").orderBy("_kb").rowsBetween(Window.unboundedPreceding, -1)
    # The hash of whole rows keeps this side's exchange the same as the other's, so that
    # Spark runs one of them.
    offsets = (ranged.groupBy(F.col("_g").alias("_kg"), F.col("_b").alias("_kb"))
               .agg(F.sum(v).alias("_bt"), F.count(F.lit(1)).alias("_seen"),
                    F.max(F.xxhash64(*[F.col(c) for c in columns])).alias("_hash"))
               .withColumn("_off", F.coalesce(F.sum("_bt").over(earlier), F.lit(0)).cast("long")
                           + F.when(F.col("_hash").isNull(), 1).otherwise(0)))
    joined = inside.join(offsets, (F.col("_g") == F.col("_kg")) & (F.col("_b") == F.col("_kb")), "left")
    total = (F.when(F.col("_seen") == F.col("_held"), F.col("_off") + F.col("_in"))
             .otherwise(F.raise_error(F.lit("the range buckets were cut twice, differently"))))
    return small.unionByName(joined.withColumn(out, total.cast("long")).select(*small.columns))


def _windowed(df: DataFrame, by: list[str], order: Sequence[Column], v: Column, out: str) -> DataFrame:
    before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.coalesce(F.sum(v).over(before), F.lit(0)).cast("long"))


def rank_within_user(lists: DataFrame, ties: Sequence[str], k: int | None = None,
                     rank_col: str = "rn", user: str = USER, playcount: str = PLAYCOUNT,
                     group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Rank (long) of every row within its user, or of the first ``k`` only."""
    if k is not None:
        ranked = lists.withColumn(rank_col, F.row_number().over(user_window(ties, user, playcount)))
        return ranked.where(F.col(rank_col) <= k)
    ranked = running_total(lists, user, order_desc_then(playcount, ties), out="_before",
                           group_limit=group_limit)
    return ranked.withColumn(rank_col, F.col("_before") + 1).drop("_before")

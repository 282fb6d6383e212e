"""Helpers shared by the text operators: words, local bindings, shared tables,
and an equi-join that spreads hot keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_dir

# The ASCII white space of the word rule ``[^\x20\x09-\x0D]+``.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` bound to a lambda variable: computed once per row,
    however often ``body`` (or a lambda inside it) refers to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; NULL and blank texts: none."""
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(inner) > 0, F.split(inner, SPACE_RUN)).otherwise(
        F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as Parquet in the cluster's shared folder and read back.

    The written table cuts the lineage: a lost executor costs only the tasks
    that it was running, and later jobs do not compute ``df`` again.
    """
    path = shared_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Remove a table written by ``stored`` that no later plan reads."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(base: str, *tables: DataFrame) -> str:
    """``base``, with underscores added until no table has a column of that name (names
    are compared as Spark does, without case)."""
    used = {c.lower() for t in tables for c in t.columns}
    while base.lower() in used:
        base += "_"
    return base


def hash_of(df: DataFrame, columns: list[str]) -> Column:
    """One 64-bit hash of the ``columns`` (map columns, which have no hash, are left out)."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return F.xxhash64(F.lit(0), *[F.col(f"`{c}`") for c in columns if "map<" not in kinds[c]])


def ranked(rows: DataFrame, group: Column, order: list[Column], tag: str, value: Column | None = None) -> DataFrame:
    """(row, grp, place, total): each row of ``rows`` as a struct, its ``group`` (an expression
    of no NULLs), its exact place in the order ``order`` inside the group, from 0, and the
    group's rows. With ``value`` (whole numbers) these count values instead of rows.

    No window holds a whole group: the rows are written, cut by range into ordered parts
    and written again, and a row's place is its place inside (part, group) plus the
    group's rows in earlier parts. Rows that are equal in ``order`` follow their place in
    the first written table, so copies are cut apart like any other rows. The window over
    part sizes sees one row per part.
    """
    spark = rows.sparkSession
    held = stored(rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"),
                              group.alias("grp"), (F.lit(1) if value is None else value).cast("long").alias("v"),
                              *[o.alias(f"o{k}") for k, o in enumerate(order)]), f"{tag}-rows")
    keys = [f"o{k}" for k in range(len(order))] + ["file", "line"]
    cut = stored(held.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("line"))
                 .repartitionByRange(shuffle_parts(spark), "grp", *keys)
                 .withColumn("part", F.spark_partition_id()), f"{tag}-parts")
    ahead = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (cut.groupBy("grp", "part").agg(F.sum("v").alias("n"))
              .select("grp", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).cast("long").alias("start"),
                      F.sum("n").over(Window.partitionBy("grp")).alias("total")))
    before = Window.partitionBy("grp", "part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.withColumn("inside", F.coalesce(F.sum("v").over(before), F.lit(0)).cast("long"))
    return placed.join(starts, ["grp", "part"]).select(
        "row", "grp", (F.col("start") + F.col("inside")).alias("place"), "total")


def lookup_join(big: DataFrame, small: DataFrame, keys: list[str], weight: str,
                hot_share: int = 1024, keep_weight: bool = False) -> DataFrame:
    """``big`` left-joined (NULL-safe) with ``small``, which holds each key once.

    ``small[weight]`` says how many rows of ``big`` (or an upper bound in
    proportion) hold the key. Keys with at least 1/``hot_share`` of the summed
    weight are at most ``hot_share`` and are broadcast; rows of ``big`` that
    match one never reach the shuffle, so no shuffle task holds a hot key. All
    other rows take an ordinary shuffled join. ``weight`` is returned only with
    ``keep_weight``.
    """
    values = [c for c in small.columns if c not in keys and (keep_weight or c != weight)]
    total = small.agg(F.sum(weight)).scalar()
    is_hot = F.col(weight) * F.lit(hot_share) >= total
    hot = small.where(is_hot).select(
        *[F.col(k).alias(f"_h_{k}") for k in keys], F.struct(*values).alias("_hv"),
        F.lit(True).alias("_hot"))
    cold = small.where(~is_hot).select(
        *[F.col(k).alias(f"_c_{k}") for k in keys], F.struct(*values).alias("_cv"))
    on_hot = [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys]
    on_cold = [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in keys]
    tagged = big.join(F.broadcast(hot), on_hot, "left")
    fixed = tagged.where(F.col("_hot")).select(*big.columns, F.col("_hv").alias("_v"))
    rest = (tagged.where(F.col("_hot").isNull()).select(*big.columns)
            .join(cold, on_cold, "left").select(*big.columns, F.col("_cv").alias("_v")))
    return fixed.unionByName(rest).select(*big.columns, *[F.col(f"_v.{v}").alias(v) for v in values])

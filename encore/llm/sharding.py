"""Sharding by jump consistent hashing.

A stable 64-bit key (the leading digits of md5 of the id) and the number of shards decide
a row's shard; no ring or table of shards is kept. For the key's pseudo-random sequence
the published loop jumps from shard to shard while the next jump stays below the number
of shards, about ln(shards) steps. Appending a shard therefore moves a row only into the
new shard, one row in shards + 1 on average.

The loop runs over whole Arrow batches of keys in numpy, whose 64-bit products wrap as the
method wants (Spark's own raise an error in ANSI mode). Slots, the places inside a shard,
come from ``common.ranked``: no task holds a shard, however uneven the shards are.

Defined results: a NULL id has the key of the empty text, so NULL ids share a shard; rows
of the same id share a shard, whatever their texts; NULL texts have no bytes (size 1,
CRC 0); repeated rows each get a slot; an empty table gives no rows. Any number of rows
may share an id: that makes a shard large, but no task, except that a task which writes a
shard's file holds ``rows_per_file`` rows. Columns of ``docs`` are kept as they are,
whatever their names; the result column is ``out``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, hash_of, ranked

# Fixed values of the published generator and of its 31-bit draw.
STEP = 2862933555777941757
DRAWS = 1 << 31


def shard_key(doc_id: Column) -> Column:
    """Signed 64-bit key of an id: the first 16 hexadecimal digits of its md5."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 16), 16, -10).cast("long")


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each key (any 64-bit integers) among ``shards``."""
    state = keys.astype(np.int64).view(np.uint64).copy()
    shard = np.zeros(len(state), np.int64)
    active = np.arange(len(state))
    while len(active):
        state[active] = state[active] * np.uint64(STEP) + np.uint64(1)
        draw = (state[active] >> np.uint64(33)).astype(np.float64) + 1.0
        target = ((shard[active] + 1) * (DRAWS / draw)).astype(np.int64)
        stays = target < shards
        active = active[stays]
        shard[active] = target[stays]
    return shard.astype(np.int32)


def jump_column(key: Column, shards: int) -> Column:
    if shards < 1:
        raise ValueError("there must be a shard")

    @F.pandas_udf("int")
    def at(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(), shards))

    return at(key)


def assign(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", out: str = "place") -> DataFrame:
    """``docs`` with ``out``: struct of shard, grown_shard (with one shard more) and slot
    (place inside the shard, gapless from 0, in order of key, then the other columns'
    hash)."""
    key, held = free_name("key", docs), free_name("shard", docs)
    grown = free_name("grown", docs)
    keyed = docs.withColumn(key, shard_key(F.col(f"`{doc_id}`")))
    sharded = keyed.withColumns({held: jump_column(F.col(key), shards), grown: jump_column(F.col(key), shards + 1)})
    order = [F.col(key), F.col(f"`{doc_id}`"), hash_of(docs, docs.columns)]
    placed = ranked(sharded, F.col(held), order, "sharding")
    made = F.struct(F.col(f"row.{held}").alias("shard"), F.col(f"row.{grown}").alias("grown_shard"), F.col("place").alias("slot"))
    return placed.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns], made.alias(out))


def write_shards(placed: DataFrame, path: str, rows_per_file: int = 1_000_000, place: str = "place") -> None:
    """Write assigned rows as Parquet, a folder ``shard=k`` for each shard; its files hold
    consecutive slots, ``rows_per_file`` each, sorted."""
    rest = [F.col(f"`{c}`") for c in placed.columns if c != place]
    shard, chunk = F.col(f"{place}.shard"), F.floor(F.col(f"{place}.slot") / rows_per_file).cast("long")
    (placed.select(F.struct(*rest).alias("row"), F.col(f"{place}.slot").alias("slot"), shard.alias("shard"),
                   chunk.alias("chunk"))
     .repartition("shard", "chunk").sortWithinPartitions("shard", "chunk", "slot")
     .drop("chunk").write.partitionBy("shard").option("maxRecordsPerFile", rows_per_file).parquet(path))


def shard_query(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select("doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
                         F.crc32(text.cast("binary")).alias("text_crc32"))
    return assign(narrow, 8).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "place.shard", "place.slot", "place.grown_shard")


ORACLE_SQL = r"""
WITH RECURSIVE tab AS (
  SELECT list(list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1)), k) ORDER BY k) AS t
  FROM range(256) r(k)),
d AS (
  SELECT doc_id, (octet_length(encode(coalesce(text, ''))) + 1)::BIGINT AS size,
         coalesce(xor(list_reduce(list_transform(regexp_extract_all(hex(encode(text)), '..'),
                         lambda p: ('0x' || p)::BIGINT),
                      lambda c, b: xor(c >> 8, tab.t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT),
                  4294967295::BIGINT), 0)::BIGINT AS text_crc32,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 16))::UBIGINT AS key
  FROM documents, tab),
jumps AS (
  SELECT DISTINCT key, n::BIGINT AS n, key::UHUGEINT AS k, 0::BIGINT AS b FROM d, (VALUES (8), (9)) v(n)
  UNION ALL
  SELECT key, n, k, t FROM (
    SELECT key, n, k, floor((b + 1) * (2147483648::DOUBLE / ((k // 8589934592::UHUGEINT)::DOUBLE + 1)))::BIGINT AS t
    FROM (SELECT key, n, b, (k * 2862933555777941757::UHUGEINT + 1) % 18446744073709551616::UHUGEINT AS k FROM jumps))
  WHERE t < n),
shards AS (
  SELECT key, max(b) FILTER (n = 8)::INT AS shard, max(b) FILTER (n = 9)::INT AS grown_shard FROM jumps GROUP BY key)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY
         CASE WHEN key >= 9223372036854775808 THEN key::HUGEINT - 18446744073709551616 ELSE key::HUGEINT END,
         doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard
FROM d JOIN shards USING (key)
"""

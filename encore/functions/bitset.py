"""Sets of small numbers as arrays of bits, for filters that cost no join.

A set of 2**bits numbers takes 2**(bits - 3) bytes whatever its members (512 KB for 22
bits), so it can go to every task. Hashes of keys reduced to such numbers give a filter
without false negatives: what it lets through is then settled exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def slot_of(bits: int, *columns: Column) -> Column:
    """Number of a key, 0 to 2**bits - 1."""
    return F.xxhash64(*columns).bitwiseAND(F.lit((1 << bits) - 1))


def bit_array(slots: DataFrame, slot: str, bits: int) -> Column:
    """Scalar subquery: the numbers in column ``slot`` as 2**(bits - 6) words of 64 bits."""
    words = (slots.groupBy(F.shiftright(slot, 6).alias("_word"))
             .agg(F.expr(f"bit_or(shiftleft(1L, cast({slot} & 63 as int)))").alias("_bits")))
    every = slots.sparkSession.range(1 << (bits - 6)).join(words, F.col("id") == F.col("_word"), "left")
    held = F.sort_array(F.collect_list(F.struct("id", F.coalesce("_bits", F.lit(0).cast("long")).alias("_bits"))))
    return every.agg(F.transform(held, lambda w: w["_bits"]).alias("_set")).scalar()


def has_bit(found: Column, slot: Column) -> Column:
    word = F.get(found, F.shiftright(slot, 6).cast("int"))
    return F.call_function("getbit", word, slot.bitwiseAND(F.lit(63)).cast("int")) == 1

"""Benchmark decontamination by spaced seeds.

Words are lower-cased runs of letters and digits. A mask fixes some places of a
short window and ignores the others; the hash of the words at the fixed places is
the window's seed, so a window with replaced words at ignored places keeps its
seed. Seeds of all benchmark windows are joined with those of all document windows.
A hit names an item and a diagonal (document place minus item place); around it the
item is laid along the document and their words compared place by place. A document
is contaminated if a stretch of ``window`` places (the whole item if it is shorter)
agrees in at least ``similarity`` of its words: substitutions are tolerated wherever
they fall. The three masks hit every stretch of 10 to 15 places with up to a fifth of
the words replaced, whichever these are (all patterns were enumerated); items of fewer
than ``MASKED`` words are sought by the run of adjacent words that must survive in them
(``SHORT``), which documents are only searched for when such items exist. An item of
fewer than ``min_item`` words is no evidence inside a longer text: it is reported in
n_items and overlap, but contaminates only a document that has no other words.

DataFrame expressions only. The benchmark's seeds are broadcast when there are at
most ``broadcast_rows`` of them, else joined by a shuffle in which seeds that many
document windows hold are spread (``lookup_join`` over each seed's item places).
Hits are made distinct (text, item, diagonal) before they are shuffled; equal texts
are verified once. Only texts with hits are read again for verification.

Defined results: NULL, empty and wordless texts are clean; items without words match
nothing; repeated rows each get a row; an empty benchmark leaves every document
clean; an empty table gives no rows. Other columns pass through unread.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, lookup_join, stored

# Places of a window that a seed fixes, and the fewest words of an item that they suit.
MASKS = ((0, 1, 2, 3, 5), (0, 1, 5, 7, 8), (0, 2, 3, 6, 7))
MASKED = 10
# Fewest and most words of a short item, and the run that a fifth of other words leaves.
SHORT = ((1, 1, (0,)), (2, 5, (0, 1)), (6, 7, (0, 1, 2)), (8, 9, (0, 1, 2, 3)))


def tokens(text: Column) -> Column:
    """Hashes of a text's lower-cased runs of letters and digits, in order."""
    plain = F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<bigint>")).otherwise(
        F.transform(F.split(plain, " "), lambda w: F.xxhash64(w)))


def seeds(w: Column, masks) -> Column:
    """Per mask, the seeds of all its windows over the word hashes ``w``."""
    def of(k: int, mask: tuple[int, ...]) -> Column:
        last = F.size(w) - 1 - max(mask)
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(
            F.lit(k), *[F.get(w, i + j) for j in mask]))).otherwise(F.array().cast("array<bigint>"))

    return F.array(*[of(zlib.crc32(repr(m).encode()), m) for m in masks])


def benchmark_seeds(items: DataFrame, masks=MASKS) -> DataFrame:
    """(seed, item, place, short) of ``items`` (item, w)."""
    def made(rows: DataFrame, of, short: int) -> DataFrame:
        return (rows.select("item", F.explode(seeds(F.col("w"), of)).alias("_s"))
                .select("item", F.posexplode("_s").alias("place", "seed"), F.lit(short).alias("short")))

    out = made(items.where(F.size("w") >= MASKED), masks, -1)
    for k, (low, high, run) in enumerate(SHORT):
        out = out.unionByName(made(items.where(F.size("w").between(low, high)), (run,), k))
    return out


def overlap(doc: Column, item: Column, diagonal: Column, window: int) -> Column:
    """Share of equal words in the best stretch of ``window`` item places (all of a
    shorter item), the item laid along the document at ``diagonal``."""
    n = F.size(item)
    size = F.least(n, F.lit(window))
    equal = F.transform(item, lambda x, k: F.when(F.get(doc, diagonal + k) == x, 1).otherwise(0))

    def best(m: Column) -> Column:
        first = F.aggregate(F.slice(m, F.lit(1), size), F.lit(0), lambda a, x: a + x)
        later = F.when(n > size, F.sequence(size, F.greatest(size, n - 1))).otherwise(
            F.array().cast("array<int>"))
        # Slides the stretch along; the struct holds the present and the best sum.
        return F.aggregate(
            later, F.struct(first.alias("now"), first.alias("top")),
            lambda a, k: let(a["now"] + F.get(m, k) - F.get(m, k - size), lambda now: F.struct(
                now.alias("now"), F.greatest(a["top"], now).alias("top"))),
            lambda a: a["top"] / size)

    return let(equal, best)


def hits(docs: DataFrame, places: DataFrame, masks=MASKS, broadcast_rows: int = 500_000) -> DataFrame:
    """(key, item, diagonal), distinct; ``docs`` as (key, w), ``places`` as ``benchmark_seeds``."""
    used = sorted(r[0] for r in places.select("short").distinct().collect())  # at most five values
    lists = seeds(F.col("w"), [m for k in used for m in (masks if k < 0 else [SHORT[k][2]])] or masks)
    windows = docs.select("key", F.explode(lists).alias("_s")).select(
        "key", F.posexplode("_s").alias("at", "seed"))
    if places.count() <= broadcast_rows:
        met = windows.join(F.broadcast(places.select("seed", "item", "place")), "seed")
    else:
        by_seed = places.groupBy("seed").agg(F.collect_list(F.struct("item", "place")).alias("_p"))
        asked = windows.groupBy("seed").agg(F.count(F.lit(1)).alias("_n"))
        met = (lookup_join(windows, by_seed.join(asked, "seed"), ["seed"], "_n")
               .where(F.col("_p").isNotNull()).select("key", "at", F.inline("_p")))
    return met.select("key", "item", (F.col("at") - F.col("place")).alias("diagonal")).distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 15, similarity: float = 0.8,
                  masks=MASKS, broadcast_rows: int = 500_000, text: str = "text",
                  item_id: str = "item_id", item_text: str = "text",
                  out: str = "decontamination", min_item: int = 5) -> DataFrame:
    """``docs`` with ``out``: struct of contaminated, n_items and overlap (the best
    verified share of equal words, 0 without one) of all items found."""
    items = stored(benchmark.select(F.col(item_id).alias("item"), tokens(F.col(item_text)).alias("w"))
                   .where(F.size("w") > 0), "bench-items")
    places = stored(benchmark_seeds(items, masks), "bench-seeds")
    key = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    found = stored(hits(docs.select(key.alias("key"), tokens(F.col(text)).alias("w")),
                        places, masks, broadcast_rows), "seed-hits")
    texts = stored(found.select("key").distinct(), "hit-texts")
    ours = (docs.select(key.alias("key"), F.col(text).alias("t"))
            .join(F.broadcast(texts) if texts.count() <= broadcast_rows else texts, "key", "left_semi")
            .groupBy("key").agg(F.first("t").alias("t")).select("key", tokens(F.col("t")).alias("w")))
    bench = items.select("item", F.col("w").alias("iw"))
    laid = found.join(ours, "key").join(
        F.broadcast(bench) if places.count() <= broadcast_rows else bench, "item")
    judged = stored(
        laid.select("key", "item", overlap(F.col("w"), F.col("iw"), F.col("diagonal"), window).alias("share"),
                    ((F.size("iw") >= min_item) | (F.size("iw") == F.size("w"))).alias("counts"))
        .where(F.col("share") >= similarity)
        .groupBy("key", "item").agg(F.max("share").alias("share"), F.max("counts").alias("counts"))
        .groupBy("key").agg(F.count(F.lit(1)).alias("n_items"), F.max("share").alias("overlap"),
                            F.max("counts").alias("contaminated")), "contaminated")
    verdict = F.struct("contaminated", "n_items", "overlap")
    clean = F.struct(F.lit(False).alias("contaminated"), F.lit(0).cast("long").alias("n_items"),
                     F.lit(0.0).alias("overlap"))
    # The row in one column, so that no column of it can clash.
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"))
    if judged.count() <= broadcast_rows:
        both = keyed.join(F.broadcast(judged.select("key", verdict.alias("verdict"))), "key", "left")
    else:
        copies = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
        both = lookup_join(keyed, judged.join(copies, "key").select("key", verdict.alias("verdict"), "copies"),
                           ["key"], "copies")
    return both.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns], F.coalesce("verdict", clean).alias(out))


def contamination_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return decontaminate(docs.select("doc_id", "text"), benchmark).select(
        "doc_id", "decontamination.contaminated", "decontamination.n_items", "decontamination.overlap")

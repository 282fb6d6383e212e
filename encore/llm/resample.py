"""Importance resampling towards a target distribution, with bit-sliced weights.

Features are runs of 1 to ``max_words`` words, hashed to ``buckets`` buckets by CRC-32. A
bucket's gain is the scaled log ratio of its smoothed share in the target texts to that in
the documents, floored to an integer. A document's weight is the floored mean of its
features' gains; documents with Gumbel noise added to the weight are drawn from the top,
which samples without replacement in proportion to exp(weight / scale).

Bit-sliced aggregation: a document's bucket counts become bit planes (plane i has a bit for
each bucket whose count has bit i), the gains become planes of their magnitudes, apart for
positive and negative gains. The sum of count times gain is the sum over pairs of planes
of the set bits of their AND, times 2^(i + j): integers only, so it is exact and the same
in any order.

Bucket totals are counted by one scan (a task returns at most ``buckets`` rows, summed by
a shuffle); their gains, ``buckets`` integers whatever the input, go to every task. A
second scan weighs the documents; its narrow rows are ranked by ``common.ranked``, so no
task holds the whole order.

Defined results: NULL and empty texts have no features and weight 0; a NULL id draws the
noise of the empty text; equal rows get different ranks; texts of any length are taken
whole (a text's planes are as many as its largest count has bits); empty documents give
no rows; an empty target gives every bucket t = T = 0. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, ranked

# A-Z become a-z; other ASCII letters and digits stay; all other ASCII is a gap.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def text_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(WORD_BYTES).split(b" ") if text else []


def feature_hashes(text: str | None, max_words: int) -> tuple[np.ndarray, int]:
    """CRC-32 of every feature of a text, and its number of words."""
    words = [w for w in text_words(text) if w]
    runs = list(map(zlib.crc32, words))
    out = list(runs)
    for n in range(1, max_words):
        # A run's CRC goes on from that of the run that is one word shorter.
        runs = list(map(zlib.crc32, words[n:], map(zlib.crc32, repeat(b" "), runs)))
        out += runs
    return np.fromiter(out, np.int64, len(out)), len(words)


def bucket_totals(texts: DataFrame, buckets: int, max_words: int, text: str = "text") -> DataFrame:
    """(bucket, n): features of all texts by bucket."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for part in batches:
            for t in part["text"]:
                total += np.bincount(feature_hashes(t, max_words)[0] % buckets, minlength=buckets)
        found = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": found, "n": total[found]})

    return (texts.select(F.col(f"`{text}`").alias("text")).mapInPandas(count, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = 10_000, max_words: int = 2,
                 scale: int = 1000, text: str = "text", target_text: str = "text") -> np.ndarray:
    """The gain of every bucket: floor(scale * ln((t+1)(S+buckets) / ((s+1)(T+buckets))))."""
    counts = []
    for table, column in ((docs, text), (target, target_text)):
        n = np.zeros(buckets)
        for row in bucket_totals(table, buckets, max_words, column).collect():  # at most ``buckets`` rows
            n[row["bucket"]] = row["n"]
        counts.append(n)
    s, t = counts
    return np.floor(scale * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of non-negative integers: row i holds bit i of all values, packed into
    64-bit words; no rows if all are 0."""
    depth = int(values.max(initial=0)).bit_length()
    bits = (values >> np.arange(depth)[:, None]) & 1
    padded = np.zeros((depth, -(-len(values) // 64) * 64), np.uint8)
    padded[:, :len(values)] = bits
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


def plane_sum(counts: np.ndarray, gains: np.ndarray) -> int:
    """Sum over bit planes of 2^(i+j) times the set bits that plane i of the counts and
    plane j of the gains share."""
    if not len(counts) or not len(gains):
        return 0
    shared = np.bitwise_count(counts[:, None, :] & gains[None, :, :]).sum(axis=2, dtype=np.int64)
    return sum(int(n) << (i + j) for (i, j), n in np.ndenumerate(shared))


def weigh(docs: DataFrame, gains: np.ndarray, max_words: int = 2, text: str = "text", out: str = "weight") -> DataFrame:
    """``docs`` with ``out``: struct of n_words, n_features, weight."""
    up, down = planes(np.maximum(gains, 0)), planes(np.maximum(-gains, 0))
    buckets = len(gains)

    @F.pandas_udf("n_words long, n_features long, weight long")
    def weight(texts: pd.Series) -> pd.DataFrame:
        made = []
        for t in texts:
            hashes, n_words = feature_hashes(t, max_words)
            counts = planes(np.bincount(hashes % buckets, minlength=buckets))
            total = plane_sum(counts, up) - plane_sum(counts, down)
            made.append((n_words, len(hashes), total // len(hashes) if len(hashes) else 0))
        return pd.DataFrame(made, columns=["n_words", "n_features", "weight"])

    return docs.withColumn(out, weight(F.col(f"`{text}`")))


def noise(doc_id: Column, seed: int = 7, scale: int = 1000) -> Column:
    """Floored, scaled Gumbel noise of an id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(float(-scale)) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, buckets: int = 10_000,
             max_words: int = 2, seed: int = 7, doc_id: str = "doc_id", text: str = "text",
             target_text: str = "text", keep: list[str] | None = None, out: str = "draw") -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all; those kept are written twice to the
    shared folder) with ``out``: struct of n_words, n_features, weight, score and rank (from
    1 for the drawn documents, NULL for the others). Of the N documents of at least
    ``min_words`` words floor(percent * N / 100) are drawn by score, ties to smaller ids."""
    keep = docs.columns if keep is None else keep
    gains = bucket_gains(docs, target, buckets, max_words, text=text, target_text=target_text)
    w, r, i = (free_name(c, docs) for c in ("weighed", "score", "id"))
    scored = weigh(docs, gains, max_words, text, w).select(
        *[F.col(f"`{c}`") for c in keep], F.col(w), F.col(f"`{doc_id}`").alias(i),
        (F.col(f"{w}.weight") + noise(F.col(f"`{doc_id}`"), seed)).alias(r))
    # The documents that can be drawn are group 1.
    group = (F.col(f"{w}.n_words") >= min_words).cast("int")
    placed = ranked(scored, group, [-F.col(r), F.col(i).isNull(), F.col(i)], "resample")
    drawn = F.floor(F.col("total") * F.lit(percent) / F.lit(100))
    rank = F.when((F.col(f"row.{w}.n_words") >= min_words) & (F.col("place") < drawn), F.col("place") + 1)
    made = F.struct(*[F.col(f"row.{w}.{c}").alias(c) for c in ("n_words", "n_features", "weight")],
                    F.col(f"row.{r}").alias("score"), rank.alias("rank"))
    return placed.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], made.alias(out))


def resample_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    made = resample(docs, benchmark, keep=["doc_id"])
    return made.select("doc_id", "draw.n_features", "draw.weight", "draw.score", "draw.rank")


ORACLE_SQL = r"""
WITH tab AS (
  SELECT list(list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1)), k) ORDER BY k) AS t
  FROM range(256) r(k)),
texts AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, is_doc, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT doc_id, text, true AS is_doc FROM documents UNION ALL SELECT NULL, text, false FROM benchmark)),
feats AS MATERIALIZED (
  SELECT r, is_doc, f, count(*) AS n FROM (
    SELECT r, is_doc, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f
    FROM texts)
  GROUP BY ALL),
hashed AS MATERIALIZED (
  SELECT f, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(f)), '..'), lambda p: ('0x' || p)::BIGINT),
                  lambda c, b: xor(c >> 8, tab.t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT),
                4294967295::BIGINT) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM feats), tab),
counted AS MATERIALIZED (SELECT r, is_doc, bucket, sum(n) AS n FROM feats JOIN hashed USING (f) GROUP BY ALL),
sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (is_doc), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (NOT is_doc), 0)::DOUBLE AS t
  FROM counted GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM sums) + 10000)
                                 / ((s + 1) * ((SELECT sum(t) FROM sums) + 10000))))::BIGINT AS gain
  FROM sums),
sized AS (
  SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS total
  FROM counted JOIN gains USING (bucket) WHERE is_doc GROUP BY r),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
         coalesce(((total - ((total % n_features + n_features) % n_features)) // n_features), 0)::BIGINT AS weight,
         ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM texts LEFT JOIN sized USING (r) WHERE is_doc),
noisy AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM scored),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
         count(*) OVER (PARTITION BY n_words >= 20) AS n FROM noisy)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * n // 100 THEN place END AS rank
FROM placed
"""

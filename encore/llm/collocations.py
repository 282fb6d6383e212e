"""Phrase collocations per language, mined with Rabin-Karp fingerprints.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and pieces into
words at spaces and tabs. A phrase is a run of words of one piece, its words joined by one
space. All counts are exact and cover every text.

1. Fingerprints, one scan for each length: numpy prefix polynomials over the bytes, one
   modulo a prime and one modulo 2^64, give every n-gram's 62-bit key and a 16-bit
   witness from two prefix values each. A task adds up equal keys in blocks and sends
   them as sorted arrays, dealt by key range; a bucket's arrays are merged by one more
   sort, with an occurrence pointer (40 bits of the text's hash, 24 of the word number).
   Phrases themselves are not shuffled. A phrase is no more frequent than its parts, so
   the scan for n words skips runs whose two parts of n - 1 words miss a bit set of the
   frequent ones. Its size is fixed (2^filter_bits bits, whatever the input), so it goes
   to every task; too full it prunes less, never wrongly.
2. Collisions: keys whose witnesses differ stand for several phrases. Their n-grams are
   counted again from the texts, by the words themselves.
3. Only frequent phrases are materialised: pointers meet the texts they name, and a
   phrase counts as found if its words give the key again.
4. A candidate's score is that of its weakest cut into two phrases, an exact decimal
   quotient. Parts that many candidates share (frequent words) are spread by
   ``lookup_join``. Candidates that a longer one mostly explains are dropped.

Defined results: NULL and empty texts have no words; a NULL language is ``und``; repeated
rows count each time; ties of score go by count, then phrase in byte order; fewer than
``top`` candidates are all returned; an empty table gives no rows. Long texts are worked
on in cuts of about a megabyte at piece ends (a piece is never cut, so one piece is the
unit of memory). Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lookup_join, shuffle_parts, stored

U = np.uint64
WORD, GAP, BREAK = 0, 1, 2
KIND = np.array([BREAK if chr(c) in ".,;:!?\n\x0b\x0c\r" else GAP if chr(c) in " \t" else WORD for c in range(256)],
                np.uint8)
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
SPACED = np.where(KIND == WORD, LOWER, 32).astype(np.uint8).tobytes()
PRIME = (1 << 31) - 1
CUT = 1 << 20
BLOCK = 1 << 20
NUMBER_BITS = 24
PARTS = "bucket long, lang string, keys array<long>, c array<int>, p array<long>, w array<smallint>"
COUNTS = "lang string, key long, c long, p long, one boolean"


def modulo(x: np.ndarray) -> np.ndarray:
    return x - x // U(PRIME) * U(PRIME)


class Prints:
    """Fingerprints of byte ranges from prefix polynomials with fixed random bases, one
    modulo PRIME and one modulo 2^64."""

    def __init__(self, bits: int = 62):
        rng = np.random.default_rng(11)
        self.mask = U((1 << bits) - 1)
        self.small = rng.integers(1, PRIME, 256, dtype=np.uint64)
        self.large = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
        self.base = int(rng.integers(1 << 20, PRIME)), int(rng.integers(1 << 61, 1 << 62)) * 4 + 3
        self.size = 0

    def _powers(self, base: int, m: int, n: int) -> np.ndarray:
        out = np.ones(1, U)
        while len(out) < n:
            more = out * U(pow(base, len(out), m))
            out = np.concatenate([out, modulo(more) if m == PRIME else more])
        return out[:n]

    def load(self, data: np.ndarray) -> None:
        """Prefix polynomials of ``data`` (bytes)."""
        if self.size <= len(data):
            self.size = max(2 * self.size, len(data) + 1)
            self.powers, self.inverses = ([self._powers(pow(b, e, m), m, self.size) for b, m in zip(
                self.base, (PRIME, 1 << 64), strict=True)] for e in (1, -1))
        n, zero = len(data), np.zeros(1, U)
        # Terms below 2^31 add up to less than 2^64 in any text.
        self.first = np.concatenate([zero, np.cumsum(modulo(self.small[data] * self.powers[0][:n]), dtype=U)])
        self.second = np.concatenate([zero, np.cumsum(self.large[data] * self.powers[1][:n], dtype=U)])

    def of(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys, witnesses) of byte ranges."""
        a = modulo(modulo(self.first[end] - self.first[start]) * self.inverses[0][start])
        b = (self.second[end] - self.second[start]) * self.inverses[1][start]
        b = (b ^ (b >> U(32))) * U(0xD6E8FEB86659FD93)
        keys = ((a << U(31) | b >> U(33)) & self.mask).view(np.int64)
        return keys, (b >> U(17)).astype(np.uint16).view(np.int16)


class Words:
    """Words of a buffer of texts that ends with a break: ``data`` holds them joined by
    single spaces, ``start`` and ``end`` their ranges there, ``at`` their starts in the
    buffer, ``piece`` a number that only words of one piece share."""

    def __init__(self, buffer: np.ndarray):
        kind = KIND[buffer]
        edge = np.flatnonzero(np.diff((kind == WORD).astype(np.int8), prepend=0, append=0))
        self.at, stop = edge[::2], edge[1::2]
        self.piece = np.cumsum(kind == BREAK)[self.at]
        keep = kind == WORD
        keep[stop] = True
        self.data = np.where(kind[keep] == WORD, LOWER[buffer[keep]], 32).astype(np.uint8)
        size = stop - self.at
        self.end = np.cumsum(size + 1) - 1
        self.start = self.end - size

    def runs(self, n: int) -> np.ndarray:
        """First words of all runs of ``n`` words inside a piece."""
        return np.flatnonzero(self.piece[n - 1:] == self.piece[:max(0, len(self.piece) - n + 1)])


def cuts(offsets: np.ndarray, data: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray, bool]]:
    """(buffer, first text, starts of its texts, whether it goes on in the same text): texts
    in buffers of about CUT bytes, each text closed by a line end."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offsets, offsets[i] + CUT, "right")) - 1))
        part = data[offsets[i]:offsets[j]]
        if len(part) > CUT:
            ends, at = np.append(np.flatnonzero(KIND[part] == BREAK) + 1, len(part)), 0
            while at < len(part):
                stop = int(ends[min(len(ends) - 1, np.searchsorted(ends, at + CUT))])
                yield np.append(part[at:stop], np.uint8(10)), i, np.zeros(1, np.int64), at > 0
                at = stop
        else:
            ends = offsets[i + 1:j + 1] - offsets[i]
            yield np.insert(part, ends, 10), i, offsets[i:j] - offsets[i] + np.arange(j - i), False
        i = j


def text_words(batch: pa.RecordBatch) -> Iterator[tuple[Words, np.ndarray, np.ndarray]]:
    """(words, text of each word, number of each word in its text) of a batch's ``text``."""
    texts = batch.column("text").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    seen = 0
    for buffer, first, starts, goes_on in cuts(offsets, np.frombuffer(data, np.uint8)):
        words = Words(buffer)
        if len(words.at):
            text = np.searchsorted(starts, words.at, "right") - 1
            number = np.arange(len(words.at)) - np.searchsorted(words.at, starts)[text]
            yield words, text + first, number + (seen if goes_on else 0)
        seen = (seen if goes_on else 0) + len(words.at)


def lang_codes(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(code of each row's language, languages, a hash of each)."""
    coded = batch.column("lang").dictionary_encode()
    hashes = [zlib.crc32(x.encode("utf-8")) << 16 for x in coded.dictionary.to_pylist()]
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, np.array(hashes, np.int64)


def in_set(bits: np.ndarray, keys: np.ndarray, lang_hash: np.ndarray) -> np.ndarray:
    slot = (keys ^ lang_hash) & np.int64(64 * len(bits) - 1)
    return (bits[slot >> 6] >> (slot & 63).astype(U)) & U(1) != 0


def bit_set(keys: DataFrame, bits: int) -> np.ndarray:
    """2**bits bits with those of the (lang, key) rows set. They reach the driver as at most
    2**10 packed rows of 2**(bits - 13) bytes, whatever the number of keys."""
    slot = F.col("key").bitwiseXOR(F.shiftleft(F.crc32(F.col("lang").cast("binary")), 16)).bitwiseAND(
        F.lit((1 << bits) - 1))
    size = max(0, bits - 16)  # words of a row, as a power of two

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        words = np.zeros(1 << size, np.int64)
        words[rows["word"].to_numpy() & ((1 << size) - 1)] = rows["bits"]
        return pd.DataFrame({"place": [rows["place"].iloc[0]], "packed": [words.tobytes()]})

    packed = (keys.select(slot.alias("slot"))
              .groupBy(F.shiftright("slot", 6).alias("word"))
              .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits"))
              .withColumn("place", F.shiftright("word", size))
              .groupBy("place").applyInPandas(pack, "place long, packed binary"))
    out = np.zeros((1 << (bits - 6 - size), 1 << size), np.int64)
    for row in packed.collect():
        out[row["place"]] = np.frombuffer(row["packed"], np.int64)
    return out.ravel().view(U)


def grouped(key: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first rows of its groups) of rows equal in key and witness."""
    order = np.argsort(key)
    k, v = key[order], w[order]
    same = k[1:] == k[:-1]
    if (same & (v[1:] != v[:-1])).any():  # several phrases under one key
        order = np.lexsort((w, key))
        k, v = key[order], w[order]
        same = (k[1:] == k[:-1]) & (v[1:] == v[:-1])
    return order, np.flatnonzero(np.append(True, ~same))


class Block:
    """Occurrences of one task, added up by key when there are BLOCK of them."""

    def __init__(self, bits: int, bucket_bits: int):
        self.shift, self.held, self.size, self.totals = max(0, bits - bucket_bits), {}, 0, {}

    def add(self, lang: str, key: np.ndarray, w: np.ndarray, p: np.ndarray) -> None:
        if len(key):
            self.held.setdefault(lang, []).append((key, w, p))
            self.size += len(key)

    def flush(self) -> Iterator[pa.RecordBatch]:
        for lang, parts in self.held.items():
            key, w, p = (np.concatenate(x) for x in zip(*parts, strict=True))
            order, first = grouped(key, w)
            key, w = key[order][first], w[order][first]
            c = np.diff(np.append(first, len(order))).astype(np.int32)
            yield self._rows(lang, key >> self.shift, key, c, np.minimum.reduceat(p[order], first), w)
        for lang, n in self.totals.items():
            one = np.full(1, -1, np.int64)
            yield self._rows(lang, one, one, np.full(1, n, np.int32), one, np.zeros(1, np.int16))
        self.held, self.size, self.totals = {}, 0, {}

    @staticmethod
    def _rows(lang: str, bucket: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        ends = pa.array(np.append(first, len(bucket)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in columns]
        return pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.array([lang] * len(first)), *lists],
                                          ["bucket", "lang", "keys", "c", "p", "w"])


def merge(least: int):
    """Sums a bucket's arrays; returns the keys found at least ``least`` times."""
    def settle(part: pd.DataFrame) -> pd.DataFrame:
        made = []
        for lang, rows in part.groupby("lang", sort=False):
            key, c, p, w = (np.concatenate(rows[x].to_list()) for x in ("keys", "c", "p", "w"))
            order = np.argsort(key)
            key, w = key[order], w[order]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            c = np.add.reduceat(c[order].astype(np.int64), first)
            some = (c >= least) | (key[first] < 0)
            one = np.minimum.reduceat(w, first) == np.maximum.reduceat(w, first)
            made.append(pd.DataFrame({"lang": lang, "key": key[first][some], "c": c[some],
                                      "p": np.minimum.reduceat(p[order], first)[some], "one": one[some]}))
        return pd.concat(made)

    return settle


def count_keys(texts: DataFrame, n: int, parts: np.ndarray | None, least: int, bits: int, bucket_bits: int) -> DataFrame:
    """COUNTS of the runs of ``n`` words whose parts are in ``parts`` (None: all), those found
    at least ``least`` times. With ``n`` = 1 rows of key -1 have the words of each language."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints, block = Prints(bits), Block(bits, bucket_bits)
        for batch in batches:
            code, names, hashes = lang_codes(batch)
            names = names.to_pylist()
            h = batch.column("h").to_numpy() >> NUMBER_BITS << NUMBER_BITS
            for words, text, number in text_words(batch):
                lang, at = code[text], words.runs(n)
                prints.load(words.data)
                if parts is not None:
                    short = words.runs(n - 1)
                    hit = np.zeros(len(text), bool)
                    hit[short] = in_set(parts, prints.of(words.start[short], words.end[short + n - 2])[0],
                                        hashes[lang[short]])
                    at = at[hit[at] & hit[at + 1]]
                key, w = prints.of(words.start[at], words.end[at + n - 1])
                p = h[text[at]] | (number[at] & ((1 << NUMBER_BITS) - 1))
                found = lang[at]
                for k in np.unique(lang):
                    mine = found == k
                    block.add(names[k], key[mine], w[mine], p[mine])
                    if n == 1:
                        block.totals[names[k]] = block.totals.get(names[k], 0) + int(mine.sum())
                if block.size >= BLOCK:
                    yield from block.flush()
        yield from block.flush()

    found = texts.mapInArrow(scan, PARTS)
    # The rows of totals, a few for each block, are dealt by language and place.
    deal = F.when(F.col("bucket") < 0, -1 - F.pmod(F.monotonically_increasing_id(), F.lit(64))).otherwise(F.col("bucket"))
    return found.withColumn("bucket", deal).groupBy("bucket").applyInPandas(merge(least), COUNTS)


def recount(texts: DataFrame, collided: DataFrame, n: int, filter_bits: int, bits: int) -> DataFrame:
    """(lang, phrase, f) of all runs of ``n`` words that hold a key of ``collided``."""
    wanted = bit_set(collided, filter_bits)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Prints(bits)
        for batch in batches:
            code, names, hashes = lang_codes(batch)
            for words, text, _ in text_words(batch):
                lang, at = code[text], words.runs(n)
                prints.load(words.data)
                key = prints.of(words.start[at], words.end[at + n - 1])[0]
                some = in_set(wanted, key, hashes[lang[at]])
                at, data = at[some], words.data.tobytes()
                phrase = [data[a:b].decode("utf-8") for a, b in zip(words.start[at], words.end[at + n - 1], strict=True)]
                yield pa.RecordBatch.from_arrays([names.take(pa.array(lang[at])), pa.array(key[some]),
                                                  pa.array(phrase, pa.string())], ["lang", "key", "phrase"])

    return (texts.mapInArrow(scan, "lang string, key long, phrase string")
            .groupBy("lang", "key", "phrase").agg(F.count(F.lit(1)).alias("f"))
            .join(collided.select("lang", "key"), ["lang", "key"], "left_semi")
            .select("lang", "phrase", "f"))


def materialise(texts: DataFrame, found: DataFrame, bits: int, broadcast_rows: int) -> DataFrame:
    """(lang, words, phrase, f) of the rows (lang, key, words, c, p) of ``found``."""
    asked = stored(found.groupBy(F.shiftright("p", NUMBER_BITS).alias("h"))
                   .agg(F.collect_list(F.struct("lang", "key", "words", "p", "c")).alias("asked")), "phrases-asked")
    ids = asked.select("h")
    ids = F.broadcast(ids) if asked.count() <= broadcast_rows else ids
    named = texts.select(F.shiftright("h", NUMBER_BITS).alias("h"), "text").join(ids, "h", "left_semi").distinct()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        prints = Prints(bits)
        for part in batches:
            for text, asks in zip(part["text"], part["asked"], strict=True):
                words = [w for w in text.encode("utf-8").translate(SPACED).split(b" ") if w]
                turn = 0
                while asks is not None and len(asks) and turn < len(words):
                    # Word numbers are known up to a multiple of 2^NUMBER_BITS.
                    at = [turn + (r["p"] & ((1 << NUMBER_BITS) - 1)) for r in asks]
                    runs = [b" ".join(words[i:i + r["words"]]) for i, r in zip(at, asks, strict=True)]
                    end = np.cumsum([len(r) + 1 for r in runs]) - 1
                    prints.load(np.frombuffer(b" ".join(runs), np.uint8))
                    same = prints.of(np.append(0, end[:-1] + 1), end)[0] == np.array([r["key"] for r in asks], np.int64)
                    yield pd.DataFrame([(r["lang"], r["words"], run.decode("utf-8"), r["c"])
                                        for r, run, ok in zip(asks, runs, same, strict=True) if ok],
                                       columns=["lang", "words", "phrase", "f"])
                    # A text of the same hash that lacks the phrase is not the one meant.
                    asks = [r for r, ok in zip(asks, same, strict=True) if not ok]
                    turn += 1 << NUMBER_BITS

    return (named.join(asked, "h").mapInPandas(read, "lang string, words int, phrase string, f long")
            .dropDuplicates(["lang", "phrase"]))


def frequent_phrases(docs: DataFrame, max_words: int = 3, least: int = 10, text: str = "text", lang: str = "lang",
                     filter_bits: int = 26, bits: int = 62, broadcast_rows: int = 500_000) -> tuple[DataFrame, DataFrame]:
    """((lang, words, phrase, f) of all phrases of up to ``max_words`` words found at least
    ``least`` times, (lang, n) words of each language)."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    texts = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), body.alias("text"),
                        F.xxhash64(body).alias("h"))
    # About six bytes a word: buckets of some BLOCK occurrences, and one for each task.
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bucket_bits = max(size // (6 * BLOCK), shuffle_parts(docs.sparkSession)).bit_length()
    levels, again, parts, totals = [], [], None, None
    for n in range(1, max_words + 1):
        level = stored(count_keys(texts, n, parts, least, bits, min(bits, bucket_bits)), f"phrases-{n}")
        if n == 1:
            totals = level.where("key < 0").groupBy("lang").agg(F.sum("c").alias("n"))
            level = level.where("key >= 0")
        collided = level.where("not one")
        if collided.head(1):
            recounted = recount(texts, collided, n, filter_bits, bits).where(F.col("f") >= least)
            again.append(recounted.select("lang", F.lit(n).alias("words"), "phrase", "f"))
        levels.append(level.where("one").select("lang", "key", F.lit(n).alias("words"), "c", "p"))
        if n < max_words:
            parts = bit_set(level, filter_bits)
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    phrases = materialise(texts, found, bits, broadcast_rows)
    for recounted in again:
        phrases = phrases.unionByName(recounted)
    return stored(phrases, "phrases"), totals


def scored_cuts(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, score): each candidate with its weakest cut."""
    word = F.split("phrase", " ")
    cut = (phrases.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), word.alias("w"),
                                             F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
           .withColumns({"left": F.array_join(F.slice("w", F.lit(1), F.col("k")), " "),
                         "right": F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ")})
           .drop("w"))
    for part, name in (("left", "l"), ("right", "r")):
        used = stored(cut.groupBy("lang", F.col(part).alias("phrase")).agg(F.count(F.lit(1)).alias("uses"))
                      .join(phrases.select("lang", "phrase", F.col("f").alias(name)), ["lang", "phrase"])
                      .withColumnRenamed("phrase", part), f"phrases-{part}")
        cut = lookup_join(cut, used, ["lang", part], "uses")
    # Up to 10^14 occurrences fit: a * a * 10^6 has at most 37 digits.
    a, l, r = (F.col(c).cast("decimal(14,0)") for c in "alr")
    score = F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (a * a), l * r).cast("long")
    best = cut.groupBy("lang", "phrase").agg(
        F.first("words").alias("words"), F.first("a").alias("a"),
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "words", "a", "best.l", "best.r", "best.score")


def explained(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, most): the largest count of a longer candidate around a candidate."""
    word = F.split("phrase", " ")
    inner = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("words") - 1),
        lambda size: F.transform(F.sequence(F.lit(1), F.col("words") - size + 1),
                                 lambda first: F.array_join(F.slice(word, first, size), " "))))
    return (phrases.where("words > 2").select("lang", F.explode(inner).alias("phrase"), "f")
            .groupBy("lang", "phrase").agg(F.max("f").alias("most")))


def collocations(docs: DataFrame, max_words: int = 3, least: int = 10, top: int = 2000, contained: int = 50,
                 **options) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` candidates of each language.

    A candidate that lies inside a longer one with at least ``contained`` percent of its
    count is dropped.
    """
    phrases, totals = frequent_phrases(docs, max_words, least, **options)
    whole = (scored_cuts(phrases).join(explained(phrases), ["lang", "phrase"], "left")
             .where(F.col("most").isNull() | (F.lit(100) * F.col("most") < F.lit(contained) * F.col("a"))))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # The first of each of 64 salts, then the first of those: however many tasks hold a
    # language, the last window gets at most 64 * top rows of it.
    for by in (["lang", "salt"], ["lang"]):
        whole = (whole.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
                 .withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
                 .where(F.col("rank") <= top))
    first = whole
    return first.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
runs AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM runs GROUP BY lang),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM runs, (VALUES (1), (2), (3)) v(k)),
f AS MATERIALIZED (
  SELECT lang, k AS words, phrase, count(*)::BIGINT AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 10),
split AS (SELECT lang, phrase, words, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1),
cut AS (
  SELECT lang, phrase, a, k, array_to_string(w[:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest
  FROM split, (VALUES (1), (2)) v(k) WHERE k < words),
rated AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
         ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.rest),
weakest AS (SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, phrase, max(f) AS most FROM (
    SELECT lang, f, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '),
                            array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase
    FROM f WHERE words = 3) GROUP BY ALL),
ordered AS (
  SELECT w.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM weakest w LEFT JOIN inside i USING (lang, phrase) WHERE i.most IS NULL OR 100 * i.most < 50 * w.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ordered JOIN totals USING (lang) WHERE rank <= 2000
"""

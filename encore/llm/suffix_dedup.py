"""Removal of repeated byte strings: every byte covered by a string of ``length``
bytes that also starts anywhere else, in the same document or another.

The suffixes are sampled, the samples are named by hashes of fixed-length tuples and
grouped by them, a run's name is extended once to all bytes of its strings, and what
is left is compared or regrouped by hashes of whole strings. Nothing is sorted, names
do not recurse, and no remaining suffixes are merged or compared with adjacent ones,
as the difference-cover algorithm does: hash grouping replaces these. The sample is chosen by content instead of by a periodic
difference cover: of each window of ``length - tuple + 1`` tuples the one of smallest
hash is sampled, so equal strings hold their sample at the same offset (what the
cover guarantees for one of its residues) with far fewer samples; see the README for
the figures that decided this.

1. Each start of a ``length``-byte string has one sample. Starts with the same sample
   are a run; the run's name is the hash of the sampled tuple, its long name also that
   of all bytes its strings cover. Tuples seen once settle their runs: not repeated.
2. Long names seen twice or more settle theirs: every start of the run is repeated.
3. What is left are runs that share a tuple but not all of their bytes (the edges of
   repeats). One run of each long name of such a tuple is laid beside the others and
   compared string by string at equal offsets from the sample.

Counts are aggregated before the shuffle; the runs of frequent names are spread by
``lookup_join``; a tuple with more than ``group_limit`` different runs is compared
through a grouping of its strings' hashes, spread over all tasks, instead of in one.
Equality is decided by two independent 64-bit hashes (tuple and whole string).

Defined results: NULL texts are empty; texts shorter than ``length`` lose nothing;
copies of a text of at least ``length`` bytes lose everything; repeated rows are
copies; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup_join, shuffle_parts, stored

U = np.uint64
RUNS = "h long, n int, first int, last int, at int, key long, ext long"


class Hasher:
    """Polynomial hashes of byte strings over random byte values, modulo 2**64."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
        self.base = int(rng.integers(1 << 61, 1 << 62)) * 4 + 3
        self.powers = np.ones(1, U)
        self.inverses = np.ones(1, U)

    def prefix(self, data: bytes) -> np.ndarray:
        if len(self.powers) <= len(data):
            size = max(2 * len(self.powers), len(data) + 1)
            step = np.full(size, self.base, U)
            back = np.full(size, pow(self.base, -1, 1 << 64), U)
            step[0] = back[0] = 1
            self.powers, self.inverses = np.cumprod(step, dtype=U), np.cumprod(back, dtype=U)
        terms = self.values[np.frombuffer(data, np.uint8)] * self.powers[:len(data)]
        return np.concatenate([np.zeros(1, U), np.cumsum(terms, dtype=U)])

    def of(self, prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((prefix[stop] - prefix[start]) * self.inverses[start])


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U(29))) * U(0xA0761D6478BD642F)
    return h ^ (h >> U(32))


def smallest(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the first smallest value in every window of ``width`` values."""
    place, size = np.arange(len(h)), 1
    while 2 * size <= width:
        a, b = place[:len(place) - size], place[size:]
        place = np.where(h[b] < h[a], b, a)
        size *= 2
    n = len(h) - width + 1
    a, b = place[:n], place[width - size:width - size + n]
    return np.where(h[b] < h[a], b, a)


def runs_of(data: bytes, tuples: Hasher, strings: Hasher, length: int, width: int):
    """(first, last, at, key, ext): the runs of starts that share a sample at ``at``."""
    grams = np.arange(len(data) - width + 1)
    h = tuples.of(tuples.prefix(data), grams, grams + width)
    sample = smallest(h, length - width + 1)
    first = np.concatenate([[0], np.flatnonzero(sample[1:] != sample[:-1]) + 1])
    last = np.concatenate([first[1:] - 1, [len(sample) - 1]])
    at = sample[first]
    whole = strings.of(strings.prefix(data), first, last + length)
    ext = mix(whole + (at - first).astype(U) * U(0x9E3779B97F4A7C15))
    return first, last, at, h[at].view(np.int64), ext.view(np.int64)


def all_runs(texts: DataFrame, length: int, width: int) -> DataFrame:
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tuples, strings = Hasher(1), Hasher(2)
        for part in batches:
            for at in range(0, len(part), 500):
                piece = part.iloc[at:at + 500]
                made = [runs_of(t.encode("utf-8"), tuples, strings, length, width) for t in piece["text"]]
                sizes = [len(m[0]) for m in made]
                out = {"h": np.repeat(piece["h"].to_numpy(), sizes), "n": np.repeat(piece["n"].to_numpy(), sizes)}
                for k, name in enumerate(("first", "last", "at", "key", "ext")):
                    out[name] = np.concatenate([m[k] for m in made]) if made else []
                yield pd.DataFrame(out)

    return texts.mapInPandas(cut, RUNS)


def _string_hashes(context: bytes, first: int, at: int, strings: Hasher, length: int):
    """(offset of the sample, hash) of every string in a run's bytes."""
    start = np.arange(len(context) - length + 1)
    return at - first - start, strings.of(strings.prefix(context), start, start + length)


def _flag_runs(first: int, flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(first + int(a), first + int(b) - 1) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _compare(length: int):
    """Compares the runs of whole tuple groups, partition by partition (sorted by key)."""
    def settle(part: pd.DataFrame, strings: Hasher) -> pd.DataFrame:
        made = [_string_hashes(c, f, a, strings, length)
                for c, f, a in zip(part["context"], part["first"], part["at"], strict=True)]
        sizes = np.array([len(m[0]) for m in made])
        key = np.repeat(part["key"].to_numpy().view(U), sizes)
        names = mix(mix(key + np.concatenate([m[0] for m in made]).astype(U) * U(0x9E3779B97F4A7C15))
                    ^ np.concatenate([m[1] for m in made]))
        _, where, count = np.unique(names, return_inverse=True, return_counts=True)
        again, ends = count[where] > 1, np.cumsum(sizes)
        out = []
        for h, n, f, single, stop, size in zip(part["h"], part["n"], part["first"], part["single"],
                                               ends, sizes, strict=True):
            if single:
                out += [(h, n, a, b) for a, b in _flag_runs(f, again[stop - size:stop])]
        return pd.DataFrame(out, columns=["h", "n", "first", "last"])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        strings, held = Hasher(2), None
        for part in batches:
            if not len(part):
                continue
            part = part if held is None else pd.concat([held, part])
            keys = part["key"].to_numpy()
            done = int(np.searchsorted(keys, keys[-1]))  # the last group may go on
            if done:
                yield settle(part.iloc[:done], strings)
            held = part.iloc[done:]
        if held is not None and len(held):
            yield settle(held, strings)

    return compare


def _with_texts(runs: DataFrame, texts: DataFrame, length: int, broadcast_rows: int) -> DataFrame:
    """``runs`` with ``context``, the bytes that their strings cover."""
    per_text = stored(runs.groupBy("h", "n").agg(F.collect_list(F.struct(
        "first", "last", "at", "key", "single", "hot")).alias("runs")), "suffix-asked")
    ids = per_text.select("h", "n")
    asked = F.broadcast(ids) if per_text.count() <= broadcast_rows else ids
    found = texts.join(asked, ["h", "n"], "left_semi").groupBy("h", "n").agg(F.first("text").alias("text"))
    kind = "h long, n int, first int, last int, at int, key long, single boolean, hot boolean, context binary"

    def slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            out = []
            for h, n, text, rs in zip(part["h"], part["n"], part["text"], part["runs"], strict=True):
                data = text.encode("utf-8")
                out += [(h, n, r["first"], r["last"], r["at"], r["key"], r["single"], r["hot"],
                         data[r["first"]:r["last"] + length]) for r in rs]
            yield pd.DataFrame(out, columns=["h", "n", "first", "last", "at", "key", "single", "hot", "context"])

    return stored(found.join(per_text, ["h", "n"]).mapInPandas(slices, kind), "suffix-contexts")


def repeated_starts(docs: DataFrame, length: int = 400, width: int = 128, group_limit: int = 4_096,
                    broadcast_rows: int = 500_000, text: str = "text") -> DataFrame:
    """(h, n, first, last): per text (its hash and bytes) ranges of repeated starts."""
    t = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.xxhash64(t).alias("h"), F.octet_length(t).cast("int").alias("n"),
                        t.alias("text")).where(F.col("n") >= length)
    runs = all_runs(texts, length, width)
    keys = stored(runs.groupBy("key").agg(F.count(F.lit(1)).alias("seen"), (F.min("ext") != F.max("ext"))
                                          .alias("edge")).where("seen > 1"), "suffix-keys")
    shared = stored(lookup_join(runs, keys, ["key"], "seen").where(F.col("edge").isNotNull()), "suffix-runs")
    edges = shared.where("edge")
    names = stored(edges.groupBy("key", "ext").agg(
        F.count(F.lit(1)).alias("c"), F.min(F.struct("h", "n", "first", "last", "at")).alias("run")), "suffix-names")
    sure = shared.where("not edge").select("h", "n", "first", "last").unionByName(
        lookup_join(edges, names.where("c > 1").select("key", "ext", "c", F.lit(True).alias("again")),
                    ["key", "ext"], "c").where("again").select("h", "n", "first", "last"))
    # A tuple whose runs are all settled needs no comparison.
    open_ = names.groupBy("key").agg(F.count(F.lit(1)).alias("variants"), F.min("c").alias("least")).where("least = 1")
    asked = (lookup_join(names, open_, ["key"], "variants", keep_weight=True).where("least = 1").select(
        "run.*", "key", (F.col("c") == 1).alias("single"), (F.col("variants") > group_limit).alias("hot")))
    beside = _with_texts(asked, texts, length, broadcast_rows)
    n = shuffle_parts(docs.sparkSession)
    cold = (beside.where("not hot").select("key", "h", "n", "first", "at", "single", "context")
            .repartition(n, "key").sortWithinPartitions("key")
            .mapInPandas(_compare(length), "h long, n int, first int, last int"))

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        strings = Hasher(2)
        for part in batches:
            for r in part.itertuples(index=False):
                offset, h = _string_hashes(r.context, r.first, r.at, strings, length)
                yield pd.DataFrame({"key": r.key, "offset": offset, "s": h.view(np.int64), "h": r.h, "n": r.n,
                                    "start": r.first + np.arange(len(h)), "single": r.single})

    hot = beside.where("hot")
    if hot.head(1):
        strings = stored(hot.select("key", "h", "n", "first", "at", "single", "context").mapInPandas(
            explode, "key long, offset int, s long, h long, n int, start int, single boolean"), "suffix-strings")
        again = strings.groupBy("key", "offset", "s").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        again = stored(again.withColumn("again", F.lit(True)), "suffix-again")
        found = (lookup_join(strings.where("single"), again, ["key", "offset", "s"], "c").where("again")
                 .select("h", "n", F.col("start").alias("first"), F.col("start").alias("last")))
        cold = cold.unionByName(found)
    return sure.unionByName(cold).distinct()


def _merged(ranges, length: int) -> list[tuple[int, int]]:
    """Maximal byte spans (start, end) covered by strings that start in ``ranges``."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b + length)
        else:
            out.append([a, b + length])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, length: int = 400, text: str = "text", out: str = "repeats",
                   broadcast_rows: int = 500_000, **options) -> DataFrame:
    """``docs`` with ``out``: struct of n_bytes, spans (removed byte ranges) and kept
    (the remaining bytes)."""
    starts = repeated_starts(docs, length, text=text, broadcast_rows=broadcast_rows, **options)
    kind = "array<struct<start:long,end:long>>"

    @F.pandas_udf(kind)
    def merged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in batches:
            yield pd.Series([[{"start": a, "end": b} for a, b in _merged([(r["first"], r["last"]) for r in rs], length)]
                             for rs in part], dtype=object)

    # A text's many ranges become a few spans before they meet the texts.
    spans = stored(starts.groupBy("h", "n").agg(F.collect_list(F.struct("first", "last")).alias("r"))
                   .select("h", "n", merged("r").alias("spans")), "suffix-spans")
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # The row in one column, so that no column of it can clash.
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.xxhash64(t).alias("h"), F.octet_length(t).cast("int").alias("n"))
    size = spans.agg(F.count(F.lit(1)), F.sum(F.size("spans"))).first()
    if size[0] <= broadcast_rows and (size[1] or 0) <= 4 * broadcast_rows:
        joined = keyed.join(F.broadcast(spans), ["h", "n"], "left")
    else:
        copies = keyed.groupBy("h", "n").agg(F.count(F.lit(1)).alias("copies"))
        joined = lookup_join(keyed, spans.join(copies, ["h", "n"]), ["h", "n"], "copies")

    @F.pandas_udf("binary")
    def kept(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for part, found in batches:
            out = []
            for t, gone in zip(part, found, strict=True):
                data, at, pieces = t.encode("utf-8") if t else b"", 0, []
                for r in [] if gone is None else gone:
                    pieces.append(data[at:r["start"]])
                    at = r["end"]
                out.append(b"".join([*pieces, data[at:]]))
            yield pd.Series(out, dtype=object)

    made = F.struct(F.col("n").cast("long").alias("n_bytes"),
                    F.coalesce("spans", F.array().cast(kind)).alias("spans"),
                    kept(F.col(f"row.`{text}`"), F.col("spans")).alias("kept"))
    return joined.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns], made.alias(out))


def suffix_query(docs: DataFrame) -> DataFrame:
    made = remove_repeats(docs.select("doc_id", "text"))
    removed = F.aggregate("repeats.spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return made.select(
        "doc_id", F.col("repeats.n_bytes").alias("n_bytes"), removed.alias("n_removed"),
        F.size("repeats.spans").cast("long").alias("n_spans"),
        F.sha2("repeats.kept", 256).alias("kept_sha256"))

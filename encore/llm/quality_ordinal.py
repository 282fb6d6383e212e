"""Quality by ordinal cumulative-link regression on graded ratings.

A text is a sparse vector: its lower-cased words and binned layout measures
(capitals, symbols, repeated words and lines, lengths) hashed into ``2**bits``
places. One weight vector w, shared by all grades, gives s = w·x; ordered
thresholds θ₁ < θ₂ < … give the tails P(grade ≥ k) = σ(s - θₖ). Their sum is the
expected grade, and a document is selected when the tail at ``min_grade`` is at
least ``min_tail``.

The model is fitted by mini-batch gradient steps on a bounded sample of the
labelled rows (``max_rows``, the smallest hashes of doc_id first); executors build
the vectors and only those of the sample come to the driver. The model (weights
and thresholds, of fixed size) goes to the tasks, which score whole texts in Arrow
batches.

Defined results: NULL and empty texts have no words and are scored by their layout
alone; NULL grades and ids are not used for fitting, repeated labels count with
their lowest grade; with labels of fewer than two grades every document is
selected with expected grade and tails NULL; of the texts of a repeated labelled id one
is fitted; texts of any length are scored whole; repeated rows each get a row; an
empty table gives no rows. Other columns pass through unread.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shuffle_parts

RATING = "struct<expected_grade:double,tails:array<double>>"
SYMBOLS = frozenset("#*$%&|<>!")
BINS = 12


def layout(text: str, found: list[bytes]) -> list[float]:
    """Layout measures in 0..1."""
    n, size = max(len(found), 1), max(len(text), 1)
    capitals = sum(map(bytes.isupper, text.encode("utf-8", "replace").split()))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip()]
    pairs = list(zip(found, found[1:], strict=False))
    return [
        min(1.0, np.log1p(len(found)) / 12),
        capitals / n,
        min(1.0, 4 * symbols / size),
        len(set(found)) / n,
        len(set(pairs)) / max(len(pairs), 1),
        sum(a == b for a, b in pairs) / n,
        len(set(lines)) / max(len(lines), 1),
        min(1.0, sum(map(len, found)) / n / 24),
        min(1.0, 4 * (text.count(".") + text.count(",")) / n),
    ]


def features(text: str | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, values): hashed words with square-root shares, and layout bins."""
    text = text or ""
    found = text.lower().encode("utf-8", "replace").split()
    mask = (1 << bits) - 1
    bins = [zlib.crc32(b"layout %d %d" % (k, int(v * BINS))) & mask for k, v in enumerate(layout(text, found))]
    if not found:
        return np.array(bins, np.int32), np.full(len(bins), 0.5)
    places, counts = np.unique(np.fromiter(map(zlib.crc32, found), np.uint32, len(found)) & np.uint32(mask),
                               return_counts=True)
    return (np.concatenate([places.astype(np.int32), np.array(bins, np.int32)]),
            np.concatenate([np.sqrt(counts / len(found)), np.full(len(bins), 0.5)]))


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class OrdinalModel:
    weights: np.ndarray | None
    thresholds: np.ndarray
    bits: int

    def tails(self, text: str | None) -> list[float] | None:
        if self.weights is None:
            return None
        places, values = features(text, self.bits)
        return _sigmoid(float(self.weights[places] @ values) - self.thresholds).tolist()


def fit_vectors(rows: list[tuple[int, np.ndarray, np.ndarray]], bits: int, epochs: int = 25,
                batch: int = 64, rate: float = 0.3, decay: float = 1e-4) -> OrdinalModel:
    """Cumulative-link model by AdaGrad over (grade, places, values) rows."""
    grades = np.array([r[0] for r in rows], np.int64)
    top = int(grades.max()) if len(grades) else 0
    if len(set(grades.tolist())) < 2:
        return OrdinalModel(None, np.zeros(top), bits)
    weights, seen = np.zeros(1 << bits), np.full(1 << bits, 1e-6)
    # Thresholds start at the logits of the grades' shares; gaps stay positive as exponentials.
    share = np.clip([(grades >= k).mean() for k in range(1, top + 1)], 1e-3, 1 - 1e-3)
    cuts = np.maximum.accumulate(np.log((1 - share) / share) + np.arange(top) * 1e-3)
    raw = np.concatenate([cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3))])
    raw_seen, rng = np.full(top, 1e-6), np.random.default_rng(7)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            sizes = [len(rows[i][1]) for i in pick]
            places = np.concatenate([rows[i][1] for i in pick])
            values = np.concatenate([rows[i][2] for i in pick])
            owner = np.repeat(np.arange(len(pick)), sizes)
            s = np.bincount(owner, weights[places] * values, len(pick))
            cuts = np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))
            edges = np.concatenate([[-np.inf], cuts, [np.inf]])
            y = grades[pick]
            above, beyond = _sigmoid(s - edges[y]), _sigmoid(s - edges[y + 1])
            by_s = 1.0 - above - beyond
            p = np.maximum(above - beyond, 1e-9)
            by_cut = (np.bincount(y + 1, beyond * (1 - beyond) / p, top + 2)
                      - np.bincount(y, above * (1 - above) / p, top + 2))[1:top + 1] / len(pick)
            used, where = np.unique(places, return_inverse=True)
            g = np.bincount(where, by_s[owner] * values, len(used)) / len(pick) - decay * weights[used]
            seen[used] += g * g
            weights[used] += rate * g / np.sqrt(seen[used])
            tail = np.cumsum(by_cut[::-1])[::-1]
            g = np.concatenate([tail[:1], tail[1:] * np.exp(raw[1:])])
            raw_seen += g * g
            raw += 0.05 * g / np.sqrt(raw_seen)
    return OrdinalModel(weights, np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])])), bits)


def grade(quality: Column, toxic: Column) -> Column:
    """Graded rating from two labels: 0 poor, 1 well written but toxic, 2 good."""
    return (quality * (F.lit(2) - F.coalesce(toxic, F.lit(0)))).cast("int")


def sample_vectors(docs: DataFrame, grades: DataFrame, bits: int = 18, max_rows: int = 8_000,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, grade, places, vals) of at most ``max_rows`` rows of ``grades``. The vectors are
    bytes (int32 and float32): as arrays the driver would hold an object per number."""
    ids = (grades.where(F.col("grade").isNotNull() & F.col("doc_id").isNotNull())
           .groupBy(F.col("doc_id").alias("_id")).agg(F.min("grade").cast("int").alias("grade"))
           .orderBy(F.xxhash64("_id"), "_id").limit(max_rows))

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            made = [features(t, bits) for t in part["text"]]
            yield pd.DataFrame({"id": part["id"], "grade": part["grade"],
                                "places": [m[0].astype(np.int32).tobytes() for m in made],
                                "vals": [m[1].astype(np.float32).tobytes() for m in made]})

    # One row per id, that of the smallest text hash: an id may stand in any number of rows.
    return (docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).join(F.broadcast(ids), "_id")
            .groupBy("_id", "grade").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
            .repartition(shuffle_parts(docs.sparkSession))
            .select(F.col("_id").cast("string").alias("id"), "text", "grade")
            .mapInPandas(vectors, "id string, grade int, places binary, vals binary"))


def fit(docs: DataFrame, grades: DataFrame, bits: int = 18, max_rows: int = 8_000,
        doc_id: str = "doc_id", text: str = "text") -> OrdinalModel:
    """A model from at most ``max_rows`` rows of ``grades`` (doc_id, grade)."""
    rows = sample_vectors(docs, grades, bits, max_rows, doc_id, text).toPandas()
    rows = rows.sort_values(["id", "grade"], kind="stable")
    return fit_vectors([(int(g), np.frombuffer(p, np.int32), np.frombuffer(v, np.float32).astype(np.float64))
                        for g, p, v in zip(rows["grade"], rows["places"], rows["vals"], strict=True)], bits)


def rate(docs: DataFrame, model: OrdinalModel, text: str = "text", out: str = "rating") -> DataFrame:
    """``docs`` with ``out``: struct of expected grade and tails P(grade ≥ 1), ≥ 2, …"""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(RATING)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in batches:
            tails = [shared.value.tails(t) for t in part]
            yield pd.DataFrame({"expected_grade": [None if t is None else sum(t) for t in tails], "tails": tails})

    return docs.withColumn(out, score(F.col(text)))


def selected(rating: str, min_grade: int = 1, min_tail: float = 0.5) -> Column:
    tail = F.get(F.col(f"{rating}.tails"), F.lit(min_grade - 1))
    return F.coalesce(tail >= min_tail, F.lit(True))


def quality(docs: DataFrame, grades: DataFrame, min_grade: int = 1, min_tail: float = 0.5,
            **options) -> DataFrame:
    """One row per document: doc_id, expected_grade, tails, selected."""
    model = fit(docs, grades, **options)
    rated = rate(docs.select("doc_id", "text"), model)
    return rated.select("doc_id", F.col("rating.expected_grade").alias("expected_grade"),
                        F.col("rating.tails").alias("tails"),
                        selected("rating", min_grade, min_tail).alias("selected"))


def label_grades(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", grade(F.col("quality"), F.col("toxic")).alias("grade"))

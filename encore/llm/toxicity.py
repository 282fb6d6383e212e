"""Toxicity by maximum-scoring segments.

Training counts, over labelled documents, in how many toxic and other documents
each unit occurs; a unit is a word or one of its leading parts, so inflected forms
that were never seen share the evidence of their stem. A unit's weight is the log
odds of its rates under a Dirichlet prior in proportion to the unit's rate over
both classes, less ``certainty`` standard deviations: rare words prove nothing.
Units below ``min_weight`` are left out of the model.

A word scores the largest weight of its units, or ``-drift`` if none is above 0.
One linear scan of a text finds all its maximal-scoring segments. A segment of
score S in a text of n words has the expected number K·n·exp(-λS) of chance
segments as good (λ from the words of other documents); those expected less than
``significance`` times are its toxic passages. The document's score comes from
the best and the summed significant segments, through a logistic curve fitted on
training documents that were kept out of the counts.

The model is fitted on a bounded sample of the labelled rows (``max_rows``, the
smallest hashes of doc_id first) and holds at most ``max_units`` units; it alone
is sent to the tasks. Texts are scored whole, in Arrow batches.

Defined results: NULL, empty and wordless texts have no segment and get the score
of a text without evidence; a NULL doc_id counts as not held out and is never a
training row; labels that are NULL are not used, repeated labels count as toxic if
any is; without training rows of both classes every score is 0; repeated rows each
get a row; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = re.compile(r"[^\W\d_]+")
PASSAGES = "struct<score:double,passages:array<struct<start:int,end:int,score:double>>>"


def units(word: str, stems: tuple[int, ...]) -> list[str]:
    """The word and, as ``stem*``, its leading parts of the given lengths."""
    return [word] + [word[:k] + "*" for k in stems if len(word) > k]


def segments(places: list[int], scores: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first word, last word, score) in one scan.

    ``places`` and ``scores`` are the words that score above 0, in order; every
    other word scores ``-drift``. Each candidate keeps the running total before
    and after it; a new one swallows earlier candidates back to the nearest one
    that starts lower, when that raises its own total.
    """
    found: list[list[float]] = []  # first, last, total before, total after
    total, at = 0.0, -1
    for place, score in zip(places, scores, strict=True):
        total -= drift * (place - at - 1)
        at = place
        new = [place, place, total, total + score]
        total += score
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j -= 1
            if j < 0 or found[j][3] >= new[3]:
                break
            new = [found[j][0], new[1], found[j][2], new[3]]
            del found[j:]
        found.append(new)
    return [(int(a), int(b), after - before) for a, b, before, after in found]


class _Scores(dict):
    """Word to score, computed at first use; forgotten when it grows large."""

    def __init__(self, weights: dict[str, float], stems: tuple[int, ...], drift: float):
        super().__init__()
        self.weights, self.stems, self.none = weights, stems, -drift

    def __missing__(self, word: str) -> float:
        if len(self) > 500_000:
            self.clear()
        best = max((self.weights.get(u, 0.0) for u in units(word, self.stems)), default=0.0)
        self[word] = value = best if best > 0 else self.none
        return value


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    stems: tuple[int, ...]
    drift: float
    rate: float  # λ
    constant: float  # K
    significance: float
    curve: list[float] = field(default_factory=lambda: [0.0, 0.0, 0.0])
    fitted: bool = False

    def passages(self, text: str | None, scores: _Scores) -> tuple[int, list[tuple[int, int, float]]]:
        found = WORDS.findall(text.lower()) if text else []
        if not found:
            return 0, []
        values = np.fromiter(map(scores.__getitem__, found), np.float64, len(found))
        for i in np.flatnonzero(values > 0).tolist():  # a word said again at once adds nothing
            if i and found[i] == found[i - 1]:
                values[i] = -self.drift
        places = np.flatnonzero(values > 0)
        return len(found), segments(places.tolist(), values[places].tolist(), self.drift) if len(places) else []

    def evidence(self, n: int, segs: list[tuple[int, int, float]]) -> tuple[list[float], list]:
        """(features, significant segments): minus log10 of the best expectation
        and log of the summed significant score."""
        if not segs:
            return [0.0, 0.0], []
        limit = math.log(self.constant * n / self.significance) / self.rate
        good = [s for s in segs if s[2] > limit]
        best = max(s[2] for s in segs)
        tail = (self.rate * best - math.log(self.constant * n)) / math.log(10)
        return [min(max(tail, 0.0), 40.0), math.log1p(sum(s[2] for s in good))], good

    def probability(self, x: list[float]) -> float:
        if not self.fitted:
            return 0.0
        z = self.curve[0] + self.curve[1] * x[0] + self.curve[2] * x[1]
        return 1.0 / (1.0 + math.exp(-max(min(z, 40.0), -40.0)))


def _significance_rate(weights: dict[str, float], shares: dict[float, float], drift: float) -> float:
    """λ > 0 with Σ p(s)·exp(λs) = 1 over the words of other documents."""
    low, high = 1e-6, 20.0
    rest = 1.0 - sum(shares.values())

    def mean(lam: float) -> float:
        return rest * math.exp(-lam * drift) + sum(p * math.exp(min(lam * s, 700.0)) for s, p in shares.items())

    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if mean(mid) < 1 else (low, mid)
    return max(low, 0.05)


def _significance_constant(best: list[tuple[int, float]], rate: float) -> float:
    """K of the extreme-value law P(best < s) = exp(-K n exp(-λ s)), by maximum likelihood
    from (words n, best segment score) of other documents; score 0: no segment, so the
    best is only known to lie below 0. Between 1e-9 and 1, half a segment if there is none."""
    found = sum(1 for _, s in best if s > 0)
    mass = sum(n * math.exp(-rate * s) if s > 0 else n for n, s in best)
    return min(1.0, max(1e-9, (found or 0.5) / mass)) if mass else 0.2


def _logistic(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Two-feature logistic curve by damped Newton steps, lightly regularised."""
    a = np.hstack([np.ones((len(x), 1)), x])
    w, ridge = np.zeros(a.shape[1]), np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        grad = a.T @ (y - p) - ridge @ w
        hess = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + ridge
        step = np.linalg.solve(hess, grad)
        w += step / max(1.0, np.abs(step).max())
    return [float(v) for v in w]


def is_held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int, doc_id: str = "doc_id",
                  text: str = "text", label: str = "toxic") -> DataFrame:
    """(text, y, part) of at most ``max_rows`` labelled rows that are not held out;
    part 0 to 3 is counted, 4 fits the curve."""
    ids = (labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_y"))
           .where(F.col("_id").isNotNull() & F.col("_y").isNotNull() & ~is_held_out(F.col("_id")))
           .groupBy("_id").agg(F.max("_y").alias("y"))
           .withColumn("_h", F.xxhash64("_id")).orderBy("_h", "_id").limit(max_rows))
    # One row per id, that of the smallest text hash: an id may stand in any number of rows.
    return (docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"))
            .join(F.broadcast(ids), "_id")
            .groupBy("_id", "y", "_h").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
            .select("text", "y", F.pmod("_h", F.lit(5)).cast("int").alias("part")))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, max_units: int = 20_000,
        stems: tuple[int, ...] = (3, 4, 5), prior: float = 30.0, certainty: float = 2.5, min_weight: float = 1.5,
        drift: float = 0.5, significance: float = 0.05, **names: str) -> ToxicityModel:
    """A model from at most ``max_rows`` labelled rows of ``docs``."""
    rows = training_rows(docs, labels, max_rows, **names).repartition(
        max(2, min(64, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = (Counter(), Counter())
        docs_seen, tokens = [0, 0], 0
        for part in batches:
            for t, y in zip(part["text"], part["y"], strict=True):
                found = WORDS.findall(t.lower()) if t else []
                seen[y > 0].update({u for w in set(found) for u in units(w, stems)})
                docs_seen[y > 0] += 1
                tokens += 0 if y > 0 else len(found)
        names = list(seen[0].keys() | seen[1].keys())
        yield pd.DataFrame({"unit": pd.Series(names, dtype=object), "toxic": [seen[1][u] for u in names], "other": [seen[0][u] for u in names]})
        yield pd.DataFrame({"unit": pd.Series([None], dtype=object), "toxic": [docs_seen[1]], "other": [docs_seen[0]]})

    counts = (rows.where("part < 4").select("text", "y")
              .mapInPandas(count, "unit string, toxic long, other long")
              .groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))
    counts = counts.withColumn("_all", F.col("toxic") + F.col("other")).persist()
    totals = counts.where("unit is null").collect()
    n1, n0 = (totals[0]["toxic"], totals[0]["other"]) if totals else (0, 0)
    model = ToxicityModel({}, stems, drift, 1.0, 0.2, significance)
    if not n1 or not n0:
        counts.unpersist()
        return model
    # Log odds of document rates; each class is given ``prior`` more documents in which
    # the unit is as frequent as over both classes.
    extra = F.lit(float(prior)) * F.col("_all") / F.lit(n1 + n0)
    hit, miss = F.col("toxic") + extra, F.col("other") + extra
    odds = (F.log(hit / (F.lit(n1 + prior + 0.5) - hit)) - F.log(miss / (F.lit(n0 + prior + 0.5) - miss)))
    weight = odds - F.lit(certainty) * F.sqrt(F.lit(1.0) / hit + F.lit(1.0) / miss)
    best = (counts.where(F.col("unit").isNotNull() & (F.col("toxic") > 0))
            .select("unit", "other", weight.alias("w")).where(F.col("w") >= min_weight)
            .orderBy(F.col("w").desc(), "unit").limit(max_units).collect())
    counts.unpersist()
    model.weights = {r["unit"]: r["w"] for r in best}

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scores = _Scores(model.weights, model.stems, model.drift)
        for part in batches:
            out = []
            for t, y in zip(part["text"], part["y"], strict=True):
                n, segs = model.passages(t, scores)
                hits = [round(scores[w], 2) for w in (WORDS.findall(t.lower()) if segs else ()) if scores[w] > 0]
                out.append((int(y), n, [float(s) for s in hits], [s[2] for s in segs]))
            yield pd.DataFrame(out, columns=["y", "n", "hits", "segs"])

    held = rows.where("part = 4").select("text", "y").mapInPandas(
        measure, "y int, n long, hits array<double>, segs array<double>").collect()
    words = sum(r["n"] for r in held if not r["y"]) or 1
    hits = Counter(s for r in held if not r["y"] for s in r["hits"])
    top = max(model.weights.values(), default=1.0)
    shares = {s: k / words for s, k in hits.items()} | ({} if hits else {round(top, 2): 0.5 / words})
    model.rate = _significance_rate(model.weights, shares, drift)
    model.constant = _significance_constant(
        [(r["n"], max(r["segs"], default=0.0)) for r in held if not r["y"] and r["n"]], model.rate)
    x = np.array([model.evidence(r["n"], [(0, 0, s) for s in r["segs"]])[0] for r in held]).reshape(-1, 2)
    y = np.array([float(r["y"]) for r in held])
    if len(y) and 0 < y.sum() < len(y):
        model.curve, model.fitted = _logistic(x, y), True
    elif len(y):
        model.curve, model.fitted = [-3.0, 1.0, 1.0], True
    return model


def score_texts(docs: DataFrame, model: ToxicityModel, text: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with ``out``: struct of score and the significant toxic passages
    (first and last word, counted from 0, and segment score)."""

    @F.pandas_udf(PASSAGES)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scores = _Scores(model.weights, model.stems, model.drift)
        for part in batches:
            got = []
            for t in part:
                n, segs = model.passages(t, scores)
                x, good = model.evidence(n, segs)
                got.append((model.probability(x), [{"start": a, "end": b, "score": s} for a, b, s in good]))
            yield pd.DataFrame(got, columns=["score", "passages"])

    return docs.withColumn(out, score(F.col(text)))


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_passages."""
    model = fit(docs, labels, **options)
    rows = docs.select("doc_id", "text")
    return score_texts(rows, model).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"),
        F.size("toxicity.passages").alias("n_passages"))

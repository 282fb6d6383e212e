"""Phrase collocations (op11) against brute force."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from encore.llm import collocations as co
from encore.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["key", "c", "h", "at", "n", "a", "l", "r", "score", "rank", "phrase", "words", "f", "uses", "low"]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(docs, max_words=3, least=10, top=2000):
    n, f = Counter(), defaultdict(Counter)
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found = []
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        for p, a in cand.items():
            inside = (q for q, b in cand.items() if len(q) > len(p) and 2 * b >= a
                      and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)))
            if next(inside, None):
                continue
            score, _, l, r = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                 for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def result(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.collect()))


def test_query_equals_brute_force(spark):
    docs = [(r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute(docs)
    assert len(want) > 100 and result(QUERIES["op11_collocations"](spark, SF)) == want


def test_collisions_are_settled_by_the_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    rows = [(r.text, r.lang) for r in docs.collect()]
    docs = spark.createDataFrame([(i, t, lg, None, 0) for i, (t, lg) in enumerate(rows)], DOCS)
    # Keys of 9 bits: nearly all hold several phrases. A full bit set prunes nothing.
    assert result(co.collocations(docs, least=4, bits=9, filter_bits=6)) == brute(rows, least=4)


def test_longer_phrases_and_shuffled_lookup(spark):
    rows = [("new york city hall is in new york. " * 4, "en"), ("the new york city hall; new york city", "en")] * 3
    docs = spark.createDataFrame([(None, t, lg, None, 0) for t, lg in rows], DOCS)
    made = co.collocations(docs, max_words=4, least=3, broadcast_rows=0)
    assert result(made) == brute(rows, max_words=4, least=3)


def test_odd_rows(spark):
    long = "One two\tTHREE  four " * 40_000 + ". " + "é x\x0by ! " * 150_000
    rows = [(None, "en"), ("", None), (" \t\n", "en"), (long, "de"), ("a b", None), ("a b", None), ("a b", "und"),
            ("A B\x00c d\x1fe", "x"), ("straße é É ß", "")] + [("word", "en")] * 12
    docs = spark.createDataFrame([(k % 3, t, lg, None, None) for k, (t, lg) in enumerate(rows)], DOCS)
    docs = docs.select("*", *[F.lit(f"mine-{c}").alias(c) for c in CLASH])
    assert result(co.collocations(docs, least=2, top=7)) == brute(rows, least=2, top=7)
    assert result(co.collocations(docs.limit(0))) == []


def test_cuts_cover_long_texts():
    texts = [b"", b"a b", b"c, d " * 500_000, b"e", b"", b"f" * 3_000_000]
    offsets = np.cumsum([0] + [len(t) for t in texts])
    whole = [b""] * len(texts)
    for buffer, first, starts, _ in co.cuts(offsets, np.frombuffer(b"".join(texts), np.uint8)):
        parts = np.split(buffer, starts[1:])
        for k, part in enumerate(parts):
            assert part[-1] == 10
            whole[first + k] += part[:-1].tobytes()
    assert whole == texts


def test_pointers_of_few_bits_and_small_blocks(spark, monkeypatch):
    # Text hashes of 60 bits, word numbers of 4, so that most numbers wrap round.
    monkeypatch.setattr(co, "NUMBER_BITS", 4)
    rows = [("a b c d e f g h. " * 9 + "x y z, " * k, "en") for k in range(5)]
    docs = spark.createDataFrame([(None, t, lg, None, 0) for t, lg in rows], DOCS)
    texts = docs.select("lang", "text", F.xxhash64("text").alias("h"))
    level = co.count_keys(texts, 2, None, 5, 62, 3)
    found = co.materialise(texts, level.select("lang", "key", F.lit(2).alias("words"), "c", "p"), 62, 100)
    want = Counter(p for t, _ in rows for x in re.split("[.,]", t) for p in zip(x.split(), x.split()[1:]))
    assert {r.phrase: r.f for r in found.collect()} == {" ".join(p): n for p, n in want.items() if n >= 5}


def test_exact_scores_of_huge_counts(spark):
    rows = [("x", 1, "a", 10**13), ("x", 1, "b", 10**13 - 1), ("x", 2, "a b", 10**13 - 7)]
    phrases = spark.createDataFrame(rows, "lang string, words int, phrase string, f long")
    [got] = co.scored_cuts(phrases).collect()
    assert got.score == 10**6 * (10**13 - 7)**2 // (10**13 * (10**13 - 1))

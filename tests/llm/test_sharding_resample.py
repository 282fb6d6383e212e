"""Sharding (op13) and importance resampling (op12) against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from encore.llm import resample, sharding
from encore.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["key", "shard", "grown", "row", "grp", "part", "file", "line", "o0", "weighed", "score", "id", "slot",
         "total", "inside", "start", "place_"]
LONG = "Long Text, word " * 20_000
ROWS = [(1, "a b", "en", "s", 3), (1, "a b", "en", "s", 3), (1, "other", "en", "s", 5), (None, "no id", None, None, 0),
        (None, None, None, None, None), (None, None, None, None, None), (2, None, "en", "s", 0), (3, "", "en", "s", 0),
        (4, " \t\n", "en", "s", 3), (5, LONG, "de", "s", 0), (6, "é😀ß Xé9 " * 15, "fr", "s", 0)]


def documents(spark, rows=ROWS):
    return spark.createDataFrame(rows, DOCS).select("*", *[F.lit(f"mine-{c}").alias(c) for c in CLASH])


# --- sharding

def plain_jump(key: int, shards: int) -> int:
    b, j, key = -1, 0, key % 2**64
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def key_of(doc_id) -> int:
    k = int(hashlib.md5(b"" if doc_id is None else str(doc_id).encode()).hexdigest()[:16], 16)
    return k - 2**64 if k >= 2**63 else k


def test_jump_is_the_published_function():
    keys = np.random.default_rng(5).integers(-2**63, 2**63, 500, dtype=np.int64)
    for n in (1, 2, 7, 8, 9, 1000):
        assert [plain_jump(int(k), n) for k in keys] == sharding.jump(keys, n).tolist()


def test_appending_moves_only_the_necessary_rows(spark):
    keys = np.random.default_rng(6).integers(-2**63, 2**63, 40_000, dtype=np.int64)
    before = sharding.jump(keys, 8)
    after = sharding.jump(keys, 9)
    assert set(after[before != after]) == {8}
    assert abs((before != after).mean() - 1 / 9) < 0.01
    assert abs(np.bincount(before) / 5000 - 1).max() < 0.06
    with pytest.raises(ValueError):
        sharding.jump_column(F.lit(1), 0)


def expected_shards(rows):
    out, seen = [], defaultdict(list)
    for doc_id, text, *_ in rows:
        data = (text or "").encode()
        k = key_of(doc_id)
        out.append((doc_id, len(data) + 1, zlib.crc32(data), "key", plain_jump(k, 8), plain_jump(k, 9)))
        seen[plain_jump(k, 8)].append((k, doc_id))
    return out, seen


def check_shards(rows, got):
    want, groups = expected_shards(rows)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.doc_id, r["size"], r.text_crc32, r.law, r.shard, r.grown_shard) for r in got), key=key) == sorted(
        want, key=key)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append((r.slot, key_of(r.doc_id)))
    for shard, found in slots.items():
        assert [s for s, _ in sorted(found)] == list(range(len(groups[shard])))
        assert [k for _, k in sorted(found)] == sorted(k for k, _ in groups[shard])


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    made = QUERIES["op13_sharding"](spark, SF)
    assert made.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    check_shards([(r.doc_id, r.text) for r in docs.collect()], made.collect())


def test_odd_rows_keep_their_columns(spark):
    docs = documents(spark)
    check_shards(ROWS, sharding.shard_query(docs).collect())
    made = sharding.assign(docs, 3, out="where")
    assert made.columns == [*docs.columns, "where"]
    assert all(r[c] == f"mine-{c}" for r in made.collect() for c in CLASH)
    assert sorted(map(repr, (tuple(r)[:5] for r in made.collect()))) == sorted(map(repr, ROWS))
    assert sharding.shard_query(documents(spark, [])).collect() == []


def test_one_id_in_most_rows_takes_several_parts(spark):
    docs = spark.range(4000).select(F.when(F.col("id") < 3000, 7).otherwise(F.col("id")).alias("doc_id"),
                                    F.lit("same").alias("text"))
    got = sharding.shard_query(docs).collect()
    check_shards([(r.doc_id, r.text) for r in docs.collect()], got)


def test_shard_files_hold_consecutive_slots(spark, tmp_path):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"),
                                   F.lit("x").alias("slot"))
    placed = sharding.assign(docs, 4)
    sharding.write_shards(placed, f"{tmp_path}/out", rows_per_file=40)
    read = spark.read.parquet(f"{tmp_path}/out").select("row.*", F.col("slot").alias("at"), "shard",
                                                        F.col("_metadata.file_name").alias("f"))
    rows = read.collect()
    assert sorted((r.doc_id, r.shard, r["at"]) for r in rows) == sorted(
        (r.doc_id, r.place.shard, r.place.slot) for r in placed.collect())
    files = defaultdict(list)
    for r in rows:
        files[r.shard, r.f].append(r["at"])
    for at in files.values():
        assert len(at) <= 40 and max(at) - min(at) == len(at) - 1


# --- resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    runs = words + [" ".join(p) for p in zip(words, words[1:])]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def brute_resample(docs, benchmark):
    made = [(i, *features(t)) for i, t in docs]
    s = Counter(b for _, _, fs in made for b in fs)
    t = Counter(b for x in benchmark for b in features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in range(10_000)]
    rows = []
    for doc_id, n, fs in made:
        weight = sum(gain[b] for b in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(fs), weight, score, None, n])
    order = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(order[:25 * len(order) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def test_resample_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = QUERIES["op12_resample"](spark, SF)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_resample(docs, bench)


def test_resample_odd_rows(spark):
    docs = documents(spark, ROWS * 3)
    bench = spark.createDataFrame([("long word",), (None,), ("",)], "text string")
    want = brute_resample([(r[0], r[1]) for r in ROWS * 3], ["long word", None, ""])
    assert sorted(map(tuple, resample.resample_query(docs, bench).collect()), key=repr) == want
    whole = resample.resample(docs, bench, percent=50)
    assert whole.columns == [*docs.columns, "draw"]
    assert all(r[c] == f"mine-{c}" for r in whole.collect() for c in CLASH)
    assert sorted(r.draw["rank"] for r in whole.collect() if r.draw["rank"]) == [1, 2, 3]
    assert resample.resample_query(documents(spark, []), bench).collect() == []
    alone = resample.resample_query(docs, bench.limit(0)).collect()
    assert sorted(map(tuple, alone), key=repr) == brute_resample([(r[0], r[1]) for r in ROWS * 3], [])


def test_plane_sums_are_plain_sums():
    rng = np.random.default_rng(3)
    for most in (1, 2, 1 << 20):
        counts, gains = rng.integers(0, most, 1000), rng.integers(-20_000, 20_000, 1000)
        up, down = resample.planes(np.maximum(gains, 0)), resample.planes(np.maximum(-gains, 0))
        sliced = resample.planes(counts)
        assert resample.plane_sum(sliced, up) - resample.plane_sum(sliced, down) == int((counts * gains).sum())

"""The mixing stage writes only what it plans by and returns."""

from __future__ import annotations

import corpus_pipeline
from encore.llm.common import stored


def test_mix_writes_plain_columns_and_only_those_it_needs(spark, monkeypatch):
    rows = [(1, "a b c", "s", "en", "x", 0), (1, "a b c", "s", "en", "x", 1), (None, None, None, None, None, 2),
            (2, "d e", "t", "de", "y", 3), (3, "", "t", "de", "y", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, file string, line int")
    written = {}

    def seen(df, tag):
        written[tag] = df.columns
        return stored(df, tag)

    monkeypatch.setattr(corpus_pipeline, "stored", seen)
    got = corpus_pipeline.mix(spark, docs, "").collect()
    assert written["mix-docs"] == ["doc_id", "text", "source"]
    assert sorted((repr(r["doc_id"]), repr(r["text"]), r["size"]) for r in got) == sorted(
        (repr(r[0]), repr(r[1]), len((r[1] or "").split())) for r in rows)
    assert [r["position"] for r in got if r["position"] is not None] == sorted(
        r["position"] for r in got if r["position"] is not None)

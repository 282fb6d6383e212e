"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing
column names, for every operator and every pipeline stage."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from encore.llm import (
    decontaminate,
    license_scan,
    line_quality,
    mixing,
    pii,
    quality_ordinal,
    simhash,
    suffix_dedup,
    toxicity,
    url_graph,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["key", "fp", "h", "n", "size", "host", "w", "pii", "license", "component", "score", "rating"]
LONG = "a long text of words and 4111 1111 1111 1111 x@y.zz " * 2_000
ROWS = [(1, "plain words of a text that is long enough to be a text", "en", "s1", 54),
        (1, "plain words of a text that is long enough to be a text", "en", "s1", 54),
        (None, "no id here", None, None, None), (None, None, None, None, None),
        (2, None, "en", "s1", 0), (3, "", "en", None, 0), (4, " \t\n\x0b\x0c\r ", None, "s2", 7),
        (5, LONG, "de", "s2", len(LONG)), (6, "idiot loser +1 (499) 555-6503 1.2.3.4", "en", "s3", 37),
        (7, "é😀ß x", "fr", "S3", 6), (8, "word", "en", "s1", 4), (9, "line\n" * 300, "en", "s1", 1500)]
LABELS = "doc_id long, quality int, toxic int"


def docs_of(spark, rows=ROWS):
    docs = spark.createDataFrame(rows, DOCS)
    return docs.select("*", *[F.lit(f"mine-{c}").alias(c) for c in CLASH])


def tables(spark, tmp_path, rows=ROWS):
    """A folder like the driver's, with odd labels and benchmark rows."""
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (1, 1, 1), (2, None, None), (None, 1, 1), (5, 1, 0), (6, 1, 1), (8, 0, 0),
                           (9, 0, None)] if rows else [], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None), (2, ""), (3, "word"), (None, "of a text that is long")] if rows else [],
                          "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def run_all(spark, docs, d):
    read = lambda name: spark.read.parquet(f"{d}/{name}.parquet")
    return {
        "toxicity": toxicity.toxicity(docs, read("labels")),
        "lines": line_quality.line_quality(docs),
        "simhash": simhash.near_duplicates(docs),
        "mix": mixing.mix_query(docs),
        "suffix": suffix_dedup.suffix_query(docs),
        "license": license_scan.license_query(docs),
        "pii": pii.pii_query(docs),
        "quality": quality_ordinal.quality(docs, quality_ordinal.label_grades(read("labels"))),
        "clean": decontaminate.contamination_query(docs, read("benchmark")),
    }


def test_every_operator_gives_a_row_per_odd_row(spark, tmp_path):
    d = tables(spark, tmp_path)
    got = {k: df.collect() for k, df in run_all(spark, docs_of(spark), d).items()}
    assert {k: len(v) for k, v in got.items()} == {k: len(ROWS) for k in got}
    by = {k: {r["doc_id"]: r for r in v} for k, v in got.items()}
    assert all(0.0 <= r["score"] <= 1.0 for r in got["toxicity"])
    assert by["lines"][2]["n_words"] == 0 and by["lines"][2]["base_failed"] and not by["lines"][2]["kept"]
    assert by["lines"][9]["n_dup_lines"] == 299
    zero = {r["component_id"] for r in got["simhash"] if r["fingerprint"] == "0" * 16}
    assert zero == {2}  # NULL, empty and blank texts are one group
    assert by["mix"][2]["size"] == 0 and by["mix"][2]["taken"] == 0
    assert by["suffix"][2]["n_bytes"] == 0 and by["suffix"][9]["n_spans"] == 1
    assert by["pii"][6]["n_phone"] == 1 and by["pii"][6]["n_ip"] == 1 and by["pii"][2]["spans"] == ""
    assert by["pii"][5]["n_card"] == by["pii"][5]["n_email"] == 2_000
    assert by["clean"][8]["contaminated"] and not by["clean"][2]["contaminated"]


def test_every_operator_accepts_empty_tables(spark, tmp_path):
    d = tables(spark, tmp_path, [])
    for name, df in run_all(spark, docs_of(spark, []), d).items():
        assert df.collect() == [], name


def test_operators_keep_clashing_columns(spark, tmp_path):
    docs, d = docs_of(spark), tables(spark, tmp_path)
    bench = spark.read.parquet(f"{d}/benchmark.parquet")
    model = quality_ordinal.fit(docs, quality_ordinal.label_grades(spark.read.parquet(f"{d}/labels.parquet")))
    for out in (decontaminate.decontaminate(docs, bench, out="added"), pii.find_spans(docs, out="added"),
                suffix_dedup.remove_repeats(docs, out="added"), quality_ordinal.rate(docs, model, out="added")):
        assert out.columns == [*docs.columns, "added"]
        assert {r["key"] for r in out.select("key").collect()} == {"mine-key"}


HELPERS = ["_h", "_n", "_spans", "_text_key", "_hash", "_rating", "_found", "_clean", "_verdict", "_hot", "_hv", "_cv",
           "_v", "_copies", "row", "t", "verdict", "spans", "clean", "rating", "hash", "copies", "stays", "file", "line"]


def test_helper_columns_leave_clashing_input_alone(spark, tmp_path):
    d = tables(spark, tmp_path)
    docs = spark.read.parquet(f"{d}/documents.parquet").select("*", *[F.lit(f"mine-{c}").alias(c) for c in HELPERS])
    bench = spark.read.parquet(f"{d}/benchmark.parquet")
    made = {"clean": decontaminate.decontaminate(docs, bench, out="added"),
            "far": decontaminate.decontaminate(docs, bench, out="added", broadcast_rows=0),
            "cut": suffix_dedup.remove_repeats(docs, out="added"),
            "cut-far": suffix_dedup.remove_repeats(docs, out="added", broadcast_rows=0)}
    made |= {name: stage(spark, docs, d) for name, stage in corpus_pipeline.STAGES[:-1]}
    for name, df in made.items():
        found = df.select(*HELPERS).distinct().collect()
        assert [tuple(r) for r in found] == [tuple(f"mine-{c}" for c in HELPERS)], name
    last = corpus_pipeline.mix(spark, docs, d)
    assert sorted((r["text"] for r in last.collect()), key=repr) == sorted((r[1] for r in ROWS), key=repr)


def test_one_labelled_id_in_many_rows(spark):
    """However many rows hold a labelled id, one of them is fitted."""
    rows = [(1, f"other text number {k}", "en", "s", 0) for k in range(50)] + [(2, "idiot loser", "en", "s", 0)] * 50
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1)], LABELS)
    assert toxicity.training_rows(docs, labels, 100).count() <= 2
    model = quality_ordinal.fit(docs, quality_ordinal.label_grades(labels), max_rows=10)
    assert all(r["selected"] is not None for r in quality_ordinal.rate(docs, model).select(
        quality_ordinal.selected("rating").alias("selected")).collect())


def test_mixing_splits_a_null_id(spark):
    """Most rows hold no id: places are exact, whatever the range parts."""
    docs = spark.range(600).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("doc_id"),
                                   F.when(F.col("id") % 2 == 0, "s").alias("source"), F.lit("two words").alias("text"))
    plan = mixing.curriculum_plan(docs).collect()
    assert len(plan) == 600
    for source in ("s", None):
        mine = [r for r in plan if r["source"] == source]
        assert sum(r["taken"] for r in mine) == int(mine[0]["target"])
        assert all(0 <= r["taken"] <= 4 for r in mine)


def test_stages_keep_the_columns_and_run_on_odd_and_empty_rows(spark, tmp_path):
    d = tables(spark, tmp_path / "a")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.dtypes == docs.dtypes, name
        assert out.count() <= len(ROWS)
        wide = stage(spark, docs_of(spark), d)
        assert wide.columns == docs_of(spark).columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, d).count() == len(ROWS)
    empty = tables(spark, tmp_path / "b", [])
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_near_duplicate_stage_keeps_one_row_per_group(spark, tmp_path):
    d = tables(spark, tmp_path)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept = corpus_pipeline.near_duplicates(spark, docs, d).select("doc_id").collect()
    ids = [r[0] for r in kept]
    assert len(ids) == len(set(ids)) and 1 in ids and 2 in ids and 3 not in ids and 4 not in ids


PAGES = [(1, None, None), (2, "", ""), (3, "no scheme/net", "<a href='http://x.net/'>"), (None, "http://x.net/a", None),
         (4, "HTTP://A.Example.NET/en/x?q=/de/", None), (4, "HTTP://A.Example.NET/en/x?q=/de/", None),
         (5, "http://net", "<a href=//bad.net/>"), (6, "http://b.org/fr/#x", None), (7, "a://b://c.net/p", None)]


def test_url_filter_on_odd_pages(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("host", F.lit("mine"))
    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in url_graph.url_filter(pages).collect()]
    assert sorted(got, key=repr) == sorted([
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
        (None, "x.net", "/a", "net/", "block"), (4, "a.example.net", "/en/x", "example.net/en/", "allow"),
        (4, "a.example.net", "/en/x", "example.net/en/", "allow"), (5, "net", "", None, "block"),  # links to a host of a blocked domain
        (6, "b.org", "/fr/", "org/fr/", "allow"), (7, "b:", "//c.net/p", None, "allow")], key=repr)
    assert url_graph.url_filter(pages.where("false")).collect() == []


@pytest.mark.parametrize("rounds", [10])
def test_distrust_flows_against_links_and_trust_along(spark, rounds):
    pages = spark.createDataFrame(
        [(1, "http://spam.net/a", ""), (2, "http://friend.com/x", "<a href='http://spam.net/a'>"),
         (3, "http://good.org/fr/1", "<a href='http://liked.com/'>"), (4, "http://liked.com/y", ""),
         (5, "http://liked.com/z", "<a href='http://spam.net/b'><a href=\"https://good.org/\">"),
         (6, "http://far.com/", "<a href='http://friend.com/'>")], "page_id long, url string, html string")
    verdict = {r["page_id"]: r["verdict"] for r in url_graph.url_filter(pages, rounds=rounds).collect()}
    assert verdict == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "block"}


def test_group_decisions_join_each_linked_row_once(spark, monkeypatch):
    """Fingerprints without links meet no lookup: the winners' plan stays small."""
    plans, store = {}, simhash.stored

    def seen(df, tag):
        plans[tag] = df._jdf.queryExecution().sparkPlan().toString()
        return store(df, tag)

    monkeypatch.setattr(simhash, "stored", seen)
    texts = ["a b c d e f g h", "a b c d e f g h", "one two three four five", "a b c d e f g h", ""]
    docs = spark.createDataFrame([(None if k == 3 else k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {(r["doc_id"], r["copies"], r["stays"]) for r in simhash.group_decisions(docs).collect()}
    assert got == {(0, 1, True), (1, 1, False), (None, 1, False)}
    assert plans["simhash-winners"].count("Join") <= 4

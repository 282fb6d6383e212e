"""Cases in which an operator once did less than its whole job."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from encore.llm import decontaminate, line_quality, pii, url_graph

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_pages_that_share_many_lines_count_each(spark):
    shared = [" ".join(f"w{chr(97 + k)}{c}" for c in "abcdefg") for k in range(20)]
    own = "".join(f" {w}{{0}}" for w in ("one", "two", "three", "four"))
    rows = [(i, "\n".join([*shared, own.format("x" * (i + 1))]), "en", "site", 0) for i in range(60)]
    rows += [(100 + i, "\n".join([f"copied line {k} a b" for k in "abc"]), "en", "site", 0) for i in range(60)]
    docs = spark.createDataFrame(rows, DOCS)
    lines = line_quality.document_lines(line_quality.text_features(docs))
    counts = [r["n_docs"] for r in line_quality.frequent_lines(lines).collect()]
    assert counts == [60] * 20  # exact copies count once, so their lines are not frequent
    got = {r["doc_id"]: r for r in line_quality.line_quality(docs).collect()}
    assert all(got[i]["n_boilerplate_words"] == 140 and not got[i]["base_failed"] and not got[i]["kept"]
               for i in range(60))
    assert all(got[100 + i]["n_boilerplate_words"] == 0 for i in range(60))


PAGES = "page_id long, url string, html string"


def test_distrust_does_not_fade_with_more_linkers(spark):
    rows = [(0, "http://spam.net/a", "")]
    rows += [(1 + i, f"http://h{i}.com/x", "<a href='http://spam.net/a'>") for i in range(40)]
    mixed = "".join(f"<a href='http://g{i}.com/'>" for i in range(9)) + "<a href='http://spam.net/a'>"
    rows += [(100, "http://mixed.com/x", mixed), (101, "http://far.com/x", "<a href='http://h0.com/x'>")]
    verdict = {r["page_id"]: r["verdict"] for r in url_graph.url_filter(
        spark.createDataFrame(rows, PAGES), rounds=2).collect()}
    assert verdict == {i: "block" for i in range(41)} | {100: "allow", 101: "block"}


def test_linked_hosts_without_pages_are_seeds_by_their_rule(spark):
    rows = [(1, "http://a.com/x", "<a href='http://spam.NET'>"), (2, "http://b.com/x", "<a href='//example.net/en/p'>"),
            (3, "http://c.com/x", "<a href='http://example.net/other'>"),
            (4, "http://d.com/x", "<a href='http://plain.com/'>")]
    for pages in (rows[:2] + rows[3:], rows[2:]):
        got = url_graph.url_filter(spark.createDataFrame(pages, PAGES), rounds=2).collect()
        assert {r["page_id"]: r["verdict"] for r in got} == {
            i: {1: "block", 2: "allow", 3: "block", 4: "allow"}[i] for i, _, _ in pages}


LONG = "".join(f"k{i}Z" for i in range(200))


@pytest.mark.parametrize(("text", "want"), [
    ("password = correcthorsebattery here", ["password = correcthorsebattery"]),
    ('{"password": "open sesame, \\"friend\\"!"}', ['password": "open sesame, \\"friend\\"!']),
    ('{"id":1234567890,"password":"hunter2hunter2"}', ['id":1234567890', 'password":"hunter2hunter2']),
    ("password: p@ssw0rd!2024 x", ["password: p@ssw0rd!2024"]),
    ("user=adminadmin&password=p%40ss#word$", ["user=adminadmin", "password=p%40ss#word$"]),
    (f"secret = {LONG}.{LONG}.{LONG} x", [f"secret = {LONG}.{LONG}.{LONG}"]),
    (f"pwd='{LONG} {LONG}' x", [f"pwd='{LONG} {LONG}"]),
    ("password: hunter22!me@corp.com x", ["password: hunter22!me@corp.com"]),
])
def test_secrets_are_proposed_whole(spark, text, want):
    p = pii.proposals(F.col("t"))
    free = F.filter(p, lambda x: (x["g"] == 0) & ~pii._overlaps(x, pii.base_spans(F.col("t"))))
    got = spark.createDataFrame([(text,)], "t string").select(F.transform(free, lambda x: x["s"])).first()[0]
    assert got == want
    named = spark.createDataFrame([(s,) for s in want], "s string").select(F.rlike("s", F.lit(pii.CREDENTIAL)))
    assert any(r[0] for r in named.collect())


def test_near_duplicate_stage_keeps_every_group(spark, tmp_path):
    texts = [" ".join(f"{t}{k}" for k in range(30)) for t in ("alpha", "beta", "gamma", "delta")]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (8, texts[2])]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    kept = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=repr) == sorted(
        [(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3])], key=repr)


def test_short_items_are_reported_but_drop_only_their_own_text(spark):
    docs = spark.createDataFrame([(1, "he said yes to a trip to Paris"), (2, "Yes!"), (3, "a trip to rome by train now"),
                                  (4, "nothing of it")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "yes"), (2, "Paris"), (3, "trip to Rome by train")], "item_id long, text string")
    got = {r[0]: tuple(r[1:]) for r in decontaminate.contamination_query(docs, items).collect()}
    assert got == {1: (False, 2, 1.0), 2: (True, 1, 1.0), 3: (True, 1, 1.0), 4: (False, 0, 0.0)}

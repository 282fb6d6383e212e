"""Each pipeline stage, on all that the stage before kept, against a brute-force version."""

from __future__ import annotations

import itertools
import os
import re

import pytest
import regex

import corpus_pipeline
from encore.llm import pii, quality_ordinal
from encore.llm.common import stored, table

from .test_brute_force import BASE, _fingerprint, _valid

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF_DIR), reason="driver tables missing")


@pytest.fixture(scope="module")
def steps(spark):
    """The documents before and after every stage."""
    kept = [table(spark, SF_DIR, "documents")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        kept.append(stored(stage(spark, kept[-1], SF_DIR), f"test-pipeline-{k}"))
    return kept


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_quality_stage(spark, steps):
    model = quality_ordinal.fit(steps[0], quality_ordinal.label_grades(table(spark, SF_DIR, "labels")))
    want = {i for i, r in by_id(steps[0]).items() if model.weights is None or model.tails(r["text"])[0] >= 0.5}
    assert set(by_id(steps[1])) == want


def test_near_duplicate_stage(steps):
    before = by_id(steps[1])
    prints = {i: _fingerprint(r["text"], 4) for i, r in before.items()}
    group = {i: i for i in before}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i
    for a, b in itertools.combinations(sorted(before), 2):
        if bin(prints[a] ^ prints[b]).count("1") <= 4:
            low, high = sorted((find(a), find(b)))
            group[high] = low
    assert set(by_id(steps[2])) == {find(i) for i in before}


def test_decontamination_stage(spark, steps):
    word = regex.compile(r"[\p{L}\p{N}]+")
    items = [word.findall(r["text"].lower()) for r in table(spark, SF_DIR, "benchmark").collect()]

    def leaks(text):
        w = word.findall((text or "").lower())
        for item in items:
            size = min(15, len(item))
            need = -(-size * 8 // 10)
            places = {}
            for p, x in enumerate(w):
                for k, y in enumerate(item):
                    if x == y:
                        places.setdefault(p - k, set()).add(k)
            for same in places.values():
                if len(same) >= need and max(len([k for k in same if a <= k < a + size])
                                             for a in range(len(item) - size + 1)) >= need:
                    return True
        return False
    assert set(by_id(steps[3])) == {i for i, r in by_id(steps[2]).items() if not leaks(r["text"])}


def test_pii_stage(steps):
    before, after = by_id(steps[3]), by_id(steps[4])
    assert set(before) == set(after)
    found = by_id(pii.find_spans(steps[3]))
    changed = 0
    for i, r in before.items():
        spans = sorted((m.start(), k, m.end()) for k, (kind, p) in enumerate(BASE)
                       for m in re.finditer(p, r["text"] or "") if _valid(kind, m.group()))
        every = [(s["start"], s["k"], s["end"]) for s in found[i]["pii"]]
        assert spans == [s for s in every if s[1] < len(BASE)]
        at, out = 0, []
        for a, k, b in every:
            if b > at:
                out += [r["text"][at:a], f"[{pii.KINDS[k].upper()}]"]
                at = b
        clean = None if r["text"] is None else "".join([*out, r["text"][at:]])
        assert after[i]["text"] == clean and after[i]["n_chars"] == (None if clean is None else len(clean))
        changed += clean != r["text"]
    assert changed


def test_mixing_stage_and_whole_run(spark, steps):
    assert set(by_id(steps[5])) == set(by_id(steps[4]))
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for i, r in by_id(steps[4]).items()}
    assert {i: r["size"] for i, r in by_id(steps[5]).items()} == sizes
    run = sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect()), key=repr)
    assert run == sorted(map(tuple, steps[5].collect()), key=repr)

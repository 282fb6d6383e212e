from __future__ import annotations

import pytest

from encore.operators import popularity as pop
from tests.conftest import rows

TIES = [("u1", "B", 10, 1), ("u1", "A", 10, 2), ("u2", "C", 5, 1), ("u2", "A", 5, 2)]
NULLS = [("u1", None, 5, 1), ("u1", "", 4, 2), ("u1", "X", 3, 3), (None, "X", 2, 1),
         ("u2", "X", 1, 1)]


def test_top_items_ties_broken_by_name(artists):
    out = pop.top_artists(artists(TIES), k=2)
    assert rows(out) == [("A", 2, 100.0), ("B", 1, 50.0)]


def test_top_items_null_and_empty_are_groups(artists):
    out = rows(pop.top_artists(artists(NULLS)))
    # total users counts the NULL user once: {u1, u2, NULL} = 3
    assert out[0] == ("X", 2, pytest.approx(200.0 / 3))
    assert out[1] == (None, 1, pytest.approx(100.0 / 3))
    assert out[2] == ("", 1, pytest.approx(100.0 / 3))


def test_same_top1_artist_uses_name_tiebreak(artists):
    assert rows(pop.same_top1_artist(artists(TIES))) == [("A", 2, 100.0)]


def test_same_top1_artist_empty(artists):
    assert pop.same_top1_artist(artists([])).count() == 0


def _mentions(counts):
    out, user = [], 0
    for artist, n in counts.items():
        for _ in range(n):
            user += 1
            out.append((f"u{user}", artist, 1, 1))
    return out


def test_long_tail_range_frame_ties(artists):
    edge80 = artists(_mentions({"P": 5, "Q": 3, "R": 3, "S": 1}))
    # running totals 5, 11, 11, 12; 80 % of 12 = 9.6 → only P
    assert rows(pop.long_tail(edge80)) == [(4, 1, 25.0)]
    # 95 % = 11.4 → the tied pair enters together
    assert rows(pop.long_tail(edge80, share=0.95)) == [(4, 3, 75.0)]


def test_long_tail_empty(artists):
    assert rows(pop.long_tail(artists([]))) == [(0, 0, 0.0)]


def test_mention_stats(artists):
    out = dict(rows(pop.mention_stats(artists(_mentions({"P": 5, "Q": 3, "R": 3, "S": 1})))))
    assert out["mean"] == 3.0
    assert out["median"] == 3.0
    assert out["stddev"] == pytest.approx(1.632993161855452, abs=1e-12)


def test_summary_matches_plain_aggregates(spark):
    import statistics
    from encore.functions.histogram import summary
    values = [3, 1, 1, 7, 7, 7, 2, None, 40]
    df = spark.createDataFrame([(v,) for v in values], "n long")
    got = summary(df, "n", {"p10": 0.1, "p50": 0.5, "p99": 0.99}, mean="m", stddev="s").first()
    known = sorted(v for v in values if v is not None)
    assert (got["p10"], got["p50"], got["p99"]) == (1.0, 3.0, 40.0)
    assert got["m"] == pytest.approx(statistics.mean(known))
    assert got["s"] == pytest.approx(statistics.stdev(known))
    assert rows(summary(df.where("false"), "n", {"p": 0.5}, mean="m", stddev="s")) == [(None, None, None)]
    assert rows(summary(df.where("n = 40"), "n", {"p": 0.5}, stddev="s")) == [(40.0, None)]

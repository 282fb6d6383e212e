"""The host graph (op10) against its DuckDB SQL on generated pages with links."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest

from encore.llm import url_graph

PAGES = "page_id long, url string, html string"


def pages(seed: int, n: int):
    rng = np.random.default_rng(seed)
    hosts = [f"h{k}.com" for k in range(30)] + ["spam.net", "www.example.net", "a.org", "b.org", "example.com", "bad.NET"]
    out = []
    for k in range(n):
        # A third of the links go to one host.
        to = ["h0.com" if rng.random() < 0.33 else hosts[rng.integers(len(hosts))] for _ in range(rng.integers(0, 4))]
        html = "".join(f"<a href=\"{rng.choice(['http:', 'HTTPS:', ''])}//{t}{rng.choice(['', '/', '/fr/x', '/en/', '/de/a?q'])}\">"
                       for t in to) + "<img src='/local.png'><a href=///x>"
        host = hosts[rng.integers(len(hosts) - 2)]
        out.append((k, f"http://{host}{rng.choice(['', '/', '/fr/1', '/en/2', '/de/3#x', '/p?q'])}", html))
    return [*out, (None, None, None), (None, "no scheme", "<a href=//h1.com>"), (n, "http://h2.com/", None)]


@pytest.mark.parametrize(("seed", "n"), [(1, 60), (3, 12)])
def test_verdicts_equal_the_sql(spark, seed, n):
    rows = pages(seed, n)
    got = url_graph.url_filter(spark.createDataFrame(rows, PAGES)).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    want = con.execute(url_graph.ORACLE_SQL).fetchall()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    ruled = {r["verdict"] for r in got if r["rule"] is None}
    assert ruled == {"allow", "block"} or n < 20

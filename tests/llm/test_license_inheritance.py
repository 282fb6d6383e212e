"""Licence files among the documents of op6's query, by their sources."""

from __future__ import annotations

from encore.llm import license_scan

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
MIT = "Released under the MIT License"
GPL = "Licensed under the GNU General Public License, version 3"
APACHE = "Licensed under the Apache License, Version 2.0"
# (source, text, licence, origin)
CASES = [
    ("repo/LICENSE", MIT, "MIT", "file"), ("repo/src/x.py", "plain words", "MIT", "inherited"),
    ("repo", "plain words", "MIT", "inherited"), ("repo/src", f"plain words\n{APACHE}", "Apache-2.0", "header"),
    ("repo/lib/COPYING.txt", GPL, "GPL-3.0", "file"), ("repo/lib/y.py", None, "GPL-3.0", "inherited"),
    ("repository/x.py", "plain words", None, None),
    ("https://Code.example.org/p/License.md?raw=1#top", APACHE, "Apache-2.0", "file"),
    ("http://code.example.org/p/a/b.html?x=/q/", "plain words", "Apache-2.0", "inherited"),
    ("http://code.example.org/q/", "plain words", None, None),
    # Sources that are no file in a folder license no other document.
    ("license", MIT, "MIT", "header"), ("/LICENSE", MIT, "MIT", "header"), ("https://license", MIT, "MIT", "header"),
    ("src1", f"plain words\n{GPL}", "GPL-3.0", "header"), ("src1", "plain words", None, None),
    ("src2", MIT, "MIT", "header"), ("src2", "plain words", None, None), (None, "plain words", None, None),
]


def test_documents_inherit_from_licence_files(spark):
    docs = spark.createDataFrame([(k, t, "en" if k % 2 else None, s, 0) for k, (s, t, _, _) in enumerate(CASES)], DOCS)
    got = {r["doc_id"]: (CASES[r["doc_id"]][0], r["license"], r["origin"])
           for r in license_scan.license_query(docs).collect()}
    assert got == {k: (s, name, origin) for k, (s, _, name, origin) in enumerate(CASES)}

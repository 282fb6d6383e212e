"""Licence versions and variants (op6): near-equal notices of other names, SPDX lines."""

from __future__ import annotations

from encore.llm import license_scan

HEADER = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU {} Public "
          "License as published by the Free Software Foundation; either version {} of the License, or (at your option) "
          "any later version.")
CASES = [
    (HEADER.format("General", "2"), "GPL-2.0"), (HEADER.format("General", "3"), "GPL-3.0"),
    (HEADER.format("Lesser General", "2.1"), "LGPL-2.1"), (HEADER.format("Lesser General", "3"), "LGPL-3.0"),
    (HEADER.format("Affero General", "3"), "AGPL-3.0"), (HEADER.format("General", "1"), None),
    ("Licensed under CC BY-ND 4.0", "CC-BY-ND-4.0"), ("Licensed under CC BY 4.0", "CC-BY-4.0"),
    ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"), ("Licensed under CC BY 3.0", None),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "CC-BY-NC-4.0"),
    ("// SPDX-License-Identifier: MIT", "MIT"), ("# SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
    ("SPDX-License-Identifier: LGPL-2.1", "LGPL-2.1"), ("SPDX-License-Identifier: Zlib", None),
    ("SPDX-License-Identifier: GPL-1.0", None), ("Licensed under the Apache License, Version 1.1", None),
    ("Released under the MIT License.", "MIT"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met: copies must retain the notice", "BSD-2-Clause"),
    ("See the license of some other work", None), (None, None), ("", None),
]


def test_versions_and_variants_must_agree(spark):
    files = spark.createDataFrame([(f"d{k}/f.py", t) for k, (t, _) in enumerate(CASES)], "path string, text string")
    got = {r["path"]: r["license"] for r in license_scan.license_scan(files).collect()}
    assert {CASES[k][0]: got[f"d{k}/f.py"] for k in range(len(CASES))} == dict(CASES)


def test_every_template_fits_itself():
    for name, text in license_scan.TEMPLATES:
        need, bar = license_scan.template_marks(name, text)
        held = {license_scan.mark(w) for w in license_scan.re.findall(license_scan.TOKEN, text.lower())}
        assert set(need) <= held and not set(bar) & held, (name, text)

"""Licence scan: notices by sparse TF-IDF cosine, then inheritance by directory.

Candidate passages are the lines with a licence word, and the blank-line separated
paragraphs around them; of a licence file (by its name) also the whole text. Their
words are compared with the notice templates: weights are (1 + log tf)·idf with idf
over the templates, words that no template has count with the largest idf in the
passage's length, and the best template above ``min_cosine`` names the licence. Texts of
one family differ in few words, so a cosine alone would take one version for another:
a template counts only if the passage holds its marks (version, variant, of an SPDX line
every part of the name) and none of its family's other marks.

A file without a notice of its own takes the licence of the nearest directory above
it that holds a licence file. Distinct directories are spread into their ancestors
and joined with the licensed ones; the deepest wins.

Equal passages are scored once: the score table has one row per distinct passage and
meets the texts in ``lookup_join``, so a notice that a third of all files carry stays
spread. The templates are a fixed list and are broadcast; so are no other tables.

Defined results: NULL and empty texts have no notice; NULL paths are files in no
directory and inherit nothing; of several notices in a file the best cosine wins,
then the smaller licence name; the same rule holds for several licence files of a
directory; texts of any length are searched whole; repeated rows each get a row; an empty
table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup_join, stored

# Short notices by SPDX name.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation, either version 3 of "
                "the License, or (at your option) any later version"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met; neither the name of the copyright "
                     "holder nor the names of its contributors may be used to endorse or promote products"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
            "fee is hereby granted"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright under CC0 1.0 Universal"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("Proprietary", "Copyright. All rights reserved. Unauthorized copying of this file is strictly prohibited"),
)
GNU_HEADERS = (("GPL-2.0", "General", "2"), ("LGPL-2.1", "Lesser General", "2.1"), ("LGPL-3.0", "Lesser General", "3"),
               ("AGPL-3.0", "Affero General", "3"))
GNU_HEADER = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} "
              "Public License as published by the Free Software Foundation, either version {} of the License, or (at "
              "your option) any later version")
GNU_LINE = "Licensed under the GNU {} Public License, version {}"
CC_PARTS = (("SA", "ShareAlike"), ("NC", "NonCommercial"), ("ND", "NoDerivatives"))
CC_VARIANTS = ("", "SA", "NC", "ND", "NC SA", "NC ND")
# Words that mean one another, and by family (a start of the SPDX name) its variants and versions.
SAME = {"noncommercial": "nc", "sharealike": "sa", "noderivatives": "nd", "noderivs": "nd", "lgpl": "lesser",
        "agpl": "affero", "2": "2.0", "3": "3.0", "4": "4.0", "1": "1.0"}
FAMILIES = (
    (("GPL", "LGPL", "AGPL"), ("lesser", "affero"), ("1.0", "2.0", "2.1", "3.0")),
    (("CC-BY",), ("nc", "sa", "nd"), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    (("Apache",), (), ("1.0", "1.1", "2.0")),
    (("MPL",), (), ("1.0", "1.1", "2.0")),
    (("BSD",), ("neither",), ()),
)
OWN_MARKS = {"LGPL": ("lesser",), "AGPL": ("affero",), "BSD-3-Clause": ("neither",)}


def _templates() -> tuple[tuple[str, str], ...]:
    """The notices, those that follow from a family's pattern, and an SPDX line for each name."""
    made = list(NOTICES)
    for name, words, version in GNU_HEADERS:
        made += [(name, GNU_HEADER.format(words, version)), (name, GNU_LINE.format(words, version))]
    long = dict(CC_PARTS)
    for variant in CC_VARIANTS:
        parts = variant.split()
        name = "-".join(["CC", "BY", *parts, "4.0"])
        made += [(name, f"Licensed under CC {'-'.join(['BY', *parts])} 4.0"),
                 (name, "This work is licensed under a Creative Commons "
                        f"{'-'.join(['Attribution', *[long[p] for p in parts]])} 4.0 International License")]
    names = sorted({n for n, _ in made} - {"Proprietary"})
    made += [(n, f"SPDX-License-Identifier: {n}") for n in names]
    return tuple(dict.fromkeys(made))


TEMPLATES = _templates()
TRIGGER = r"(?i)licen[cs]e|copyright|permission|redistribut|all rights reserved|spdx"
FILE_NAME = r"(?i)^(?:licen[cs]e|copying|unlicense)(?:[.-][a-z0-9.-]*)?$"
TOKEN = r"[a-z0-9]+(?:\.[0-9]+)*"


def template_weights(templates=TEMPLATES) -> tuple[dict[str, list[tuple[int, float]]], dict[str, float], float]:
    """(token -> (template, normalised weight), token -> idf, idf of other words)."""
    bags = [Counter(re.findall(TOKEN, t.lower())) for _, t in templates]
    seen = Counter(w for b in bags for w in b)
    idf = {w: 1.0 + math.log(len(bags) / k) for w, k in seen.items()}
    weights = defaultdict(list)
    for k, bag in enumerate(bags):
        v = {w: (1 + math.log(c)) * idf[w] for w, c in bag.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        for w, x in v.items():
            weights[w].append((k, x / norm))
    return dict(weights), idf, 1.0 + math.log(len(bags))


def mark(token: str) -> str:
    return SAME.get(token, token)


def template_marks(name: str, text: str) -> tuple[list[str], list[str]]:
    """(marks that a passage must hold, marks that it must not hold) for a template."""
    family = next(((v, n) for starts, v, n in FAMILIES if name.startswith(starts)), ((), ()))
    own = [m for start, marks in OWN_MARKS.items() if name.startswith(start) for m in marks]
    parts = {mark(w) for w in re.findall(TOKEN, name.lower().replace("-", " "))}
    need = [m for m in (*family[0], *family[1]) if m in parts or m in own]
    if text.startswith("SPDX"):
        held = {mark(w) for w in re.findall(TOKEN, text.lower())}
        need = sorted(parts & held | (set(need) & held))
    return need, [m for m in (*family[0], *family[1]) if m not in parts and m not in own]


def passages(text: Column, is_file: Column) -> Column:
    """Distinct candidate passages, as their space-joined tokens."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(TRIGGER)))
    blocks = F.filter(F.split(text, r"\n[\x20\t\r]*\n"), lambda x: F.rlike(x, F.lit(TRIGGER)))
    whole = F.when(is_file, F.array(text)).otherwise(F.array().cast("array<string>"))
    tokens = F.transform(F.concat(lines, blocks, whole), lambda x: F.array_join(
        F.regexp_extract_all(F.lower(x), F.lit(TOKEN), F.lit(0)), " "))
    any_ = F.rlike(text, F.lit(TRIGGER)) | is_file
    return F.when(any_, F.array_distinct(tokens)).otherwise(F.array().cast("array<string>"))


def score_passages(found: DataFrame, templates=TEMPLATES, min_cosine: float = 0.6) -> DataFrame:
    """(passage, license, cosine) of the distinct ``found`` (passage) that match."""
    spark = found.sparkSession
    weights, idf, other = template_weights(templates)
    table = F.broadcast(spark.createDataFrame(
        [(w, float(idf[w]), [(k, float(x)) for k, x in pairs]) for w, pairs in sorted(weights.items())],
        "token string, idf double, pairs array<struct<k:int,w:double>>"))
    names = F.array(*[F.lit(n) for n, _ in templates])
    rules = [template_marks(n, t) for n, t in templates]
    need, bar = ([[F.lit(m) for m in r[i]] for r in rules] for i in (0, 1))
    lists = [F.array(*[F.array(*x).cast("array<string>") for x in side]) for side in (need, bar)]
    every = sorted({m for r in rules for side in r for m in side})
    same = F.create_map(*[F.lit(x) for pair in SAME.items() for x in pair])
    # A row per word carries the passage's hash, never its text.
    found = found.select(F.md5(F.col("passage").cast("binary")).alias("pid"), "passage")
    counts = (found.select("pid", F.explode(F.split("passage", " ")).alias("token"))
              .groupBy("pid", "token").agg(F.count(F.lit(1)).alias("tf")).join(table, "token", "left")
              .withColumn("x", (F.lit(1.0) + F.log("tf")) * F.coalesce("idf", F.lit(other))))
    # The marks of a passage are among a fixed list, so the set is small.
    word = F.coalesce(F.try_element_at(same, F.col("token")), F.col("token"))
    norms = counts.groupBy("pid").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"),
                                      F.collect_set(F.when(word.isin(every), word)).alias("marks"))
    dots = (counts.where(F.col("pairs").isNotNull()).select("pid", "x", F.inline("pairs"))
            .groupBy("pid", "k").agg(F.sum(F.col("x") * F.col("w")).alias("dot")))
    fits = (F.size(F.array_except(F.get(lists[0], F.col("k")), "marks")) == 0) & ~F.arrays_overlap(
        F.get(lists[1], F.col("k")), "marks")
    best = (dots.join(norms, "pid").where(fits)
            .select("pid", F.get(names, F.col("k")).alias("license"),
                    F.round(F.col("dot") / F.col("norm"), 9).alias("cosine"))
            .where(F.col("cosine") >= min_cosine)
            .groupBy("pid").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("b")))
    return (found.join(best, "pid").select("passage", F.col("b.license").alias("license"), (-F.col("b.c")).alias("cosine")))


def _folder(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def inherited(files: DataFrame) -> DataFrame:
    """(folder, license, cosine): per folder of ``files`` (folder, is_file, license,
    cosine) the licence of the nearest folder at or above it with a licence file."""
    owners = (files.where(F.col("is_file") & F.col("license").isNotNull())
              .groupBy(F.col("folder").alias("owner"))
              .agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("b")))
    parts = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(
        k.alias("depth"), F.array_join(F.slice(parts, F.lit(1), k), "/").alias("owner")))
    steps = (files.groupBy("folder").agg(F.count(F.lit(1)).alias("n_files")).where(F.col("folder").isNotNull())
             .select("folder", "n_files", F.inline(above)))
    found = steps.groupBy("owner").agg(F.count(F.lit(1)).alias("_n")).join(owners, "owner")
    return (lookup_join(steps, found, ["owner"], "_n").where(F.col("b").isNotNull())
            .groupBy("folder", "n_files").agg(F.max_by("b", "depth").alias("b"))
            .select("folder", "n_files", F.col("b.license").alias("_license"), (-F.col("b.c")).alias("_cosine")))


def license_scan(files: DataFrame, path: Column | str = "path", text: str = "text", keep: tuple[str, ...] = (),
                 min_cosine: float = 0.6, templates=TEMPLATES) -> DataFrame:
    """One row per file: ``keep`` columns, path, license, cosine and origin ("file" of a
    licence file, "header", "inherited", NULL without a licence)."""
    p = F.col(path) if isinstance(path, str) else path
    t = F.coalesce(F.col(text), F.lit(""))
    is_file = F.coalesce(F.rlike(F.regexp_extract(p, "[^/]*$", 0), F.lit(FILE_NAME)), F.lit(False))
    rows = stored(files.select(
        *keep, p.alias("path"), is_file.alias("_is_file"), passages(t, is_file).alias("_passages")), "licence-files")
    rows = rows.withColumn("_key", F.when(F.size("_passages") > 0, F.md5(F.to_json("_passages").cast("binary"))))
    # One row per distinct set of passages: copies of a notice are scored once.
    sets = rows.where("_key is not null").groupBy("_key").agg(
        F.first("_passages").alias("_passages"), F.count(F.lit(1)).alias("_n"))
    each = sets.select("_key", "_n", F.explode("_passages").alias("passage"))
    used = each.groupBy("passage").agg(F.count(F.lit(1)).alias("_used"))
    scored = stored(score_passages(used.select("passage"), templates, min_cosine).join(used, "passage"),
                    "licence-passages")
    own = (lookup_join(each, scored, ["passage"], "_used").where(F.col("license").isNotNull())
           .groupBy("_key", "_n").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("b"))
           .select("_key", "_n", F.col("b.license").alias("license"), (-F.col("b.c")).alias("cosine")))
    judged = stored(lookup_join(rows.drop("_passages"), own, ["_key"], "_n")
                    .withColumn("folder", _folder(F.col("path"))).drop("_key"), "licence-own")
    above = inherited(judged.select("folder", F.col("_is_file").alias("is_file"), "license", "cosine"))
    out = lookup_join(judged, above, ["folder"], "n_files")
    origin = (F.when(F.col("license").isNotNull(), F.when(F.col("_is_file"), "file").otherwise("header"))
              .when(F.col("_license").isNotNull(), "inherited"))
    return out.select(*keep, "path", F.coalesce("license", "_license").alias("license"),
                      F.coalesce("cosine", "_cosine").alias("cosine"), origin.alias("origin"))


def source_path(source: Column) -> Column:
    """A source as a path: of a URL its host, in lower case, and its path."""
    url = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)"
    host, rest = (F.regexp_extract(source, url, k) for k in (1, 2))
    return F.when(F.rlike(source, F.lit(url)), F.concat(F.lower(host), rest)).otherwise(source)


def license_query(docs: DataFrame) -> DataFrame:
    """Documents as files ``source/lang/doc_id``. Where the source itself is the path or URL
    of a licence file in some folder, the document is that file: documents whose sources
    lie at or below the folder inherit from it."""
    source = source_path(F.col("source"))
    named = F.rlike(F.regexp_extract(source, "[^/]/+([^/]*)$", 1), F.lit(FILE_NAME))
    path = F.concat_ws("/", F.coalesce(source, F.lit("")), F.coalesce("lang", F.lit("")),
                       F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return license_scan(docs, F.when(named, source).otherwise(path), keep=("doc_id",))

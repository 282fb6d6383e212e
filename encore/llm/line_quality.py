"""Quality rules with a cross-document line frequency.

Every non-blank line of a text is normalised (lower case, digit runs as 0, white
space runs as one blank) and hashed. A line that more than ``max_docs`` distinct
documents of a host hold is boilerplate there; its words are taken off each
document, and a document that keeps less than ``min_left`` of its words is
rejected as depleted, as is one that fails the base rules.

Distinct documents are distinct texts: exact copies count once, texts that differ
anywhere count each, however many lines they share.

DataFrame expressions only. Counts are aggregated before they are shuffled; the
frequent lines meet the documents' lines in ``lookup_join``, which broadcasts at
most 1,024 hot lines and shuffles the rest; no group of lines or of copies is
gathered in a task.

Defined results: NULL and blank texts have no words, lines or symbols and fail
the base rules; a NULL host is a host of its own; repeated rows each get a row;
an empty table gives no rows. Columns of the input other than the three named
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_RUN, SPACES, let, lookup_join, stored, words

WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"


def _packed_windows(w: Column) -> Column:
    """One long per 3-word window: hash bits above, window index below.

    The index takes as many bits as the text needs, the hash the rest, so a sort
    brings equal windows together with their places."""
    n = F.size(w)
    hashes = F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.call_function("shiftleft", F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
                                  F.length(F.bin(n))).bitwiseOR(i.cast("long"))))
    return F.coalesce(hashes, F.array().cast("array<bigint>"))


def _repeated_words(p: Column, n_words: Column) -> Column:
    """Words in windows found twice or more, from the sorted packed windows."""
    low = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(n_words)))

    def same(x: Column, y: Column) -> Column:
        differ = x.bitwiseXOR(y)
        return F.coalesce((differ >= 0) & (differ < low), F.lit(False))

    again = F.filter(p, lambda x, i: same(x, F.get(p, i - 1)) | same(x, F.get(p, i + 1)))
    places = F.array_sort(F.transform(again, lambda x: x.bitwiseAND(low - 1)))
    return let(places, lambda q: F.aggregate(
        F.transform(q, lambda x, i: F.least(F.lit(3).cast("long"),
                                            F.coalesce(F.get(q, i + 1) - x, F.lit(3).cast("long")))),
        F.lit(0).cast("long"), lambda a, b: a + b))


def _normal(line: Column) -> Column:
    blanks = F.regexp_replace(F.btrim(line, F.lit(SPACES)), SPACE_RUN, " ")
    return F.regexp_replace(F.lower(blanks), "[0-9]+", "0")


def text_features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  host: str = "source") -> DataFrame:
    """(doc_id, host, _text, base columns, lines array of (h, n)) per document."""
    t = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), F.md5(t.cast("binary")).alias("_text"),
        let(words(t), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _packed_windows(w).alias("windows"))).alias("_w"),
        F.length(F.regexp_replace(t, "[^" + SYMBOLS + "]+", "")).cast("long").alias("n_symbols"),
        let(F.filter(F.split(t, "\n"), lambda x: F.rlike(x, F.lit(WORD))), lambda ls: F.struct(
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup"),
            F.transform(ls, lambda x: F.struct(
                F.substring(F.md5(_normal(x).cast("binary")), 1, 16).alias("h"),
                F.size(F.split(F.btrim(x, F.lit(SPACES)), SPACE_RUN)).cast("long").alias("n")))
            .alias("lines"))).alias("_l"))
    sorted_windows = base.withColumn("_p", F.sort_array(F.col("_w.windows")))
    return sorted_windows.select(
        "doc_id", "host", "_text", F.col("_w.n_words").alias("n_words"),
        F.col("_w.word_chars").alias("word_chars"), "n_symbols",
        F.col("_l.n_dup").alias("n_dup_lines"),
        _repeated_words(F.col("_p"), F.col("_w.n_words")).alias("n_repeat_words"),
        F.col("_l.lines").alias("lines"))


def document_lines(features: DataFrame) -> DataFrame:
    """(host, _text, pos, h, n): a row per non-blank line."""
    return (features.where(F.size("lines") > 0)
            .select("host", "_text", F.posexplode("lines").alias("pos", "_line"))
            .select("host", "_text", "pos", F.col("_line.h").alias("h"), F.col("_line.n").alias("n")))


def frequent_lines(lines: DataFrame, max_docs: int = 50) -> DataFrame:
    """(host, h, n_docs, n_rows) of the lines above the limit."""
    return (lines.groupBy("host", "h", "_text").agg(F.count(F.lit(1)).alias("_c"))
            .groupBy("host", "h").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("_c").alias("n_rows"))
            .where(F.col("n_docs") > max_docs))


def line_quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
                 max_docs: int = 50, min_left: float = 0.5, min_words: int = 50,
                 max_repeat: float = 0.5) -> DataFrame:
    """One row per document: base counts, n_boilerplate_words, base_failed, kept."""
    features = stored(text_features(docs, doc_id, text, host), "line-features")
    lines = document_lines(features)
    frequent = stored(frequent_lines(lines, max_docs), "frequent-lines")
    hits = (lookup_join(lines, frequent, ["host", "h"], "n_rows")
            .where(F.col("n_docs").isNotNull())
            .groupBy("host", "_text", "pos").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("_copies"))
            .groupBy("host", "_text").agg(F.sum("n").alias("_boilerplate"), F.max("_copies").alias("_copies")))
    judged = lookup_join(features.drop("lines"), hits, ["host", "_text"], "_copies")
    removed = F.coalesce(F.col("_boilerplate"), F.lit(0).cast("long"))
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        removed.alias("n_boilerplate_words"), failed.alias("base_failed"),
        (~failed & (F.col("n_words") - removed >= min_left * F.col("n_words"))).alias("kept"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
win AS (
  SELECT r, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS k
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM win) WHERE c > 1),
rep AS (
  SELECT r, sum(least(3, coalesce(nx - i, 3)))::bigint AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nx FROM dup) GROUP BY r),
ln AS (
  SELECT r, source, md5(t) AS th, unnest(string_split(t, chr(10))) AS l FROM d),
lines AS (
  SELECT r, source, th, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n,
         left(md5(regexp_replace(lower(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')),
                                 '[0-9]+', '0', 'g')), 16) AS h
  FROM ln WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dl AS (SELECT r, (count(*) - count(DISTINCT l))::bigint AS n FROM lines GROUP BY r),
freq AS (SELECT source, h FROM lines GROUP BY source, h HAVING count(DISTINCT th) > 50),
boil AS (
  SELECT l.r, sum(l.n)::bigint AS n FROM lines l
  JOIN freq f ON l.h = f.h AND l.source IS NOT DISTINCT FROM f.source GROUP BY l.r),
o AS (
  SELECT d.doc_id, len(w.w)::bigint AS n_words,
         coalesce(length(array_to_string(w.w, '')), 0)::bigint AS word_chars,
         length(regexp_replace(d.t, '[^#*$%&|<>]+', '', 'g'))::bigint AS n_symbols,
         coalesce(dl.n, 0)::bigint AS n_dup_lines, coalesce(rep.n, 0)::bigint AS n_repeat_words,
         coalesce(boil.n, 0)::bigint AS n_boilerplate_words
  FROM d JOIN w USING (r) LEFT JOIN dl USING (r) LEFT JOIN rep USING (r) LEFT JOIN boil USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND 2 * (n_words - n_boilerplate_words) >= n_words AS kept
FROM o
"""

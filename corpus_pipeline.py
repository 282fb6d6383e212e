"""The corpus pipeline: documents in, a training mix out.

Each stage is one operator of ``encore.llm`` applied to all that the stage before
kept; ``run`` writes every stage's rows as Parquet in the shared folder and reads
them again. All stages but the last return the columns of ``documents``; the last
returns the mix: one row per kept document with its redacted text, its words taken
and its training positions, range-sorted by position.

Defined results: a document with a NULL text is kept or rejected like an empty one;
texts of any length are judged whole; of each group of near-duplicate texts (repeated
rows included) one row stays, whatever ids the texts have, the smallest by (doc_id, md5
of the text) with NULL ids last; rows that tie in both are equal but for their other
columns, and any one of them stays; empty tables give no rows (without labels every
document is selected, without benchmark items none is contaminated). Further columns
are kept as they are by all stages but the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.functions.bitset import bit_array, has_bit, slot_of
from encore.llm import decontaminate as _clean
from encore.llm import mixing as _mixing
from encore.llm import pii as _pii
from encore.llm import quality_ordinal as _quality
from encore.llm import simhash as _simhash
from encore.llm.common import free_name, lookup_join, stored, table

# Bits of the set of keys that the near-duplicate stage decides on (2 MB).
DECISION_BITS = 24


def _row(docs: DataFrame):
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose tail probability of grade 1 or better is at least 0.5."""
    rating = free_name("rating", docs)
    grades = _quality.label_grades(table(spark, sf_dir, "labels"))
    rated = _quality.rate(docs, _quality.fit(docs, grades), out=rating)
    return rated.where(_quality.selected(rating)).drop(rating)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first row by (doc_id, hash of the text), NULL ids last, of each SimHash
    group (4-word shingles, 4 differing bits).

    Only rows of groups with more than one row are decided on. A bit set of their keys
    lets the others through where they are, so texts without a near copy (and those few
    that share a bit) are not shuffled.
    """
    decisions = stored(_simhash.group_decisions(docs, shingle=4, radius=4), "duplicate-decisions")
    slot = slot_of(DECISION_BITS, F.col("doc_id"), F.col("hash"))
    found = bit_array(decisions.select(slot.alias("slot")).distinct(), "slot", DECISION_BITS)
    keyed = docs.select(_row(docs), "doc_id", _simhash.text_hash("text").alias("hash"))
    asked = lookup_join(keyed.where(has_bit(found, slot)), decisions, ["doc_id", "hash"], "copies", keep_weight=True)
    asked = stored(asked.where(F.coalesce("stays", F.lit(True))), "duplicate-asked")
    copied = F.coalesce(F.col("copies") > 1, F.lit(False))
    return (keyed.where(~has_bit(found, slot)).select("row")
            .unionByName(asked.where(~copied).select("row"))
            .unionByName(asked.where(copied).dropDuplicates(["doc_id", "hash"]).select("row"))
            .select("row.*"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents without a verified benchmark passage."""
    verdict = free_name("verdict", docs)
    found = _clean.decontaminate(docs, table(spark, sf_dir, "benchmark"), out=verdict)
    return found.where(~F.col(f"{verdict}.contaminated")).drop(verdict)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets."""
    spans, text = free_name("spans", docs), free_name("clean", docs)
    clean = _pii.find_spans(docs, out=spans).withColumn(text, _pii.redact(F.col("text"), F.col(spans)))
    new = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return clean.select(*[new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col(f"`{c}`")
                          for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix of what is left, ordered by training position, with the texts.

    The plan is made from narrow rows; the texts meet it by their place in a written
    table, since ids may be NULL or repeated. Only the columns that the mix returns or
    plans by are written, as plain columns: a nested row costs its readers more memory.
    """
    held = stored(docs.select("doc_id", "text", "source"), "mix-docs").select(
        "*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("line"))
    plan = _mixing.curriculum_plan(held, keep=("file", "line"))
    texts = held.select("text", "file", "line")
    whole = plan.withColumns({"file": F.col("kept.file"), "line": F.col("kept.line")}).drop("kept")
    return _mixing.training_order(whole.join(texts, ["file", "line"]).drop("file", "line"))


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("pii redaction", redact_pii),
    ("source mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs


# The fitted classifiers cannot be written in SQL; tests/llm compares each stage's
# effect with a brute-force version.
ORACLE_SQL = None

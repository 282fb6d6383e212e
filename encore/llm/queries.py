"""Registered queries of this subpackage and the DuckDB SQL of those that SQL
can express. Each query applies its operator to the whole of its table."""

from __future__ import annotations

from . import (
    collocations,
    decontaminate,
    license_scan,
    line_quality,
    mixing,
    pii,
    quality_ordinal,
    resample,
    sharding,
    simhash,
    suffix_dedup,
    toxicity,
    url_graph,
)
from .common import table

QUERIES = {
    "op1_toxicity": lambda spark, d: toxicity.toxicity(table(spark, d, "documents"), table(spark, d, "labels")),
    "op2_line_quality": lambda spark, d: line_quality.line_quality(table(spark, d, "documents")),
    "op3_simhash": lambda spark, d: simhash.near_duplicates(table(spark, d, "documents")),
    "op4_mixing": lambda spark, d: mixing.mix_query(table(spark, d, "documents")),
    "op5_suffix_dedup": lambda spark, d: suffix_dedup.suffix_query(table(spark, d, "documents")),
    "op6_license_scan": lambda spark, d: license_scan.license_query(table(spark, d, "documents")),
    "op7_pii": lambda spark, d: pii.pii_query(table(spark, d, "documents")),
    "op8_quality_ordinal": lambda spark, d: quality_ordinal.quality(
        table(spark, d, "documents"), quality_ordinal.label_grades(table(spark, d, "labels"))),
    "op9_decontaminate": lambda spark, d: decontaminate.contamination_query(
        table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op10_url_graph": lambda spark, d: url_graph.url_filter(table(spark, d, "pages")),
    "op11_collocations": lambda spark, d: collocations.collocations(table(spark, d, "documents")),
    "op12_resample": lambda spark, d: resample.resample_query(
        table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op13_sharding": lambda spark, d: sharding.shard_query(table(spark, d, "documents")),
}

ORACLE_SQL = {
    "op2_line_quality": line_quality.ORACLE_SQL,
    "op4_mixing": mixing.ORACLE_SQL,
    "op10_url_graph": url_graph.ORACLE_SQL,
    "op11_collocations": collocations.ORACLE_SQL,
    "op12_resample": resample.ORACLE_SQL,
    "op13_sharding": sharding.ORACLE_SQL,
}

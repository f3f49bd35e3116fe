"""The numbered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import cascade, chunks, codes, compression, contamination, html, language, neardup, quality, rollup, sstable, templates, variants

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_shards": sstable.op1_token_shards,
    "op2_quality": quality.op2_quality,
    "op3_url_rules": cascade.op3_url_rules,
    "op4_contamination": contamination.op4_contamination,
    "op5_line_templates": templates.op5_line_templates,
    "op6_near_duplicates": neardup.op6_near_duplicates,
    "op7_token_rollup": rollup.op7_token_rollup,
    "op8_main_text": html.op8_main_text,
    "op9_chunked_bpe": chunks.op9_chunked_bpe,
    "op10_language": language.op10_language,
    "op11_spelling_variants": variants.op11_spelling_variants,
    "op12_vector_codes": codes.op12_vector_codes,
    "op13_compression_quality": compression.op13_compression_quality,
}

ORACLES: dict[str, str] = {
    "op3_url_rules": cascade.ORACLE,
    "op4_contamination": contamination.ORACLE,
    "op5_line_templates": templates.ORACLE,
    "op6_near_duplicates": neardup.ORACLE,
    "op11_spelling_variants": variants.ORACLE,
    "op12_vector_codes": codes.ORACLE,
}

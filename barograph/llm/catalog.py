"""The queries of this subpackage by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barograph.llm import bytespans, classifier, decontaminate, divergence, embeddings, extraction, filter_audit, mixing, packing, pseudo_likelihood, simhash, substrings, templates

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substrings": substrings.op1_substrings,
    "op2_templates": templates.op2_templates,
    "op3_packing": packing.op3_packing,
    "op4_pseudo_likelihood": pseudo_likelihood.op4_pseudo_likelihood,
    "op5_suffix_array": bytespans.op5_suffix_array,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_simhash": simhash.op7_simhash,
    "op8_embeddings": embeddings.op8_embeddings,
    "op9_mixing": mixing.op9_mixing,
    "op10_quality": classifier.op10_quality,
    "op11_html_extraction": extraction.op11_html_extraction,
    "op12_source_divergence": divergence.op12_source_divergence,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op9_mixing": mixing.OP9_SQL,
    "op12_source_divergence": divergence.OP12_SQL,
    "op13_filter_audit": filter_audit.OP13_SQL,
}

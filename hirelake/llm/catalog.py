"""Registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hirelake.llm import (
    alignment,
    collocations,
    counts,
    fingerprints,
    jaccard,
    licenses,
    lines,
    mixing,
    neighbours,
    packing,
    simhash,
    suffixes,
    toxicity,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One for each operator, over whole tables."""
    return {
        "op1_token_counts": counts.op1,
        "op2_best_fit_packing": packing.op2,
        "op3_fingerprints": fingerprints.op3,
        "op4_suffix_dedup": suffixes.op4,
        "op5_mixing": mixing.op5,
        "op6_ngram_jaccard": jaccard.op6,
        "op7_toxicity": toxicity.op7,
        "op8_license_scan": licenses.op8,
        "op9_line_dedup": lines.op9,
        "op10_nearest": neighbours.op10,
        "op11_collocations": collocations.op11,
        "op12_simhash": simhash.op12,
        "op13_token_alignment": alignment.op13,
    }


def oracle_sql() -> dict[str, str]:
    """Where SQL can express the operator; the others are tested against brute force in tests/llm."""
    return {"op9_line_dedup": lines.OP9_SQL, "op11_collocations": collocations.OP11_SQL}

"""Candidates against the stored index: profile -> filtered hybrid search -> rerank -> report rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.functions import text, vectors
from hirelake.operators import contract, search


@dataclass(frozen=True)
class Match:
    """Results of one matching run; each is a lazy frame keyed by ``qid``."""

    profiles: DataFrame
    ranked: DataFrame
    context: DataFrame
    cards: DataFrame
    gaps: DataFrame


def match(
    candidates: DataFrame,
    index: DataFrame,
    silver: DataFrame,
    k: int = 30,
    n: int = 10,
    scorer=search.token_overlap,
    answers: DataFrame | None = None,
) -> Match:
    """Match every candidate (qid, cv_text) at once.

    Years and query come from the rule profile, or from ``answers`` (qid, answer) of a profile model,
    read as 'YOE:' / 'QUERY:' lines. ``index`` and ``silver`` are tables as ``plans.batch`` writes
    them. Candidates without a match stay in ``context`` with n_matches = 0.
    """
    profiles = contract.candidate_profiles(candidates.select(F.col("qid").cast("string"), "cv_text"), "qid", "cv_text")
    if answers is not None:
        yoe, line = text.profile_lines("answer", "cv_text")
        told = answers.select(F.col("qid").cast("string"), "answer")
        profiles = profiles.join(told, "qid", "left").select(
            "qid",
            F.when(F.col("answer").isNull(), F.col("yoe")).otherwise(yoe).alias("yoe"),
            F.when(F.col("answer").isNull(), F.col("query")).otherwise(line).alias("query"),
            "skills",
            "cv_text",
        )
    q = search.measured(
        vectors.with_query_vectors(profiles.select("qid", "yoe", F.col("query").alias("text")), "text")
    )
    corpus = index.select(
        F.col("point_id").alias("id"),
        F.col("metadata.yoe").alias("yoe"),
        F.col("page_content").alias("text"),
        F.col("metadata.job_title").alias("title"),
        F.col("metadata.source").alias("source"),
        "page_content",
        "metadata",
        "dense",
        "terms",
        "weights",
    )
    fused = search.fuse(search.top_k(q, corpus, k=k), k)
    ranked = search.rerank(
        fused, q, corpus, k, n, scorer, dedupe=["page_content"], carry=["page_content", "metadata"]
    )
    hits = q.hint(ranked.select("qid", "rank", F.col("metadata.job_id").alias("job_id")), n)
    needed = silver.select("job_id", text.json_list("ai_core_tech_stack").alias("required")).join(hits, "job_id")
    pairs = needed.join(q.hint(profiles.select("qid", "skills")), "qid")
    gaps = search.skill_gap(pairs, "required", "skills").select("qid", "rank", "job_id", "matched", "missing")
    return Match(profiles, ranked, search.context(ranked, q), search.cards(ranked), gaps)

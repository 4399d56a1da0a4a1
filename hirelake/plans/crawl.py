"""Saved listing and detail pages of both sites -> what ``plans.batch.run_batch`` takes in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake import schemas as S
from hirelake.operators.staging import union_sources
from hirelake.sources import pages

# crawl order: keyword by keyword, page by page, card by card
CRAWL_ORDER = ["source", "keyword_idx", "page_no", "card_idx"]


def _site_cards(listing: DataFrame, rules: pages.CardRules, source: str, crawl_time: Column) -> DataFrame:
    position = F.array_position(F.array(*[F.lit(k) for k in S.KEYWORDS]), F.col("keyword"))
    ready = listing.withColumn(
        "keyword_idx", F.when(position > 0, position).otherwise(F.lit(len(S.KEYWORDS) + 1))
    )
    keep = ("keyword", "keyword_idx", "page_no")
    found = pages.cards(ready, rules, keep)
    return pages.cards_to_raw(found, source, F.col("keyword"), crawl_time, keep[1:])


def listing_cards(site_a: DataFrame, site_b: DataFrame, crawl_time: Column) -> DataFrame:
    """Bronze-shaped cards of both sites with their ``CRAWL_ORDER`` columns.

    A listing frame has page_id, url, html, keyword and page_no. Repeats of a job stay in; the
    bronze insert keeps the first in crawl order. Only site B answers with refusal pages.
    """
    return union_sources(
        _site_cards(site_a, pages.SITE_A_CARDS, S.SITE_A, crawl_time),
        _site_cards(site_b.where(~pages.blocked("html")), pages.SITE_B_CARDS, S.SITE_B, crawl_time),
    )


def detail_texts(site_a: DataFrame, site_b: DataFrame) -> DataFrame:
    """(source, job_id, job_description) of saved detail pages: page_id = job id, html, HTTP status.

    A bad status is final on site A ('Error <code>') and worth another fetch on site B.
    """
    parts = {
        S.SITE_A: pages.job_descriptions(site_a, pages.SITE_A_JD, "status", check_blocked=False),
        S.SITE_B: pages.job_descriptions(site_b, pages.SITE_B_JD, "status", S.JD_CONNECTION_ERROR),
    }
    rows = [df.select(F.lit(s).alias("source"), F.col("page_id").alias("job_id"), "job_description") for s, df in parts.items()]
    return union_sources(*rows)

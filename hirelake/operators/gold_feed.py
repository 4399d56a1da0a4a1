"""Gold aggregates kept up to date by a change feed: signed counts that can be taken back.

A changed silver row counts -1 as it was and +1 as it is. States hold sums and counts, never averages or
distinct counts, so deltas add up in any order. Silver is keyed: a job counts once for each of its skills.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake import schemas as S
from hirelake.operators import gold

SKILLS, ROLES, LEVELS = ["skill", "source"], ["job_role", "source"], ["job_level", "skill", "source"]


def signed(feed: DataFrame) -> DataFrame:
    """Feed rows (before, after) as silver rows with ``sign``."""
    was = feed.where("before IS NOT NULL").select("before.*", F.lit(-1).cast("long").alias("sign"))
    now = feed.where("after IS NOT NULL").select("after.*", F.lit(1).cast("long").alias("sign"))
    return was.unionByName(now)


def as_feed(rows: DataFrame) -> DataFrame:
    """Whole rows as a feed of insertions: the first state of an aggregate."""
    row = F.struct(*rows.columns)
    return rows.select(F.when(F.lit(False), row).alias("before"), row.alias("after"))


def skill_deltas(feed: DataFrame) -> DataFrame:
    rows = gold.skills_exploded(signed(feed), "source", "sign", distinct=True)
    return rows.groupBy(*SKILLS).agg(F.sum("sign").alias("total_mentions"))


def role_deltas(feed: DataFrame) -> DataFrame:
    role, years = F.col("ai_job_role"), F.col("min_years_of_experience")
    rows = signed(feed).where((role != S.UNKNOWN) & (role != S.ERROR))
    return rows.groupBy(role.alias("job_role"), "source").agg(
        F.sum("sign").alias("total_jobs"),
        F.coalesce(F.sum(F.col("sign") * years), F.lit(0)).alias("years"),
        F.coalesce(F.sum(F.when(years.isNotNull(), F.col("sign"))), F.lit(0)).alias("with_years"),
    )


def level_deltas(feed: DataFrame) -> DataFrame:
    level = F.col("job_level")
    rows = signed(feed).where((level != S.ERROR) & (level != S.UNKNOWN))
    rows = gold.skills_exploded(rows, "job_level", "source", "sign")
    return rows.groupBy(*LEVELS).agg(F.sum("sign").alias("mentions"))


def add(state: DataFrame, delta: DataFrame, key: list[str]) -> DataFrame:
    """``state`` moved on by ``delta``; groups without rows go. The first value column counts rows."""
    values = [c for c in state.columns if c not in key]
    both = state.unionByName(delta.select(state.columns))
    return both.groupBy(*key).agg(*[F.sum(v).alias(v) for v in values]).where(F.col(values[0]) != 0).select(state.columns)


def role_summary(state: DataFrame) -> DataFrame:
    """The role state as `gold.role_summary` gives it."""
    mean = F.when(F.col("with_years") > 0, F.round(F.col("years") / F.col("with_years"), 1))
    return state.select("job_role", "source", "total_jobs", mean.alias("avg_years_required"))


# --- approximate distinct counts, on request --------------------------------------------------------

#: Logarithm of a sketch's registers; one standard error is about 1.04 / sqrt(2**LG_K).
LG_K = 12


def skill_sketches(rows: DataFrame, *batch: str, lg_k: int = LG_K) -> DataFrame:
    """(skill, source, *batch, sketch): a mergeable sketch of the jobs of each skill, source and batch.

    Sketches of any batches can be merged later, also where a job stands in several of them: what exact
    counts would need all job ids for.
    """
    items = gold.skills_exploded(rows, "job_id", "source", *batch, distinct=True)
    return items.groupBy("skill", "source", *batch).agg(F.hll_sketch_agg("job_id", F.lit(lg_k)).alias("sketch"))


def approximate_skill_counts(sketches: DataFrame) -> DataFrame:
    """(skill, source, total_mentions): estimated distinct jobs over all sketches given."""
    merged = sketches.groupBy("skill", "source").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("skill", "source", F.hll_sketch_estimate("sketch").alias("total_mentions"))

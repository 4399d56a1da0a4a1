"""Gold aggregates and market reports over silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake import schemas as S
from hirelake.functions import text


def skills_exploded(silver: DataFrame, *keep: str, distinct: bool = False) -> DataFrame:
    """One row per list item of the JSON skill column, blanks and NULLs dropped.

    The plain-column guards reach the Parquet scan; the item guard runs on the array, before rows
    are multiplied.
    """
    stack = F.col("ai_core_tech_stack")
    items = F.filter(text.json_list(stack), lambda x: x.isNotNull() & (x != ""))
    if distinct:
        items = F.array_distinct(items)
    return silver.where(stack.isNotNull() & (stack != "[]")).select(*keep, F.explode(items).alias("skill"))


def skill_counts(silver: DataFrame, keyed: bool = False) -> DataFrame:
    """Distinct jobs per (skill, source).

    With ``keyed`` the caller vouches for one row per job_id (silver tables are written so): repeats
    are then dropped inside the row, and only (skill, source) partial counts are shuffled.
    """
    if keyed:
        rows = skills_exploded(silver, "source", distinct=True)
        return rows.groupBy("skill", "source").agg(F.count("*").alias("total_mentions"))
    rows = skills_exploded(silver, "job_id", "source")
    return rows.groupBy("skill", "source").agg(F.countDistinct("job_id").alias("total_mentions"))


def role_summary(silver: DataFrame) -> DataFrame:
    """Jobs and mean years per (role, source)."""
    role = F.col("ai_job_role")
    return (
        silver.where((role != S.UNKNOWN) & (role != S.ERROR))
        .groupBy(role.alias("job_role"), "source")
        .agg(
            F.count("*").alias("total_jobs"),
            F.round(F.avg("min_years_of_experience"), 1).alias("avg_years_required"),
        )
    )


def skills_by_level(silver: DataFrame) -> DataFrame:
    """Mentions per (level, skill, source); a skill listed twice counts twice."""
    level = F.col("job_level")
    rows = skills_exploded(silver.where((level != S.ERROR) & (level != S.UNKNOWN)), "job_level", "source")
    return rows.groupBy("job_level", "skill", "source").agg(F.count("*").alias("mentions"))


def level_demand(silver: DataFrame) -> DataFrame:
    """Jobs per level, all statuses, NULL level included; largest first."""
    return (
        silver.groupBy(F.col("job_level").alias("level"))
        .agg(F.count("*").alias("total_jobs"))
        .orderBy(F.desc("total_jobs"), F.asc_nulls_last("level"))
    )


def role_demand(silver: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent roles."""
    return (
        silver.groupBy(F.col("ai_job_role").alias("role"))
        .agg(F.count("*").alias("total_jobs"))
        .orderBy(F.desc("total_jobs"), F.asc_nulls_last("role"))
        .limit(n)
    )


def csv_skill_demand(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent tokens of a comma-separated column.

    Empty and 'Unknown' tokens are dropped before trimming, so a blank token survives as ''.
    """
    raw = F.filter(F.split(F.col(column), ","), lambda x: (x != "") & (x != S.UNKNOWN))
    return (
        df.select(F.explode(raw).alias("raw"))
        .groupBy(F.trim("raw").alias("tech_skill"))
        .agg(F.count("*").alias("mentions"))
        .orderBy(F.desc("mentions"), F.asc("tech_skill"))
        .limit(n)
    )

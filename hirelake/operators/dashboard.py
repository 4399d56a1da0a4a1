"""Dashboard queries over silver: KPIs, distributions, filter options, KPI cube."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake import schemas as S
from hirelake.functions import text
from hirelake.operators.gold import skills_exploded


def selection(source: str | None = None, level: str | None = None) -> Column:
    """Active rows, narrowed to a source and a level when given."""
    parts = [F.col("status") == S.ACTIVE]
    if source is not None:
        parts.append(F.col("source") == source)
    if level is not None:
        parts.append(F.col("job_level") == level)
    return reduce(and_, parts)


def _kpi_aggs() -> list[Column]:
    """Job count leaves 'Error' and NULL levels out; the mean and the English count do not."""
    english = F.col("english_requirement")
    return [
        F.count_if(F.col("job_level") != S.ERROR).alias("jobs"),
        F.coalesce(F.round(F.avg("min_years_of_experience"), 1), F.lit(0.0)).alias("avg_yoe"),
        F.count_if(english != S.ENGLISH_NONE).alias("english_jobs"),
    ]


def _english_pct() -> Column:
    pct = F.round(F.lit(100.0) * F.col("english_jobs") / F.col("jobs"), 1)
    return F.when(F.col("jobs") > 0, pct).otherwise(F.lit(0.0)).alias("english_pct")


def kpis(silver: DataFrame, source: str | None = None, level: str | None = None) -> DataFrame:
    """One row: job count (plain and formatted), mean years, English demand. One pass."""
    one = silver.where(selection(source, level)).agg(*_kpi_aggs())
    return one.select("jobs", text.thousands("jobs").alias("jobs_text"), "avg_yoe", "english_jobs", _english_pct())


def kpi_cube(silver: DataFrame) -> DataFrame:
    """KPIs of every (source or all) x (level or all) selection; ``*_all`` = 1 marks 'all'.

    Rows are summed per (source, level) first, so the cube expands a few hundred rows, not the table.
    """
    english, years = F.col("english_requirement"), F.col("min_years_of_experience")
    cells = (
        silver.where(F.col("status") == S.ACTIVE)
        .groupBy("source", "job_level")
        .agg(
            F.count_if(F.col("job_level") != S.ERROR).alias("jobs"),
            F.sum(years.cast("bigint")).alias("years"),
            F.count(years).alias("n_years"),
            F.count_if(english != S.ENGLISH_NONE).alias("english_jobs"),
        )
    )
    cube = cells.cube("source", "job_level").agg(
        F.grouping("source").cast("int").alias("source_all"),
        F.grouping("job_level").cast("int").alias("level_all"),
        F.sum("jobs").alias("jobs"),
        F.coalesce(F.round(F.try_divide(F.sum("years"), F.sum("n_years")), 1), F.lit(0.0)).alias("avg_yoe"),
        F.sum("english_jobs").alias("english_jobs"),
    )
    return cube.select(
        "source", "job_level", "source_all", "level_all", "jobs", "avg_yoe", "english_jobs", _english_pct()
    )


def levels(silver: DataFrame) -> DataFrame:
    """Active jobs per level, largest first."""
    return (
        silver.where(selection() & (F.col("job_level") != S.ERROR))
        .groupBy("job_level")
        .agg(F.count("*").alias("n_jobs"))
        .orderBy(F.desc("n_jobs"), "job_level")
    )


def yoe_histogram(silver: DataFrame, max_bins: int = 10) -> DataFrame:
    """Active jobs per equal-width bin of years, at most ``max_bins`` bins, empty bins left out.

    Counts per distinct year come first, so the range lookup reads a handful of rows.
    """
    yoe = F.col("min_years_of_experience")
    counts = silver.where(selection() & yoe.isNotNull()).groupBy(yoe.alias("yoe")).agg(F.count("*").alias("n"))
    # the sum keeps this plan equal to the outer one up to its exchange, which Spark then reuses
    ends = counts.agg(F.struct(F.min("yoe").alias("low"), F.max("yoe").alias("high"), F.sum("n").alias("n"))).scalar()
    low = ends["low"].cast("bigint")
    width = F.greatest(F.lit(1), F.ceil((ends["high"] - low + 1) / max_bins))
    start = low + F.floor((F.col("yoe") - low) / width) * width
    return (
        counts.select(start.cast("bigint").alias("bin_start"), (start + width).cast("bigint").alias("bin_end"), "n")
        .groupBy("bin_start", "bin_end")
        .agg(F.sum("n").alias("n_jobs"))
        .orderBy("bin_start")
    )


def source_options(silver: DataFrame) -> DataFrame:
    """Sources to choose from, any status."""
    src = F.col("source")
    return silver.where(src.isNotNull() & (src != "")).select("source").distinct().orderBy("source")


def level_options(silver: DataFrame) -> DataFrame:
    """Levels to choose from, any status: known levels in career order, then the rest by name."""
    lvl = F.col("job_level")
    present = silver.where((lvl != S.ERROR) & (lvl != "")).select("job_level").distinct()
    pos = F.array_position(F.array(*[F.lit(x) for x in S.LEVEL_ORDER]), lvl)
    position = F.when(pos > 0, pos).otherwise(F.lit(len(S.LEVEL_ORDER) + 1)).cast("int")
    return present.withColumn("position", position).orderBy("position", "job_level")


def top_skills(silver: DataFrame, source: str | None = None, level: str | None = None, n: int = 10) -> DataFrame:
    """The ``n`` most mentioned skills of a selection."""
    rows = skills_exploded(silver.where(selection(source, level) & (F.col("job_level") != S.ERROR)))
    return (
        rows.groupBy("skill")
        .agg(F.count("*").alias("total_mentions"))
        .orderBy(F.desc("total_mentions"), F.asc("skill"))
        .limit(n)
    )


def english_levels(silver: DataFrame, source: str | None = None, level: str | None = None) -> DataFrame:
    """Jobs per English requirement of a selection."""
    return (
        silver.where(selection(source, level) & F.col("english_requirement").isNotNull())
        .groupBy("english_requirement")
        .agg(F.count("*").alias("n_jobs"))
        .orderBy(F.desc("n_jobs"), "english_requirement")
    )

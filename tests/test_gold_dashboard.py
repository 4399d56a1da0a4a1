from __future__ import annotations

from pyspark.sql import functions as F

from hirelake import schemas as S
from hirelake.operators import dashboard, gold
from hirelake.sources import tables
from tests.test_state import silver


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_repeated_skill_counts(spark):
    df = silver(
        spark,
        {"job_id": "1", "source": "A", "job_level": "Senior", "ai_core_tech_stack": '["a","a","",null]'},
        {"job_id": "2", "source": "A", "job_level": None, "ai_core_tech_stack": '["a"]'},
        {"job_id": "3", "source": "A", "job_level": "Senior", "ai_core_tech_stack": "[]"},
        {"job_id": "4", "source": "A", "job_level": "Error", "ai_core_tech_stack": "oops"},
    )
    assert rows(gold.skill_counts(df)) == rows(gold.skill_counts(df, keyed=True)) == [("a", "A", 2)]
    assert rows(gold.skills_by_level(df)) == [("Senior", "a", "A", 2)]


def test_unkeyed_rows_count_a_job_once(spark):
    df = silver(spark, *[{"job_id": "1", "source": "A", "ai_core_tech_stack": '["a"]'}] * 3)
    assert rows(gold.skill_counts(df)) == [("a", "A", 1)]


def test_role_summary(spark):
    df = silver(
        spark,
        *[{"job_id": str(i), "source": "A", "ai_job_role": r} for i, r in enumerate(["X", "X", "Unknown", "Error", None])],
    )
    assert rows(gold.role_summary(df)) == [("X", "A", 2, None)]


def test_csv_tokens(spark):
    df = spark.createDataFrame([("Python, AWS,, ,Unknown",), (None,)], "s string")
    assert sorted(rows(gold.csv_skill_demand(df, "s"))) == [("", 1), ("AWS", 1), ("Python", 1)]


def test_kpis_of_nothing(spark):
    assert rows(dashboard.kpis(silver(spark))) == [(0, "0", 0.0, 0, 0.0)]
    assert rows(dashboard.yoe_histogram(silver(spark))) == []


def test_filters_are_values_not_text(spark):
    df = silver(spark, {"job_id": "1", "source": "x' OR '1'='1", "status": "Active", "job_level": "Senior"})
    assert dashboard.kpis(df, source="x' OR '1'='1").first().jobs == 1
    assert dashboard.kpis(df, source="y").first().jobs == 0


def test_cube_agrees_with_kpis(spark):
    data = [
        {"job_id": str(i), "source": "AB"[i % 2], "status": "Active", "job_level": [None, "Senior", "Error"][i % 3],
         "min_years_of_experience": i if i % 5 else None, "english_requirement": S.ENGLISH_LEVELS[i % 4]}
        for i in range(40)
    ]
    df = silver(spark, *data)
    cube = dashboard.kpi_cube(df)
    total = cube.where("source_all = 1 AND level_all = 1").select("jobs", "avg_yoe", "english_jobs", "english_pct")
    one = dashboard.kpis(df).select("jobs", "avg_yoe", "english_jobs", "english_pct")
    assert rows(total) == rows(one)
    cell = cube.where("source = 'A' AND level_all = 0 AND job_level = 'Senior'").select("jobs", "avg_yoe", "english_pct")
    assert rows(cell) == rows(dashboard.kpis(df, "A", "Senior").select("jobs", "avg_yoe", "english_pct"))
    # a missing level is a row of its own, apart from 'all levels'
    assert cube.where("job_level IS NULL AND source = 'A'").count() == 2


def test_level_options(spark):
    df = silver(spark, *[{"job_id": str(i), "job_level": v} for i, v in enumerate(["Senior", "Zeta", "Intern", "Error", "", None, "Alpha"])])
    assert [r.job_level for r in dashboard.level_options(df).collect()] == ["Intern", "Senior", "Alpha", "Zeta"]


def test_histogram_bins(spark):
    df = silver(spark, *[{"job_id": str(i), "status": "Active", "min_years_of_experience": y} for i, y in enumerate([0, 1, 24, 24, None])])
    assert rows(dashboard.yoe_histogram(df)) == [(0, 3, 2), (24, 27, 2)]


def test_profile_and_peek(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    assert rows(tables.profile({"t": df})) == [("t", "n", 1, "int", 2, 0), ("t", "s", 2, "string", 2, 1)]
    assert rows(tables.peek(df, ["s"], 1)) == [(1, "a")]


def test_hot_skill(spark):
    """A third of all rows under one key: partial counts leave one row per task to shuffle."""
    df = spark.range(30_000).select(
        F.col("id").cast("string").alias("job_id"),
        F.lit("A").alias("source"),
        F.when(F.col("id") < 10_000, F.lit('["hot"]')).otherwise(F.concat(F.lit('["k'), F.col("id"), F.lit('"]'))).alias("ai_core_tech_stack"),
    )
    assert rows(gold.skill_counts(df).orderBy(F.desc("total_mentions")).limit(1)) == [("hot", "A", 10_000)]

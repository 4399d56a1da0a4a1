"""What the physical plans must and must not contain."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from hirelake import schemas as S
from hirelake.operators import dashboard, gold, index, search, staging, state
from hirelake.plans import batch, catalog
from hirelake.sources import testbed

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver"))
    catalog.q32_expire_stale(catalog.Testbed(spark, FOLDER)).write.mode("overwrite").parquet(path)
    return spark.read.schema(S.SILVER).parquet(path)


@pytest.mark.parametrize("name", catalog.queries().keys() - catalog.WRITING)
def test_no_cross_join_and_no_row_udf(spark, name):
    text = plan(catalog.queries()[name](spark, FOLDER))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", text)


def test_pending_is_an_anti_join(stored):
    jobs = stored.select("job_id", "job_url", "job_title", F.lit("x").alias("job_description"))
    assert "LeftAnti" in plan(state.pending_jobs(jobs, stored))


def test_top_skills_keeps_ten_rows_per_task(stored):
    assert "TakeOrderedAndProject" in plan(dashboard.top_skills(stored))


def test_latest_limits_before_the_shuffle(stored):
    text = plan(staging.latest(stored, ["job_id"], "last_seen_at", ["job_title"]))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1


def test_dashboard_filters_reach_the_scan(stored):
    text = plan(dashboard.top_skills(stored, "ITVIEC", "Senior"))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    for part in ("EqualTo(status,Active)", "EqualTo(source,ITVIEC)", "EqualTo(job_level,Senior)", "IsNotNull(ai_core_tech_stack)"):
        assert part in pushed
    columns = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {c.split(":")[0] for c in columns.split(",")} == {"ai_core_tech_stack", "job_level", "source", "status"}


def test_incremental_load_filters_reach_the_scan(stored):
    text = plan(index.to_index(stored, dt.datetime(1998, 4, 25, 9), full=False))
    assert "GreaterThanOrEqual(processed_at,1998-04-25T00:00)" in text and "LessThan(processed_at,1998-04-26T00:00)" in text
    text = plan(index.ids_to_delete(stored, dt.datetime(1998, 4, 25, 9)))
    assert "GreaterThanOrEqual(last_seen_at,1998-04-23T00:00)" in text


def test_keyed_counts_shuffle_once(stored):
    assert plan(gold.skill_counts(stored, keyed=True)).count("Exchange hashpartitioning") == 1


def test_upsert_shuffles_each_side_once(stored):
    text = plan(state.upsert_touch(stored, stored, dt.datetime(2000, 1, 1)))
    assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == 2


def test_few_queries_leave_the_corpus_in_place(spark):
    corpus = spark.range(100).select("id", F.array(F.col("id").cast("double")).alias("dense"))
    hits = search.top_k(corpus.withColumnRenamed("id", "qid").limit(3), corpus, ("dense",), 3)
    assert plan(hits).count("Exchange") == 1  # the partial top rows only


def test_ranking_and_fusion_share_a_shuffle(spark):
    corpus = spark.range(100).select("id", F.array(F.col("id").cast("double")).alias("dense"))
    hits = search.top_k(corpus.withColumnRenamed("id", "qid").limit(3), corpus, ("dense",), 3)
    assert plan(search.fuse(hits)).count("Exchange") == 1


def test_kpi_cube_expands_cells_not_rows(stored):
    text = plan(dashboard.kpi_cube(stored))
    assert text.index("Expand") < text.rindex("Exchange hashpartitioning(source") < text.index("FileScan")


def test_batch_silver_stages_once(spark, tmp_path):
    """q61_batch_silver reads the staged jobs four times; their wide window is made once, and the rows are those of one plan."""
    ts = "TIMESTAMP_NTZ '1997-01-01 00:00:00'"
    spark.sql(
        f"""SELECT id AS o_orderkey, id * 3 AS o_custkey, 'O' AS o_orderstatus, '1-URGENT' AS o_orderpriority,
        {ts} + make_dt_interval(CAST(id * 40 AS INT)) AS o_orderdate FROM range(30)"""
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql(
        f"""SELECT id DIV 3 AS l_orderkey, id AS l_partkey, id % 5 AS l_suppkey, CAST(id % 3 + 1 AS INT) AS l_linenumber,
        CASE id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS l_returnflag, IF(id % 2 = 0, 'O', 'F') AS l_linestatus,
        0.04D AS l_discount, {ts} + make_dt_interval(CAST(id AS INT)) AS l_shipdate FROM range(120)"""
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = catalog.queries()["q61_batch_silver"](spark, str(tmp_path))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "l_shipdate" not in plan and "l_partkey" not in plan

    t = testbed.Testbed(spark, str(tmp_path))
    jobs = batch.staged(t.raw().select(S.RAW.names))
    old = t.silver().where(F.col("processed_at") < catalog._day(catalog.OLD_END))
    records = batch.extract_step(state.pending_jobs(jobs, old, keep=("source",)))
    want = batch.silver_step(old, jobs, records, catalog.AS_OF)
    assert want.count() > 30
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))

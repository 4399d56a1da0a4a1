"""One batch run: saved pages -> bronze -> silver -> gold -> index, on snapshot tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake import schemas as S
from hirelake.functions import vectors
from hirelake.operators import contract, gold, index, staging, state
from hirelake.sources.snapshots import Snapshots

SITES = [(S.SITE_A, S.SITE_A_SILVER), (S.SITE_B, S.SITE_B_SILVER)]

INDEX = T.StructType(
    [
        T.StructField("point_id", T.StringType()),
        T.StructField("page_content", T.StringType()),
        T.StructField(
            "metadata",
            T.StructType(
                [
                    T.StructField("job_id", T.StringType()),
                    T.StructField("job_title", T.StringType()),
                    T.StructField("job_url", T.StringType()),
                    T.StructField("yoe", T.IntegerType()),
                    T.StructField("source", T.StringType()),
                ]
            ),
        ),
        T.StructField("dense", T.ArrayType(T.FloatType())),
        T.StructField("terms", T.ArrayType(T.StringType())),
        T.StructField("weights", T.ArrayType(T.DoubleType())),
    ]
)


def staged(bronze: DataFrame) -> DataFrame:
    """Latest observation per (site, job). Both sites in one frame, so one shuffle serves them."""
    ties = [c for c in S.RAW.names if c not in ("job_id", "source", "crawl_timestamp")]
    return staging.latest(bronze, ["source", "job_id"], "crawl_timestamp", ties)


RECORDS = T.StructType(
    [
        *[f for f in S.SILVER.fields if f.name in ("job_id", "job_url", "job_title")],
        T.StructField("source", T.StringType()),
        T.StructField("record", S.EXTRACTION),
    ]
)


def silver_name() -> Column:
    """The silver spelling of a bronze source."""
    return F.create_map(*[F.lit(x) for pair in SITES for x in pair])[F.col("source")]


def extract_step(pending: DataFrame, extractor: contract.Extractor | None = None) -> DataFrame:
    """One record per pending job; a job id seen on both sites is extracted once."""
    order = [F.asc("source"), F.asc("job_title"), F.asc("job_description")]
    todo = staging.top_per_key(pending.withColumn("source", silver_name()), ["job_id"], order, 1)
    records = contract.extract_with(todo, extractor) if extractor else contract.extract_rules(todo)
    return records.select(RECORDS.names)


def silver_step(
    silver: DataFrame, jobs: DataFrame, records: DataFrame, as_of: dt.datetime, crawl: DataFrame | None = None
) -> DataFrame:
    """touch -> upsert valid records, quarantine the rest -> mark inactive -> expire.

    ``jobs`` is read for ids, sources and URLs only. Valid and broken records go through one join, and ``records`` is read once. Postings vanish when
    ``crawl``, a complete crawl, misses them; without one, when ``jobs`` does.
    """
    out = state.touch_seen(silver, jobs, as_of)
    fresh = state.with_silver_defaults(contract.to_silver(records), as_of, keep=("ok",))
    out = state.upsert_touch(out, fresh, as_of, ok="ok")
    urls = (jobs if crawl is None else crawl).select(silver_name().alias("source"), "job_url")
    return state.expire_stale(state.mark_inactive(out, urls, [name for _, name in SITES]), as_of)


@dataclass(frozen=True)
class BatchResult:
    """Version numbers a run wrote."""

    bronze: int
    descriptions: int
    jobs: int
    records: int
    silver: int
    gold: dict[str, int]
    index: int


#: A posting's identity until silver: two sites may use one id for different postings.
SITE_KEY = ["source", "job_id"]
DESCRIPTIONS = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("job_id", T.StringType()),
        T.StructField("job_description", T.StringType()),
        T.StructField("retry", T.BooleanType()),
    ]
)


def jobs_to_fetch(bronze: DataFrame, stored: DataFrame) -> DataFrame:
    """What an enricher has to fetch: bronze jobs without a settled description."""
    settled = stored.where(~F.col("retry")).select(*SITE_KEY)
    return bronze.select("job_id", "job_url", "source").join(settled, SITE_KEY, "left_anti")


def embed_documents(docs: DataFrame) -> DataFrame:
    return vectors.with_vectors(docs, "page_content")


def new_descriptions(stored: DataFrame, fetched: DataFrame) -> DataFrame:
    """Fetched descriptions to add: those of jobs without a settled one.

    ``retry`` marks texts that call for another fetch, so a later run reads two narrow columns to
    know what is settled.
    """
    settled = stored.where(~F.col("retry")).select(*SITE_KEY)
    rows = fetched.select(
        *SITE_KEY, "job_description", state.needs_description("job_description").alias("retry")
    ).join(settled, SITE_KEY, "left_anti")
    return staging.top_per_key(rows, SITE_KEY, [F.asc("retry"), F.asc("job_description")], 1)


def with_descriptions(jobs: DataFrame, stored: DataFrame) -> DataFrame:
    """Jobs with their settled description, or the newest fetch result if none is settled.

    ``jobs`` should be few: only their descriptions are shuffled.
    """
    rows = stored.join(jobs.select(*SITE_KEY).distinct(), SITE_KEY, "left_semi")
    best = staging.top_per_key(rows, SITE_KEY, [F.asc("retry"), F.desc("v")], 1)
    return state.update_column(jobs, best, SITE_KEY, "job_description")


def report(spark: SparkSession, root: str, result: BatchResult) -> DataFrame:
    """(what, rows): extraction outcome and silver status changes of a run."""
    store = Snapshots(spark, root)
    counts = contract.contract_counts(store.read("records", RECORDS, result.records))
    outcome = counts.select(
        F.inline(F.array(*[F.struct(F.lit(f"extracted: {c}").alias("what"), F.col(c).alias("rows")) for c in counts.columns]))
    )
    now = store.read("silver", S.SILVER, result.silver)
    before = store.read("silver", S.SILVER, result.silver - 1) if result.silver > 1 else now.limit(0)
    moves = state.status_changes(before, now)
    moved = moves.select(F.concat_ws(" -> ", "old_status", "new_status").alias("what"), "rows")
    return outcome.unionByName(moved)


def run_batch(
    spark: SparkSession,
    root: str,
    new_cards: DataFrame,
    descriptions: DataFrame,
    as_of: dt.datetime,
    order: list[str],
    extractor: contract.Extractor | None = None,
    crawl_is_complete: bool = False,
    embed: Callable[[DataFrame], DataFrame] = embed_documents,
) -> BatchResult:
    """Write the next version of every table.

    ``new_cards`` are bronze-shaped rows plus the crawl ``order`` columns; ``descriptions`` is
    (source, job_id, job_description). With ``crawl_is_complete`` a posting the cards miss becomes Inactive.
    Bronze cards and descriptions are append-only, so a run never
    rewrites the texts and the staging window never carries them. Each step reads back the table the
    step before wrote: a lost executor recomputes one step at most, and lineage never grows across
    steps.
    """
    store = Snapshots(spark, root)
    cards = store.read_all("bronze", S.RAW).select(S.RAW.names)
    v_bronze = store.write("bronze", state.absent_rows(cards, new_cards, SITE_KEY, order))
    texts = store.read_all("descriptions", DESCRIPTIONS)
    v_texts = store.write("descriptions", new_descriptions(texts, descriptions))

    v_jobs = store.write("int_all_jobs", staged(store.read_all("bronze", S.RAW).select(S.RAW.names)))
    jobs = store.read("int_all_jobs", S.RAW, v_jobs)
    silver = store.read("silver", S.SILVER)
    unseen = jobs.join(silver.select("job_id"), "job_id", "left_anti")
    pending = state.pending_jobs(
        with_descriptions(unseen, store.read_all("descriptions", DESCRIPTIONS)), silver, keep=("source",)
    )
    v_records = store.write("records", extract_step(pending, extractor))
    records = store.read("records", RECORDS, v_records)

    def one_row_a_job(rows: DataFrame) -> None:
        if not state.duplicate_keys(rows, ["job_id"]).isEmpty():
            raise ValueError("the new silver version holds a job_id twice")

    after = silver_step(silver, jobs, records, as_of, new_cards if crawl_is_complete else None)
    v_silver = store.write("silver", after, one_row_a_job)
    now = store.read("silver", S.SILVER, v_silver)
    marts = {
        "gold_skill_counts": gold.skill_counts(now, keyed=True),
        "gold_role_summary": gold.role_summary(now),
        "gold_skills_by_level": gold.skills_by_level(now),
    }
    v_gold = {name: store.write(name, df) for name, df in marts.items()}

    first = not store.versions("index")
    v_index = store.write("index", index.sync(store.read("index", INDEX), now, as_of, first, embed))
    return BatchResult(v_bronze, v_texts, v_jobs, v_records, v_silver, v_gold, v_index)

"""Text -> typed record, and the contract every record is checked against."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake import schemas as S
from hirelake.functions import phrases, rules, text
from hirelake.operators.staging import top_per_key

# Called once per Python worker; returns a function from a frame of (job_id, job_title,
# job_description) to one record (a dict, or None for a failure) per row.
Extractor = Callable[[], Callable[[pd.DataFrame], list]]


def extract_with(jobs: DataFrame, extractor: Extractor, retries: int = 2) -> DataFrame:
    """Run a model over the jobs: adds ``record``, NULL where it failed.

    The model is loaded once per worker and sees Arrow batches. Rows without a record are tried
    again, ``retries`` times at most. If the model raises, the rows of that batch are tried one by one, and
    a row that raises by itself has no record. The job columns pass through, so nothing is joined back.
    """

    def attempt(model, rows: pd.DataFrame) -> list[tuple]:
        try:
            return list(zip(rows.index, model(rows), strict=True))
        except Exception:
            if len(rows) == 1:
                return [(rows.index[0], None)]
            return [pair for i in range(len(rows)) for pair in attempt(model, rows.iloc[i : i + 1])]

    out = T.StructType([*jobs.schema.fields, T.StructField("record", S.EXTRACTION)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = extractor()
        for batch in batches:
            batch = batch.reset_index(drop=True)
            todo, records = batch, [None] * len(batch)
            for _ in range(retries + 1):
                if todo.empty:
                    break
                for i, r in attempt(model, todo[["job_id", "job_title", "job_description"]]):
                    records[i] = r
                todo = batch[[r is None for r in records]]
            yield batch.assign(record=pd.Series(records, dtype=object))

    return jobs.mapInPandas(run, out)


def extract_rules(jobs: DataFrame) -> DataFrame:
    """The built-in extractor: adds a ``record`` struct, JVM-side, no shuffle."""
    ready = rules.prepared(jobs, "job_title", "job_description")
    return ready.select(*jobs.columns, rules.record().alias("record"))


def is_valid(r: str = "record") -> Column:
    """Does the record keep the contract? Never NULL."""
    f = {n: F.col(f"{r}.{n}") for n in S.EXTRACTION.names}
    skills = f["core_tech_stack"]
    ok = (
        f["min_years_of_experience"].isNotNull()
        & skills.isNotNull()
        & (F.size(skills) <= S.MAX_SKILLS)
        & ~F.exists(skills, lambda x: x.isNull())
        & f["english_requirement"].isin(*S.ENGLISH_LEVELS)
        & f["job_role"].isin(*S.JOB_ROLES)
        & f["job_level"].isin(*S.JOB_LEVELS)
    )
    return F.coalesce(ok, F.lit(False))


def silver_rows(records: DataFrame, *keep: str) -> DataFrame:
    """Valid records in silver column names; the level of 'Unknown' is filled from the years."""
    r = {n: F.col(f"record.{n}") for n in S.EXTRACTION.names}
    return records.select(
        "job_id",
        "job_url",
        "job_title",
        r["min_years_of_experience"].alias("min_years_of_experience"),
        text.to_json_list(r["core_tech_stack"]).alias("ai_core_tech_stack"),
        r["english_requirement"].alias("english_requirement"),
        r["job_role"].alias("ai_job_role"),
        rules.level_from_years(r["job_level"], r["min_years_of_experience"]).alias("job_level"),
        "source",
        *keep,
    )


def to_silver(records: DataFrame) -> DataFrame:
    """Every record as a silver row in one projection, plus ``ok``.

    A broken record keeps id, URL, title and source; its level and status say 'Error'.
    """
    both = records.withColumn("ok", is_valid())
    rows = silver_rows(both, "ok")
    data = [c for c in rows.columns if c not in ("job_id", "job_url", "job_title", "source", "job_level", "ok")]
    ok = F.col("ok")
    return rows.withColumns(
        {
            **{c: F.when(ok, F.col(c)) for c in data},
            "job_level": F.when(ok, F.col("job_level")).otherwise(F.lit(S.ERROR)),
            "status": F.when(ok, F.lit(S.ACTIVE)).otherwise(F.lit(S.ERROR)),
        }
    )


def contract_counts(records: DataFrame) -> DataFrame:
    """(ok, total) of a batch."""
    return records.agg(F.count_if(is_valid()).alias("ok"), F.count("*").alias("total"))


def skills_from_dictionary(
    docs: DataFrame, dictionary: DataFrame, key: str, body: str, limit: int | None = None
) -> DataFrame:
    """The canonical skills of each document, all or the first ``limit``, in order of first appearance.

    ``dictionary`` is (alias, canonical), an alias one token; `skills_from_phrases` takes aliases of several.
    The limit of a posting's record (S.MAX_SKILLS) is the contract's; here a caller states one or gets all. Tokens are reduced to one row per (document, token) inside
    the row before anything is shuffled; Spark broadcasts the dictionary only below its size
    threshold and otherwise joins by token. Documents without a hit keep an empty list: each
    document adds one blank row, which costs less than a join back.
    """
    words = text.tokens(body)
    hits = docs.select(key, F.posexplode(F.array_distinct(words)).alias("pos", "alias")).join(
        dictionary.select("alias", "canonical").distinct(), "alias"
    )
    return _first_skills(docs, hits, key, limit)


def skills_from_phrases(
    docs: DataFrame, dictionary: DataFrame, key: str, body: str, limit: int | None = None, by_join: bool | None = None
) -> DataFrame:
    """`skills_from_dictionary` with aliases of any number of tokens, the longest match first.

    Aliases are read as texts are: lower case, tokens of letters and digits; an alias without tokens matches
    nothing. In "machine learning platform" the alias "machine learning" hides "learning platform" and
    "machine". An alias of several canonical skills gives all of them.
    """
    spelled = dictionary.select(F.array_join(text.tokens("alias"), " ").alias("phrase"), "canonical").distinct()
    found = phrases.find(docs.select(key, body), key, text.tokens(body), spelled, by_join)
    return _first_skills(docs, found.join(spelled, "phrase"), key, limit)


def _first_skills(docs: DataFrame, hits: DataFrame, key: str, limit: int | None) -> DataFrame:
    """Skills by first appearance from hits (key, pos, canonical)."""
    blank = docs.select(key, F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("canonical"))
    first = hits.select(key, "pos", "canonical").unionByName(blank).groupBy(key, "canonical").agg(F.min("pos").alias("pos"))
    order = [F.col("pos").asc_nulls_last(), F.col("canonical").asc_nulls_last()]
    found = F.when(F.col("canonical").isNotNull(), F.struct("pos", "canonical"))
    if limit is not None:
        first = top_per_key(first, [key], order, limit)
    return (
        first.groupBy(key)
        .agg(F.array_sort(F.collect_list(found)).alias("l"))
        .select(key, F.col("l.canonical").alias("skills"))
    )


def candidate_profiles(candidates: DataFrame, key: str, body: str) -> DataFrame:
    """Years, one-line query and skills of many candidate texts at once.

    The query is the role and the skills; a text without known skills is its own query.
    """
    ready = rules.prepared(candidates.select(key, F.col(body).alias("cv_text")), F.lit(""), "cv_text")
    found = ready.select(
        key, "cv_text", rules.min_years().alias("yoe"), rules.job_role().alias("role"), rules.known_skills().alias("skills")
    )
    query = F.concat_ws(" ", "role", F.array_join("skills", " "))
    return found.select(
        key, "yoe", F.when(F.size("skills") > 0, query).otherwise(F.col("cv_text")).alias("query"), "skills", "cv_text"
    )

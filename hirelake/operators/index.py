"""The search index as a table: points, incremental upsert and delete."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake import schemas as S
from hirelake.functions import text
from hirelake.operators.staging import one_per_key
from hirelake.operators.state import as_of_lit


def as_of_date(as_of: dt.datetime | Column) -> Column:
    return as_of_lit(as_of).cast("date")


def header(source: str = "source", title: str = "job_title") -> Column:
    """The part of a document the result card strips again."""
    return F.concat(F.lit("Source: "), text.or_none(source), F.lit(" | Title: "), text.or_none(title), F.lit(" | "))


def page_content() -> Column:
    """The document text of a silver row; NULL renders as 'None'."""
    return F.concat(
        header(),
        F.lit("Tech: "),
        text.or_none("ai_core_tech_stack"),
        F.lit(" | Level: "),
        text.or_none("job_level"),
        F.lit(" | Exp: "),
        text.or_none("min_years_of_experience"),
        F.lit(" years | English: "),
        text.or_none("english_requirement"),
    )


def documents(silver: DataFrame, *keep: str) -> DataFrame:
    """point_id, page_content and the payload struct of every row, plus ``keep`` columns."""
    meta = F.struct(
        "job_id", "job_title", "job_url", F.col("min_years_of_experience").alias("yoe"), F.col("source")
    )
    return silver.select(
        text.point_id("job_id").alias("point_id"), page_content().alias("page_content"), meta.alias("metadata"), *keep
    )


def to_index(silver: DataFrame, as_of: dt.datetime | Column, full: bool) -> DataFrame:
    """Documents to load: of every Active row on a full load, else of the Active rows processed today."""
    rows = silver.where(F.col("status") == S.ACTIVE)
    if not full:
        today = as_of_date(as_of)
        # a range on the plain column, so the filter reaches the Parquet scan
        start = today.cast("timestamp_ntz")
        end = F.date_add(today, 1).cast("timestamp_ntz")
        rows = rows.where((F.col("processed_at") >= start) & (F.col("processed_at") < end))
    return documents(rows)


def ids_to_delete(silver: DataFrame, as_of: dt.datetime | Column, days: int = 2) -> DataFrame:
    """Point ids of rows marked Inactive in the last ``days`` days (Expired rows stay)."""
    since = F.date_sub(as_of_date(as_of), days).cast("timestamp_ntz")
    gone = silver.where((F.col("status") == S.INACTIVE) & (F.col("last_seen_at") >= since))
    return gone.select(text.point_id("job_id").alias("point_id"))


def index_delete(index: DataFrame, ids: DataFrame) -> DataFrame:
    return index.join(ids.select("point_id"), "point_id", "left_anti")


def index_upsert(index: DataFrame, batch: DataFrame) -> DataFrame:
    """Replace by point_id, add the rest."""
    batch = one_per_key(batch, ["point_id"])
    return index.join(batch.select("point_id"), "point_id", "left_anti").unionByName(batch)


def sync(
    index: DataFrame,
    silver: DataFrame,
    as_of: dt.datetime | Column,
    full: bool,
    embed: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One sync run: a full load replaces everything, else delete what vanished and upsert today's rows.

    ``embed`` adds the vector columns; it only ever sees the batch.
    """
    batch = to_index(silver, as_of, full)
    if embed is not None:
        batch = embed(batch)
    if full:
        return one_per_key(batch, ["point_id"])
    batch = one_per_key(batch, ["point_id"])
    # deleted and replaced points leave in one join, so the wide index rows move once at most
    leaving = ids_to_delete(silver, as_of).unionByName(batch.select("point_id"))
    return index_delete(index, leaving).unionByName(batch)

"""State changes as pure functions (old state, batch, as_of) -> new state.

None of them reads the clock. Batches may repeat a key; the stored side holds one row per key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake import schemas as S
from hirelake.operators.staging import first_seen, one_per_key, top_per_key, union_sources


def as_of_lit(as_of: dt.datetime | Column) -> Column:
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


# --- bronze -------------------------------------------------------------------


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def absent_rows(old: DataFrame, new: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """The rows of ``new`` whose key is not stored yet; within the batch the first in ``order`` wins."""
    key = _keys(key)
    return first_seen(new, key, order).join(old.select(*key), key, "left_anti").select(old.columns)


def insert_absent(old: DataFrame, new: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """Stored rows as they are, plus the absent ones."""
    return old.unionByName(absent_rows(old, new, key, order))


def needs_description(c: Column | str) -> Column:
    """Descriptions worth fetching again; other error sentinels are final."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | c.isin("", S.JD_CONNECTION_ERROR)


def update_column(
    old: DataFrame, updates: DataFrame, key: str | list[str], column: str, where: Column | None = None
) -> DataFrame:
    """Overwrite ``column`` by key where the updates have the key (and ``where`` holds on the old row)."""
    key = _keys(key)
    upd = updates.select(*key, F.col(column).alias("__new"), F.lit(True).alias("__hit"))
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    if where is not None:
        hit = hit & where
    joined = old.join(upd, key, "left").withColumn(column, F.when(hit, F.col("__new")).otherwise(F.col(column)))
    return joined.select(old.columns)


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys held by more than one row, with their row count: empty for a well-kept state table."""
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


# --- silver -------------------------------------------------------------------


def with_silver_defaults(
    rows: DataFrame, as_of: dt.datetime | Column, status: str = S.ACTIVE, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Fill columns an insert leaves out: NULL for data, ``as_of`` for the times, a status."""
    now = as_of_lit(as_of)
    defaults = {"processed_at": now, "last_seen_at": now, "status": F.lit(status)}
    cols = []
    for f in S.SILVER.fields:
        if f.name in rows.columns:
            c = F.col(f.name).cast(f.dataType)
        else:
            c = defaults.get(f.name, F.lit(None).cast(f.dataType))
        cols.append(c.alias(f.name))
    return rows.select(*cols, *keep)


def upsert_touch(old: DataFrame, new: DataFrame, as_of: dt.datetime | Column, ok: str | None = None) -> DataFrame:
    """Insert new ids; for stored ids only ``last_seen_at`` and ``status`` change.

    Re-extracted values are dropped on conflict: the stored row wins. ``ok`` names a boolean column
    of ``new``; a row where it is false is inserted if absent but touches nothing, and loses to a
    true one of the same id. One full outer join over unique keys: each side is shuffled once.
    """
    now = as_of_lit(as_of)
    order = [F.col(ok).desc()] if ok else []
    batch = top_per_key(new, ["job_id"], [*order, F.xxhash64(*new.columns)], 1)
    batch = batch.withColumn("__b", F.lit(True)).alias("b")
    base = old.withColumn("__o", F.lit(True)).alias("o")
    joined = base.join(batch, "job_id", "full_outer")
    stored, incoming = F.col("__o").isNotNull(), F.col("__b").isNotNull()
    touches = incoming & F.col(f"b.{ok}") if ok else incoming
    cols = []
    for c in S.SILVER.names:
        kept = F.when(stored, F.col(f"o.{c}")).otherwise(F.col(f"b.{c}")) if c != "job_id" else F.col(c)
        if c == "last_seen_at":
            kept = F.when(touches, now).otherwise(kept)
        elif c == "status":
            kept = F.when(touches, F.lit(S.ACTIVE)).otherwise(kept)
        cols.append(kept.alias(c))
    return joined.select(*cols)


def error_rows(bad: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """Failed extractions as silver rows: level and status 'Error', extracted columns NULL."""
    kept = bad.select("job_id", "job_url", "job_title", "source", F.lit(S.ERROR).alias("job_level"))
    return with_silver_defaults(kept, as_of, S.ERROR)


def quarantine(old: DataFrame, bad: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """Insert-if-absent of failed extractions."""
    rows = one_per_key(error_rows(bad, as_of), ["job_id"])
    return old.unionByName(rows.join(old.select("job_id"), "job_id", "left_anti").select(old.columns))


def touch_seen(silver: DataFrame, seen: DataFrame, as_of: dt.datetime | Column, source: str | None = None) -> DataFrame:
    """Every stored id present in ``seen`` becomes Active and last seen now, whatever its status was."""
    if source is not None:
        seen = seen.where(F.col("source") == source)
    keys = seen.select("job_id").distinct().withColumn("__seen", F.lit(True))
    hit = F.col("__seen").isNotNull()
    return (
        silver.join(keys, "job_id", "left")
        .withColumn("last_seen_at", F.when(hit, as_of_lit(as_of)).otherwise(F.col("last_seen_at")))
        .withColumn("status", F.when(hit, F.lit(S.ACTIVE)).otherwise(F.col("status")))
        .select(silver.columns)
    )


def snapshot_urls(seen: dict[str, DataFrame]) -> DataFrame:
    """(source, job_url) of several snapshots, each under its silver source name."""
    return union_sources(*[df.select(F.lit(s).alias("source"), "job_url") for s, df in seen.items()])


def mark_inactive(silver: DataFrame, urls: DataFrame, sources: list[str]) -> DataFrame:
    """Rows of ``sources`` whose URL is missing from their own source's snapshot become Inactive.

    ``urls`` is (source, job_url). SQL ``NOT IN`` rules: a NULL on the right marks nothing, a NULL
    URL on the left is marked only by an empty right side. One equi-join for all sources keeps it a
    shuffle join at any size, where Spark's own NOT IN would need the right side broadcast.
    """
    # one scalar over the whole right side; its sets hold at most the source names passed in
    known = urls.agg(
        F.struct(
            F.collect_set("source").alias("any"),
            F.collect_set(F.when(F.col("job_url").isNull(), F.col("source"))).alias("null"),
        )
    ).scalar()
    hits = urls.where(F.col("job_url").isNotNull()).distinct().withColumn("__hit", F.lit(True))
    src = F.col("source")
    missing = src.isin(*sources) & (
        ~F.array_contains(known["any"], src)
        | (F.col("job_url").isNotNull() & F.col("__hit").isNull() & ~F.array_contains(known["null"], src))
    )
    return (
        silver.join(hits, ["source", "job_url"], "left")
        .withColumn("status", F.when(missing, F.lit(S.INACTIVE)).otherwise(F.col("status")))
        .select(silver.columns)
    )


def expire_stale(silver: DataFrame, as_of: dt.datetime | Column, days: int = 3) -> DataFrame:
    """Active rows not seen for more than ``days`` days (strictly) become Expired."""
    stale = (F.col("status") == S.ACTIVE) & (F.col("last_seen_at") < as_of_lit(as_of) - F.make_dt_interval(F.lit(days)))
    return silver.withColumn("status", F.when(stale, F.lit(S.EXPIRED)).otherwise(F.col("status")))


def status_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(old_status, new_status, rows) over the ids both versions hold."""
    pairs = old.select("job_id", F.col("status").alias("old_status")).join(
        new.select("job_id", F.col("status").alias("new_status")), "job_id"
    )
    return pairs.groupBy("old_status", "new_status").agg(F.count("*").alias("rows"))


def changed_rows(before: Column, after: Column) -> Column:
    """Aggregate: rows whose value differs, NULL-safe, for one-pass before/after counts."""
    return F.count_if(~before.eqNullSafe(after))


def pending_jobs(jobs: DataFrame, silver: DataFrame, source: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Jobs with a usable description and no silver row.

    ``jobs`` holds one row per job_id (staging made it so), which makes the wide DISTINCT over the
    description column unnecessary. The description is passed on whole; ``keep`` adds columns.
    """
    if source is not None:
        jobs = jobs.where(F.col("source") == source)
    ready = jobs.where(
        F.col("job_description").isNotNull()
        & ~F.col("job_description").isin(S.JD_NOT_FOUND, S.JD_CONNECTION_ERROR)
    ).select("job_id", "job_url", "job_title", "job_description", *keep)
    return ready.join(silver.select("job_id"), "job_id", "left_anti")

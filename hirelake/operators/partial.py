"""State changes on bucketed tables: the same rules as ``state`` and ``staging``, on the touched buckets only.

Each function returns (feed version, buckets rewritten). The rules themselves are those of the whole-table
functions; here they see the rows they can change and nothing else.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.operators import staging, state
from hirelake.sources.buckets import Buckets, pairs

Applied = tuple[int, list[int]]


def _changed(rows: DataFrame, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(before, after) of the rows that a row-by-row ``change`` alters; no join."""
    columns = rows.columns
    tagged = rows.withColumn("__before", F.struct(*columns))
    out = change(tagged).select(F.col("__before").alias("before"), F.struct(*columns).alias("after"))
    return out.where(~F.col("before").eqNullSafe(F.col("after")))


def _same_keys(rows: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    return rows.join(batch.select(*key).distinct(), key, "left_semi")


def upsert(table: Buckets, batch: DataFrame, as_of: dt.datetime | Column, ok: str | None = None) -> Applied:
    """Insert new ids, touch stored ones (`state.upsert_touch`)."""
    with table.staged(batch) as rows:
        old = _same_keys(table.read(table.touched(rows)), rows, table.key)
        return table.apply(pairs(old, state.upsert_touch(old, rows, as_of, ok), table.key))


def touch(table: Buckets, seen: DataFrame, as_of: dt.datetime | Column, source: str | None = None) -> Applied:
    """Stored ids present in ``seen`` become Active (`state.touch_seen`)."""
    if source is not None:
        seen = seen.where(F.col("source") == source)
    with table.staged(seen.select(*table.key).distinct()) as keys:
        rows = table.read(table.touched(keys))
        return table.apply(_changed(rows, lambda t: state.touch_seen(t, keys, as_of)))


def _by_status(table: Buckets, columns: list[str], change: Callable[[DataFrame], DataFrame]) -> Applied:
    """A change of the status, decided on a few columns of all rows; whole rows only of buckets with a change."""
    narrow = _changed(table.read().select(*columns), change)
    found = narrow.select(*[F.col(f"after.{k}").alias(k) for k in table.key], F.col("after.status").alias("__status"))
    with table.staged(found) as keys:
        rows = table.read(table.touched(keys)).join(keys, table.key)
        after = [F.col("__status").alias(c) if c == "status" else F.col(c) for c in table.schema.names]
        return table.apply(rows.select(F.struct(*table.schema.names).alias("before"), F.struct(*after).alias("after")))


def mark_inactive(table: Buckets, urls: DataFrame, sources: list[str]) -> Applied:
    """Rows whose URL is missing from their source's snapshot (`state.mark_inactive`)."""
    columns = list(dict.fromkeys([*table.key, "source", "job_url", "status"]))
    return _by_status(table, columns, lambda t: state.mark_inactive(t, urls, sources))


def expire(table: Buckets, as_of: dt.datetime | Column, days: int = 3) -> Applied:
    """Active rows not seen for long (`state.expire_stale`)."""
    columns = list(dict.fromkeys([*table.key, "status", "last_seen_at"]))
    return _by_status(table, columns, lambda t: state.expire_stale(t, as_of, days))


def insert_absent(table: Buckets, batch: DataFrame, order: list[str]) -> list[int]:
    """Append the batch's keys that are not stored, the first of each in ``order``; returns the buckets read.

    Only keys are read, of the buckets that hold a key of the batch; the rest of the table is not opened.
    """
    with table.staged(staging.first_seen(batch, table.key, order).select(table.schema.names)) as first:
        some = table.touched(first)
        known = table.read(some).select(*table.key)
        table.append(first.join(known, table.key, "left_anti"))
    return some


def advance_latest(table: Buckets, observations: DataFrame, ts: str, tie: list[str]) -> Applied:
    """Newest row for each key, moved on by new observations alone.

    Latest-of-latest is latest of all, so the state (one row a key) stands for every observation before.
    """
    with table.staged(staging.latest(observations, table.key, ts, tie).select(table.schema.names)) as fresh:
        old, new = (F.struct(*[F.col(f"{side}.{c}") for c in table.schema.names]) for side in ("o", "n"))
        order_old, order_new = (F.struct(*[F.col(f"{side}.{c}") for c in (ts, *tie)]) for side in ("o", "n"))
        stored = table.read(table.touched(fresh)).withColumn("__stored", F.lit(True)).alias("o")
        same_key = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in table.key]
        both = fresh.alias("n").join(stored, same_key, "left")  # one row a key on either side
        newer = F.col("__stored").isNull() | (order_new > order_old)  # NULL is the least, as in `staging.latest`
        return table.apply(both.where(newer).select(F.when(F.col("__stored"), old).alias("before"), new.alias("after")))

"""A run that moves only what it touches: bucketed tables, change feeds and signed gold deltas.

The whole-snapshot run of ``plans.batch`` and this one apply the same rules and give the same rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake import schemas as S
from hirelake.operators import contract, gold_feed, partial, state
from hirelake.plans import batch
from hirelake.sources.buckets import Buckets
from hirelake.sources.snapshots import Snapshots

TIES = [c for c in S.RAW.names if c not in ("job_id", "source", "crawl_timestamp")]

_LONG, _TEXT = T.LongType(), T.StringType()


def _state(key: list[str], *values: str) -> T.StructType:
    return T.StructType([*[T.StructField(k, _TEXT) for k in key], *[T.StructField(v, _LONG) for v in values]])


#: Gold states: (schema, key, deltas of a feed).
GOLD: dict[str, tuple[T.StructType, list[str], Callable[[DataFrame], DataFrame]]] = {
    "skills": (_state(gold_feed.SKILLS, "total_mentions"), gold_feed.SKILLS, gold_feed.skill_deltas),
    "roles": (_state(gold_feed.ROLES, "total_jobs", "years", "with_years"), gold_feed.ROLES, gold_feed.role_deltas),
    "levels": (_state(gold_feed.LEVELS, "mentions"), gold_feed.LEVELS, gold_feed.level_deltas),
}


@dataclass
class Lake:
    """The tables of an incremental run below one root."""

    spark: SparkSession
    root: str
    buckets: int = 64
    rewritten: dict[str, list[int]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.jobs = Buckets(self.spark, f"{self.root}/jobs", S.RAW, ["source", "job_id"], self.buckets)
        self.silver = Buckets(self.spark, f"{self.root}/silver", S.SILVER, ["job_id"], self.buckets)
        self.store = Snapshots(self.spark, f"{self.root}/gold")

    def load_silver(self, rows: DataFrame) -> None:
        """A silver table to go on from, with its gold states."""
        self.silver.load(rows)
        self._gold(gold_feed.as_feed(self.silver.read()))

    def gold(self, name: str) -> DataFrame:
        return self.store.read(name, GOLD[name][0])

    def _gold(self, feed: DataFrame) -> None:
        for name, (_, key, deltas) in GOLD.items():
            self.store.write(name, gold_feed.add(self.gold(name), deltas(feed), key))

    def _apply(self, name: str, applied: partial.Applied) -> None:
        version, some = applied
        self.rewritten[name] = some
        self._gold(self.silver.feed(version))

    def observe(self, observations: DataFrame) -> None:
        """New observations of postings move the latest row of their jobs."""
        self.rewritten["jobs"] = partial.advance_latest(self.jobs, observations, "crawl_timestamp", TIES)[1]

    def advance(
        self,
        seen: DataFrame,
        records: DataFrame,
        as_of: dt.datetime,
        urls: DataFrame | None = None,
        days: int = 3,
    ) -> None:
        """touch -> upsert and quarantine -> mark inactive -> expire, each on its buckets, gold by the changes.

        ``seen`` holds the ids seen now, ``records`` the extraction results, ``urls`` (source, job_url) of a
        complete crawl; without it no posting vanishes.
        """
        self._apply("touch", partial.touch(self.silver, seen, as_of))
        fresh = state.with_silver_defaults(contract.to_silver(records), as_of, keep=("ok",))
        self._apply("upsert", partial.upsert(self.silver, fresh, as_of, "ok"))
        if urls is not None:
            sites = [name for _, name in batch.SITES]
            self._apply("inactive", partial.mark_inactive(self.silver, urls, sites))
        self._apply("expire", partial.expire(self.silver, as_of, days))

    def role_summary(self) -> DataFrame:
        return gold_feed.role_summary(self.gold("roles"))

    def pending(self) -> DataFrame:
        """Jobs of the latest state without a silver row, with their source for the extraction."""
        return state.pending_jobs(self.jobs.read(), self.silver.read().select("job_id"), keep=("source",))

    def crawl_urls(self) -> DataFrame:
        return self.jobs.read().select(batch.silver_name().alias("source"), F.col("job_url"))

"""Bronze -> staging -> intermediate: latest row per key, first seen, union of sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of every key.

    Spark plans a WindowGroupLimit below the exchange, so a map task ships at most ``n`` rows per
    key: a hot key costs n x map-tasks rows in its reducer, not its whole size.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    name = rank or "__rank"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return out if rank else out.drop(name)


def latest(df: DataFrame, keys: list[str], ts: str, tie: list[str]) -> DataFrame:
    """Newest row per key; NULL timestamps lose, equal timestamps go to the larger tie-break."""
    order = [F.col(c).desc_nulls_last() for c in [ts, *tie]]
    return top_per_key(df, keys, order, 1)


def first_seen(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """First row per key in crawl order."""
    return top_per_key(df, key, [F.col(c).asc_nulls_last() for c in order], 1)


def one_per_key(df: DataFrame, key: list[str]) -> DataFrame:
    """One row per key, the same one on every run: the smallest row hash."""
    return top_per_key(df, key, [F.xxhash64(*df.columns).asc()], 1)


def union_sources(*parts: DataFrame) -> DataFrame:
    """UNION ALL by column name, so a source with another column order still lines up."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def new_per_page(cards: DataFrame, key: str, keyword: str, page: str, order: list[str]) -> DataFrame:
    """How many jobs each (keyword, page) showed for the first time; 0 for all-repeat pages.

    ``order`` starts with keyword and page. Two partial aggregations: no window over a key's whole
    history.
    """
    seen = cards.groupBy(key).agg(F.min(F.struct(*order)).alias("f"))
    firsts = seen.select(F.col(f"f.{keyword}").alias(keyword), F.col(f"f.{page}").alias(page), F.lit(1).alias("__new"))
    pages = cards.select(keyword, page, F.lit(0).alias("__new"))
    return pages.unionByName(firsts).groupBy(keyword, page).agg(F.sum("__new").alias("n_new"))

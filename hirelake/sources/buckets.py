"""Keyed tables in hash buckets: a batch reads and rewrites only the buckets that hold its keys.

``<root>/rows/hash_bucket=<b>`` holds the rows, ``<root>/feed/v=<n>`` the changes of each write as
(before, after) pairs. Plain Parquet: buckets are pruned as partitions and replaced by dynamic partition
overwrite. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from hirelake.sources.snapshots import Snapshots

BUCKET = "hash_bucket"


def pairs(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """(before, after) of the keys whose row differs; NULL stands for a missing row. Keys are unique on each side."""
    columns = after.columns
    old = before.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)], F.struct(*columns).alias("before"))
    new = after.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)], F.struct(*columns).alias("after"))
    both = old.join(new, [f"__k{i}" for i in range(len(key))], "full_outer")
    return both.where(~F.col("before").eqNullSafe(F.col("after"))).select("before", "after")


class Buckets:
    """A keyed table with one row a key and ``n`` buckets; ``n`` is fixed when the table is made."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: list[str], n: int = 64):
        self.spark, self.root, self.schema, self.key, self.n = spark, root.rstrip("/"), schema, key, n
        self.rows_path = f"{self.root}/rows"
        self.store = Snapshots(spark, self.root)
        self.feed_schema = StructType([StructField("before", schema), StructField("after", schema)])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.n)).cast("int")

    def exists(self) -> bool:
        fs, path = self.store._fs(self.rows_path)
        return fs.exists(path)

    @contextmanager
    def staged(self, rows: DataFrame) -> Iterator[DataFrame]:
        """``rows`` written once and read back, for a batch that is looked at several times; gone afterwards."""
        path = f"{self.root}/_staged-{uuid.uuid4().hex}"
        rows.write.parquet(path)
        try:
            yield self.spark.read.schema(rows.schema).parquet(path)
        finally:
            fs, folder = self.store._fs(path)
            fs.delete(folder, True)

    def read(self, some: list[int] | None = None) -> DataFrame:
        """All rows, or those of ``some`` buckets; other buckets' files are not listed as input."""
        if not self.exists():
            return self.spark.createDataFrame([], self.schema)
        full = StructType([*self.schema.fields, StructField(BUCKET, IntegerType())])
        rows = self.spark.read.schema(full).parquet(self.rows_path)
        if some is not None:
            rows = rows.where(F.col(BUCKET).isin(some) if some else F.lit(False))
        return rows.select(self.schema.names)

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of the rows' keys: ``n`` numbers at most."""
        return sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())

    def _write(self, rows: DataFrame, mode: str) -> None:
        # by bucket, but a large bucket is cut into several tasks and files
        dealt = rows.select(*self.schema.names, self.bucket().alias(BUCKET)).hint("rebalance", F.col(BUCKET))
        writer = dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BUCKET).parquet(self.rows_path)

    def load(self, rows: DataFrame) -> Buckets:
        """The first rows of the table, one for each key."""
        self._write(rows, "append")
        return self

    def append(self, rows: DataFrame) -> None:
        """Rows of new keys, as new files in their buckets; nothing stored is read or moved."""
        self._write(rows, "append")

    def apply(self, changes: DataFrame) -> tuple[int, list[int]]:
        """Write ``changes`` (before, after) to the feed, then rewrite their buckets: (feed version, buckets).

        Rows only ever change or come, so a bucket never becomes empty. A failure behind the feed's commit is
        mended by `redo`, which may run any number of times.
        """
        version = self.store.write("feed", changes.select("before", "after"))
        return version, self.redo(version)

    def redo(self, version: int) -> list[int]:
        """Bring the buckets up to a feed version once more."""
        after = self.feed(version).where("after IS NOT NULL").select("after.*")
        some = self.touched(after)
        if some:
            kept = self.read(some).join(after.select(*self.key), self.key, "left_anti")
            self._write(kept.select(self.schema.names).unionByName(after), "overwrite")
        return some

    def feed(self, version: int) -> DataFrame:
        return self.store.read("feed", self.feed_schema, version)

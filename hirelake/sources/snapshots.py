"""State tables as version folders: ``<root>/<table>/v=<n>``.

A version is either a whole snapshot (small state, rewritten every run) or a batch of new rows
(append-only tables, never rewritten). It counts only once Spark's output committer has written
``_SUCCESS``, so a job that loses its driver half-way leaves the previous version current. Readers
pin their versions when they start.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StructField, StructType


class Snapshots:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), p

    def versions(self, table: str) -> list[int]:
        """Committed versions, oldest first."""
        fs, p = self._fs(f"{self.root}/{table}")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        found = sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit())
        return [v for v in found if self._committed(table, v)]

    def _committed(self, table: str, version: int) -> bool:
        fs, p = self._fs(f"{self.root}/{table}/v={version}/_SUCCESS")
        return fs.exists(p)

    def read(self, table: str, schema: StructType, version: int | None = None) -> DataFrame:
        """One pinned version (the newest by default); an empty frame before the first write."""
        if version is None:
            done = self.versions(table)
            if not done:
                return self.spark.createDataFrame([], schema)
            version = done[-1]
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table}/v={version}")

    def read_all(self, table: str, schema: StructType) -> DataFrame:
        """All committed versions of an append-only table; a ``v`` column holds the version number."""
        done = self.versions(table)
        full = StructType([*schema.fields, StructField("v", IntegerType())])
        if not done:
            return self.spark.createDataFrame([], full)
        base = f"{self.root}/{table}"
        return self.spark.read.schema(full).option("basePath", base).parquet(*[f"{base}/v={v}" for v in done])

    def write(self, table: str, df: DataFrame, check: Callable[[DataFrame], None] | None = None) -> int:
        """Write the next version, a snapshot or a batch of new rows, and return its number.

        The rows go to a staging folder first; ``check`` sees them there and may raise, which leaves the
        table as it was. The number is then claimed by creating a file that must not exist, so of two
        writers that started from one version the second fails and overwrites nothing.
        """
        done = self.versions(table)
        version = done[-1] + 1 if done else 1
        base = f"{self.root}/{table}"
        staging = f"{base}/_staging-{uuid.uuid4().hex}"
        df.write.parquet(staging)
        if check:
            check(self.spark.read.schema(df.schema).parquet(staging))
        fs, claim = self._fs(f"{base}/_claim-{version}")
        try:
            claimed = fs.createNewFile(claim)
        except Py4JJavaError:  # some stores raise instead
            claimed = False
        if not claimed:
            raise RuntimeError(f"version {version} of {table} is taken by another writer")
        if not fs.rename(self._fs(staging)[1], self._fs(f"{base}/v={version}")[1]):
            raise RuntimeError(f"version {version} of {table} could not be committed")
        return version

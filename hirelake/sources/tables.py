"""Parquet scans by logical name, and table profiles."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def scan(spark: SparkSession, root: str, name: str, schema: StructType | None = None) -> DataFrame:
    """A Parquet table by name; with a schema given, nothing is inferred."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{root.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Re-split a scan that yields fewer partitions than there are cores.

    For CPU-heavy work on a small file. A large table has many splits already and passes through.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, ordinal, data_type, row_count, null_count), one scan per table."""

    def one(name: str, df: DataFrame) -> DataFrame:
        fields = df.schema.fields
        counts = df.agg(
            F.count("*").alias("n"), *[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)]
        )
        rows = F.array(
            *[
                F.struct(
                    F.lit(f.name).alias("column_name"),
                    F.lit(i + 1).alias("ordinal"),
                    F.lit(f.dataType.simpleString()).alias("data_type"),
                    F.col("n").alias("row_count"),
                    (F.col("n") - F.col(f"c{i}")).alias("null_count"),
                )
                for i, f in enumerate(fields)
            ]
        )
        return counts.select(F.lit(name).alias("table_name"), F.inline(rows))

    return reduce(lambda a, b: a.unionByName(b), [one(n, d) for n, d in tables.items()])


def peek(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)

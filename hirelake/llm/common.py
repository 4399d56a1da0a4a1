"""Helpers of the corpus operators: written tables, running sums, neighbours, byte hashes, components.

Python inside tasks works on Arrow batches of one partition and keeps no more than one slice of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelake.sources.scratch import fresh

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that the vectorised kernels take at a time.
SLICE = 1 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, safe from lost executors."""
    spark = df.sparkSession
    path = fresh(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def spread_bits(rows: int, per_bucket: int = 4000) -> int:
    """Bits of a hash that cut ``rows`` into buckets of about ``per_bucket``."""
    return max(4, min(24, (max(1, rows) // per_bucket).bit_length()))


def running_sum(df: DataFrame, key: str, bucket: str, order: list[Column], value: str, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` in the rows of ``key`` before this one, by (``bucket``, ``order``).

    No window holds more than one (key, bucket): the sums of the buckets, made by partial aggregation,
    give each bucket its start. ``bucket`` has to follow ``order``.
    """
    before = Window.partitionBy(key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        df.groupBy(key, bucket)
        .agg(F.sum(value).alias("_t"))
        .select(key, bucket, F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_start"))
    )
    within = Window.partitionBy(key, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn("_sum", F.coalesce(F.sum(value).over(within), F.lit(0)))
        .join(starts, [key, bucket])
        .withColumn(name, F.col("_sum") + F.col("_start"))
        .drop("_sum", "_start")
    )


# --- byte strings -----------------------------------------------------------------------------------

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = np.uint64(0xBF58476D1CE4E5B9)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * np.uint64(pow(base, have, 1 << 64))
        have += more
    return out


_TABLES: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _tables(n: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if seed not in _TABLES or len(_TABLES[seed][0]) < n:
        base = (_BASE + 2 * 0x5851F42D4C957F2D * seed) & _MASK | 1
        size = 1 << max(16, (n - 1).bit_length())
        letters = mix(np.arange(1, 257, dtype=np.uint64) * _STEP + np.uint64(seed))
        _TABLES[seed] = _powers(base, size), _powers(pow(base, -1, 1 << 64), size), letters
    return _TABLES[seed]


class Hashes:
    """Hashes of all substrings of a byte array: equal bytes, equal values, wherever they stand."""

    def __init__(self, data: np.ndarray, seed: int = 0):
        up, self.down, letters = _tables(len(data) + 1, seed)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(letters[data] * up[: len(data)], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (end - start).astype(np.uint64)
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + length * _STEP)

    def grams(self, q: int) -> np.ndarray:
        """Of the substrings of ``q`` bytes, by their start."""
        n = len(self.sums) - q
        if n <= 0:
            return np.empty(0, np.uint64)
        return mix((self.sums[q:] - self.sums[:n]) * self.down[:n] + np.uint64(q * int(_STEP) & _MASK))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` neighbours, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def text_slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cuts a column of texts (null: empty) into runs of rows of about ``size`` bytes; one text is never cut.

    Gives first row, row after the last, the bytes of those texts one after another, and their bounds.
    """
    column = column.fill_null("").cast(pa.large_string())
    if len(column) == 0:
        return
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1
        last = min(len(column), max(last, first + 1))
        yield first, last, whole[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of the words of several texts that stand one after another."""
    return runs(~is_space(data), bounds)


def runs(kept: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of the runs of ``kept`` bytes; a run ends where its text does."""
    inside = np.empty(len(kept) + 2, bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = kept
    first = inside[1:] & ~inside[:-1]
    last = inside[:-1] & ~inside[1:]
    cuts = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(kept))]
    joined = cuts[inside[cuts] & inside[cuts + 1]]  # a word ends where a text ends
    first[joined] = last[joined] = True
    start, end = np.flatnonzero(first), np.flatnonzero(last)
    return start, end, np.searchsorted(bounds, start, "right") - 1


# --- graphs -----------------------------------------------------------------------------------------


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label) for the nodes of ``links``: the smallest node that links reach.

    Alternating stars: each node's larger neighbours move under its smallest neighbour, then each node's
    smaller neighbours under the smallest of them. Both are a minimum by node, made by partial aggregation,
    and an equi-join; a hub's neighbours are never gathered. The links never grow in number.
    """
    links = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links"
    )

    def content(df: DataFrame):
        return df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()

    seen = content(links)
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        parent = large.groupBy("u").agg(F.min("v").alias("p"))
        small = large.join(parent, "u").where("v <> p").select(F.col("v").alias("u"), F.col("p").alias("v"))
        links = stored(small.union(parent.select("u", F.col("p").alias("v"))).distinct(), "links")
        now = content(links)
        if now == seen:
            break
        seen = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )

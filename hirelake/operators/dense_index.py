"""Exact nearest vectors with fewer reads: vectors in groups around trained centres, skipped by their bounds.

A group has a centre and a radius, the largest angle of a member to it. For a query at angle a to the centre
no member can score more than cos(a - radius). Groups that cannot reach the query's k-th score are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from hirelake.operators import search
from hirelake.operators.staging import top_per_key

#: Vectors that the centres are trained on, rounds of training, and the most centres (their table is broadcast).
SAMPLE, ROUNDS, MOST_GROUPS = 20_000, 8, 4_096
#: Vectors without direction: they score 0 with every query.
ZERO = -1
#: Most queries, and most cells (a query and a group), that are searched in one pass; more take one pass each.
CHUNK_QUERIES, CHUNK_CELLS = 20_000, 8_000_000
#: Room for rounding: scores are rounded to search.DIGITS.
SLACK = 1e-6


def train(sample: np.ndarray, groups: int, seed: int = 1) -> np.ndarray:
    """Unit centres of unit vectors; the sample is bounded, so this is work of a fixed size."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(groups, len(sample)), replace=False)]
    for _ in range(ROUNDS):
        own = np.argmax(sample @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), centres)
    return centres


@dataclass
class DenseIndex:
    """A written index: vectors by group, and of each group centre, radius, size and least years."""

    spark: SparkSession
    path: str
    schema: T.StructType
    centres: np.ndarray
    radius: np.ndarray
    size: np.ndarray
    least_yoe: np.ndarray

    def rows(self, groups: list[int]) -> DataFrame:
        """The vectors of some groups; the others' files are pruned."""
        rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/vectors")
        return rows.where(F.col("group").isin(groups) if groups else F.lit(False))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Queries x groups: the highest score that a member can have. The last group holds the zero vectors."""
        if not len(self.centres):  # only vectors without direction, or none
            return np.where(self.size[None, :] > 0, np.zeros((len(queries), 1)), -np.inf)
        angle = np.arccos(np.clip(queries @ self.centres.T, -1, 1))
        best = np.cos(np.maximum(0, angle - self.radius[None, :-1]))
        best = np.where(np.linalg.norm(queries, axis=1, keepdims=True) > 0, best, 0.0)
        best = np.hstack([best, np.zeros((len(queries), 1))])
        return np.where(self.size[None, :] > 0, best, -np.inf)


def build(corpus: DataFrame, path: str, groups: int | None = None, sample: int = SAMPLE) -> DenseIndex:
    """Write the index of ``corpus`` (id, dense, optional yoe) below ``path``.

    Rows are dealt by ranges of (group, hash of id): a group of any size is spread over tasks, and a task
    writes few groups.
    """
    spark = corpus.sparkSession
    if "yoe" not in corpus.columns:
        corpus = corpus.withColumn("yoe", F.lit(None).cast("double"))
    corpus = corpus.select("id", F.col("yoe").cast("double").alias("yoe"), "dense").where(F.col("dense").isNotNull())
    taken = corpus.orderBy(F.xxhash64("id"), "id").limit(sample).select("dense").toPandas()
    unit = search._unit(taken["dense"]) if len(taken) else np.zeros((0, 1))
    unit = unit[np.linalg.norm(unit, axis=1) > 0]
    n = groups or min(MOST_GROUPS, max(1, math.isqrt(corpus.count())))
    centres = train(unit, min(n, MOST_GROUPS)) if len(unit) else np.zeros((0, unit.shape[1]))
    sent = spark.sparkContext.broadcast(centres)  # MOST_GROUPS vectors at most

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            if part.empty:
                continue
            vectors = search._unit(part["dense"])
            group, angle = np.full(len(part), ZERO), np.zeros(len(part))
            some = np.flatnonzero(np.linalg.norm(vectors, axis=1) > 0)
            if len(some):
                dots = vectors[some] @ sent.value.T
                group[some] = np.argmax(dots, axis=1)
                angle[some] = np.arccos(np.clip(dots.max(axis=1), -1, 1))
            yield part.assign(group=group.astype(np.int32), angle=angle)

    schema = T.StructType([*corpus.schema.fields, T.StructField("group", T.IntegerType()), T.StructField("angle", T.DoubleType())])
    dealt = corpus.mapInPandas(assign, schema).repartitionByRange(F.col("group"), F.xxhash64("id"))
    dealt.write.partitionBy("group").parquet(f"{path}/vectors")

    radius, size = np.zeros(len(centres) + 1), np.zeros(len(centres) + 1, np.int64)
    least = np.full(len(centres) + 1, np.nan)
    written = spark.read.schema(schema).parquet(f"{path}/vectors")
    for group, angle, count, yoe in written.groupBy("group").agg(F.max("angle"), F.count("*"), F.min("yoe")).collect():
        radius[group], size[group] = angle + 1e-9, count  # group -1 is the last place
        least[group] = np.nan if yoe is None else yoe
    return DenseIndex(spark, path, schema, centres, radius, size, least)


@dataclass
class Read:
    """What a search has read."""

    groups: int = 0
    group_visits: int = 0
    vectors_scored: int = 0
    of_groups: int = 0
    of_vectors: int = 0


def top_k(queries: search.Queries | DataFrame, index: DenseIndex, k: int = 30, exclude_self: bool = False, probes: int = 2) -> tuple[DataFrame, Read]:
    """The rows that ``search.top_k`` gives for dense vectors, and what was read for them.

    First each query reads the groups of its ``probes`` best bounds; the k-th score found there is a floor.
    Then it reads the groups whose bound reaches that floor: the result is exact. Queries come in chunks of
    bounded size; a task scores a group's rows only against the queries that visit the group.
    """
    q = queries if isinstance(queries, search.Queries) else search.measured(queries)
    at_once = min(CHUNK_QUERIES, max(2_000, CHUNK_CELLS // len(index.size)))
    chunks = max(1, -(-q.count // at_once), -(-q.bytes // search.MAX_BROADCAST_BYTES))
    read = Read(of_groups=int((index.size > 0).sum()), of_vectors=q.count * int(index.size.sum()))
    seen: set[int] = set()
    parts = []
    for chunk in range(chunks):
        some = q.df if chunks == 1 else q.df.where(F.pmod(F.xxhash64("qid"), F.lit(chunks)) == chunk)
        rows = some.select("qid", *(["yoe"] if "yoe" in q.df.columns else []), "dense").orderBy("qid").toPandas()
        if rows.empty:
            continue
        unit = search._unit(rows["dense"])
        most = rows["yoe"].to_numpy(float) + 1 if "yoe" in rows else None
        bound = index.bounds(unit)
        if most is not None:  # NULL years are NaN and let nothing pass
            bound = np.where(index.least_yoe[None, :] <= most[:, None], bound, -np.inf)
        order = np.argsort(-bound, axis=1, kind="stable")[:, :probes]
        visit = np.zeros(bound.shape, bool)
        np.put_along_axis(visit, order, True, axis=1)
        visit &= bound > -np.inf
        floor = np.full(len(rows), -np.inf)
        found = top_per_key(_scored(index, rows["qid"].tolist(), unit, most, visit, k, exclude_self), ["qid"], [F.desc("score"), F.asc("id")], k, rank="rank")
        place = {x: i for i, x in enumerate(rows["qid"].tolist())}
        for qid, score in found.where(F.col("rank") == k).select("qid", "score").collect():  # one a query of the chunk
            floor[place[qid]] = score
        visit = (bound + SLACK >= floor[:, None]) & (bound > -np.inf)
        seen.update(np.flatnonzero(visit.any(axis=0)).tolist())
        read.group_visits += int(visit.sum())
        read.vectors_scored += int((visit * index.size[None, :]).sum())
        parts.append(_scored(index, rows["qid"].tolist(), unit, most, visit, k, exclude_self))
    read.groups = len(seen)
    if not parts:
        found = index.rows([]).select(F.col("id").alias("qid"), "id", F.col("yoe").alias("score"))
    else:
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
    return top_per_key(found, ["qid"], [F.desc("score"), F.asc("id")], k, rank="rank").select("qid", "id", "score", "rank"), read


def _scored(index: DenseIndex, qids: list, unit: np.ndarray, most: np.ndarray | None, visit: np.ndarray, k: int, exclude_self: bool) -> DataFrame:
    """k rows for each query and task, of the groups that the query visits."""
    last = visit.shape[1] - 1
    groups = [ZERO if g == last else g for g in np.flatnonzero(visit.any(axis=0)).tolist()]
    rows = index.rows(groups).select("id", "yoe", "dense", "group")
    sent = index.spark.sparkContext.broadcast((qids, unit, most, visit))  # one chunk of queries

    kind = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("qid", kind), T.StructField("id", kind), T.StructField("score", T.DoubleType())])
    shape = to_arrow_schema(schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, unit, most, visit = sent.value
        best = search._Best(k, len(qids))
        place = {x: i for i, x in enumerate(qids)}
        for batch in batches:
            part = batch.to_pandas()
            group = part["group"].to_numpy()
            for g in np.unique(group):
                asked = np.flatnonzero(visit[:, g])
                if not len(asked):
                    continue
                here = part[group == g]
                step = max(16, min(search.CHUNK, search.CELLS // len(asked)))
                column = {x: i for i, x in enumerate(asked.tolist())} if exclude_self else {}
                for at in range(0, len(here), step):
                    some = here.iloc[at : at + step]
                    ids = some["id"].to_numpy()
                    allowed = np.ones((len(some), len(asked)), dtype=bool)
                    if most is not None:
                        allowed = some["yoe"].to_numpy(float)[:, None] <= most[asked][None, :]
                    if exclude_self:
                        for i, x in enumerate(ids.tolist()):
                            if place.get(x) in column:
                                allowed[i, column[place[x]]] = False
                    best.add(search._unit(some["dense"]) @ unit[asked].T, ids, allowed, asked)
        query, scores, found = best.rows()
        frame = pd.DataFrame({"qid": pd.Series(qids).to_numpy()[query], "id": found, "score": scores})
        yield pa.RecordBatch.from_pandas(frame, schema=shape, preserve_index=False)

    return rows.mapInArrow(score, schema)

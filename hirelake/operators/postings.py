"""Sparse search over impact-ordered postings: blocks that cannot lift a point to the k-th place are not read.

A term's postings lie in levels of equal impact (its weight, cut to a fixed grid), a level in blocks of bounded
size. The threshold join reads a query's levels from the top: as soon as the weights still unread cannot add up
to the k-th score found, no unseen point can belong to the result. Seen points are scored whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.operators import search
from hirelake.operators.staging import top_per_key, union_sources
from hirelake.sources import scratch

#: Levels for each unit of weight, postings of a block, postings a term reads at least to find a first floor.
GRID, BLOCK, PROBE = 32, 512, 128
SLACK = 1e-6
#: Blocks of a level that the first floor is taken from, and points whose postings meet in one task.
PROBE_BLOCKS, SHARD = 4, 16_384


@dataclass
class Postings:
    """A written index: postings in blocks, the levels of each term, and the points themselves."""

    spark: SparkSession
    path: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")


def build(corpus: DataFrame, path: str, block: int = BLOCK) -> Postings:
    """Write the index of ``corpus`` (id, terms, weights, optional yoe) below ``path``.

    A term of all points never meets in one task: its levels are counted by partial aggregation, and a level
    is cut by a hash of the id into as many blocks as its count asks for.
    """
    spark = corpus.sparkSession
    if "yoe" not in corpus.columns:
        corpus = corpus.withColumn("yoe", F.lit(None).cast("double"))
    corpus = corpus.select("id", F.col("yoe").cast("double").alias("yoe"), "terms", "weights")
    corpus.write.parquet(f"{path}/points")
    points = spark.read.parquet(f"{path}/points")
    one = points.select("id", "yoe", F.explode(F.arrays_zip("terms", "weights")).alias("p")).where("p.weights > 0")
    one = one.select(F.col("p.terms").alias("term"), F.col("p.weights").alias("weight"), "id", "yoe")
    one = one.withColumn("level", F.floor(F.col("weight") * GRID).cast("int"))
    levels = one.groupBy("term", "level").agg(F.count("*").alias("n"), F.max("weight").alias("most"))
    levels.write.parquet(f"{path}/levels")
    cuts = spark.read.parquet(f"{path}/levels").select("term", "level", F.ceil(F.col("n") / F.lit(block)).alias("cuts"))
    salted = one.join(cuts, ["term", "level"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int"))
    blocks = salted.groupBy("term", "level", "block").agg(F.collect_list(F.struct("id", "yoe", "weight")).alias("postings"))
    ordered = blocks.repartitionByRange("term", "level", "block").sortWithinPartitions("term", F.desc("level"), "block")
    ordered.write.parquet(f"{path}/blocks")  # sorted, so a filter on terms skips row groups by their statistics
    return Postings(spark, path)


def _cuts(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one query's (term, level, most) and floor: the lowest level read, and what each term has left below it."""
    floor = rows["floor"].iloc[0] - SLACK
    cut = int(rows["level"].min())
    for level in sorted(set((rows["level"] + 1).tolist())):
        below = rows[rows["level"] < level]
        if below.groupby("term")["most"].max().sum() >= floor:
            break
        cut = level
    rest = rows[rows["level"] < cut].groupby("term")["most"].max()
    terms = rows["term"].unique()
    left = pd.Series(0.0, index=terms).add(rest, fill_value=0.0)
    return pd.DataFrame({"qid": rows["qid"].iloc[0], "term": left.index, "cut": cut, "left": left.to_numpy(), "all_left": left.sum(), "floor": floor})


def top_k(queries: search.Queries | DataFrame, index: Postings, k: int = 30, probe: int = PROBE) -> tuple[DataFrame, DataFrame]:
    """The rows that ``search.top_k`` gives for sparse vectors, and (read, total): postings read and stored.

    1. Each query term reads its top levels, ``probe`` postings or more, of a long level PROBE_BLOCKS blocks. Their
       sums are lower bounds, so the k-th best is a floor for the k-th score. 2. Levels are read down to where the
       largest weights left, one for each term, add up to less than the floor. A posting is read once for all
       queries: those of some points meet in one task, which adds them up for each query and finds the points
       whose sum with what may be left reaches the floor. 3. These are scored on their whole vectors. Nothing
       that can reach the floor is skipped: exact. Queries travel to the tasks as in ``search``, in several
       passes if there are many.
    """
    q = queries if isinstance(queries, search.Queries) else search.measured(queries)
    limited = "yoe" in q.df.columns
    most = (F.col("yoe") + 1).cast("double") if limited else F.lit(None).cast("double")
    asked = q.df.select("qid", most.alias("max_yoe"), F.array_distinct("terms").alias("terms"))
    allowed = F.col("p.yoe") <= F.col("max_yoe") if limited else F.lit(True)
    spark = index.spark
    by_qid = asked.groupBy("qid").agg(F.max("max_yoe").alias("max_yoe"), (F.count("*") == 1).alias("single"))
    wanted = asked.select("qid", F.explode("terms").alias("term")).distinct().join(by_qid, "qid")
    heads = wanted.join(index.table("levels"), "term")
    blocks = index.table("blocks")

    above = F.sum("n").over(_down("qid", "term"))
    first = heads.withColumn("above", F.coalesce(above, F.lit(0))).where(F.col("above") < probe).select("qid", "max_yoe", "term", "level")
    hit = blocks.where(F.col("block") < PROBE_BLOCKS).join(first, ["term", "level"])
    hit = hit.select("qid", "max_yoe", F.explode("postings").alias("p")).where(allowed)
    partial = hit.groupBy("qid", "p.id").agg(F.sum("p.weight").alias("score"))
    kth = top_per_key(partial, ["qid"], [F.desc("score"), F.asc("id")], k, rank="rank").where(F.col("rank") == k)
    floors = heads.join(kth.select("qid", F.col("score").alias("floor")), "qid", "left")
    floors = floors.withColumn("floor", F.when(F.col("single"), F.coalesce("floor", F.lit(0.0))).otherwise(0.0))
    kind = q.df.schema["qid"].dataType
    cut_schema = T.StructType([
        T.StructField("qid", kind), T.StructField("term", T.StringType()), T.StructField("cut", T.IntegerType()),
        T.StructField("left", T.DoubleType()), T.StructField("all_left", T.DoubleType()), T.StructField("floor", T.DoubleType()),
    ])
    cuts = floors.select("qid", "term", "level", "most", "floor").groupBy("qid").applyInPandas(_cuts, cut_schema)
    path = scratch.fresh(spark, "cuts")
    cuts.join(by_qid, "qid").write.parquet(path)
    cuts = spark.read.parquet(path)
    need = heads.join(cuts.drop("max_yoe", "single"), ["qid", "term"]).where(F.col("level") >= F.col("cut"))
    passes = max(1, math.ceil(q.count / search.MAX_BROADCAST_QUERIES), math.ceil(q.bytes / search.MAX_BROADCAST_BYTES))
    chunk = F.pmod(F.xxhash64("qid"), F.lit(passes))
    candidates = union_sources(*[_candidates(index, cuts.where(chunk == i), k, limited, kind) for i in range(passes)])

    whole = index.table("points").select("id", "terms", "weights").join(candidates, "id").join(asked.select("qid", F.col("terms").alias("asked")), "qid")
    scored_schema = T.StructType([T.StructField("qid", kind), T.StructField("id", index.table("points").schema["id"].dataType), T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            scores = [
                sum(w for t, w in zip(terms, weights, strict=True) if t in own)
                for terms, weights, own in zip(part["terms"], part["weights"], map(set, part["asked"]), strict=True)
            ]
            yield part[["qid", "id"]].assign(score=np.round(np.array(scores, float), search.DIGITS))

    scored = whole.select("qid", "id", "terms", "weights", "asked").mapInPandas(score, scored_schema).where("score > 0")
    ranked = top_per_key(scored, ["qid"], [F.desc("score"), F.asc("id")], k, rank="rank").select("qid", "id", "score", "rank")
    read = need.select("term", "level").distinct().join(index.table("levels"), ["term", "level"]).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("read"))
    total = index.table("levels").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    return ranked, read.withColumn("one", F.lit(1)).join(total.withColumn("one", F.lit(1)), "one").drop("one")


def _candidates(index: Postings, cuts: DataFrame, k: int, limited: bool, kind: T.DataType) -> DataFrame:
    """(qid, id) of the points that can reach their query's floor, by the postings from its cuts up.

    ``cuts`` (qid, max_yoe, single, term, cut, left, all_left, floor) is of bounded size. The postings of its terms are
    dealt by a hash of the id; each moves once, however many queries ask for it.
    """
    spark = index.spark
    rows = cuts.toPandas()
    if rows.empty:
        return spark.createDataFrame([], T.StructType([T.StructField("qid", kind), T.StructField("id", index.table("points").schema["id"].dataType)]))
    codes = {term: i for i, term in enumerate(sorted(rows["term"].unique()))}
    asked = [
        (qid, some["term"].map(codes).to_numpy(), some["cut"].to_numpy(), some["left"].to_numpy(), some["all_left"].iloc[0], some["floor"].iloc[0], some["max_yoe"].iloc[0], some["single"].iloc[0])
        for qid, some in rows.groupby("qid", sort=False)
    ]
    sent = spark.sparkContext.broadcast(asked)
    lowest = rows.groupby("term")["cut"].min()
    terms = spark.createDataFrame([(t, codes[t], int(c)) for t, c in lowest.items()], "term string, code int, lowest int")
    read = index.table("blocks").join(F.broadcast(terms), "term").where(F.col("level") >= F.col("lowest"))
    shards = max(1, math.ceil(index.table("points").count() / SHARD))
    one = read.select("code", "level", F.explode("postings").alias("p")).where("p.id IS NOT NULL")
    one = one.select(F.pmod(F.xxhash64("p.id"), F.lit(shards)).cast("int").alias("shard"), "code", "level", "p.id", "p.yoe", "p.weight")
    out = T.StructType([T.StructField("qid", kind), T.StructField("id", one.schema["id"].dataType)])
    return one.groupBy("shard").applyInArrow(_reaching(sent, len(codes), k, limited, search.to_arrow_schema(out)), out)


def _reaching(sent, n_codes: int, k: int, limited: bool, out: pa.Schema) -> Callable[[pa.Table], pa.Table]:
    """Of the postings of some points: the (qid, id) whose bound reaches the query's floor."""

    def find(table: pa.Table) -> pa.Table:
        code, level, weight, yoe = (table.column(c).to_numpy() for c in ("code", "level", "weight", "yoe"))
        ids = table.column("id").combine_chunks().dictionary_encode()
        point, ids = ids.indices.to_numpy(), ids.dictionary
        order = np.lexsort((-level, code))
        code, level, weight, yoe, point = code[order], level[order], weight[order], yoe[order], point[order]
        once = len(np.unique(point.astype(np.int64) * n_codes + code)) == len(code)  # else two rows have one id
        start = np.searchsorted(code, np.arange(n_codes + 1))
        qids, found = [], []
        for qid, terms, cuts, left, all_left, floor, max_yoe, single in sent.value:
            ends = [start[t] + np.searchsorted(-level[start[t] : start[t + 1]], -cut, "right") for t, cut in zip(terms, cuts, strict=True)]
            at = np.concatenate([np.arange(start[t], end) for t, end in zip(terms, ends, strict=True)])
            less = np.repeat(left, [end - start[t] for t, end in zip(terms, ends, strict=True)])
            if limited:
                allowed = yoe[at] <= max_yoe  # NULL is NaN and never matches
                at, less = at[allowed], less[allowed]
            if not len(at):
                continue
            seen = np.bincount(point[at], minlength=len(ids))
            at_most = np.bincount(point[at], weights=weight[at] - less, minlength=len(ids)) + all_left
            if once and single and np.count_nonzero(seen) >= k:  # the k-th best sum of these points is a floor too
                least = np.bincount(point[at], weights=weight[at], minlength=len(ids))
                floor = max(floor, np.partition(least, len(ids) - k)[len(ids) - k] - SLACK)
            some = np.flatnonzero((seen > 0) & (at_most >= floor))
            qids.extend([qid] * len(some))
            found.append(some)
        found = ids.take(pa.array(np.concatenate(found) if found else np.empty(0, np.int64)))
        return pa.Table.from_arrays([pa.array(qids, out.field("qid").type), found.cast(out.field("id").type)], schema=out)

    return find


def _down(*key: str):
    from pyspark.sql import Window

    return Window.partitionBy(*key).orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, -1)

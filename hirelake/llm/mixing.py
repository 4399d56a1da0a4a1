"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.common import WORD, documents, running_sum, spread_bits, stored

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix for each word of the input.
SHARE = 1.5
#: How often a document may be taken.
REPEATS = 2
#: Sub-intervals of one step of the search for the cut, and the rows that end it.
CELLS = 4096
#: Ranges in which entries with one finish time are summed.
RANGES = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Never null, in code point order, the null source last."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, repeats: int) -> DataFrame:
    """(k, source_size, target) of each source. ``sizes``: k, size.

    The weights' shares of the budget, where what lies above ``repeats`` times a source's size goes to the
    others by weight until none is above. Only sums go to the driver; the sources stay a table.
    """
    total = stored(sizes.groupBy("k").agg(F.sum("size").alias("source_size")), "sources")
    # The place in code point order: the place in a written range plus the ranges before.
    ordered = total.withColumn("last", F.col("k") == "n").repartitionByRange("last", "k")
    ordered = stored(ordered.withColumn("part", F.spark_partition_id()).withColumn("one", F.lit(1)), "ordered")
    placed = running_sum(ordered, "one", "part", [F.col("last"), F.col("k")], "one", "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    table = stored(
        placed.select("k", "source_size", weight.alias("w"), (F.col("source_size") * float(repeats)).alias("cap")),
        "weights",
    )
    budget = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:  # level: words for each unit of weight among the sources below their cap
        full = F.col("cap") <= F.col("w") * level
        used, free = table.agg(
            F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("w"))), F.lit(0.0)),
        ).first()
        nxt = (budget - used) / free if free else level
        if nxt <= level:
            break
        level = nxt
    return stored(table.select("k", "source_size", F.least("cap", F.col("w") * level).alias("target")), "targets")


def _cut(entries: DataFrame, budget: float) -> tuple[float, str, int] | None:
    """The last (v, k, u) that a queue in that order takes before the sum of t passes ``budget``.

    Each step sums the entries by sub-interval of v and goes on in the one where the budget ends. Entries of
    one v are summed by ranges of (k, u) in the same way. At most CELLS sums, and in the end at most CELLS
    entries, come to the driver.
    """
    low, high = entries.agg(F.min("v"), F.max("v")).first()
    if low is None:
        return None
    left, here = budget, entries
    best = None
    while True:
        width = (high - low) / CELLS
        if width and low + width != low:
            cell = F.least(F.floor((F.col("v") - low) / width), F.lit(CELLS - 1))
            here = here.withColumn("cell", cell)
        else:
            ranges = here.drop("cell").repartitionByRange(RANGES, "v", "k", "u")
            here = stored(ranges.withColumn("cell", F.spark_partition_id()), "ranges")
        sums = sorted(
            here.groupBy("cell").agg(F.sum("t"), F.count("*"), F.max(F.struct("v", "k", "u")), F.min("v"), F.max("v")).collect()
        )
        over = None
        for c, t, n, last, small, large in sums:
            if t <= left:
                left, best = left - t, tuple(last)
            else:
                over = c, n, small, large
                break
        if over is None:
            return best
        c, n, small, large = over
        here = here.where(F.col("cell") == c)
        if n <= CELLS:
            for v, k, u, t in here.orderBy("v", "k", "u").select("v", "k", "u", "t").collect():
                if t > left:
                    return best
                left, best = left - t, (v, k, u)
            return best
        low, high = small, large


def mix(
    docs: DataFrame,
    size: Column,
    doc_id: str = "doc_id",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    seed: int = 11,
) -> DataFrame:
    """(row, size, source_size, target, copies): each row of ``docs`` and how often the mix takes it.

    Weighted fair queueing: within its source a document has a random place (a hash of seed and doc_id).
    Its virtual finish time is the source's words up to and with it, over the source's target; a repeat
    finishes a whole source later. The queue is cut, in the global order of the finish times, where the
    budget is used up. A source's order makes its cut one place for each repeat, so the rows learn their
    copies from the small table of sources and no text is shuffled.

    Null text: size 0. Null source: a source of its own, the last. Rows of one source and doc_id share a
    place and are taken together. Rows of size 0 go with their place. A source of size 0, and an empty
    table, give target 0 and no copies. Extra columns stay in ``row``.
    """
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        size.alias("size"),
        source_key(F.col(source)).alias("k"),
        F.xxhash64(F.lit(seed), F.col(doc_id)).alias("u"),
    )
    sizes = stored(rows.select("k", "u", "size"), "sizes")
    goal = targets(sizes, weights, share, repeats)
    bits = spread_bits(sizes.count())
    blocks = sizes.groupBy("k", "u").agg(F.sum("size").alias("t")).withColumn("bucket", F.shiftright("u", 64 - bits))
    queue = running_sum(blocks, "k", "bucket", [F.col("u")], "t", "c").select("k", "u", "t", "c")
    passes = F.explode(F.array(*[F.lit(i) for i in range(repeats)]))
    finish = (F.col("c") + F.col("t") + F.col("i") * F.col("source_size")) / F.col("target")
    entries = stored(
        queue.join(goal, "k").where("target > 0").withColumn("i", passes).select("k", "u", "t", "i", finish.alias("v")),
        "queue",
    )
    budget = goal.agg(F.sum("target")).first()[0] or 0.0
    last = _cut(entries, budget)
    if last is None:
        return rows.join(goal, "k", "left").select("row", "size", "source_size", "target", F.lit(0).alias("copies"))
    v, k, u = last
    taken = entries.where(F.struct("v", "k", "u") <= F.struct(F.lit(v), F.lit(k), F.lit(u)))
    ends = taken.groupBy("k").pivot("i", list(range(repeats))).agg(F.max("u"))
    ends = ends.select("k", *[F.col(str(i)).alias(f"end{i}") for i in range(repeats)])
    table = stored(goal.join(ends, "k", "left"), "cuts")
    copies = sum((F.coalesce(F.col("u") <= F.col(f"end{i}"), F.lit(False)).cast("int") for i in range(repeats)), F.lit(0))
    return rows.join(table, "k", "left").select("row", "size", "source_size", "target", copies.alias("copies"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    narrow = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    mixed = mix(narrow, F.col("size"))
    return mixed.select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
    )


def take(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: each document as often as the mix takes it."""
    mixed = mix(docs, word_count(F.col("text"))).where("copies > 0")
    times = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("time")
    return mixed.select("row", times).select("row.*")

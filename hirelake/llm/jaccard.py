"""Near duplicates: a size-aware heavy-light join on the Jaccard similarity of word shingles."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelake.llm.common import Hashes, components, documents, lowered, mix, stored, text_slices, words

#: Words of a shingle, and the least similarity in hundredths.
WIDTH, LEAST = 5, 80
#: Cells of the table of shingle counts, the same at every size, and cells of one row of it.
CELLS, BLOCK = 1 << 20, 1 << 12
#: Rounds in which each node meets one node of another component before what is left is compared in full.
ROUNDS = 2
#: Sets up to this size may be light.
MOST_LIGHT = 20

SETS = "doc_id long, n long, s1 long, s2 long, marks binary, block int, counts binary"
GRAMS = "token long, s1 long, x long"
#: Of x: lower bits of s2, the size, whether the set may be a center, and the place (all ones for a subset).
X_S2, X_N, X_CENTER, X_PLACE = 52, 25, 24, (1 << 24) - 1
MOST_N = (1 << (X_S2 - X_N)) - 1
#: Signatures that a task remembers in order to write the keys of equal sets once.
REMEMBERED = 500_000
#: Bytes of text whose shingles a task makes at a time.
PART = 1 << 18
#: Sets up to so many are picked from the texts by a broadcast of their ids (8 bytes each), more by a shuffle.
MOST_SENT = 1_000_000
ARRAYS = "doc_id long, s1 long, s2 long, shingles array<long>"
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def least_overlap(a: int, b: int, least: int) -> int:
    """The smallest intersection with which sets of sizes a and b link."""
    return -(-least * (a + b) // (100 + least))


def prefix(n: int, least: int) -> int:
    """Of sets in one global order, two that link share one of so many first members of each."""
    return n - -(-least * n // 100) + 1


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Runs of rows, as (first row, sets): the sorted distinct shingle hashes of each text."""
    for first, last, data, bounds in text_slices(column, PART):
        low = lowered(data)
        start, end, text = words(low, bounds)
        word = Hashes(low, 3).spans(start, end)
        begins = np.searchsorted(text, np.arange(last - first + 1))
        rolled = np.zeros(max(0, len(word) - width + 1), np.uint64)
        for i in range(width if len(rolled) else 0):
            rolled += mix(word[i : i + len(rolled)] * _ODD[i % 5] + np.uint64(i))
        rolled = mix(rolled)
        out = []
        for row in range(last - first):
            a, b = begins[row], begins[row + 1]
            if b - a >= width:
                out.append(np.unique(rolled[a : b - width + 1]))
            elif b > a:  # fewer words: the whole sequence, told from shingles by its length
                whole = sum((mix(word[a + i : a + i + 1] * _ODD[i % 5]) for i in range(b - a)), np.uint64(b - a))
                out.append(mix(whole))
            else:
                out.append(np.empty(0, np.uint64))
        yield first, out


def signature(members: np.ndarray) -> tuple[int, int]:
    """128 bits that tell one set from another."""
    a = mix(members ^ np.uint64(0x243F6A8885A308D3)).sum(dtype=np.uint64)
    b = mix(members + np.uint64(0x13198A2E03707344)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def marks_of(members: np.ndarray) -> bytes:
    """A bit for each bucket that holds a member, of a power of two buckets, two to four for each member."""
    flags = np.zeros(max(64, 1 << (2 * len(members)).bit_length()), bool)
    flags[(members & np.uint64(len(flags) - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def most_overlap(n: int, marks: bytes, other: int, other_marks: bytes) -> int:
    """No two sets of these sizes and marks share more: a bucket that one has alone holds a member of its own."""
    a, b = np.frombuffer(marks, np.uint8), np.frombuffer(other_marks, np.uint8)
    size = min(len(a), len(b))  # the larger one is folded: its buckets of equal lower bits become one
    a, b = (np.bitwise_or.reduce(x.reshape(-1, size), axis=0) for x in (a, b))
    alone, other_alone = (int(np.bitwise_count(x).sum()) for x in (a & ~b, b & ~a))
    return min(n - alone, other - other_alone)


def _cell(members: np.ndarray, cells: int) -> np.ndarray:
    return (members >> np.uint64(13)).astype(np.int64) & (cells - 1)


def _sets(batches: Iterator[pa.RecordBatch], width: int, cells: int) -> Iterator[pa.RecordBatch]:
    """Size and signature of each text, and at the end this task's table of shingle counts."""
    names = [c.split()[0] for c in SETS.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary())
    counts = np.zeros(cells, np.uint32)
    for batch in batches:
        ids, sizes, s1, s2, marks = batch.column("doc_id").to_pylist(), [], [], [], []
        for _, sets in shingle_sets(batch.column("text"), width):
            for members in sets:
                a, b = signature(members) if len(members) else (0, 0)
                sizes.append(len(members)), s1.append(a), s2.append(b), marks.append(marks_of(members))
            np.add.at(counts, _cell(np.concatenate(sets), cells), np.uint32(1))
        n = len(ids)
        columns = (ids, sizes, s1, s2, marks, [None] * n, [None] * n)
        del batch  # else it is there while the next one comes
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
    used = [b for b in range(cells // BLOCK) if counts[b * BLOCK : (b + 1) * BLOCK].any()]
    rows = [counts[b * BLOCK : (b + 1) * BLOCK].tobytes() for b in used]
    none = [None] * len(used)
    columns = (none, none, none, none, none, used, rows)
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            sums.setdefault(block, np.zeros(BLOCK, np.uint64))
            sums[block] += np.frombuffer(counts, np.uint32)
    for block, counts in sums.items():
        level = np.minimum(127, np.floor(2 * np.log2(counts.astype(float) + 1))).astype(np.uint8)
        row = ([block], [float(counts.sum())], [float((counts.astype(float) ** 2).sum())], [level.tobytes()])
        yield pa.RecordBatch.from_pydict(dict(zip(("block", "total", "squares", "levels"), row, strict=True)), MERGED)


MERGED = pa.schema([("block", pa.int32()), ("total", pa.float64()), ("squares", pa.float64()), ("levels", pa.binary())])


def _shingle_levels(blocks: DataFrame, cells: int) -> tuple[np.ndarray, float]:
    """The tasks' tables added up: twice the logarithm of each cell's count (a byte a cell comes to the
    driver), and the mean length of the list that a shingle is on, over all places of shingles."""
    table, total, squares = np.zeros(cells, np.uint8), 0.0, 0.0
    merged = blocks.repartition("block").mapInArrow(_merge, "block int, total double, squares double, levels binary")
    for block, t, q, levels in merged.collect():
        table[block * BLOCK : (block + 1) * BLOCK] = np.frombuffer(levels, np.uint8)
        total, squares = total + t, squares + q
    return table, 1.0 + max(0.0, squares / max(total, 1.0) - total / cells)


def subsets_of(n: int, least: int) -> int:
    """How many subsets a light set of size n is written as."""
    return sum(comb(n, least_overlap(n, m, least)) for m in partners(n, least))


def partners(n: int, least: int) -> list[int]:
    return [m for m in range(-(-least * n // 100), 100 * n // least + 1) if least_overlap(n, m, least) <= min(n, m)]


def boundary(histogram: dict[int, int], scan: float, least: int) -> int:
    """The size up to which sets are light, by rows: a light set's subsets against a heavy one's scans.

    ``scan`` is the mean length of a list; the sets just below the boundary are scanned as well, as partners
    of those above.
    """
    best, cost = 0, np.inf
    for x in range(MOST_LIGHT + 1):
        low = -(-least * (x + 1) // 100)
        light = sum(c * subsets_of(n, least) for n, c in histogram.items() if 0 < n <= x)
        heavy = sum(c * prefix(n, least) * scan for n, c in histogram.items() if n >= low)
        if light + heavy < cost:
            best, cost = x, light + heavy
    return best


def _grams(batches: Iterator[pa.RecordBatch], level: np.ndarray, light: int, width: int, least: int) -> Iterator[pa.RecordBatch]:
    """The keys under which a set is looked for.

    Heavy: its first members in the order rare before frequent, each the key of an inverted list, with the
    place in that order. Light: all subsets of the size that a link with a set of each size needs; the
    sets that share one link, and the smaller of the two sizes may be the center. Of equal sets a task writes
    the first one's keys.
    """
    low = -(-least * (light + 1) // 100)
    known: set[tuple[int, int]] = set()
    for batch in batches:
        for _, sets in shingle_sets(batch.column("text"), width):
            keys, s1, x = [], [], []

            def add(found: np.ndarray, s: tuple[int, int], n: int, center: bool, place) -> None:
                keys.append(found.view(np.int64))
                s1.append(np.full(len(found), s[0]))
                low_s2 = np.int64(s[1]) << np.int64(X_S2)
                x.append(np.full(len(found), low_s2 | min(n, MOST_N) << X_N | center << X_CENTER) | place)

            for members in sets:
                n = len(members)
                if not n:
                    continue
                s = signature(members)
                if s in known:
                    continue
                if len(known) >= REMEMBERED:
                    known.clear()
                known.add(s)
                if n >= low:
                    p = prefix(n, least)
                    order = (level[_cell(members, len(level))].astype(np.uint64) << np.uint64(56)) | (members >> np.uint64(8))
                    first = np.sort(np.partition(order, p - 1)[:p] if p < n else order)
                    add(first, s, n, True, np.minimum(np.arange(p), X_PLACE - 1))
                if n <= light:
                    for m in partners(n, least):
                        a, b = min(n, m), max(n, m)
                        rows = np.array(list(combinations(members.tolist(), least_overlap(a, b, least))), np.uint64)
                        shape = mix(np.array([a << 32 | b], np.uint64))
                        got = mix(mix(rows + shape).sum(axis=1, dtype=np.uint64))
                        add(got | np.uint64(1 << 63), s, n, n == a, X_PLACE)
            if keys:
                arrays = [pa.array(np.concatenate(c)) for c in (keys, s1, x)]
                yield pa.RecordBatch.from_arrays(arrays, ["token", "s1", "x"])


def _arrays(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
    for batch in batches:
        ids = batch.column("doc_id")
        for first, sets in shingle_sets(batch.column("text"), width):
            sig = [signature(m) for m in sets]
            columns = (
                ids.slice(first, len(sets)),
                [s[0] for s in sig],
                [s[1] for s in sig],
                [m.view(np.int64) for m in sets],
            )
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                [c.split()[0] for c in ARRAYS.split(", ")],
            )


def classes(docs: DataFrame, width: int = WIDTH, least: int = LEAST) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of ``docs`` (doc_id, text).

    Equal sets are one node, the smallest doc_id of them. Nodes then meet under the keys of `_grams`: subsets
    for light sets, inverted lists for heavy ones, with the boundary chosen by cost. Lists are cheap as their
    keys are each set's rarest members, by a fixed-size table of counts of all shingles.

    A list is cut into runs of nodes whose sizes let them link (`_runs`); in what follows a run is a list.
    A list of m nodes is not written out as pairs. Each node is compared with the first and with the one
    before it in the list, ordered by place: the first has the fewest rarer members, so of a group of edited
    copies it is nearest to all others. The links found give components. ROUNDS times each node is then
    compared with nodes of other components in its list, and in the end only pairs of nodes that share a
    list, are in different components and were not compared before still are. Every pair that can link is thus
    compared or already in one component: the result is exact. Sizes and places in the order rule out pairs
    that cannot reach the overlap, a list of two by that at once; then marks of the sets' members rule out
    pairs that have too many members alone. All others are compared on their whole sets.

    Null or empty text, or text without words: size 0, linked with nothing. Fewer words than ``width``: one
    member, the whole sequence. Rows of one doc_id count as one document, and link. A null doc_id has its
    size and no component. Other columns are not looked at.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    first = stored(rows.mapInArrow(lambda it: _sets(it, width, CELLS), SETS), "sets")
    sets = first.where("block IS NULL").select("doc_id", "n", "s1", "s2")
    marks = first.where("block IS NULL").select("doc_id", "n", "s1", "s2", "marks")
    levels, scan = _shingle_levels(first.where("block IS NOT NULL").select("block", "counts"), CELLS)
    some = sets.where(F.col("n").between(1, 2 * MOST_LIGHT)).groupBy("n").count().collect()
    light = boundary({r[0]: r[1] for r in some}, scan, least)
    level = spark.sparkContext.broadcast(levels)  # a byte a cell

    nodes = sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("s1", "s2").agg(
        F.min("doc_id").alias("node"), F.max("n").alias("n")
    )
    nodes = stored(nodes, "nodes")
    grams = rows.mapInArrow(lambda it: _grams(it, level.value, light, width, least), GRAMS)
    by_list = Window.partitionBy("token")

    def place(x: Column) -> Column:
        own = x.bitwiseAND(X_PLACE)
        return F.when(own < X_PLACE, own).otherwise(-1).cast("int")

    def size(x: Column) -> Column:
        return F.shiftright(x, X_N).bitwiseAND(MOST_N)

    one = F.struct("s1", "x")
    shared = (
        grams.repartition("token")
        .distinct()  # within the partitions that the windows need
        .withColumn("m", F.count("*").over(by_list))
        .where("m > 1")
        .withColumn("p", F.min(one).over(by_list))
        .withColumn("q", F.max(one).over(by_list))
    )
    p, q = F.col("p.x"), F.col("q.x")
    two = (F.col("m") > 2) | (place(p) < 0) | _fits(size(p), place(p), size(q), place(q), light, least)
    shared = shared.where(two).select("token", "s1", "x")
    same = (F.shiftrightunsigned("x", X_S2) == F.col("s2").bitwiseAND(0xFFF)) & (size(F.col("x")) == F.least("n", F.lit(MOST_N)))
    lists = shared.join(nodes, (shared["s1"] == nodes["s1"]) & same)
    lists = lists.select(
        "token",
        "node",
        "n",
        place(F.col("x")).alias("pos"),
        (F.shiftright("x", X_CENTER).bitwiseAND(1) == 1).alias("center"),
    )
    lists = stored(_runs(lists, least), "lists")

    heavy, subsets = lists.where("pos >= 0"), lists.where("pos < 0")
    hub = F.min(F.when(F.col("center"), F.col("node"))).over(by_list)
    exact = subsets.withColumn("other", hub).where("other <> node").select(F.col("node").alias("a"), F.col("other").alias("b"))

    by_run = Window.partitionBy("token", "run")
    in_order = by_run.orderBy("pos", "n", "node")
    me = F.struct("node", "n", "pos")

    def can_link(o: Column) -> Column:
        return _fits(F.col("me.n"), F.col("me.pos"), o["n"], o["pos"], light, least)

    met = (
        heavy.where("m > 1")
        .withColumn("me", me)
        .withColumn("before", F.lag("me").over(in_order))
        .withColumn("head", F.first("me").over(in_order))
    )
    met = met.withColumn("others", F.filter(F.array_distinct(F.array("before", "head")), lambda o: (o["node"] != F.col("node")) & can_link(o)))
    pairs = met.select("me", F.explode("others").alias("other"))
    done = stored(_possible(pairs, light, least), "pairs")
    links = stored(exact.union(_compared(rows, marks, done, nodes, width, least)), "links")
    label = stored(components(links, "a", "b"), "labels")

    def unseen(pairs: DataFrame) -> DataFrame:
        """Of the pairs those that can link and were not compared in an earlier round."""
        return stored(_possible(pairs, light, least).join(done, ["a", "b"], "left_anti"), "pairs")

    # Of lists of up to three nodes all pairs have been looked at. Of longer ones that still hold several
    # components: their pairs across components that were not compared.
    long = heavy.where("m > 3").select("token", "run", "node", "n", "pos")

    def labelled(df: DataFrame) -> DataFrame:
        return df.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))

    def open_lists() -> DataFrame:
        rows = labelled(long).withColumn("l", F.min("label").over(by_run)).withColumn("h", F.max("label").over(by_run))
        return stored(rows.where("l <> h").select("token", "run", "label", "node", "n", me.alias("me")), "open")

    here = open_lists()
    for turn in range(ROUNDS):  # other orders: each node and the last one before it of another component
        shuffled = by_run.orderBy(F.xxhash64("label", F.lit(turn)), "me.pos", "n", "node")
        step = F.lag(F.struct("label", "me")).over(shuffled)
        head = F.first(F.struct("label", "me")).over(shuffled)
        met = here.withColumn("step", step).withColumn("head", head)
        others = F.filter(F.array("step", "head"), lambda o: (o["label"] != F.col("label")) & can_link(o["me"]))
        new = unseen(met.withColumn("others", others).select("me", F.explode("others.me").alias("other")))
        grown = stored(links.union(_compared(rows, marks, new, nodes, width, least)), "links")
        done = done.union(new)
        if grown.count() == links.count():
            break
        links = grown
        label = stored(components(links, "a", "b"), "labels")
        here = open_lists()
    left = here.select("token", "run", "label", "me")
    right = here.select("token", "run", F.col("label").alias("label2"), F.col("me").alias("other"))
    across = left.join(right, ["token", "run"]).where("label <> label2 AND me.node > other.node").select("me", "other")
    more = _compared(rows, marks, unseen(across), nodes, width, least)
    label = stored(components(links.union(more), "a", "b"), "labels")

    by_class = nodes.join(label, "node", "left").select("s1", "s2", F.coalesce("label", "node").alias("component"))
    own = F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component"))
    return sets.join(by_class, ["s1", "s2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), own.alias("component_id")
    )


def _runs(lists: DataFrame, least: int) -> DataFrame:
    """Adds ``run`` and ``m``: a list is cut where the next larger set is too large to link, ``m`` nodes are in a run.

    All sets before such a cut are too small for all behind it, so nodes that can link are in one run.
    """
    by_size = Window.partitionBy("token").orderBy("n", "node")
    far = 100 * F.lag("n").over(by_size) < least * F.col("n")
    cut = lists.withColumn("far", F.coalesce(far.cast("int"), F.lit(0))).withColumn("run", F.sum("far").over(by_size))
    return cut.drop("far").withColumn("m", F.count("*").over(Window.partitionBy("token", "run")))


def _possible(pairs: DataFrame, light: int, least: int) -> DataFrame:
    """Distinct pairs that size and place let link, and that are not both light."""
    a, b = F.col("me"), F.col("other")
    return pairs.where(_fits(a["n"], a["pos"], b["n"], b["pos"], light, least)).select(
        F.least(a["node"], b["node"]).alias("a"), F.greatest(a["node"], b["node"]).alias("b")
    ).distinct()


def _fits(n: Column, pos: Column, other: Column, other_pos: Column, light: int, least: int) -> Column:
    """Can sets of these sizes link that share a member at these places of the order, and none before both?"""
    need = F.ceil(least * (n + other) / F.lit(100.0 + least) - 1e-9)
    room = 1 + F.least(n - pos - 1, other - other_pos - 1)
    small, large = F.least(n, other), F.greatest(n, other)
    return (100 * small >= least * large) & (room >= need) & (large > light)


def _named(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, s1, s2) of the nodes in pairs, broadcast if they are few."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    return _small(stored(wanted.join(nodes, "node").select("node", "s1", "s2"), "wanted"))


def _near_by_marks(pairs: DataFrame, marks: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """Of the pairs those that the sizes and marks of their sets do not rule out."""
    side = _named(pairs, nodes).withColumnRenamed("node", "doc_id")
    found = marks.join(side, ["doc_id", "s1", "s2"]).select(F.col("doc_id").alias("node"), "n", "marks").dropDuplicates(["node"])
    found = stored(found, "marks")
    a = found.select(F.col("node").alias("a"), F.col("n").alias("n1"), F.col("marks").alias("m1"))
    b = found.select(F.col("node").alias("b"), F.col("n").alias("n2"), F.col("marks").alias("m2"))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(*(batch.column(c).to_pylist() for c in ("n1", "m1", "n2", "m2")), strict=True)
            kept = [(100 + least) * most_overlap(*s) >= least * (s[0] + s[2]) for s in sides]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return pairs.join(a, "a").join(b, "b").select("a", "b", "n1", "m1", "n2", "m2").mapInArrow(near, "a long, b long")


def _sets_of(rows: DataFrame, pairs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of the nodes in pairs, made anew from their texts."""
    side = _named(pairs, nodes)
    texts = rows.join(side.select(F.col("node").alias("doc_id")), "doc_id")
    arrays = texts.mapInArrow(lambda it: _arrays(it, width), ARRAYS).withColumnRenamed("doc_id", "node")
    found = stored(arrays.join(side, ["node", "s1", "s2"]).select("node", "shingles"), "shingles")
    rows_found, nodes_found = found.agg(F.count("*"), F.countDistinct("node")).first()
    return found if rows_found == nodes_found else found.dropDuplicates(["node"])  # repeated rows of a doc_id


def _compared(rows: DataFrame, marks: DataFrame, pairs: DataFrame, nodes: DataFrame, width: int, least: int) -> DataFrame:
    """Of written pairs those whose whole sets are similar enough. Only the sets of nodes in a pair are looked up."""
    if not pairs.isEmpty():
        pairs = stored(_near_by_marks(pairs, marks, nodes, least), "near")
    if pairs.isEmpty():
        return pairs
    sets_of = _sets_of(rows, pairs, nodes, width)
    a = sets_of.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    b = sets_of.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(a, "a")
        .join(b, "b")
        .where((100 + least) * both >= least * (F.size("x") + F.size("y")))
        .select("a", "b")
    )


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(documents(spark, sf_dir).select("doc_id", "text"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each class the document with the smallest doc_id stays, of its rows the first.

    Rows of one doc_id with different texts are different documents: all but one of their texts are looked at
    under numbers of their own, behind the largest doc_id. Rows of one doc_id with one text are copies, and one
    stays.
    Documents without words and rows without doc_id stay, documents without words once for each doc_id.
    """
    texts = docs.select("doc_id", F.xxhash64(F.col("text").cast("string")).alias("x")).where("doc_id IS NOT NULL")
    rows_of = texts.groupBy("doc_id").agg(F.count("*").alias("m"), F.min("x").alias("least"), F.max("x").alias("most"))
    repeated = stored(rows_of.where("m > 1").select("doc_id", "least", "most"), "repeated")
    if repeated.isEmpty():  # no row moves but for the classes
        found = classes(docs.select("doc_id", "text"))
        gone = stored(found.where("component_id <> doc_id").select(F.col("doc_id").alias("gone")).distinct(), "gone")
        return docs.join(_small(gone), docs["doc_id"] == gone["gone"], "left_anti").select(*docs.columns)
    own = texts.join(_small(repeated.where("least <> most").select("doc_id", "least")), "doc_id").where("x <> least")
    own = own.select("doc_id", "x").distinct().withColumn("place", F.monotonically_increasing_id())
    last = texts.agg(F.max("doc_id")).first()[0]
    own = stored(own.select(F.col("doc_id").alias("d"), F.col("x").alias("t"), (F.col("place") + F.lit(last + 1)).alias("own")), "own")
    row = F.struct(*docs.columns).alias("row")
    rows = docs.select(row, F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"))
    same = (F.col("doc_id") == F.col("d")) & (F.xxhash64("text") == F.col("t"))
    rows = rows.join(_small(own), same, "left").withColumn("id", F.coalesce("own", "doc_id"))
    found = stored(classes(rows.select(F.col("id").alias("doc_id"), "text")).where("doc_id IS NOT NULL"), "found")
    named = found.join(_small(own.select("own", "d")), F.col("doc_id") == F.col("own"), "left")
    named = named.select("component_id", F.struct(F.coalesce("d", "doc_id").alias("d"), F.col("doc_id").alias("id")).alias("me"))
    first = named.groupBy("component_id").agg(F.min("me").alias("first"))
    gone = named.join(first, "component_id").where("me.id <> first.id").select(F.col("me.id").alias("gone")).distinct()
    gone = stored(gone, "gone")
    rows = rows.join(_small(gone), rows["id"] == gone["gone"], "left_anti").select("row", "id")
    nth = F.row_number().over(Window.partitionBy("id").orderBy(F.xxhash64("row")))
    once = rows.where("id IS NOT NULL").withColumn("nth", nth).where("nth = 1").drop("nth")
    return once.union(rows.where("id IS NULL")).select("row.*")


def _small(table: DataFrame) -> DataFrame:
    """Up to MOST_SENT rows are broadcast, so that the texts they join stay where they are."""
    return F.broadcast(table) if table.count() <= MOST_SENT else table

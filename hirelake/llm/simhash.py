"""SimHash near duplicates: blocks that close fingerprints must share, then the Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.common import components, documents, stored

#: Words of a shingle, seed of its hash, and the bits in which linked fingerprints may differ.
WIDTH, SEED, DISTANCE = 4, 42, 4
#: Characters of a text that are cut into words at a time, and shingles whose bits are summed at a time.
PART, SHINGLES = 1 << 20, 1 << 16
#: Fingerprints that one task compares with each other; larger blocks are dealt out in tiles of two halves.
TILE = 8192
#: Blocks up to this size are compared by their places in the sorted rows, larger ones by a walk.
SMALL = 16

FINGERPRINTS = "row long, n_shingles long, fingerprint long"
LINKS = "a long, b long"


# --- fingerprints -----------------------------------------------------------------------------------


def _words(text: str) -> Iterator[list[bytes]]:
    """Lists of the words of a text, part by part; a word over the end of a part goes with the next one."""
    rest = b""
    for at in range(0, len(text), PART):
        data = rest + text[at : at + PART].encode("utf-8", "surrogatepass").lower()  # bytes: A-Z only
        found = data.split()
        rest = b""
        if found and not data[-1:].isspace() and at + PART < len(text):
            rest = found.pop()
        yield found
    if rest:
        yield [rest]


def _ones(hashes: list[int]) -> np.ndarray:
    """How many of the 64-bit values have each bit set, the highest bit first."""
    flat = np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(flat, axis=1).sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None, width: int = WIDTH, seed: int = SEED) -> tuple[int, int]:
    """(shingles, fingerprint) of a text; its shingles are taken and summed part by part."""
    digest = xxhash.xxh64_intdigest
    ones, n, carry, short = np.zeros(64, np.int64), 0, [], True
    for found in _words(text or ""):
        found = carry + found
        if len(found) >= width:
            short = False
            for first in range(0, len(found) - width + 1, SHINGLES):
                some = found[first : first + SHINGLES + width - 1]
                line = b" ".join(some)
                ends = np.cumsum([len(w) + 1 for w in some])
                begins = [0, *ends[:-1].tolist()]
                stops = (ends[width - 1 :] - 1).tolist()
                hashes = [digest(line[a:b], seed) for a, b in zip(begins, stops)]  # as many as there are stops
                ones += _ones(hashes)
                n += len(hashes)
            found = found[len(found) - width + 1 :]
        carry = found
    if short and carry:
        ones, n = _ones([digest(b" ".join(carry), seed)]), 1
    return n, int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def _fingerprints(batches: Iterator[pa.RecordBatch], width: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(t, width, seed) for t in batch.column("text").to_pylist()]
        n, prints = [x for x, _ in found], [x for _, x in found]
        arrays = [batch.column("row"), pa.array(n, pa.int64()), pa.array(prints, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["row", "n_shingles", "fingerprint"])


def fingerprints(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """(doc_id, n_shingles, fingerprint) of each row of ``docs`` (doc_id, text).

    A fingerprint's bit is 1 if over half of the shingles' hashes have it. Fewer words than ``width``: one
    shingle, the whole sequence. Null text and text without words: fingerprint 0.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("row"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda it: _fingerprints(it, width, seed), FINGERPRINTS).withColumnRenamed("row", "doc_id")


# --- blocks -----------------------------------------------------------------------------------------


def block_masks(blocks: int, distance: int) -> list[int]:
    """Bit masks, one for each choice of ``blocks - distance`` of ``blocks`` pieces of 64 bits.

    ``distance`` different bits spoil at most so many pieces: a close pair agrees on all bits of one mask.
    """
    cuts = [round(i * 64 / blocks) for i in range(blocks + 1)]
    pieces = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(pieces, blocks - distance)]


def plan_blocks(nodes: int, distance: int, most: int = 12) -> int:
    """The number of pieces with the least rows and comparisons for so many different fingerprints."""

    def cost(blocks: int) -> float:
        shared = 64 * (blocks - distance) / blocks
        return comb(blocks, distance) * nodes * (1 + nodes / 2**shared / 64)

    return min(range(distance + 2, max(most, distance + 2) + 1), key=cost)


def _walk(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what close pairs of ``prints`` join: each group's members with the first one met.

    A breadth-first walk; what was met is not compared again, so a dense group costs little more than its
    size, and no list of pairs is ever made.
    """
    heads, members = [], []
    left = np.sort(prints)
    while len(left):
        root, queue, left = left[0], [left[:1]], left[1:]
        while queue and len(left):
            front = queue.pop()
            for x in front:
                near = np.bitwise_count(left ^ x) <= distance
                if near.any():
                    met, left = left[near], left[~near]
                    heads.append(np.full(len(met), root)), members.append(met)
                    queue.append(met)
                    if not len(left):
                        break
    none = np.empty(0, prints.dtype)
    return np.concatenate([none, *heads]), np.concatenate([none, *members])


def _links(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Links inside each block; the rows come sorted by ``key``, a block's rows at most TILE of them."""
    rest_k, rest_p = np.empty(0, np.int64), np.empty(0, np.uint64)

    def closed(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        a, b = [], []
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        sizes = np.diff(np.concatenate((starts, [len(keys)])))
        place = np.arange(len(keys)) - np.repeat(starts, sizes)
        small = np.repeat((sizes > 1) & (sizes <= SMALL), sizes)
        for step in range(1, min(SMALL, int(sizes.max()))):
            left = np.flatnonzero(small[step:] & (place[step:] >= step))
            x, y = prints[left], prints[left + step]
            near = np.bitwise_count(x ^ y) <= distance
            a.append(x[near]), b.append(y[near])
        for i in np.flatnonzero(sizes > SMALL):
            heads, members = _walk(prints[starts[i] : starts[i] + sizes[i]], distance)
            a.append(heads), b.append(members)
        none = np.empty(0, np.uint64)
        arrays = [pa.array(np.concatenate([none, *c]).view(np.int64)) for c in (a, b)]
        return pa.RecordBatch.from_arrays(arrays, ["a", "b"])

    for batch in batches:
        keys = np.concatenate((rest_k, batch.column("key").to_numpy(zero_copy_only=False)))
        prints = np.concatenate((rest_p, batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64)))
        if not len(keys):
            continue
        cut = int(np.searchsorted(keys, keys[-1], "left"))  # the last block may go on
        if cut:
            yield closed(keys[:cut], prints[:cut])
        rest_k, rest_p = keys[cut:], prints[cut:]
    if len(rest_k):
        yield closed(rest_k, rest_p)


def close_pairs(nodes: DataFrame, count: int, distance: int = DISTANCE, blocks: int | None = None, tile: int = TILE) -> DataFrame:
    """(a, b): links between the different fingerprints of ``nodes`` that join what close pairs join.

    Every fingerprint goes to one block for each mask. A block is compared in one task if it holds at most
    ``tile`` fingerprints. The members of a larger one are dealt to halves by a hash, and each two halves
    meet in a task of their own: no task holds more than about ``tile``, and every pair of the block meets.
    """
    masks = block_masks(blocks or plan_blocks(count, distance), distance)
    choices = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(_signed(m)).alias("mask")) for i, m in enumerate(masks)])
    rows = nodes.select("fingerprint", F.explode(choices).alias("m"))
    rows = rows.select(F.xxhash64("m.i", F.col("fingerprint").bitwiseAND(F.col("m.mask"))).alias("key"), "fingerprint")
    size = rows.groupBy("key").agg(F.count("*").alias("size"))
    large = stored(size.where(F.col("size") > tile), "blocks")
    if not large.isEmpty():
        halves = F.ceil(F.col("size") / F.lit(tile // 2 * 0.9)).cast("int")
        here = rows.join(large.select("key", halves.alias("halves")), "key", "left")
        own = F.pmod(F.xxhash64("fingerprint", "key"), F.col("halves")).cast("int")
        others = F.transform(
            F.sequence(F.lit(0), F.col("halves") - 1),
            lambda o: F.xxhash64("key", F.least(own, o), F.greatest(own, o)),
        )
        tiles = F.explode(F.when(F.col("halves").isNull(), F.array("key")).otherwise(others))
        rows = here.select(tiles.alias("key"), "fingerprint")
    met = rows.repartition("key").sortWithinPartitions("key")
    return met.mapInArrow(lambda it: _links(it, distance), LINKS).distinct()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def hex_digits(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def near_duplicates(docs: DataFrame, width: int = WIDTH, seed: int = SEED, distance: int = DISTANCE, tile: int = TILE) -> DataFrame:
    """(doc_id, n_shingles, fingerprint, n_links, component_id) of each row of ``docs`` (doc_id, text).

    Equal fingerprints are one node. Nodes meet in the blocks of their masks (pigeonhole: a pair within
    ``distance`` bits agrees on one of them whole) and are verified by their Hamming distance. Blocks give
    links that join the same nodes as all close pairs do, not the pairs themselves; ``n_links`` counts those
    a fingerprint is on. component_id is the smallest doc_id that links reach.

    Null or empty text, or no words: fingerprint 0, linked like any other. Repeated rows and rows of one
    doc_id have each their own text's fingerprint and component. A row without doc_id takes part and gets the
    smallest doc_id it reaches, or null. An empty table gives no rows. Other columns are not looked at.
    """
    prints = stored(fingerprints(docs, width, seed), "fingerprints")
    nodes = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "nodes")
    links = stored(close_pairs(nodes.select("fingerprint"), nodes.count(), distance, tile=tile), "pairs")
    label = stored(components(links, "a", "b"), "labels").withColumnRenamed("node", "fingerprint")
    named = nodes.join(label, "fingerprint", "left").withColumn("label", F.coalesce("label", "fingerprint"))
    least = named.groupBy("label").agg(F.min("first").alias("component_id"))
    ends = links.select(F.explode(F.array("a", "b")).alias("fingerprint")).groupBy("fingerprint").agg(F.count("*").alias("n_links"))
    table = stored(named.join(least, "label").join(ends, "fingerprint", "left").select("fingerprint", "n_links", "component_id"), "classes")
    return prints.join(table, "fingerprint").select(
        "doc_id", "n_shingles", "fingerprint", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id"
    )


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))
    return found.withColumn("fingerprint", hex_digits(F.col("fingerprint"))).select(
        "doc_id", "fingerprint", "component_id", "n_shingles", "n_links"
    )

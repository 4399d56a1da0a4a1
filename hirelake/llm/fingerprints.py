"""Document fingerprints of closed syncmers, matched by position."""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.common import Hashes, documents, mix, sliding_min, text_slices

#: Bytes of an anchor and of the substrings that decide on it.
ANCHOR, INNER = 24, 8
#: Places of a fingerprint; each keeps one anchor.
BINS = 64
#: Documents of a range of ids, about, and the most ranges.
BUCKET, RANGES = 2000, 1 << 16
_ENTRY = np.dtype([("bin", "u1"), ("hash", "<u4"), ("pos", "<u4")])

RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprints(texts: list[str]) -> list[np.ndarray]:
    """The anchors that each text keeps, by bin.

    An anchor is a closed syncmer: a string of ANCHOR bytes whose least inner string of INNER bytes (by hash)
    is its first or its last. Whether it is one depends on its own bytes only, so an edit changes no anchor
    that it does not touch. Each of BINS hash ranges keeps its anchor with the least hash, at its first
    position. A text without a syncmer has its least string of ANCHOR bytes, a shorter text itself, an empty
    text none.
    """
    out: list[np.ndarray] = []
    for first, last, data, bounds in text_slices(pa.array(texts, pa.string())):
        n_texts = last - first
        hashes = Hashes(data, 9)
        grams = hashes.grams(ANCHOR)
        text = np.repeat(np.arange(n_texts), np.diff(bounds))[: len(grams)]
        at = np.flatnonzero(np.arange(len(grams)) + ANCHOR <= bounds[text + 1]) if len(grams) else np.empty(0, int)
        chosen = np.empty(0, int)
        if len(at):
            inner = hashes.grams(INNER)
            least = sliding_min(inner, ANCHOR - INNER + 1)
            edge = (inner[at] == least[at]) | (inner[at + ANCHOR - INNER] == least[at])
            chosen = at[edge]
        owner, value, pos = text[chosen], grams[chosen], chosen - bounds[text[chosen]]
        bare = np.setdiff1d(np.arange(n_texts), owner)
        if len(bare):
            more = [[], [], []]
            for t in bare.tolist():
                a, b = int(bounds[t]), int(bounds[t + 1])
                if b - a >= ANCHOR:
                    least_at = a + int(np.argmin(grams[a : b - ANCHOR + 1]))
                    more[0].append(t), more[1].append(grams[least_at]), more[2].append(least_at - a)
                elif b > a:
                    whole = hashes.spans(np.array([a]), np.array([b]))[0]
                    more[0].append(t), more[1].append(whole), more[2].append(0)
            owner = np.concatenate([owner, np.array(more[0], int)])
            value = np.concatenate([value, np.array(more[1], np.uint64)])
            pos = np.concatenate([pos, np.array(more[2], int)])
        value = mix(value)
        place = (value >> np.uint64(58)).astype(np.int64) + owner * BINS
        order = np.lexsort((pos, value, place))
        place = place[order]
        new = np.ones(len(place), bool)
        new[1:] = place[1:] != place[:-1]
        kept = order[new]
        rows = np.empty(len(kept), _ENTRY)
        rows["bin"], rows["hash"], rows["pos"] = place[new] % BINS, value[kept] & np.uint64(0xFFFFFFFF), pos[kept]
        cuts = np.searchsorted(place[new], np.arange(1, n_texts) * BINS)
        out += np.split(rows, cuts)
    return out


def written(anchors: np.ndarray) -> str:
    return base64.b64encode(anchors.tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), _ENTRY)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of bins, of those that either text fills, whose anchors are equal and in the same order of
    position in both texts (the longest such chain). Two empty fingerprints are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    bins, i, j = np.intersect1d(a["bin"], b["bin"], True, True)
    filled = len(a) + len(b) - len(bins)
    same = a["hash"][i] == b["hash"][j]
    if not same.any():
        return 0.0
    pairs = sorted(zip(a["pos"][i[same]].tolist(), b["pos"][j[same]].tolist(), strict=True))
    ends: list[int] = []
    for _, y in pairs:
        at = bisect_left(ends, y)
        ends[at : at + 1] = [y]
    return len(ends) / filled


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document with the one after it; the rows come ordered, the first of the next bucket after the last."""
    names = [c.split()[0] for c in RESULT.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    columns = ("bucket", "extra", "doc_id", "text")
    last: list[tuple] = []
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            rows = last + list(zip(*(part.column(c).to_pylist() for c in columns), strict=True))
            last = rows[-1:]
            yield _finished(rows, names, kinds)
    if last:  # the last row has no next: an extra one, or a document without an id
        yield _finished([*last, (None, True, None, "")], names, kinds)


def _finished(rows: list[tuple], names: list[str], kinds: tuple) -> pa.RecordBatch:
    own = fingerprints([r[3] for r in rows])
    todo, edited = [], []
    for i, (bucket, extra, doc, text) in enumerate(rows[:-1]):
        if extra:
            continue
        follows = rows[i + 1][0] == bucket and doc is not None
        third = len(text) // 3
        todo.append((i, doc, text, follows))
        edited.append(text[: len(text) - third] + (rows[i + 1][3][:third] if follows else ""))
    changed = fingerprints(edited)
    out = [
        (
            doc,
            len(text),
            hashlib.sha256(new.encode()).hexdigest(),
            written(own[i]),
            written(mark),
            likeness(own[i], mark),
            likeness(own[i], own[i + 1]) if follows else 0.0,
        )
        for (i, doc, text, follows), new, mark in zip(todo, edited, changed, strict=True)
    ]
    values = zip(*out, strict=True) if out else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)


def with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they and the next text's are.

    The next document is the one with the next smaller doc_id (rows of one doc_id by a hash of the text);
    after the last comes the first. The edited text has its last third of code points replaced by the first
    as many of the next.

    Documents are dealt out by ranges of doc_id and read in order, so the texts move once. Each range gets
    a copy of the first document of the next one. The ranges are those that Spark cuts the ids into, about
    equal in documents however the ids are spread; the largest id of each, RANGES at most, comes to the driver.

    Null text: empty, with an empty fingerprint. One document is its own next. A row without doc_id has no
    next: its last third goes, near_next is 0. An empty table gives no rows. Other columns are not looked at.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    ids = rows.where("doc_id IS NOT NULL").select("doc_id")
    dealt = ids.repartitionByRange(min(RANGES, -(-ids.count() // BUCKET) or 1), "doc_id")
    ends = dealt.groupBy(F.spark_partition_id()).agg(F.max("doc_id").alias("top")).select("top").distinct()
    tops = np.array(sorted(r[0] for r in ends.collect()), np.int64)  # the largest id of each range

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column("doc_id")
            found = np.searchsorted(tops, doc.fill_null(0).to_numpy(zero_copy_only=False))
            own = pc.if_else(doc.is_null(), batch.column("loose"), pa.array(found, pa.int32()))
            extra = pa.array(np.zeros(batch.num_rows, bool))
            yield pa.RecordBatch.from_arrays([own, extra, doc, batch.column("text")], ["bucket", "extra", "doc_id", "text"])

    loose = F.pmod(F.xxhash64("text"), F.lit(64)).cast("int") - 64  # of rows without an id
    placed = rows.select(loose.alias("loose"), "doc_id", "text").mapInArrow(place, "bucket int, extra boolean, doc_id long, text string")
    if len(tops):
        after = [(b, int(tops[b - 1])) for b in range(len(tops))]  # where each range goes on; the first: at the last
        pairs = rows.sparkSession.createDataFrame(after, "bucket int, doc_id long")
        extra = rows.join(F.broadcast(pairs), "doc_id").select("bucket", F.lit(True).alias("extra"), "doc_id", "text")
        placed = placed.union(extra)
    n = max(1, len(tops))
    ordered = placed.repartition(min(n, 1 << 15), "bucket").sortWithinPartitions(
        "bucket", "extra", F.col("doc_id").desc_nulls_last(), F.xxhash64("text")
    )
    return ordered.mapInArrow(_rows, RESULT)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_edits(documents(spark, sf_dir).select("doc_id", "text"))

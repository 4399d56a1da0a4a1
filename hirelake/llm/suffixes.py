"""Removal of repeated byte strings by a winnowed hash join of windows.

This takes the place of bucket-pointer refinement, which sorts every suffix again for each depth and so moves
every byte's suffix several times (README: figures). There is no order of suffixes here and no recursion.

Each window of ``width`` bytes is stood for by one of its grams, the one with the least hash, chosen by the
window's own bytes; equal windows thus meet under equal grams at equal offsets, and neighbouring windows
share a gram. Hashes of any bytes of a text are read off prefix sums.

1. Buckets by gram: grams that stand for windows, with the run of those windows.
2. The hash of all bytes of the run. Runs with one hash share all windows; those not in the smallest
   document are repeats as a whole.
3. A window holds its gram and, to the left or to the right of it, half of its other bytes at least. Only where
   runs of a bucket have different hashes but the same half on one side, the bytes of these runs go to their
   bucket, and each window has a hash at full width.

What moves is packed (``_pack``), and texts go in compressed blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.common import Hashes, documents, mix, sliding_min, stored, text_slices

WIDTH, GRAM = 50, 18
#: Suffixes that a task holds before it sends them on, bytes of text for a part of the shuffle, for a group of
#: documents, and that a task holds before it sends them on.
HELD, PART_BYTES, GROUP_BYTES, HELD_BYTES = 1_000_000, 8 << 20, 32 << 20, 16 << 20
#: Bits of a gram's identifier, and of a run's.
GRAM_BITS, RUN_BITS = 32, 40
#: Contested runs whose windows a task works on at a time; one bucket is never cut.
RUNS = 1 << 16

#: A suffix on its way: identifiers of its gram, of its run and of the halves beside the gram (0: none), document,
#: start and further windows of its run.
SUFFIX = np.dtype(
    [("q", "<u8"), ("n", "<u8"), ("left", "<u2"), ("right", "<u2"), ("doc", "<i8"), ("lo", "<u4"), ("more", "u1")]
)
SPAN = np.dtype([("doc", "<i8"), ("lo", "<u4"), ("more", "u1")])
#: A contested run, whose bytes come with it.
RUN = np.dtype([("q", "<u8"), ("doc", "<i8"), ("lo", "<u4"), ("more", "u1")])
BLOBS = "part int, kind int, payload binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
#: Kinds of rows: suffixes to compare, repeats found, runs to refine, texts.
COMPARE, REPEAT, REFINE, TEXT = 0, 1, 2, 3


def _pack(rows: np.ndarray) -> bytes:
    """Field by field, byte plane by byte plane, each compressed by itself; the first field, in which rows are best
    ordered, as differences. A plane of zeros is empty."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=1)
    out = [np.uint32(len(rows)).tobytes()]
    for name in rows.dtype.names:
        field = np.ascontiguousarray(rows[name])
        if name == rows.dtype.names[0]:
            field = np.diff(field, prepend=field.dtype.type(0))
        for plane in field.view(np.uint8).reshape(len(rows), -1).T:
            blob = pack.compress(plane.tobytes()) if plane.any() else b""
            out += [np.uint32(len(blob)).tobytes(), blob]
    return b"".join(out)


def _unpack(blob: bytes, kind: np.dtype) -> np.ndarray:
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    n, at = int.from_bytes(blob[:4], "little"), 4
    out = np.zeros(n, kind)
    for name in kind.names:
        planes = np.zeros((n, kind[name].itemsize), np.uint8)
        for i in range(planes.shape[1]):
            size = int.from_bytes(blob[at : at + 4], "little")
            if size:
                planes[:, i] = np.frombuffer(unpack.decompress(blob[at + 4 : at + 4 + size]), np.uint8)
            at += 4 + size
        field = planes.view(kind[name]).ravel()
        out[name] = np.cumsum(field, dtype=kind[name]) if name == kind.names[0] else field
    return out


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    part, kind, payload = zip(*rows, strict=True) if rows else ((), (), ())
    arrays = [pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(payload, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, ["part", "kind", "payload"])


def _by(rows: np.ndarray, part: np.ndarray, kind: int) -> list[tuple[int, int, bytes]]:
    """One packed row for each part."""
    order = np.argsort(part, kind="stable")
    rows, part = rows[order], part[order]
    cuts = np.flatnonzero(np.diff(part)) + 1
    return [
        (int(p[0]), kind, _pack(r)) for r, p in zip(np.split(rows, cuts), np.split(part, cuts), strict=True) if len(r)
    ]


def _part(q: np.ndarray, parts: int) -> np.ndarray:
    """Ranges of gram identifiers."""
    return (q * np.uint64(parts) >> np.uint64(GRAM_BITS)).astype(np.int32)


def _spans(rows: np.ndarray, groups: int, kind: int) -> list[tuple[int, int, bytes]]:
    """For each group of documents."""
    spans = rows[np.lexsort((rows["lo"], rows["doc"]))][["doc", "lo", "more"]].astype(SPAN)
    return _by(spans, _group(spans["doc"], groups), kind)


def _group(doc: np.ndarray, groups: int) -> np.ndarray:
    return (mix(doc.view(np.uint64)) % np.uint64(groups)).astype(np.int32)


def runs(data: np.ndarray, bounds: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Text number, first and last window, and the identifiers of the gram, of all bytes and of the halves to the
    left and to the right of the gram, of each run.

    Half of a window's bytes beside the gram, or more, lie on one side of it. A run whose windows all have less on a
    side has 0 there.
    """
    none = np.empty(0, np.int64)
    if len(data) < width:
        return none, none, none, *[np.empty(0, np.uint64)] * 4
    hashes = Hashes(data, 5)
    value = hashes.grams(gram)
    windows = width - gram + 1
    at = np.arange(len(value), dtype=np.int32)
    have = 1
    while have < windows:  # the first of the least grams of each window, by doubling
        step = min(have, windows - have)
        left = value[:-step] <= value[step:]
        at = np.where(left, at[:-step], at[step:])
        value = np.where(left, value[:-step], value[step:])
        have += step
    start = np.arange(len(value))
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(value)]
    inside = start + width <= bounds[text + 1]
    new = np.ones(len(value), bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new & inside)
    ends = np.flatnonzero(np.append(new[1:], True) | np.append(inside[:-1] & ~inside[1:], False))
    last = ends[np.searchsorted(ends, first)]
    half, at = (width - gram + 1) // 2, at[first].astype(np.int64)

    def side(has: np.ndarray, start: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.uint64)
        out[has] = hashes.spans(start[has], start[has] + half) % np.uint64(0xFFFF) + np.uint64(1)
        return out

    left = side(at - half >= first, at - half)
    right = side(at + gram + half <= last + width, at + gram)
    # least hashes are small ones: spread anew
    return text[first], first, last, mix(value[first]), hashes.spans(first, last + width), left, right


def _scan(batches: Iterator[pa.RecordBatch], width: int, gram: int, parts: int, groups: int) -> Iterator[pa.RecordBatch]:
    """The runs of this task's texts. Of those in one refined bucket only the smallest document's go on to be
    compared; the others are already known to be repeats. So a passage that is everywhere sends few rows."""
    held: list[np.ndarray] = []
    size = 0

    def sent() -> pa.RecordBatch:
        rows = np.concatenate(held)
        repeat, alive, _ = resolve(rows, False)
        return _batch(_by(rows[alive], _part(rows["q"][alive], parts), COMPARE) + _spans(rows[repeat], groups, REPEAT))

    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        for row, _, data, bounds in text_slices(batch.column("text")):
            text, lo, last, q, n, left, right = runs(data, bounds, width, gram)
            rows = np.empty(len(text), SUFFIX)
            rows["q"], rows["n"] = q >> np.uint64(64 - GRAM_BITS), n >> np.uint64(64 - RUN_BITS)
            rows["left"], rows["right"], rows["doc"] = left, right, ids[row + text]
            rows["lo"], rows["more"] = lo - bounds[text], last - lo
            held.append(rows)
            size += len(rows)
            if size >= HELD:
                yield sent()
                held, size = [], 0
    if size:
        yield sent()


def resolve(rows: np.ndarray, contested: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the rows that a smaller document has too, of the others, and, if ``contested``, of those
    others that share a gram and a half beside it with another run."""
    whole = rows["n"] << np.uint64(64 - RUN_BITS) | (rows["left"] ^ rows["right"] * np.uint16(3))  # equal runs have equal halves
    order = np.lexsort((rows["doc"], whole, rows["q"]))
    q, n, doc = rows["q"][order], whole[order], rows["doc"][order]
    new = np.ones(len(rows), bool)
    new[1:] = (q[1:] != q[:-1]) | (n[1:] != n[:-1])
    first = np.flatnonzero(new)
    least = np.repeat(doc[first], np.diff(np.append(first, len(rows))))
    repeat = doc > least
    alive, several = order[~repeat], np.zeros(len(rows), bool)
    for side in ("left", "right") if contested else ():
        of = alive[rows[side][alive] != 0]
        half = rows["q"][of] << np.uint64(16) | rows[side][of].astype(np.uint64)
        by = np.lexsort((whole[of], half))
        of, half, n = of[by], half[by], whole[of[by]]
        new = np.ones(len(of), bool)
        new[1:] = half[1:] != half[:-1]
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(of)))
        several[of] |= np.repeat(n[start] != n[start + size - 1], size)
    return order[repeat], alive, np.flatnonzero(several)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list[bytes]]]]:
    """The payloads of each part, by kind; the rows come ordered by part."""
    part, held = None, {}
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("part", "kind", "payload"))
        for p, kind, payload in zip(*columns, strict=True):
            if p != part:
                if part is not None:
                    yield part, held
                part, held = p, {}
            held.setdefault(kind, []).append(payload)
    if part is not None:
        yield part, held


def _compare(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """Repeats, and runs to refine, of whole buckets; what is known to be a repeat passes."""
    for part, held in _parts(batches):
        out = [(part, REPEAT, x) for x in held.get(REPEAT, ())]
        if COMPARE in held:
            rows = np.concatenate([_unpack(x, SUFFIX) for x in held[COMPARE]])
            repeat, _, several = resolve(rows, True)
            for found, kind in ((repeat, REPEAT), (several, REFINE)):
                out += _spans(rows[found], groups, kind)
        if out:
            yield _batch(out)


def _texts(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """The texts, in compressed blocks, for the groups of their documents."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=3)
    held: list[tuple[int, bytes]] = []

    def sent() -> pa.RecordBatch:
        ids = np.array([doc for doc, _ in held], np.int64)
        group = _group(ids, groups)
        out = []
        for own in np.split(order := np.argsort(group, kind="stable"), np.flatnonzero(np.diff(group[order])) + 1):
            texts = [held[i][1] for i in own]
            head = [np.uint32(len(own)).tobytes(), ids[own].tobytes(), np.array([len(x) for x in texts], np.int64).tobytes()]
            out.append((int(group[own[0]]), TEXT, pack.compress(b"".join(head + texts))))
        return _batch(out)

    size = 0
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        texts = pc.fill_null(batch.column("text"), "").cast(pa.large_binary())
        for doc, text in zip(ids.tolist(), (x.as_py() for x in texts), strict=True):
            held.append((doc, text))
            size += len(text)
            if size >= HELD_BYTES:
                yield sent()
                held, size = [], 0
    if held:
        yield sent()


def _block(blob: bytes) -> Iterator[tuple[int, bytes]]:
    """Documents and texts of a block."""
    import zstandard

    blob = zstandard.ZstdDecompressor().decompress(blob)
    n = int.from_bytes(blob[:4], "little")
    ids, sizes = np.frombuffer(blob, np.int64, n, 4), np.frombuffer(blob, np.int64, n, 4 + 8 * n)
    at = 4 + 16 * n
    for doc, size in zip(ids.tolist(), sizes.tolist(), strict=True):
        yield doc, blob[at : at + size]
        at += size


def _with_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, int, Iterable[bytes]]]:
    """Document, spans, and its text, of rows ordered by group and kind; spans of one group are held."""
    part, blobs, table, starts = None, [], None, None
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("part", "kind", "payload"))
        for p, kind, payload in zip(*columns, strict=True):
            if p != part:
                part, blobs, table = p, [], None
            if kind != TEXT:
                blobs.append(payload)
                continue
            if table is None:
                table = np.concatenate([_unpack(x, SPAN) for x in blobs]) if blobs else np.empty(0, SPAN)
                table = table[np.argsort(table["doc"], kind="stable")]
                starts = np.ascontiguousarray(table["doc"])
                blobs = []
            for doc, text in _block(payload):
                a, b = np.searchsorted(starts, [doc, doc + 1] if doc < 2**63 - 1 else [doc, doc])
                b = len(starts) if doc == 2**63 - 1 else b
                yield doc, table[a:b], part, text


def _contested(batches: Iterator[pa.RecordBatch], width: int, gram: int, parts: int) -> Iterator[pa.RecordBatch]:
    """The runs to refine, with their bytes, for the buckets of their grams."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=3)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def sent() -> pa.RecordBatch:
        rows, data = (np.concatenate(x) for x in zip(*held, strict=True))
        length = rows["more"].astype(np.int64) + width
        start = np.cumsum(length) - length
        order = np.argsort(rows["q"], kind="stable")
        part = _part(rows["q"][order], parts)
        out = []
        for own in np.split(order, np.flatnonzero(np.diff(part)) + 1):
            head, texts = _pack(rows[own]), pack.compress(data[_ranges(start[own], length[own])].tobytes())
            out.append((int(_part(rows["q"][own[:1]], parts)[0]), COMPARE, np.uint32(len(head)).tobytes() + head + texts))
        return _batch(out)

    for doc, spans, _, text in _with_spans(batches):
        spans = spans[spans["lo"] + np.int64(width) <= len(text)]
        if not len(spans):
            continue
        data = np.frombuffer(text, np.uint8)
        rows = np.empty(len(spans), RUN)
        rows["doc"], rows["lo"] = doc, spans["lo"]
        rows["more"] = np.minimum(spans["more"], len(text) - width - spans["lo"].astype(np.int64))
        start = rows["lo"].astype(np.int64)
        least = sliding_min(Hashes(data, 5).grams(gram), width - gram + 1)  # of a window, and so of its run
        rows["q"] = mix(least[start]) >> np.uint64(64 - GRAM_BITS)
        held.append((rows, data[_ranges(start, rows["more"].astype(np.int64) + width)]))
        size += len(held[-1][1])
        if size >= HELD_BYTES:
            yield sent()
            held, size = [], 0
    if size:
        yield sent()


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers from each start on, one range after another."""
    out = np.repeat(start - (np.cumsum(length) - length), length)
    return out + np.arange(len(out))


def _settle(batches: Iterator[pa.RecordBatch], width: int, groups: int) -> Iterator[pa.RecordBatch]:
    """The windows of contested runs that a smaller document has too, bucket by bucket."""
    import zstandard

    for _, held in _parts(batches):
        heads = [int.from_bytes(x[:4], "little") for x in held[COMPARE]]
        rows = [_unpack(x[4 : 4 + n], RUN) for x, n in zip(held[COMPARE], heads, strict=True)]
        texts = [zstandard.ZstdDecompressor().decompress(x[4 + n :]) for x, n in zip(held.pop(COMPARE), heads, strict=True)]
        rows, data = np.concatenate(rows), np.frombuffer(b"".join(texts), np.uint8)
        del texts
        length = rows["more"].astype(np.int64) + width
        start = np.cumsum(length) - length
        order = np.argsort(rows["q"], kind="stable")
        buckets = np.append(np.flatnonzero(np.diff(rows["q"][order], prepend=rows["q"][order[:1]] ^ np.uint64(1))), len(order))
        at, out = 0, []
        while at < len(order):
            end = int(buckets[np.searchsorted(buckets, at + RUNS, "right") - 1])
            end = end if end > at else int(buckets[np.searchsorted(buckets, at, "right")])
            own, at = order[at:end], end
            out += _spans(_repeated(rows[own], data[_ranges(start[own], length[own])], width), groups, REPEAT)
        if out:
            yield _batch(out)


def _repeated(rows: np.ndarray, data: np.ndarray, width: int) -> np.ndarray:
    """Spans of the windows of ``rows``, whose bytes are ``data``, that a smaller document of these rows has too."""
    count = rows["more"].astype(np.int64) + 1
    run = np.repeat(np.arange(len(rows)), count)
    start = _ranges(np.cumsum(count + width - 1) - (count + width - 1), count)
    hashes = Hashes(data, 6).spans(start, start + width)
    order = np.lexsort((rows["doc"][run], rows["q"][run], hashes))
    q, doc, hashes = rows["q"][run][order], rows["doc"][run][order], hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (q[1:] != q[:-1])
    first = np.flatnonzero(new)
    least = np.repeat(doc[first], np.diff(np.append(first, len(order))))
    found = np.sort(order[doc > least])
    own = run[found]
    cut = np.ones(len(found), bool)
    cut[1:] = (found[1:] != found[:-1] + 1) | (own[1:] != own[:-1])
    first = np.flatnonzero(cut)
    spans = np.empty(len(first), SPAN)
    spans["doc"] = rows["doc"][own[first]]
    spans["lo"] = rows["lo"][own[first]] + (found[first] - (np.cumsum(count) - count)[own[first]])
    spans["more"] = np.diff(np.append(first, len(found))) - 1
    return spans


def _removed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in RESULT.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for doc, spans, _, text in _with_spans(batches):
        n, removed, n_spans, kept = len(text), 0, 0, text
        if len(spans):
            change = np.zeros(n + 1, np.int32)
            lo = spans["lo"].astype(np.int64)
            np.add.at(change, lo, 1)
            np.add.at(change, np.minimum(lo + spans["more"] + width, n), -1)
            cover = np.cumsum(change[:-1]) > 0
            removed = int(cover.sum())
            n_spans = int(cover[0]) + int((cover[1:] & ~cover[:-1]).sum())
            kept = np.frombuffer(text, np.uint8)[~cover].tobytes()
        out.append((doc, n, removed, n_spans, hashlib.sha256(kept).hexdigest()))
        if len(out) >= 2000:
            yield batch()
            out.clear()
    if out:
        yield batch()


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row of ``docs`` (doc_id, text).

    A byte goes if a string of ``width`` bytes over it also starts in a document with a smaller doc_id; this
    is judged on the texts as they came. Exact, up to collisions of the identifiers (72 bits and 16 of the halves,
    where runs share their gram 40 and those; 96 bits of single windows).

    Null and empty texts have 0 bytes; texts shorter than ``width`` keep all. Rows of one doc_id never take
    from each other. Rows without doc_id neither take nor lose. An empty table gives no rows. Other columns
    are not looked at. Suffixes travel packed, many to a row; what a task knows itself is settled there, so
    neither a passage in every document nor a large group of copies fills one task.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = rows.where("doc_id IS NOT NULL")
    total = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, groups = int(total // PART_BYTES + 16), int(total // GROUP_BYTES + 16)

    def dealt(df: DataFrame, n: int) -> DataFrame:
        return df.repartition(n, "part").sortWithinPartitions("part", "kind")

    def at_texts(found: DataFrame) -> DataFrame:
        return dealt(found.union(known.mapInArrow(lambda it: _texts(it, groups), BLOBS)), groups)

    suffixes = known.mapInArrow(lambda it: _scan(it, width, gram, parts, groups), BLOBS)
    first = stored(dealt(suffixes, parts).mapInArrow(lambda it: _compare(it, groups), BLOBS), "repeats")
    contested = at_texts(first.where(F.col("kind") == REFINE)).mapInArrow(lambda it: _contested(it, width, gram, parts), BLOBS)
    second = stored(dealt(contested, parts).mapInArrow(lambda it: _settle(it, width, groups), BLOBS), "repeats")
    found = first.where(F.col("kind") == REPEAT).union(second)
    result = at_texts(found).mapInArrow(lambda it: _removed(it, width), RESULT)
    n = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    zero = F.lit(0).cast("long")
    rest = rows.where("doc_id IS NULL").select(
        "doc_id", n, zero, zero, F.sha2(F.coalesce("text", F.lit("")), 256)
    )
    return result.union(rest)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))

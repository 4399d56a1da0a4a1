"""Two tokenizers aligned on the same texts: linked token pairs counted by inverted document bitmaps."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.common import documents, stored

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Characters outside of those that both libraries surely cut alike: such texts go to the slower one.
_OTHER = re.compile("[^\x00-\u024f\u2010-\u2027\u20ac]")
#: A chunk of document numbers: so many documents, or bytes of text, at most (one longer text: a chunk of its own).
CHUNK_DOCS, CHUNK_BYTES = 1 << 15, 8 << 20
#: A bitmap of more documents than this is stored bit by bit, a smaller one as a list of 16-bit numbers.
DENSE = CHUNK_DOCS // 16

ENCODED = (
    "chunk string, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "a int, b int, plane int, dense boolean, docs long, bits binary"
)
NAMES = [c.split()[0] for c in ENCODED.split(", ")]
SCORED = "chunk string, place int, n_best long, count_sum long"
_STATE: dict = {}


# --- tokens -----------------------------------------------------------------------------------------


def _byte_values() -> dict[str, int]:
    """The byte that each printable character of a byte-level vocabulary stands for."""
    out, spare = {}, 256
    for byte in range(256):
        plain = 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174
        out[chr(byte if plain else spare)] = byte
        spare += not plain
    return out


def tokenizers(a_file: str, b_file: str) -> tuple[Callable, Callable, list[bytes], list[bytes]]:
    """(encode A, encode B, bytes of A's ids, bytes of B's ids); encoders take lists of texts."""
    key = a_file, b_file
    if key not in _STATE:
        import base64
        import os
        from pathlib import Path

        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        first = Tokenizer.from_file(public_tokenizers.path(a_file))
        first.encode_special_tokens = True
        second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(b_file))
        letters = _byte_values()
        a_bytes = [b""] * first.get_vocab_size()
        for entry, i in first.get_vocab().items():
            if all(c in letters for c in entry):
                a_bytes[i] = bytes(letters[c] for c in entry)
            else:
                a_bytes[i] = entry.encode()
        b_bytes = []
        for i in range(second.get_piece_size()):
            piece = second.id_to_piece(i)
            b_bytes.append(bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode())

        ranked = Path(public_tokenizers.path(a_file)).with_suffix(".tiktoken")
        quick = None
        if ranked.exists():  # the same vocabulary as ranks, several times as fast
            ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, ranked.read_bytes().splitlines())}
            if all(a_bytes[i] == x for x, i in ranks.items()):
                quick = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

        def encode_a(texts: list[str]) -> list:
            if quick is None:
                return [e.ids for e in first.encode_batch([" " + t for t in texts], add_special_tokens=False)]
            return [
                first.encode(" " + t, add_special_tokens=False).ids
                if _OTHER.search(t)
                else quick.encode_to_numpy(" " + t, disallowed_special=())
                for t in texts
            ]

        def encode_b(texts: list[str]) -> list[list[int]]:
            return second.encode(texts, num_threads=1)

        _STATE[key] = encode_a, encode_b, a_bytes, b_bytes
    return _STATE[key]


def _spelled(table: list[bytes], ids: list[int]) -> bytes:
    return b"".join(itemgetter(*ids)(table)) if len(ids) > 1 else b"".join(table[i] for i in ids)


class Aligner:
    """The token groups of single texts."""

    def __init__(self, a_file: str = A_FILE, b_file: str = B_FILE):
        self.encode_a, self.encode_b, self.a_bytes, self.b_bytes = tokenizers(a_file, b_file)
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        # a token's decimal digits with what follows it: another of its side, the other side, the next group, nothing
        self.digits = [f"{i}{end}" for end in (",", "|") for i in range(len(self.a_bytes))]
        self.digits += [f"{i}{end}" for end in (",", ";") for i in range(len(self.b_bytes))]

    def align(self, a: list[int] | np.ndarray, b: list[int], text: str):
        """(A ids, B ids, places in A and in B of the tokens that end together), or None if bytes differ from space + text.

        ``a`` as an array comes from ranks of bytes, which spell every text; so its length is compared only.
        """
        want = b" " + text.encode()
        if _spelled(self.b_bytes, b) != want or isinstance(a, list) and _spelled(self.a_bytes, a) != want:
            return None
        a, b = np.asarray(a, np.int64), np.array(b, np.int64)
        ends_a, ends_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        if not len(a) or ends_a[-1] != len(want):
            return None
        at = np.searchsorted(ends_b, ends_a)
        both = np.flatnonzero(ends_b[at] == ends_a)  # both end where the text ends, so at is inside
        return a, b, both, at[both]

    def digest(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> str:
        """SHA-256 of the groups: ids of A, '|', ids of B, ';' between groups."""
        n_a, n_b = len(a), len(b)
        code_a, code_b = a.copy(), b + 2 * len(self.a_bytes)
        code_a[last_a] += len(self.a_bytes)
        code_b[last_b] += len(self.b_bytes)
        group_a = np.searchsorted(last_a, np.arange(n_a))  # the group of each token
        group_b = np.searchsorted(last_b, np.arange(n_b))
        line = np.empty(n_a + n_b, np.int64)
        line[np.arange(n_a) + np.concatenate(([0], last_b + 1))[group_a]] = code_a
        line[np.arange(n_b) + last_a[group_b] + 1] = code_b
        text = "".join(itemgetter(*line.tolist())(self.digits))  # a token of each side at least
        return hashlib.sha256(text[:-1].encode()).hexdigest()


# --- bitmaps ----------------------------------------------------------------------------------------


def bitmaps(pairs: np.ndarray, places: np.ndarray):
    """Of a chunk's links, as (pair, document place) each: rows (pair, plane, dense, documents, bits), sorted by pair.

    Plane k of a pair holds the documents whose number of its links has bit k; its bits are a list of 16-bit
    places, or a bit for each place where that is shorter.
    """
    both = np.sort(pairs << 16 | places)
    first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
    times = np.diff(np.concatenate((first, [len(both)])))
    both = both[first]
    for plane in range(int(times.max()).bit_length() if len(times) else 0):
        here = both[(times >> plane & 1).astype(bool)]
        pair, place = here >> 16, (here & 0xFFFF).astype(np.uint16)
        start = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1]))) if len(pair) else np.empty(0, np.int64)
        size = np.diff(np.concatenate((start, [len(pair)])))
        few = size <= DENSE
        listed = place[np.repeat(few, size)]
        ends = np.concatenate(([0], np.cumsum(2 * size[few]))).astype(np.int32)
        bits = pa.Array.from_buffers(pa.binary(), int(few.sum()), [None, pa.py_buffer(ends), pa.py_buffer(listed)])
        yield pair[start[few]], plane, False, size[few], bits
        full = []
        for i in np.flatnonzero(~few):
            flags = np.zeros(CHUNK_DOCS, bool)
            flags[place[start[i] : start[i] + size[i]]] = True
            full.append(np.packbits(flags, bitorder="little").tobytes())
        if full:
            yield pair[start[~few]], plane, True, size[~few], pa.array(full, pa.binary())


def _row_batch(n: int, **columns) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    arrays = []
    for field in ENCODED.split(", "):
        name, kind = field.split()
        value = columns.get(name)
        if value is None:
            arrays.append(pa.nulls(n, kinds[kind]))
        else:
            arrays.append(value if isinstance(value, pa.Array) else pa.array(value, kinds[kind]))
    return pa.RecordBatch.from_arrays(arrays, NAMES)


def _encoded(batches: Iterator[pa.RecordBatch], a_file: str, b_file: str) -> Iterator[pa.RecordBatch]:
    """A row for each document, numbered within its chunk, and behind each chunk the bitmaps of its pairs."""
    from pyspark import TaskContext

    aligner = Aligner(a_file, b_file)
    task = TaskContext.get().partitionId()
    chunk, place, held, pairs, places = 0, 0, 0, [], []

    def inverted() -> Iterator[pa.RecordBatch]:
        if pairs:
            for pair, plane, dense, docs, bits in bitmaps(np.concatenate(pairs), np.concatenate(places)):
                n = len(pair)
                yield _row_batch(
                    n, chunk=[f"{task}-{chunk}"] * n, a=(pair >> 20).astype(np.int32), b=(pair & 0xFFFFF).astype(np.int32),
                    plane=np.full(n, plane, np.int32), dense=[dense] * n, docs=docs, bits=bits,
                )

    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        for at in range(0, len(texts), 64):
            some = [t or "" for t in texts[at : at + 64]]
            rows = []
            for i, (text, a, b) in enumerate(zip(some, aligner.encode_a(some), aligner.encode_b(some), strict=True)):
                if place == CHUNK_DOCS or held and held + len(text) > CHUNK_BYTES:
                    yield _documents(rows)
                    yield from inverted()
                    chunk, place, held, pairs, places, rows = chunk + 1, 0, 0, [], [], []
                found = aligner.align(a, b, text) if text else None
                if found is None:
                    rows.append((f"{task}-{chunk}", place, ids[at + i], 0, 0, 0, 0, ""))
                else:
                    x, y, last_x, last_y = found
                    n = len(last_x)
                    rows.append((f"{task}-{chunk}", place, ids[at + i], len(x), len(y), n, n, aligner.digest(x, y, last_x, last_y)))
                    pairs.append(x[last_x] << 20 | y[last_y])
                    places.append(np.full(n, place, np.int64))
                place, held = place + 1, held + len(text)
            yield _documents(rows)
    yield from inverted()


def _documents(rows: list[tuple]) -> pa.RecordBatch:
    columns = dict(zip(NAMES, zip(*rows), strict=False)) if rows else {}
    return _row_batch(len(rows), **columns)


def encode(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """Written rows of two kinds: documents with their place in a chunk, and bitmaps of linked pairs (``a`` set)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(lambda it: _encoded(it, a_file, b_file), ENCODED), "encoded")


def pair_counts(encoded: DataFrame) -> DataFrame:
    """(a, b, links, best) of each linked pair: planes are popcounted and summed, 2**plane for each document.

    Chunks hold different documents, so the count of an OR over chunks is the sum of their counts.
    best: no other pair of this ``b`` has more links.
    """
    lists = encoded.where("a IS NOT NULL")
    counts = lists.groupBy("a", "b").agg(F.expr("sum(docs * shiftleft(1L, plane))").alias("links"))
    most = counts.groupBy("b").agg(F.max("links").alias("most"))
    return counts.join(most, "b").select("a", "b", "links", (F.col("links") == F.col("most")).alias("best"))


def document_counts(encoded: DataFrame) -> DataFrame:
    """(a, b, documents): how many documents hold each pair linked, by ORing its planes chunk by chunk."""
    lists = encoded.where("a IS NOT NULL").select("a", "b", "chunk", "dense", "docs", "bits")

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = []
            for planes in batch.column("planes").to_pylist():
                if len(planes) == 1:
                    n.append(planes[0]["docs"])
                    continue
                flags = np.zeros(CHUNK_DOCS // 8, np.uint8)
                for p in planes:
                    flags |= _flags(p["bits"], p["dense"])
                n.append(int(np.bitwise_count(flags).sum()))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(n, pa.int64())], ["a", "b", "docs"])

    chunks = lists.groupBy("a", "b", "chunk").agg(F.collect_list(F.struct("dense", "docs", "bits")).alias("planes"))
    return chunks.mapInArrow(merged, "a int, b int, docs long").groupBy("a", "b").agg(F.sum("docs").alias("documents"))


def _flags(bits: bytes, dense: bool) -> np.ndarray:
    if dense:
        return np.frombuffer(bits, np.uint8)
    flags = np.zeros(CHUNK_DOCS, bool)
    flags[np.frombuffer(bits, np.uint16)] = True
    return np.packbits(flags, bitorder="little")


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings back to documents: each bitmap adds its pair's count to its documents, 2**plane times.

    The rows come sorted by chunk; two counters for each document of one chunk are all that is held.
    """
    now, best, total = None, None, None

    def done() -> pa.RecordBatch:
        at = np.flatnonzero(total)
        arrays = [pa.array([now] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(best[at]), pa.array(total[at])]
        return pa.RecordBatch.from_arrays(arrays, ["chunk", "place", "n_best", "count_sum"])

    for batch in batches:
        chunks = batch.column("chunk").to_pylist()
        dense = batch.column("dense").to_numpy(zero_copy_only=False)
        factor = np.int64(1) << batch.column("plane").to_numpy().astype(np.int64)
        links = batch.column("links").to_numpy() * factor
        top = batch.column("best").to_numpy(zero_copy_only=False) * factor
        column = batch.column("bits")
        first = 0
        while first < len(chunks):
            last = first
            while last < len(chunks) and chunks[last] == chunks[first]:
                last += 1
            if chunks[first] != now:
                if now is not None:
                    yield done()
                now, best, total = chunks[first], np.zeros(CHUNK_DOCS, np.int64), np.zeros(CHUNK_DOCS, np.int64)
            some = np.arange(first, last)
            few = some[~dense[first:last]]
            if len(few):
                lists = column.take(pa.array(few))
                _, offsets, data = lists.buffers()
                bounds = np.frombuffer(offsets, np.int32, len(few) + 1, lists.offset * 4)
                docs = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]].view(np.uint16)
                size = np.diff(bounds) // 2
                np.add.at(total, docs, np.repeat(links[few], size))
                np.add.at(best, docs, np.repeat(top[few], size))
            for i in some[dense[first:last]]:
                docs = np.unpackbits(np.frombuffer(column[i].as_py(), np.uint8), bitorder="little").astype(bool)
                total[docs] += links[i]
                best[docs] += top[i]
            first = last
    if now is not None:
        yield done()


def align(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row of ``docs`` (doc_id, text).

    Both tokenizers encode space + text. Byte offsets where tokens of both end cut them into groups; the two
    tokens that end there are linked. Documents get a place in a chunk of bounded size and are inverted: for
    each pair of a chunk a compressed bitmap of its documents, in planes for repeated links. The bitmaps are
    popcounted to the pairs' counts; the lists then carry their pair's count back to their documents, a
    chunk in a task.

    Texts null, empty, or whose tokens do not spell space + text: zeros and ''. Repeated rows and null
    doc_ids are rows like others. An empty table gives no rows. Other columns are not looked at.
    """
    encoded = encode(docs, a_file, b_file)
    rows = encoded.where("a IS NULL").select(*NAMES[:8])
    counts = stored(pair_counts(encoded), "counts")
    lists = encoded.where("a IS NOT NULL").select("a", "b", "chunk", "plane", "dense", "bits")
    met = lists.join(counts, ["a", "b"]).select("chunk", "plane", "dense", "bits", "links", "best")
    scores = met.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_scored, SCORED)
    found = rows.join(scores, ["chunk", "place"], "left")
    return found.select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
        "groups_sha256",
    )


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(documents(spark, sf_dir).select("doc_id", "text"))

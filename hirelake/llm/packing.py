"""Best-fit packing of token sequences, planned on the histogram of lengths."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.common import documents, running_sum, spread_bits, stored

CAPACITY = 4096
TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Spans of text whose ids a task remembers; a bound on memory only.
REMEMBERED = 700_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLAN = "length long, first_rank long, last_rank long, first_sequence long, place long, in_sequence long"

_LOWER = {c: c + 32 for c in range(65, 91)}
_SPACE = re.compile("[ \t\n\r]+")
#: White space to Python's split() but not to the tokenizer.
_NO_SPACE = re.compile("[\x1c-\x1f]")
_STATE: dict = {}


def _lower(text: str) -> str:
    """Lower case as far as it is sure to be what the tokenizer's own normaliser would make."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text.translate(_LOWER)
    return text.lower()


def _byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    out, spare = [], 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174:
            out.append(chr(byte))
        else:
            out.append(chr(spare))
            spare += 1
    return out


def encoder(name: str):
    """Text -> ids as little-endian 32-bit bytes.

    The tokenizer drops white space and never joins what stands on both sides of it, so a text is the
    concatenation of its spans between blanks; spans seen before are looked up. A Latin word, with or
    without punctuation after it, goes straight to the tokenizer's merges, all else through the whole of it.
    What is remembered goes with the encoder: a worker lives on in later stages, which need the room.
    """
    import numpy as np

    tokenizer = _tokenizer(name)
    merges = tokenizer.model
    letters = _byte_letters()
    known: dict[str, bytes] = {}

    tails: dict[str, bytes] = {}

    def packed(word: str) -> bytes:
        if not word.isascii():
            word = "".join([letters[b] for b in word.encode()])
        got = [token.id for token in merges.tokenize(word)]
        return struct.pack(f"<{len(got)}I", *got)

    def learn(spans: set[str]) -> None:
        if len(known) + len(spans) > REMEMBERED:
            known.clear()
            tails.clear()
        rest = []
        for span in spans:
            word = span.rstrip(".,;:!?")
            if not word.isalpha() or not _is_latin(word):
                rest.append(span)
                continue
            ids = known.get(word) or packed(word)
            if word != span:
                ids += tails.get(tail := span[len(word) :]) or tails.setdefault(tail, packed(tail))
            known[span] = ids
        for at in range(0, len(rest), 4096):
            some = rest[at : at + 4096]
            for span, got in zip(some, tokenizer.encode_batch(some, add_special_tokens=False), strict=True):
                known[span] = np.array(got.ids, "<u4").tobytes()

    def encode(texts: list[str]) -> Iterator[bytes]:
        split = [_SPACE.split(t) if _NO_SPACE.search(t) else t.split() for t in map(_lower, texts)]
        at = 0
        while at < len(split):  # as many texts as have half of REMEMBERED spans, or one
            end, spans = at, 0
            while end < len(split) and (end == at or spans + len(split[end]) <= REMEMBERED // 2):
                spans += len(split[end])
                end += 1
            new = set().union(*split[at:end]).difference(known)
            if new:
                learn(new)
            for text in split[at:end]:
                try:
                    got = b"".join([known[span] for span in text])
                except KeyError:  # forgotten when room was made
                    learn(set(text).difference(known))
                    got = b"".join([known[span] for span in text])
                yield got
            at = end

    return encode


def _tokenizer(name: str):
    """Read once by each worker."""
    if name not in _STATE:
        import os

        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _STATE[name] = Tokenizer.from_file(public_tokenizers.path(name))
    return _STATE[name]


def _is_latin(word: str) -> bool:
    try:
        word.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return word == word.lower()


def tokenised(batches: Iterator[pa.RecordBatch], tokenizer: str, capacity: int) -> Iterator[pa.RecordBatch]:
    encode = encoder(tokenizer)
    end = END_ID.to_bytes(4, "little")
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        for at in range(0, batch.num_rows, 256):
            ids = batch.column("doc_id").slice(at, 256).to_pylist()
            texts = pc.fill_null(batch.column("text").slice(at, 256), "").to_pylist()
            for doc, got in zip(ids, encode(texts), strict=True):
                got += end
                n = len(got) // 4
                for piece, start in enumerate(range(0, n, capacity)):
                    part = got[4 * start : 4 * (start + capacity)]
                    for column, value in zip(out, (doc, piece, start, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        names = ("doc_id", "piece", "start", "length", "ids_crc32")
        del batch  # else it is there while the next one comes
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each text's ids and the end id, cut at ``capacity``."""

    def run(batches):
        return tokenised(batches, tokenizer, capacity)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, PIECES)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit over counts: longest lengths first, each into the open sequences with the least room that
    still take it, else into new ones. Sequences with equal room and history are one group with a first
    number and a count, so the work depends on the distinct lengths, not on the documents.

    Rows: pieces of ``length`` with ranks first_rank .. last_rank stand at ``place`` and after, in_sequence
    to a sequence, from first_sequence on.
    """
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r: there are sequences with room r
    made = 0
    out = []
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            fits = open_rooms >> length
            if fits:
                r = length + (fits & -fits).bit_length() - 1
                first, count = room[r].pop()
                if not room[r]:
                    open_rooms &= ~(1 << r)
            else:
                each = capacity // length
                r, first, count = capacity, made, -(-left // each)
                made += count
            each = r // length
            whole = min(count, left // each)
            if whole:
                out.append((length, rank, rank + whole * each - 1, first, capacity - r, each))
                rank, left = rank + whole * each, left - whole * each
                _open(room, r - each * length, first, whole)
                open_rooms |= _bit(r - each * length)
                first, count = first + whole, count - whole
            if count and left:  # fewer than a sequence takes
                out.append((length, rank, rank + left - 1, first, capacity - r, each))
                _open(room, r - left * length, first, 1)
                open_rooms |= _bit(r - left * length)
                left, first, count = 0, first + 1, count - 1
            if count:
                _open(room, r, first, count)
                open_rooms |= _bit(r)
    return out


def _bit(r: int) -> int:
    return 1 << r if r else 0


def _open(room: list[list[tuple[int, int]]], r: int, first: int, count: int) -> None:
    if r:
        room[r].append((first, count))


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` with sequence_id and offset: where each piece stands.

    The histogram (at most ``capacity`` rows) is planned on the driver. A piece's rank among those of its
    length is its rank in a hash bucket plus the pieces of the buckets before, so no length, however
    frequent, meets in one task; (length, rank) then joins the plan, of a few rows a length.

    Works on ``doc_id, piece, start, length, ids_crc32``. Repeated rows and null doc_ids are packed like
    any others; a null or empty text is the end id alone; an empty table gives no rows.
    """
    spark = parts.sparkSession
    parts = stored(parts, "pieces")
    counts = {r[0]: r[1] for r in parts.groupBy("length").count().collect()}
    rows = plan(counts, capacity)
    if not rows:
        return parts.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    bits = spread_bits(sum(counts.values()))
    salted = parts.withColumn("bucket", F.shiftright(F.xxhash64("doc_id", "piece"), 64 - bits)).withColumn("one", F.lit(1))
    order = [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")]
    ranked = running_sum(salted, "length", "bucket", order, "one", "rank")
    slots = F.broadcast(spark.createDataFrame(rows, PLAN))  # bounded by the distinct lengths
    at = F.col("rank") - F.col("first_rank")
    return (
        ranked.join(slots, "length")
        .where(F.col("rank").between(F.col("first_rank"), F.col("last_rank")))
        .select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("first_sequence") + F.floor(at / F.col("in_sequence"))).cast("long").alias("sequence_id"),
            (F.col("place") + at % F.col("in_sequence") * F.col("length")).cast("long").alias("offset"),
        )
    )


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(documents(spark, sf_dir)))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the place of each piece."""
    return pack(pieces(docs))

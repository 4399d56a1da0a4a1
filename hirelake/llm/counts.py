"""Token counts that follow edits: a segment tree of pre-tokens for each document."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.common import documents

TOKENIZER = "byte_bpe_50k.tiktoken"
#: Pre-tokens of a leaf, and pre-tokens whose counts a worker remembers (a bound on memory only).
LEAF, REMEMBERED = 64, 400_000
#: Characters behind a pre-token that its end can depend on.
CONTEXT = 2
RESULT = (
    "doc_id long, n_tokens long, n_pretokens long, n_edits int, edited_chars long, edited_tokens long, reencoded long"
)
_STATE: dict = {}


def counter(name: str):
    """(pattern, counts): cuts a text into pre-tokens; the token count of each of a list of them."""
    if name not in _STATE:
        import base64

        import public_tokenizers
        import regex
        import tiktoken

        with open(public_tokenizers.path(name), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        known: dict[str, int] = {}

        def counts(parts: list[str]) -> list[int]:
            try:
                return [known[p] for p in parts]
            except KeyError:
                new = set(parts).difference(known)
                if len(known) + len(new) > REMEMBERED:
                    known.clear()
                    new = set(parts)
                for part in new:
                    known[part] = len(encoding.encode_ordinary(part))
                return [known[p] for p in parts]

        _STATE[name] = regex.compile(public_tokenizers.PATTERN), counts
    return _STATE[name]


class CountTree:
    """The pre-tokens of a text in leaves, under a tree of sums of characters and tokens.

    Whether a pre-token ends where it does depends on its own characters and the CONTEXT next ones (a blank
    before a word, an apostrophe before "re"). So an edit leaves all pre-tokens alone that end further before
    it; cutting starts anew at the first other one and stops as soon as, behind the edit, it meets an old
    boundary, from where on nothing changes.
    """

    def __init__(self, text: str, tokenizer: str = TOKENIZER):
        self.pattern, self.counts = counter(tokenizer)
        parts = self.pattern.findall(text)
        counts = self.counts(parts)
        self.n_pretokens = len(parts)
        self.leaves = [parts[i : i + LEAF] for i in range(0, len(parts), LEAF)] or [[]]
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        self.chars = [0] * (2 * self.size)
        self.tokens = [0] * (2 * self.size)
        for i, leaf in enumerate(self.leaves):
            self.chars[self.size + i] = sum(map(len, leaf))
            self.tokens[self.size + i] = sum(counts[i * LEAF : i * LEAF + len(leaf)])
        for node in range(self.size - 1, 0, -1):
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]
        self.reencoded = 0

    def _leaf(self, at: int) -> tuple[int, int]:
        """The first leaf that ends at or behind character ``at`` and is not empty, and where it starts."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if start + self.chars[node] < at or not self.chars[node]:
                start += self.chars[node]
                node += 1
        return min(node - self.size, len(self.leaves) - 1), start

    def _set(self, i: int, leaf: list[str], tokens: int) -> None:
        self.leaves[i] = leaf
        node = self.size + i
        self.chars[node], self.tokens[node] = sum(map(len, leaf)), tokens
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def edit(self, at: int, drop: int, put: str) -> None:
        """Characters at .. at + drop give way to ``put``; places beyond the text mean its end."""
        total = self.chars[1]
        at = min(max(at, 0), total)
        end = min(at + max(drop, 0), total)
        if at == end and not put:
            return
        safe = at - CONTEXT + 1
        first, start = self._leaf(safe)
        head, begin = [], start  # what stays of the first leaf
        for part in self.leaves[first]:
            if begin + len(part) >= safe:
                break
            head.append(part)
            begin += len(part)
        old = self.leaves[first][len(head) :]
        last, stop = first, start + self.chars[self.size + first]
        while True:
            while stop < end + CONTEXT and last + 1 < len(self.leaves):
                last += 1
                old = old + self.leaves[last]
                stop += self.chars[self.size + last]
            whole = "".join(old)
            text = whole[: at - begin] + put + whole[end - begin :]
            shift = len(put) - (end - at)
            bounds, place = {}, begin
            for i, part in enumerate(old):
                bounds[place] = i
                place += len(part)
            new, done, meets = [], 0, None
            for match in self.pattern.finditer(text):
                here = begin + match.start() - shift
                sure = last + 1 == len(self.leaves) or match.start() + CONTEXT <= len(text)
                if sure and match.start() >= at - begin + len(put) and here in bounds and here >= end:
                    meets = bounds[here]
                    break
                new.append(match[0])
                done = match.end()
            if meets is not None or last + 1 == len(self.leaves):
                break
            end_of = stop  # no old boundary met: take another leaf in
            last += 1
            old = old + self.leaves[last]
            stop = end_of + self.chars[self.size + last]
        tail = old[meets:] if meets is not None else []
        fresh = self.counts(new)
        self.reencoded += len(new)
        kept = self.counts(head) + fresh + self.counts(tail)
        self._set(first, head + new + tail, sum(kept))
        for i in range(first + 1, last + 1):
            self._set(i, [], 0)


def _counted(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in RESULT.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    for batch in batches:
        out = []
        columns = (batch.column(c) for c in ("doc_id", "text", "edits"))
        for doc, text, edits in zip(*columns, strict=True):
            tree = CountTree(text.as_py() or "", tokenizer)
            before, todo = tree.tokens[1], [e for e in edits.as_py() or () if e]
            for e in todo:
                tree.edit(e["at"] or 0, e["drop"] or 0, e["put"] or "")
            out.append((doc.as_py(), before, tree.n_pretokens, len(todo), tree.chars[1], tree.tokens[1], tree.reencoded))
        values = zip(*out, strict=True) if out else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)


def count_edited(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Token counts of each text before and after its edits, and the pre-tokens encoded for the edits.

    ``docs``: doc_id, text, edits (array of at, drop, put; each meant for the text as the ones before left
    it). Places are in code points. No shuffle; a task holds one document's tree at a time.

    Null text: empty, no tokens. Null edits, and null entries, are no edits; null fields are 0 or empty.
    Repeated rows, null doc_ids and an empty table are counted as they are. Other columns are not looked at.
    """
    kind = "array<struct<at:int,drop:int,put:string>>"
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("edits").cast(kind).alias("edits"),
    )
    return rows.mapInArrow(lambda it: _counted(it, tokenizer), RESULT)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under three edits: 40 characters at a third give way to the first 30 in capitals, the
    last 60 are put in at a half, 25 characters at three quarters go."""
    n = F.char_length("text")

    def edit(at, drop, put):
        return F.struct(at.cast("int").alias("at"), F.lit(drop).alias("drop"), put.alias("put"))

    edits = F.array(
        edit(n / 3, 40, F.upper(F.substring("text", 1, 30))),
        edit(n / 2, 0, F.expr("right(text, 60)")),
        edit(n * 3 / 4, 25, F.lit("")),
    )
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return count_edited(docs.withColumn("edits", edits))

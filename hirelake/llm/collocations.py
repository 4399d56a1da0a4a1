"""Phrase collocations: longest windows counted once, shorter phrases as ROLLUP sums of their prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelake.llm.common import Hashes, documents, lowered, mix, runs, stored, text_slices

#: Longest phrase, least count of a candidate, phrases reported for a language, share in hundredths that makes a
#: longer phrase replace a shorter one, and factor of the score.
LONGEST, LEAST, TOP, COVER, FACTOR = 4, 30, 2000, 80, 2_000_000
#: Bytes of texts taken at a time, and words and word pairs that a task sums before it hands them on.
PART, HELD = 1 << 20, 2 << 20
#: Bits of the table of frequent words and pairs, by their number; it has 2**MOST_BITS at most.
BITS_EACH, LEAST_BITS, MOST_BITS, BLOCK_BITS = 16, 18, 28, 15

COLUMNS = [f"w{i}" for i in range(1, LONGEST + 1)]
WINDOWS = ", ".join(["lang string", *[f"{c} string" for c in COLUMNS], "c long"])
_PIECE_ENDS = np.zeros(256, bool)
_PIECE_ENDS[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
_BLANKS = np.zeros(256, bool)
_BLANKS[list(b" \t")] = True


class Words:
    """The words of several texts: their bytes, hashes with the language, and whether the next word is in one piece with them."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, langs: np.ndarray):
        low = lowered(data)
        ends = _PIECE_ENDS[low]
        inside = ~(ends | _BLANKS[low])
        self.start, self.end, text = runs(inside, bounds)
        self.low, self.inside = low, inside
        self.text = text
        self.hash = mix(Hashes(low, 3).spans(self.start, self.end) + langs[text])
        crossed = np.concatenate(([0], np.cumsum(ends)))
        self.next = np.zeros(len(text), bool)
        if len(text) > 1:
            self.next[:-1] = (text[1:] == text[:-1]) & (crossed[self.start[1:]] == crossed[self.end[:-1]])

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, hash) of each run of ``size`` words in one piece; the hash stands for the language as well."""
        count = max(0, len(self.hash) - size + 1)
        inside, out = np.ones(count, bool), self.hash[:count]
        for lead in range(1, size):
            inside &= self.next[lead - 1 : lead - 1 + count]
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + mix(self.hash[lead : lead + count]))
        place = np.flatnonzero(inside)
        return place, out[place]

    def strings(self) -> pa.DictionaryArray:
        sizes = self.end - self.start
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        kept = self.low[self.inside]
        column = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(kept))
        return column.dictionary_encode()


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, Words]]:
    """(languages of the rows, words) of the rows of a batch, part by part."""
    langs = batch.column("lang").to_pylist()
    seeds = np.array([xxhash.xxh64_intdigest(lang) for lang in langs], np.uint64)
    names = np.array(langs, object)
    for first, last, data, bounds in text_slices(batch.column("text"), PART):
        yield names[first:last], Words(data, bounds, seeds[first:last])


class Table:
    """A bit for each hash that may be frequent."""

    def __init__(self, flags: np.ndarray, bits: int):
        self.flags, self.bits = flags, bits

    def has(self, hashes: np.ndarray) -> np.ndarray:
        cell = hashes >> np.uint64(64 - self.bits)
        return self.flags[(cell >> np.uint64(3)).astype(np.int64)] >> (7 - (cell & np.uint64(7))).astype(np.uint8) & 1 == 1


def _starts(words: Words, size: int, tables: list[Table]) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the runs of ``size`` words that the tables of shorter runs let through.

    The first table holds words and pairs, the next ones longer runs: whatever is frequent has frequent parts.
    """
    place, hashes = words.grams(size)
    if size > 2 and len(place):
        known = np.zeros(len(words.start), bool)
        parts, part_hash = words.grams(size - 1)
        known[parts] = tables[size - 3].has(part_hash)
        kept = known[place] & known[place + 1]
        place, hashes = place[kept], hashes[kept]
    return place, hashes


def _short_counts(batches: Iterator[pa.RecordBatch], sizes: tuple[int, ...], tables: list[Table]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []

    def summed() -> pa.RecordBatch:
        short, count = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(short.view(np.int64)), pa.array(count)], ["short", "c"])

    for batch in batches:
        for _, words in _parts(batch):
            held += [_starts(words, size, tables)[1] for size in sizes]
            if sum(map(len, held)) >= HELD:
                yield summed()
                held = []
    if held:
        yield summed()


def _blocks(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    flags: dict[int, np.ndarray] = {}
    for batch in batches:
        cells = batch.column("short").to_numpy().view(np.uint64) >> np.uint64(64 - bits)
        for block in np.unique(cells >> np.uint64(BLOCK_BITS)).tolist():
            mine = cells[cells >> np.uint64(BLOCK_BITS) == block] & np.uint64((1 << BLOCK_BITS) - 1)
            flags.setdefault(block, np.zeros(1 << BLOCK_BITS, bool))[mine.astype(np.int64)] = True
    for block, own in flags.items():
        yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([np.packbits(own).tobytes()])], ["block", "bits"])


def frequent(rows: DataFrame, least: int, sizes: tuple[int, ...], tables: list[Table]) -> Table:
    """A table of the runs of ``sizes`` words that stand ``least`` times in a language.

    A run that is not in the table is no part of any candidate. The table has BITS_EACH bits for each entry,
    up to 2**MOST_BITS (32 MB); a fuller table lets more through and changes no result.
    """
    sent = rows.sparkSession.sparkContext.broadcast(tables)  # 2**MOST_BITS bits a table at most
    counted = rows.mapInArrow(lambda it: _short_counts(it, sizes, sent.value), "short long, c long")
    counts = counted.groupBy("short").agg(F.sum("c").alias("c"))
    often = stored(counts.where(F.col("c") >= least).select("short"), "frequent")
    bits = min(MOST_BITS, max(LEAST_BITS, (often.count() * BITS_EACH).bit_length()))
    spread = often.repartition(F.shiftrightunsigned("short", 64 - bits + BLOCK_BITS))
    flags = np.zeros(1 << (bits - 3), np.uint8)
    size = 1 << (BLOCK_BITS - 3)
    for block, own in spread.mapInArrow(lambda it: _blocks(it, bits), "block long, bits binary").toLocalIterator():
        flags[block * size : (block + 1) * size] |= np.frombuffer(own, np.uint8)
    return Table(flags, bits)


def _windows(batches: Iterator[pa.RecordBatch], tables: list[Table]) -> Iterator[pa.RecordBatch]:
    """Each word with the LONGEST - 1 words that lead it, counted; null from the first run on that is not frequent."""
    names = WINDOWS.replace(" string", "").replace(" long", "").split(", ")
    for batch in batches:
        for langs, words in _parts(batch):
            n = len(words.start)
            if not n:
                continue
            strings = words.strings()
            ids = strings.indices.to_numpy()
            kinds, lang = np.unique(langs.astype(str), return_inverse=True)
            columns, goes_on = [lang[words.text].astype(np.int32)], np.ones(n, bool)
            for size in range(1, LONGEST + 1):
                place, hashes = _starts(words, size, tables)
                here = np.zeros(n, bool)
                here[place] = tables[max(0, size - 2)].has(hashes) if size < LONGEST else True
                goes_on &= here
                led = np.full(n, -1, np.int32)
                led[: n - size + 1] = np.where(goes_on[: n - size + 1], ids[size - 1 :], -1)
                columns.append(led)
            found = pa.table(columns, names=names[:-1]).group_by(names[:-1], use_threads=False).aggregate([([], "count_all")])
            arrays = [pa.array(kinds.tolist(), pa.string()).take(found.column("lang").combine_chunks())]
            for c in COLUMNS:
                place = found.column(c).combine_chunks().to_numpy()
                arrays.append(strings.dictionary.take(pa.array(place, mask=place < 0)))
            yield pa.RecordBatch.from_arrays([*arrays, found.column("count_all").combine_chunks()], names)


def phrase_counts(rows: DataFrame, least: int) -> DataFrame:
    """(lang, n_words, phrase, f): phrases that stand ``least`` times, and as n_words 0 the words of each language.

    Phrases are counted by the longest windows alone. ROLLUP gives every prefix the sum of its windows: of the
    first word, of the first two, and so on; each place of a phrase starts just one window. Most windows stand
    once, so before they are moved they are cut where they can be part of no candidate: tables of the hashes of
    frequent words and pairs, then of frequent runs of one word less than a window, say where.
    """
    tables: list[Table] = []
    for sizes in ((1, 2), *((size,) for size in range(3, LONGEST))):
        tables.append(frequent(rows, least, sizes, tables))
    sent = rows.sparkSession.sparkContext.broadcast(tables)  # 2**MOST_BITS bits a table at most
    windows = rows.mapInArrow(lambda it: _windows(it, sent.value), WINDOWS)
    longest = windows.groupBy("lang", *COLUMNS).agg(F.sum("c").alias("c"))
    sums = longest.rollup("lang", *COLUMNS).agg(F.sum("c").alias("f"), F.grouping_id().alias("gid"))
    # grouping_id has a bit for each column that is summed over: 2**k - 1 for the last k
    n_words = F.lit(LONGEST).cast("int") - F.bit_count("gid").cast("int")
    last = F.when(n_words <= 0, F.lit("")).otherwise(F.element_at(F.array(*COLUMNS), F.greatest(n_words, F.lit(1))))
    whole = sums.where(F.col("gid") < (1 << LONGEST)).withColumn("n_words", n_words).where(last.isNotNull())
    return whole.where((F.col("f") >= least) | (F.col("n_words") == 0)).select(
        "lang", "n_words", F.concat_ws(" ", *COLUMNS).alias("phrase"), "f"
    )


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, cover: int = COVER, factor: int = FACTOR) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, cut): the best phrases of two to LONGEST words of each language.

    ``docs`` has text and lang. Texts are cut into pieces at ``.,;:!?`` and line ends and these into words at
    blanks and tabs, A-Z as a-z. A phrase of ``a`` places is cut in two where floor(factor * a / (l + r)) is
    least, with l and r the places of its parts; ties go to the first cut. A phrase inside of a longer one with
    ``cover`` hundredths of its places goes. Ranks follow score, a, and phrase in byte order.

    Null text: empty. Null lang: ``und``, together with rows that say so. Repeated rows count again. Texts
    without words and an empty table give no rows. Other columns are not looked at.
    """
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")
    )
    found = stored(phrase_counts(rows, least), "phrases")
    phrases = found.where("n_words > 0").select("lang", "n_words", "phrase", "f")
    candidates = phrases.where("n_words > 1").withColumn("w", F.split("phrase", " "))

    def joined(first, size):
        return F.array_join(F.slice("w", first, size), " ")

    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), "n_words", "w", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("cut"))
    cuts = cuts.withColumn("left", joined(F.lit(1), F.col("cut"))).withColumn("right", joined(F.col("cut") + 1, F.col("n_words") - F.col("cut")))
    left = phrases.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    wide = "decimal(20,0)"
    score = F.expr(f"(cast({factor} as decimal(12,0)) * cast(a as {wide})) div (cast(l as {wide}) + cast(r as {wide}))")
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", score)
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))

    starts = F.sequence(F.lit(1), F.col("n_words") - F.col("size") + 1)
    inner = (
        candidates.where("n_words > 2")
        .select("lang", "f", "w", "n_words", F.explode(F.sequence(F.lit(2), F.col("n_words") - 1)).alias("size"))
        .select("lang", "f", F.explode(F.transform(starts, lambda at: joined(at, F.col("size")))).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("longer"))
    )
    covered = F.lit(100) * F.col("longer").cast(wide) >= F.lit(cover) * F.col("a").cast(wide)
    kept = best.join(inner, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False)))
    words = found.where("n_words = 0").select("lang", F.col("f").alias("n"))  # a row for each language
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        "phrase",
        "a",
        F.col("best.l").alias("l"),
        F.col("best.r").alias("r"),
        "n",
        F.col("best.score").alias("score"),
        F.col("best.cut").alias("cut"),
    )


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir).select("text", "lang")).drop("cut")


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
phrases AS (
  SELECT lang, array_to_string(w[i : i + k - 1], ' ') AS phrase, k, count(*) AS f
  FROM places, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM phrases WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM phrases WHERE k > 1 AND f >= 30),
cuts AS (SELECT lang, phrase, a, k, w, unnest(range(1, k)) AS cut FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r,
    CAST((2000000 * CAST(c.a AS HUGEINT)) // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM cuts c
  JOIN phrases x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : c.cut], ' ')
  JOIN phrases y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1 : c.k], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM (
      SELECT lang, a AS longer, array_to_string(w[s : s + z - 1], ' ') AS part
      FROM candidates, (SELECT unnest([1, 2]) AS s), (SELECT unnest([2, 3]) AS z) WHERE z < k AND s + z - 1 <= k
      UNION ALL
      SELECT lang, a, array_to_string(w[3 : 4], ' ') FROM candidates WHERE k = 4) p
    WHERE p.lang = b.lang AND p.part = b.phrase AND 100 * CAST(p.longer AS HUGEINT) >= 80 * CAST(b.a AS HUGEINT)))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""
